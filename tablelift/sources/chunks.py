"""Chunk bounds over a key, and the predicates that scan one chunk each."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


def _div(a: Column, b: Column) -> Column:
    # Whole-number division: keys beyond 2^53 keep all their digits.
    return F.call_function("div", a, b)


def _ends(df: DataFrame, key: str, n: int) -> tuple[Column, Column]:
    """First key and chunk width, as scalar subqueries over the key column alone."""
    lo, hi = F.min(key).cast("long"), F.max(key).cast("long")
    width = F.greatest(F.lit(1).cast("long"), _div(hi - lo + n, F.lit(n).cast("long")))
    ends = df.agg(lo.alias("lo"), width.alias("width"))
    return ends.select("lo").scalar(), ends.select("width").scalar()


def with_chunk(df: DataFrame, key: str, n: int) -> DataFrame:
    """Add the chunk number of every row: ``n`` key ranges of equal width.

    Rows without a key belong to chunk 0.
    """
    lo, width = _ends(df, key, n)
    return df.withColumn("chunk_id", F.coalesce(_div(F.col(key).cast("long") - lo, width), F.lit(0)))


def with_bounds(chunks: DataFrame, df: DataFrame, key: str, n: int) -> DataFrame:
    """Add the first key of each chunk and the key after its last one."""
    lo, width = _ends(df, key, n)
    first = lo + F.col("chunk_id") * width
    return chunks.withColumns({"lo": first, "hi": first + width})


def chunk_bounds(df: DataFrame, key: str, n: int) -> DataFrame:
    """(chunk_id, lo, hi, rows) of the non-empty chunks; ``hi`` is exclusive."""
    if n < 1:
        raise ValueError("n must be at least 1")
    keys = df.select(key)
    counts = with_chunk(keys, key, n).groupBy("chunk_id").agg(F.count(F.lit(1)).alias("rows"))
    return with_bounds(counts, keys, key, n).select("chunk_id", "lo", "hi", "rows")


def balanced_cuts(df: DataFrame, key: str, n: int) -> list:
    """Up to ``n - 1`` cut points that split the rows evenly, for keys with gaps or skew.

    The quantile sketch merges map-side; only the cut points reach the driver.
    Cuts are approximate, the chunks they give are still complete and disjoint.
    """
    if n < 2:
        return []
    at = F.percentile_approx(key, [i / n for i in range(1, n)], 10_000)
    cuts = df.agg(at.alias("cuts")).first()["cuts"] or []
    return sorted(set(cuts))


def range_predicates(key: str, cuts: Sequence[object]) -> list[str]:
    """Disjoint SQL predicates that together match every row, NULL keys included."""
    if not cuts:
        return ["1=1"]
    texts = [_literal(c) for c in cuts]
    first = f"({key} < {texts[0]} OR {key} IS NULL)"
    middle = [f"({key} >= {a} AND {key} < {b})" for a, b in zip(texts, texts[1:])]
    return [first, *middle, f"({key} >= {texts[-1]})"]


def _literal(value: object) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value}'"
    return f"DATE '{value}'" if isinstance(value, date) else str(value)


def split_predicates(predicates: Sequence[str], salt: str, ways: int) -> list[str]:
    """Cut every chunk ``ways`` times by a numeric source expression.

    For keys on which one value holds a large part of the rows: no key range can
    divide such a value, a hash of the row address can. Rows whose salt is NULL or
    negative are matched too, and every row exactly once.
    """
    if ways < 2:
        return list(predicates)
    part = f"COALESCE(MOD(ABS({salt}), {ways}), 0)"
    tests = [f"{part} = {i}" for i in range(ways - 1)]
    tests.append(f"{part} NOT IN ({', '.join(map(str, range(ways - 1)))})")
    return [f"({p}) AND {t}" for p in predicates for t in tests]


def chunk_of(predicates: Sequence[str]) -> Column:
    """The number of the predicate that matches a row: all chunks in one scan."""
    out = F.when(F.expr(predicates[0]), F.lit(0).cast("long"))
    for i, p in enumerate(predicates[1:], 1):
        out = out.when(F.expr(p), F.lit(i).cast("long"))
    return out


@dataclass(frozen=True)
class Chunk:
    """A part of a table that is read, written and restarted by itself.

    ``predicate`` is SQL of the source, ``files`` are paths of a file source; ``rows`` is how many rows the source says
    the part has, None where it does not say.
    """

    chunk_id: int
    predicate: str | None = None
    files: tuple[str, ...] = ()
    rows: int | None = None


def ledger_query(relation: str, key: str, n: int, where: str | None = None) -> str:
    """Source query of at most ``n`` key ranges of about even row count, in the source's own order.

    One row for each range: its number B, its first key LO, its rows N, and whether LO lies strictly above the range
    before (RISES). Ranges are cut by rank, so keys that the source holds equal (in its collation) are never parted. Range -1
    holds the rows without a key.
    """
    side = f"CASE WHEN {key} IS NULL THEN 1 ELSE 0 END"
    cut = f"FLOOR((RANK() OVER (PARTITION BY {side} ORDER BY {key}) - 1) * {n} / COUNT(*) OVER (PARTITION BY {side}))"
    rows = f"SELECT {key} AS K, CASE WHEN {key} IS NULL THEN -1 ELSE {cut} END AS B FROM {relation}{f' WHERE ({where})' if where else ''}"
    ranges = f"SELECT B, MIN(K) AS LO, COUNT(*) AS N FROM ({rows}) x GROUP BY B"
    before = "LAG(LO) OVER (ORDER BY B)"
    return f"(SELECT B, LO, N, CASE WHEN {before} IS NULL OR {before} < LO THEN 1 ELSE 0 END AS RISES FROM ({ranges}) y) z"


def ledger_chunks(key: str, ledger: Iterable[Row]) -> list[Chunk]:
    """Chunks of a ledger's rows, ordered by range number alone: the client never compares keys.

    The first chunk also takes rows without a key. A ledger whose bounds do not rise in the source is refused: ordering and
    comparison differ there, so ranges could overlap.
    """
    rows = sorted(ledger, key=lambda r: r["B"])
    flat = [r["LO"] for r in rows if not r["RISES"]]
    if flat:
        raise ValueError(f"{key} cannot cut the table: the source orders keys otherwise than it compares them, at {flat[0]!r}")
    without = sum(int(r["N"]) for r in rows if r["LO"] is None)
    keyed = [r for r in rows if r["LO"] is not None]
    counts = [int(r["N"]) for r in keyed] or [0]
    counts[0] += without
    predicates = range_predicates(key, [r["LO"] for r in keyed[1:]])
    return [Chunk(i, p, rows=n) for i, (p, n) in enumerate(zip(predicates, counts))]


def salted_chunks(chunks: Sequence[Chunk], salt: str, n: int) -> list[Chunk]:
    """Cut the chunks that hold more than twice an even share of the rows, each by the salt into even shares."""
    total = sum(c.rows or 0 for c in chunks)
    out: list[Chunk] = []
    for c in chunks:
        ways = -(-(c.rows or 0) * n // total) if total else n
        parts = split_predicates([c.predicate], salt, ways) if ways > 2 or len(chunks) == 1 else [c.predicate]
        out += [Chunk(len(out) + i, p, rows=c.rows if len(parts) == 1 else None) for i, p in enumerate(parts)]
    return out


def key_ledger(df: DataFrame, key: str, n: int, sample: int = 10_000) -> list[Chunk]:
    """Chunks of a table that Spark itself reads, by any key Spark can order, collated text included.

    Bounds come from a sample of at most ``sample`` keys, the rows of least hash, ordered under the key's own
    collation; then the rows of every range are counted over the whole table, as sums that combine before the
    shuffle. Only bounds and counts reach the driver.
    """
    name = "`" + key.replace("`", "``") + "`"
    picked = df.where(F.col(name).isNotNull()).select(F.col(name).alias("K")).orderBy(F.xxhash64(*[c for c in df.columns if not _nested(df, c)]), "K").limit(sample)
    picked.createOrReplaceTempView("__keys")
    try:
        ledger = df.sparkSession.sql(f"SELECT * FROM {ledger_query('__keys', 'K', n)}").collect()
    finally:
        df.sparkSession.catalog.dropTempView("__keys")
    chunks = ledger_chunks(name, ledger)
    counts = dict(df.groupBy(chunk_of([c.predicate for c in chunks]).alias("c")).count().collect())
    return [replace(c, rows=counts.get(c.chunk_id, 0)) for c in chunks]


def _nested(df: DataFrame, name: str) -> bool:
    return "map<" in df.schema[name].dataType.simpleString()


def even_chunks(files: Iterable[tuple[str, int, int | None]], n: int) -> list[Chunk]:
    """Files (path, bytes, rows) as at most ``n`` chunks of about even bytes, in order of their paths.

    A file is never cut: within a chunk Spark splits large files itself.
    """
    files = sorted(files)
    total, before = sum(max(1, size) for _, size, _ in files), 0
    groups: dict[int, list[tuple[str, int, int | None]]] = {}
    for f in files:
        size = max(1, f[1])
        groups.setdefault((2 * before + size) * n // (2 * total), []).append(f)
        before += size
    return [
        Chunk(i, files=tuple(p for p, _, _ in group), rows=None if any(r is None for _, _, r in group) else sum(r for _, _, r in group))
        for i, (_, group) in enumerate(sorted(groups.items()))
    ]
