"""Fidelity checks: table statistics, reconciliation and row differences."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from decimal import Context, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.functions.text import exact_micros, plain_decimal, quoted
from tablelift.operators.project import field_type
from tablelift.operators.rowhash import key_hash_total
from tablelift.plans.spec import ROW_HASH, SUMMED_TARGETS, TableSpec

ROW_COUNT, PK_HASH, SUM = "ROW_COUNT", "PK_HASH", "SUM"
NON_NULL, HASH_MISMATCHES = "NON_NULL", "HASH_MISMATCHES"

# Floating numbers that are no whole millionths are added in four bands of 50 binary orders, by their smallest
# exponent: 2.3e-13 to 256, to 2.9e17, to 3.2e32, to 3.6e47. In units of 2**(smallest - 52) such a number is a whole number below
# 2**102, which two 64-bit parts hold exactly; the parts are added apart.
_BANDS = (-42, 8, 58, 108)
_WIDTH, _HALF = 50, 2.0**40
# Bits of the lower part of millionths.
_MICROS_BITS = 26
_BEYOND, _NAN, _INF, _NEGATIVE_INF = range(len(_BANDS), len(_BANDS) + 4)

# Prefixes of the columns that sums of written and of source values are made of.
WRITTEN, SOURCE = "__w", "__s"


def summed_columns(df: DataFrame, spec: TableSpec) -> list[str]:
    have = {f.name.lower() for f in df.schema}
    return [
        c.name for c in spec.columns if c.target_type in SUMMED_TARGETS and c.name.lower() in have
    ]


def _floating(have: T.DataType, spark_type: str | None = None) -> bool:
    """Whether a column is added as floating numbers; text is where it becomes one."""
    if isinstance(have, T.StringType):
        return spark_type == "double"
    return not isinstance(have, (T.IntegralType, T.DecimalType))


def with_parts(df: DataFrame, columns: Sequence[tuple[str, str | None]], prefix: str) -> DataFrame:
    """Add what the sums of floating columns (name, target Spark type or None) are made of.

    Whole millionths ``m``; else the band ``b`` and the upper and lower part ``u`` and ``l`` in that band's units.
    Beyond the bands ``u`` is a hash. Worked out once per value, so that the aggregates stay small.
    """
    names = [(f"{prefix}{i}", name) for i, (name, kind) in enumerate(columns) if _floating(field_type(df.schema, name), kind)]
    if not names:
        return df

    def number(name: str) -> Column:
        return quoted(name) if isinstance(field_type(df.schema, name), T.DoubleType) else quoted(name).try_cast("double")

    def band(x: Column) -> Column:
        size = F.abs(x)
        found = F.when(F.isnan(x), _NAN).when(x == float("inf"), _INF).when(x == float("-inf"), _NEGATIVE_INF).when(size < 2.0 ** _BANDS[0], _BEYOND)
        for k, low in enumerate(_BANDS):
            found = found.when(size < 2.0 ** (low + _WIDTH), k)
        return found.otherwise(_BEYOND)

    # Powers of two scale without rounding.
    scale = F.array(*[F.lit(2.0 ** (12 - low)) for low in _BANDS])
    out = df.withColumns({f"{p}m": exact_micros(number(n)) for p, n in names})
    out = out.withColumns({f"{p}b": F.when(F.col(f"{p}m").isNull() & number(n).isNotNull(), band(number(n))) for p, n in names})
    parts = {}
    for p, n in names:
        scaled = number(n) * F.get(scale, F.col(f"{p}b"))
        parts[f"{p}u"] = F.when(F.col(f"{p}b") == _BEYOND, F.xxhash64(number(n))).when(F.col(f"{p}b") < len(_BANDS), F.floor(scaled))
        parts[f"{p}l"] = F.when(F.col(f"{p}b") < len(_BANDS), ((scaled - F.floor(scaled).cast("double")) * F.lit(_HALF)).cast("long"))
    return out.withColumns(parts)


def _sum_of_parts(p: str) -> Column:
    """Aggregate: the exact sum of a floating column, as text, whatever the row order.

    Whole millionths, the usual case, make the first figure. Each band of other sizes adds two figures, whole
    numbers of its units, and what lies beyond all bands is counted: NaN, infinities, and the tiniest and hugest
    numbers with a total of their hashes. Nothing is rounded, and no value changes how the others are added.
    """
    def total(part: str, k: int) -> Column:
        return F.try_sum(F.when(F.col(f"{p}b") == k, F.col(f"{p}{part}")).cast("decimal(20,0)"))

    # Millionths are below 2**53: both parts add up as 64-bit numbers over 2**36 rows, much cheaper than decimals.
    m, split = F.col(f"{p}m"), 1 << _MICROS_BITS
    upper, lower = (F.try_sum(part).cast("decimal(20,0)") for part in (F.shiftright(m, _MICROS_BITS), m.bitwiseAND(F.lit(split - 1))))
    micros = (upper * F.lit(split) + lower).cast("decimal(30,0)")
    texts = [(micros / F.lit(1_000_000)).cast("decimal(38,6)").cast("string")]
    for k, low in enumerate(_BANDS):
        texts += [F.concat(total(part, k).cast("string"), F.lit(f" x 2^{unit}")) for part, unit in (("u", low - 12), ("l", low - 52))]
    for k, name in ((_BEYOND, "beyond"), (_NAN, "NaN"), (_INF, "Infinity"), (_NEGATIVE_INF, "-Infinity")):
        n = F.count(F.when(F.col(f"{p}b") == k, 1))
        mark = F.concat(F.lit(f" {name} "), total("u", k).cast("string")) if k == _BEYOND else F.lit(f" {name}")
        texts.append(F.when(n > 0, F.concat(n.cast("string"), mark)))
    return F.nullif(F.concat_ws(" + ", *texts), F.lit(""))


def _sum_text(df: DataFrame, i: int, name: str, kind: str | None, prefix: str) -> Column:
    """Aggregate: the sum of a numeric column as text, NULL where there is none. Text counts as the numbers it says."""
    have = field_type(df.schema, name)
    if _floating(have, kind):
        return _sum_of_parts(f"{prefix}{i}")
    if isinstance(have, T.StringType):
        return plain_decimal(F.try_sum(quoted(name).try_cast("decimal(38,18)")), 18)
    if isinstance(have, T.IntegralType):
        return F.try_sum(quoted(name).cast("decimal(20,0)")).cast("string")
    return plain_decimal(F.try_sum(quoted(name)), have.scale)


def present(c: Column, dtype: T.DataType, empty_is_null: bool = False) -> Column:
    """Aggregate: how many rows hold a value."""
    return F.count(F.nullif(c, F.lit("")) if empty_is_null and isinstance(dtype, T.StringType) else c)


def statistics(
    df: DataFrame, spec: TableSpec, with_pk_hash: bool, counts: bool = False, empty_is_null: bool = False
) -> list[tuple[str, str | None, Column]]:
    """(metric, column, aggregate) of every check; all fit in one pass over the rows of :func:`prepared`.

    ``counts`` adds how many values each column has, with ``empty_is_null`` for files that don't tell the empty
    text from NULL.
    """
    stats: list[tuple[str, str | None, Column]] = [
        (ROW_COUNT, None, F.count(F.lit(1)).cast("string"))
    ]
    if with_pk_hash and spec.pk_cols:
        stats.append((PK_HASH, None, key_hash_total(df.schema, spec.pk_cols).cast("string")))
    for i, name in enumerate(summed_columns(df, spec)):
        stats.append((SUM, name, _sum_text(df, i, name, None, WRITTEN)))
    if counts:
        for c in spec.physical:
            found = present(quoted(c.name), field_type(df.schema, c.name), empty_is_null)
            stats.append((NON_NULL, c.name, found.cast("string")))
    return stats


def prepared(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The rows with the columns that :func:`statistics` adds up."""
    return with_parts(df, [(n, None) for n in summed_columns(df, spec)], WRITTEN)


def cast_columns(df: DataFrame, spec: TableSpec) -> list[tuple[str, str, bool]]:
    """(name, target Spark type, whether it is added) of the columns whose type an export changes."""
    changed = [c for c in spec.physical if field_type(df.schema, c.name).simpleString() != c.spark_type]
    return [(c.name, c.spark_type, c.target_type in SUMMED_TARGETS) for c in changed]


def source_statistics(df: DataFrame, spec: TableSpec, empty_is_null: bool = False) -> tuple[DataFrame, list[tuple[str, str, Column]]]:
    """A scanned table before anything is cast, and (metric, column, aggregate) of the columns that will be cast.

    Columns that keep their type are written as they came, so their written values speak for the source too.
    """
    changed = cast_columns(df, spec)
    summed = [(n, kind) for n, kind, added in changed if added]
    out = with_parts(df, summed, SOURCE)
    stats = [(NON_NULL, n, present(quoted(n), field_type(df.schema, n), empty_is_null).cast("string")) for n, _, _ in changed]
    stats += [(SUM, n, _sum_text(df, i, n, kind, SOURCE)) for i, (n, kind) in enumerate(summed)]
    return out, stats


def arrival_counts(spec: TableSpec) -> list[tuple[str, str | None, Column]]:
    """(metric, column, aggregate) of the rows of a scanned table, and of the values of each column, as they arrive."""
    counts = [(NON_NULL, c.name, F.count(quoted(c.name)).cast("string")) for c in spec.physical]
    return [(ROW_COUNT, None, F.count(F.lit(1)).cast("string")), *counts]


def validate(
    df: DataFrame, spec: TableSpec, with_pk_hash: bool = False, counts: bool = False, empty_is_null: bool = False
) -> DataFrame:
    """Row count, key hash total and numeric sums as (table_name, metric, column_name, value).

    One aggregation over one scan, however many columns there are. A column
    without any value has no sum row.
    """
    return long_form(df, spec, statistics(df, spec, with_pk_hash, counts, empty_is_null))


def long_form(df: DataFrame, spec: TableSpec, stats: Sequence[tuple[str, str | None, Column]]) -> DataFrame:
    """Aggregates as rows (table_name, metric, column_name, value)."""
    wide = prepared(df, spec).agg(*[agg.alias(f"s{i}") for i, (_, _, agg) in enumerate(stats)])
    rows = [
        F.struct(
            F.lit(metric).alias("metric"),
            F.lit(column).cast("string").alias("column_name"),
            F.col(f"s{i}").alias("value"),
        )
        for i, (metric, column, _) in enumerate(stats)
    ]
    return (
        wide.select(F.inline(F.array(*rows)))
        .where((F.col("metric") != SUM) | F.col("value").isNotNull())
        .select(F.lit(spec.table).alias("table_name"), "metric", "column_name", "value")
    )


def validation_record(stats: DataFrame) -> DataFrame:
    """The rows of :func:`validate` as one record per table."""
    return stats.groupBy("table_name").agg(
        F.max(F.when(F.col("metric") == ROW_COUNT, F.col("value"))).cast("long").alias("row_count"),
        F.max(F.when(F.col("metric") == PK_HASH, F.col("value"))).alias("pk_hash"),
        F.count(F.when(F.col("metric") == SUM, 1)).alias("sums"),
    )


def reconcile(source: DataFrame, target: DataFrame) -> DataFrame:
    """Compare two results of :func:`validate`: one row per metric and column."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            "metric", F.coalesce("column_name", F.lit("")).alias("column_name"), F.col("value").alias(name)
        )

    both = side(source, "source_value").join(
        side(target, "target_value"), ["metric", "column_name"], "full_outer"
    )
    return both.withColumn("matches", _bare("source_value").eqNullSafe(_bare("target_value")))


def _bare(name: str) -> Column:
    """A figure without zeros at the end of its fraction: 1.50 and 1.5 are one sum."""
    shorter = F.regexp_replace(name, r"^(-?\d+)(?:\.0+|(\.\d*?[1-9])0+)$", "$1$2")
    return F.when(shorter == "-0", "0").otherwise(shorter)


def bare(text: str | None) -> str | None:
    """The same of a figure on the driver."""
    if text is None:
        return None
    short = re.sub(r"^(-?\d+)(?:\.0+|(\.\d*?[1-9])0+)$", lambda m: m[1] + (m[2] or ""), text)
    return "0" if short == "-0" else short


def added_figures(texts: Iterable[str | None]) -> str | None:
    """Sums of parts of a table as the sum of the whole: the figures of each kind add up, exactly."""
    totals: dict[str, Decimal] = {}
    hashes = Decimal(0)
    for text in texts:
        for figure in text.split(" + ") if text else ():
            number, _, kind = figure.partition(" ")
            if kind.startswith("beyond "):
                # A count, and a total of hashes.
                kind, _, marks = kind.partition(" ")
                hashes = _EXACT.add(hashes, Decimal(marks))
            totals[kind] = _EXACT.add(totals.get(kind, Decimal(0)), Decimal(number))
    figures = []
    for kind in sorted(totals, key=_figure_order):
        figures.append(" ".join(x for x in (f"{totals[kind]:f}", kind, f"{hashes:f}" if kind == "beyond" else "") if x))
    return " + ".join(figures) or None


# More digits than any sum of figures has.
_EXACT = Context(prec=200)


def _figure_order(kind: str) -> tuple[int, int]:
    """The order in which sums name their figures: millionths, bands, what lies beyond."""
    if not kind:
        return 0, 0
    if kind.startswith("x 2^"):
        units = [unit for low in _BANDS for unit in (low - 12, low - 52)]
        return 1, units.index(int(kind[4:]))
    return 2, ("beyond", "NaN", "Infinity", "-Infinity").index(kind)


def diff(source: DataFrame, target: DataFrame, keys: Sequence[str], hash_col: str = ROW_HASH) -> DataFrame:
    """Keys whose rows differ: ``missing`` (source only), ``extra`` (target only) or ``changed``.

    Both sides are stacked and aggregated per key instead of joined. Counts and
    hash digests combine before the shuffle, so neither a hot key nor repeated
    keys can blow up a task or produce pairs. Where a key has several rows, the
    rows are compared as a multiset.
    """
    def side(df: DataFrame, is_source: bool) -> DataFrame:
        return df.select(
            *[quoted(k) for k in keys],
            F.xxhash64(quoted(hash_col)).alias("__h"),
            F.xxhash64(F.lit(1), quoted(hash_col)).alias("__g"),
            F.lit(is_source).alias("__source"),
        )

    sign = F.when(F.col("__source"), 1).otherwise(-1)
    stacked = side(source, True).unionByName(side(target, False))
    per_key = stacked.groupBy(*keys).agg(
        F.count(F.when(F.col("__source"), 1)).alias("source_rows"),
        F.count(F.when(~F.col("__source"), 1)).alias("target_rows"),
        F.sum(F.col("__h").cast("decimal(20,0)") * sign).alias("__dh"),
        F.sum(F.col("__g").cast("decimal(20,0)") * sign).alias("__dg"),
    )
    status = (
        F.when(F.col("target_rows") == 0, "missing")
        .when(F.col("source_rows") == 0, "extra")
        .when((F.col("source_rows") != F.col("target_rows")) | (F.col("__dh") != 0) | (F.col("__dg") != 0), "changed")
    )
    return (
        per_key.withColumn("status", status)
        .where("status IS NOT NULL")
        .select(*keys, "status", "source_rows", "target_rows")
    )
