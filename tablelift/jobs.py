"""Whole jobs: export one table, export many, resume, verify."""

from __future__ import annotations

import json
import logging
import math
import threading
import time
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, replace
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablelift.functions.text import quoted
from tablelift.functions.widths import columnar_bytes, text_bytes
from tablelift.operators.project import apply_types, csv_text, physical
from tablelift.operators.results import (
    FAILED, RESULT_SCHEMA, SKIPPED, SUCCESS, pending, results_ranked, run_summary, table_results,
)
from tablelift.operators.rowhash import row_hash, with_row_hash
from tablelift.operators.validate import (
    HASH_MISMATCHES, NON_NULL, ROW_COUNT, SUM, added_figures, arrival_counts, bare, long_form, prepared, reconcile,
    source_statistics, statistics,
)
from tablelift.plans.options import ExportOptions
from tablelift.plans.spec import ROW_HASH, TableSpec
from tablelift.plans.tasks import is_large
from tablelift.session import tune
from tablelift.sinks.files import TableDir, read_export, write_csv_text, write_parquet
from tablelift.sinks.manifest import (
    compact_records, delete_folder, delete_manifest, manifest_stats, read_json, read_manifest, write_json, write_manifest, write_refusal,
)
from tablelift.sources.chunks import Chunk
from tablelift.sources.scan import JdbcSource, Source, scan, scan_chunk, scan_chunked
from tablelift.sources.statement import Figures, asked, disagreements

log = logging.getLogger(__name__)


def scanned(spark: SparkSession, source: Source, spec: TableSpec, options: ExportOptions) -> DataFrame:
    """The table as its source gives it, cut into tasks. No shuffle for large tables."""
    tune(spark)
    parallel = options.parallel or spark.sparkContext.defaultParallelism
    if isinstance(source, JdbcSource):
        if source.fetch_rows is None:
            source = replace(source, fetch_rows=options.fetch_rows)
        if parallel > 1 and is_large(spec.size_gb, options.chunk_threshold_gb):
            return scan_chunked(spark, source, spec, parallel, options.where)
    return scan(spark, source, spec, options.where, options.deal_bytes)


def _typed(df: DataFrame, spec: TableSpec, options: ExportOptions) -> DataFrame:
    df = apply_types(physical(df, spec), spec, options.string_nulls)
    return with_row_hash(df, spec) if options.row_hash else df


def export_frame(spark: SparkSession, source: Source, spec: TableSpec, options: ExportOptions) -> DataFrame:
    """The rows an export writes: scanned, rewritten, typed and hashed."""
    return _typed(scanned(spark, source, spec, options), spec.with_fallback(options.number_fallback), options)


@dataclass(frozen=True)
class _Look:
    """What was seen of rows on their way to the files: as they arrived, and as they were written."""

    rows: int
    bytes: int
    written: Figures
    source: Figures
    arrived: Figures
    casts: list[dict[str, object]]

    @property
    def lost(self) -> int:
        return sum(c["lost"] for c in self.casts)

    @property
    def stats(self) -> Figures:
        """What the files should show: written values, and the source's own sums where columns were cast."""
        return self.written | {k: v for k, v in self.source.items() if k[0] == SUM and k in self.written}

    def trouble(self) -> str | None:
        """What casts took away: values, or parts of values, which only sums show."""
        gone = [f"{c['column_name']}: {c['lost']}" for c in self.casts if c["lost"]]
        if gone:
            return f"values lost in casts: {', '.join(gone)}"
        rounded = [
            f"{k[1]}: {v} to {self.written[k]}" for k, v in self.source.items()
            if k[0] == SUM and v is not None and self.written.get(k) is not None and bare(v) != bare(self.written[k])
        ]
        return f"sums changed by casts: {', '.join(rounded)}" if rounded else None

    def record(self) -> dict[str, object]:
        """The look as text, for the record of a chunk."""
        pairs = {n: [[m, c, v] for (m, c), v in getattr(self, n).items()] for n in ("written", "source", "arrived")}
        return {"rows": self.rows, "bytes": self.bytes, "casts": self.casts, **pairs}

    @classmethod
    def from_record(cls, record: dict) -> _Look:
        figures = [{(m, c): v for m, c, v in record[n]} for n in ("written", "source", "arrived")]
        return cls(record["rows"], record["bytes"], *figures, record["casts"])

    @classmethod
    def of_parts(cls, parts: Sequence[_Look]) -> _Look:
        """The look at a table that was written in parts."""
        def added(name: str) -> Figures:
            keys = dict.fromkeys(k for p in parts for k in getattr(p, name))
            return {k: added_figures(getattr(p, name).get(k) for p in parts) for k in keys}

        casts = [
            {"column_name": column[0]["column_name"], **{n: sum(c[n] for c in column) for n in ("source_values", "written_values", "lost")}}
            for column in zip(*(p.casts for p in parts))
        ]
        return cls(sum(p.rows for p in parts), sum(p.bytes for p in parts), added("written"), added("source"), added("arrived"), casts)


def _write(df: DataFrame, wide: TableSpec, path: str, options: ExportOptions, label: str, stated: bool) -> _Look:
    """Write scanned rows to a folder, looking at them before any cast and as they are written, in one stage.

    Where the source ``stated`` figures, all columns are counted on arrival, else only those that are cast.
    """
    as_text = options.fmt == "csv"
    looked, before = source_statistics(df, wide, as_text)
    arrival = before + (arrival_counts(wide) if stated else [])
    came = Observation(f"source-{label}")
    if arrival:
        looked = looked.observe(came, *_named(arrival))
    df = _typed(looked, wide, options)
    checks = statistics(df, wide, options.row_hash, counts=True, empty_is_null=as_text)
    names = [quoted(n) for n in df.columns]

    seen = Observation(f"checks-{label}")
    if as_text:
        df = prepared(df, wide).observe(seen, *_named(checks)).select(*names)
        sizes = Observation(f"sizes-{label}")
        text = csv_text(df)
        text = text.observe(sizes, text_bytes(text.columns).alias("bytes"))
        write_csv_text(text, path, options.sep, options.max_rows_per_file)
        bytes_ = sizes.get["bytes"]
    else:
        bytes_of = columnar_bytes(df.schema).alias("bytes")
        df = prepared(df, wide).observe(seen, *_named(checks), bytes_of).select(*names)
        write_parquet(df, path, options.compression, options.max_rows_per_file, options.block_bytes)
        bytes_ = seen.get["bytes"]

    written = dict(_values(seen.get, checks))
    came_in = _values(came.get, arrival) if arrival else []
    source, arrived = dict(came_in[: len(before)]), dict(came_in[len(before) :])
    # Columns that keep their type are written as they came.
    arrived |= {k: source.get(k, v) for k, v in written.items() if k[0] == SUM}
    casts = []
    for c in wide.physical:
        has = int(written[NON_NULL, c.name])
        had = int(source.get((NON_NULL, c.name), has))
        casts.append({"column_name": c.name, "source_values": had, "written_values": has, "lost": max(0, had - has)})
    return _Look(int(written[ROW_COUNT, None]), bytes_ or 0, written, source, arrived, casts)


def export_table(
    spark: SparkSession, source: Source, spec: TableSpec, out: str, options: ExportOptions = ExportOptions()
) -> dict[str, object]:
    """Write one table by one job, and its completion record; gives its task result.

    Two looks are taken at the rows on their way to the files, in the stage that writes them, so the source is read
    once: counts and sums of what arrived, before any cast, and counts, logical bytes and the key hash total of what is
    written. A source that can state figures of its own is asked first: where they are not those of the rows
    that arrived, the table is refused. Values that a cast turned into NULL, or changed, are lost; a table that lost any fails
    and gets no record, unless ``lost_values`` is "record".
    """
    started = time.monotonic()
    place = TableDir(out, spec.schema, spec.table)
    wide = spec.with_fallback(options.number_fallback)
    stated = asked(spark, source, wide, options.where)
    df = scanned(spark, source, wide, options)
    delete_manifest(spark, place)
    delete_folder(spark, place.chunks)
    look = _write(df, wide, place.data, options, f"{spec.schema}.{spec.table}", stated is not None)
    return _finish_table(spark, place, wide, options, look, stated, time.monotonic() - started)


def _finish_table(
    spark: SparkSession, place: TableDir, wide: TableSpec, options: ExportOptions, look: _Look, stated: Figures | None, seconds: float,
    chunks: int | None = None,
) -> dict[str, object]:
    """Hold a written table against its source, and record it where both agree."""
    found = disagreements(stated, look.arrived) if stated is not None else []
    if found:
        write_refusal(spark, place, wide, found)
        text = "; ".join(f"{m}{f' of {c}' if c else ''}: source {v}, arrived {a}" for m, c, v, a in found)
        return _result(wide, look.rows, look.bytes, seconds, FAILED, f"the source disagrees: {text}", look.lost)
    trouble = look.trouble()
    if trouble and options.lost_values == "fail":
        return _result(wide, look.rows, look.bytes, seconds, FAILED, trouble, look.lost)
    write_manifest(spark, place, wide, options, look.stats, look.casts, look.rows, look.bytes, seconds, stated, chunks)
    return _result(wide, look.rows, look.bytes, seconds, SUCCESS, None, look.lost)


@dataclass(frozen=True)
class ChunkPlan:
    """How a table is cut for one export. It is kept in the output folder, so that a restart cuts the table alike."""

    fingerprint: str
    chunks: tuple[Chunk, ...]
    stated: Figures | None

    def save(self, spark: SparkSession, place: TableDir) -> None:
        stated = None if self.stated is None else [[m, c, v] for (m, c), v in self.stated.items()]
        write_json(spark, place.chunks, "plan.json", {"fingerprint": self.fingerprint, "chunks": [asdict(c) for c in self.chunks], "stated": stated})

    @classmethod
    def load(cls, spark: SparkSession, place: TableDir) -> ChunkPlan | None:
        kept = read_json(spark, place.chunks, "plan.json")
        if kept is None:
            return None
        chunks = tuple(Chunk(c["chunk_id"], c["predicate"], tuple(c["files"]), c["rows"]) for c in kept["chunks"])
        return cls(kept["fingerprint"], chunks, None if kept["stated"] is None else {(m, c): v for m, c, v in kept["stated"]})


def plan_chunks(spark: SparkSession, source: Source, spec: TableSpec, out: str, options: ExportOptions) -> ChunkPlan | None:
    """The chunks of a large table, None for tables that one job reads.

    An earlier plan for the same content is taken up again; else leftovers of earlier exports go, and the new plan is kept
    before any chunk is written.
    """
    parallel = options.parallel or spark.sparkContext.defaultParallelism
    if not hasattr(source, "load_chunk") or parallel < 2:
        return None
    place = TableDir(out, spec.schema, spec.table)
    wide = spec.with_fallback(options.number_fallback)
    fingerprint = wide.fingerprint(**options.content())
    kept = ChunkPlan.load(spark, place)
    if kept and kept.fingerprint == fingerprint:
        return kept
    measured = getattr(source, "size_gb", None)
    if measured and not spec.size_gb:
        spec = replace(spec, size_gb=measured(spark, spec))
        if 0 < spec.size_gb <= options.chunk_threshold_gb:
            return None
    if not is_large(spec.size_gb, options.chunk_threshold_gb):
        return None
    if isinstance(source, JdbcSource) and source.fetch_rows is None:
        source = replace(source, fetch_rows=options.fetch_rows)
    chunks = source.chunks(spark, wide, parallel, options.where)
    if not chunks or len(chunks) < 2:
        return None
    plan = ChunkPlan(fingerprint, tuple(chunks), asked(spark, source, wide, options.where))
    delete_manifest(spark, place)
    for folder in (place.chunks, place.data):
        delete_folder(spark, folder)
    plan.save(spark, place)
    return plan


def _chunk_name(chunk_id: int) -> str:
    return f"chunk_{chunk_id:04d}.json"


def export_chunk(
    spark: SparkSession, source: Source, spec: TableSpec, out: str, options: ExportOptions, chunk: Chunk
) -> dict[str, object]:
    """Write one chunk to its own folder, and its record; gives its task result.

    A chunk that has a record is not read again. Where the source said how many rows the chunk has, other numbers of rows fail it.
    """
    started = time.monotonic()
    place = TableDir(out, spec.schema, spec.table)
    wide = spec.with_fallback(options.number_fallback)
    kept = read_json(spark, place.chunks, _chunk_name(chunk.chunk_id))
    if kept is not None:
        look = _Look.from_record(kept)
        return _result(spec, look.rows, look.bytes, 0.0, SKIPPED, None, look.lost, chunk.chunk_id)
    if isinstance(source, JdbcSource) and source.fetch_rows is None:
        source = replace(source, fetch_rows=options.fetch_rows)
    df = scan_chunk(tune(spark), source, wide, chunk, options.where)
    look = _write(df, wide, place.chunk_data(chunk.chunk_id), options, f"{spec.schema}.{spec.table}.{chunk.chunk_id}", True)
    seconds = time.monotonic() - started
    if chunk.rows is not None and chunk.rows != look.rows:
        text = f"chunk {chunk.chunk_id}: source {chunk.rows} rows, arrived {look.rows}"
        return _result(spec, look.rows, look.bytes, seconds, FAILED, text, look.lost, chunk.chunk_id)
    write_json(spark, place.chunks, _chunk_name(chunk.chunk_id), look.record() | {"seconds": seconds})
    return _result(spec, look.rows, look.bytes, seconds, SUCCESS, None, look.lost, chunk.chunk_id)


def _finish_chunks(spark: SparkSession, spec: TableSpec, out: str, options: ExportOptions, plan: ChunkPlan) -> str | None:
    """Record a table once all its chunks have records; gives what is wrong with it, else None."""
    place = TableDir(out, spec.schema, spec.table)
    kept = [read_json(spark, place.chunks, _chunk_name(c.chunk_id)) for c in plan.chunks]
    if any(k is None for k in kept):
        return None
    look = _Look.of_parts([_Look.from_record(k) for k in kept])
    wide = spec.with_fallback(options.number_fallback)
    done = _finish_table(spark, place, wide, options, look, plan.stated, max(k["seconds"] for k in kept), len(kept))
    if done["status"] == FAILED:
        # What was cut and read is not the table: the next run plans anew.
        delete_folder(spark, place.chunks)
    return done["error"]


def _named(stats: list[tuple[str, str | None, Column]]) -> list[Column]:
    return [agg.alias(f"s{i}") for i, (_, _, agg) in enumerate(stats)]


def _values(row: dict[str, object], stats: list[tuple[str, str | None, Column]]) -> list[tuple[tuple[str, str | None], str | None]]:
    return [((metric, column), row[f"s{i}"]) for i, (metric, column, _) in enumerate(stats)]


def _result(
    spec: TableSpec, rows: int, bytes_: int, seconds: float, status: str, error: str | None, lost: int = 0, chunk_id: int | None = None
) -> dict[str, object]:
    return {
        "schema": spec.schema, "table": spec.table, "chunk_id": chunk_id, "rows": rows, "bytes": bytes_,
        "seconds": seconds, "status": status, "error": error, "lost": lost,
    }


def specs_of(catalog: DataFrame) -> list[TableSpec]:
    """Specs of a discovered catalog, one table at a time."""
    return [TableSpec.from_row(row) for row in catalog.toLocalIterator()]


def export_tables(
    spark: SparkSession,
    source: Source,
    specs: Iterable[TableSpec],
    out: str,
    options: ExportOptions = ExportOptions(),
) -> DataFrame:
    """Export many tables; gives their results, slowest first.

    Tables whose record matches their spec and options are skipped, and their results say so. Large tables of sources
    that can cut them are written in chunks, all others by one job each; the chunks of all tables and the other tables go through
    one flat pool of threads, each in a scheduler pool of its table, so that small tables fill the cluster
    together and, where ``spark.scheduler.mode`` is FAIR, none waits for a large one. Chunk results add up to
    table results. A chunk or table that fails is reported and stops nothing else; the next run starts at
    the first chunk without a record.
    """
    specs = list(specs)
    started = time.monotonic()
    listing = spark.createDataFrame(
        [(s.schema, s.table, s.with_fallback(options.number_fallback).fingerprint(**options.content())) for s in specs],
        "schema string, table string, fingerprint string",
    )
    todo = {(r["schema"], r["table"]) for r in pending(listing, read_manifest(spark, out)).collect()}
    plans: dict[tuple[str, str], ChunkPlan | None] = {}
    left: dict[tuple[str, str], int] = {}
    lock = threading.Lock()

    def guarded(spec: TableSpec, work: Callable[[], dict[str, object] | None], chunk_id: int | None = None) -> dict[str, object] | None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"{spec.schema}.{spec.table}")
        try:
            return work()
        except Exception as e:  # noqa: BLE001 - the error belongs to this table's result
            log.error("export of %s.%s failed: %s", spec.schema, spec.table, e)
            return _result(spec, 0, 0, 0.0, FAILED, str(e).strip() or type(e).__name__, 0, chunk_id)

    def plan(spec: TableSpec) -> dict[str, object] | None:
        def work() -> None:
            plans[spec.schema, spec.table] = plan_chunks(spark, source, spec, out, options)

        return guarded(spec, work)

    def run(unit: tuple[TableSpec, Chunk | None]) -> list[dict[str, object]]:
        spec, chunk = unit
        if chunk is None:
            return [guarded(spec, lambda: export_table(spark, source, spec, out, options))]
        key = spec.schema, spec.table
        done = [guarded(spec, lambda: export_chunk(spark, source, spec, out, options, chunk), chunk.chunk_id)]
        with lock:
            left[key] -= 1
            last = left[key] == 0
        if last:
            def finish() -> dict[str, object] | None:
                error = _finish_chunks(spark, spec, out, options, plans[key])
                return _result(spec, 0, 0, 0.0, FAILED, error, 0, len(plans[key].chunks)) if error else None

            wrong = guarded(spec, finish, len(plans[key].chunks))
            done += [wrong] if wrong else []
        return done

    cores = spark.sparkContext.defaultParallelism
    jobs = options.parallel or max(1, math.ceil(cores * options.cpu_percent / 100))
    work = [s for s in specs if (s.schema, s.table) in todo]
    with ThreadPoolExecutor(max_workers=jobs) as pool:
        done = [r for r in pool.map(inheritable_thread_target(spark)(plan), work) if r]
        units: list[tuple[TableSpec, Chunk | None]] = []
        for s in work:
            if (s.schema, s.table) in plans:
                found = plans[s.schema, s.table]
                left[s.schema, s.table] = len(found.chunks) if found else 0
                units += [(s, c) for c in found.chunks] if found else [(s, None)]
        done += [r for results in pool.map(inheritable_thread_target(spark)(run), units) for r in results]
    done += [_result(s, 0, 0, 0.0, SKIPPED, None) for s in specs if (s.schema, s.table) not in todo]

    compact_records(spark, out)
    tasks = spark.createDataFrame(done, RESULT_SCHEMA)
    results = table_results(tasks, listing)
    write_report(results, time.monotonic() - started, out, tasks.where("chunk_id IS NOT NULL"))
    return results_ranked(results)


def write_report(results: DataFrame, seconds: float, out: str, chunks: DataFrame | None = None) -> str:
    """Write the run report (``summary``, ``details`` and, where there are any, ``chunks``) and give its folder."""
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S_%f")
    folder = f"{out.rstrip('/')}/report_{stamp}"
    run_summary(results, seconds).coalesce(1).write.json(f"{folder}/summary")
    results.write.json(f"{folder}/details")
    if chunks is not None and not chunks.isEmpty():
        chunks.coalesce(1).write.json(f"{folder}/chunks")
    return folder


def verify_export(spark: SparkSession, spec: TableSpec, out: str) -> DataFrame:
    """Read an export back and compare it with what was recorded: rows, the source's sums, values of each column.

    With row hashes, every row's hash is computed anew from what the files hold; rows where it differs are counted.
    """
    place = TableDir(out, spec.schema, spec.table)
    record = read_manifest(spark, out).where(
        (F.col("schema") == spec.schema) & (F.col("table") == spec.table)
    )
    how = record.select("fmt", "sep", "row_hash", "spec").first()
    if how is None:
        raise ValueError(f"{spec.schema}.{spec.table} has no completion record below {out}")
    # Types as they were written; a fallback for numbers may have changed them.
    kinds = {c["name"]: c["spark_type"] for c in json.loads(how["spec"])["columns"]}
    spec = replace(spec, columns=tuple(replace(c, spark_type=kinds.get(c.name, c.spark_type)) for c in spec.columns))
    back = read_export(spark, place.data, spec, how["fmt"], how["row_hash"], how["sep"])
    stats = statistics(back, spec, how["row_hash"], counts=True, empty_is_null=how["fmt"] == "csv")
    recorded = manifest_stats(record)
    if how["row_hash"]:
        again = row_hash(back.schema, spec)
        wrong = F.count(F.when(~F.col(ROW_HASH).eqNullSafe(again), 1)).cast("string")
        stats.append((HASH_MISMATCHES, None, wrong))
        none = spark.range(1).select(
            F.lit(spec.schema).alias("schema"), F.lit(spec.table).alias("table_name"), F.lit(HASH_MISMATCHES).alias("metric"),
            F.lit(None).cast("string").alias("column_name"), F.lit("0").alias("value"),
        )
        recorded = recorded.unionByName(none)
    return reconcile(recorded, long_form(back, spec, stats))
