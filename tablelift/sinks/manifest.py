"""Completion records: an append-only log of finished exports in the output folder.

A record is a small file in ``<out>/records/new``; starting an export anew appends a mark that the table has no valid
record. Readers list one folder, however many tables there are, and take the latest entry of each table. Once many
files have gathered, :func:`compact_records` writes the whole history as one table and removes them; if it is interrupted, entries
are there twice, which changes nothing.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from dataclasses import asdict
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelift.operators.validate import NON_NULL, PK_HASH, ROW_COUNT, SUM
from tablelift.plans.options import ExportOptions
from tablelift.plans.spec import ROW_HASH, ROW_HASH_COMMENT, TableSpec
from tablelift.sinks.files import TableDir

MANIFEST_SCHEMA = """
    schema string, table string, exported_at string, fingerprint string,
    fmt string, sep string, row_hash boolean, pk array<string>,
    columns array<struct<name: string, type: string, mode: string, description: string>>,
    spec string, rows long, bytes long, seconds double,
    validation struct<row_count: long, pk_hash: string,
                      aggregates: array<struct<column_name: string, agg_type: string, value: string>>,
                      errors: array<string>>,
    casts array<struct<column_name: string, source_values: long, written_values: long, lost: long>>,
    stated array<struct<metric: string, column_name: string, value: string>>, chunks long
"""
_LOG_SCHEMA = f"{MANIFEST_SCHEMA}, logged_at long, removed boolean"

# Files of the log that are left as they are.
LOG_FILES = 1000


def schema_rows(spec: TableSpec, row_hash: bool = False) -> list[tuple[str, str, str, str | None]]:
    """(name, type, mode, description) of the target columns; view-only columns are left out."""
    rows = [(c.name, c.target_type, "NULLABLE", c.comment) for c in spec.physical]
    if row_hash:
        rows.append((ROW_HASH, "STRING", "REQUIRED", ROW_HASH_COMMENT))
    return rows


def hadoop_path(spark: SparkSession, path: str):
    """A path with its file system, whichever kind of storage it names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _log(out: str) -> str:
    return f"{out.rstrip('/')}/records"


_last = 0
_clock = threading.Lock()


def _append(spark: SparkSession, out: str, record: dict[str, object]) -> None:
    """Add an entry; entries of one driver have rising times."""
    global _last
    with _clock:
        _last = max(_last + 1, time.time_ns())
        now = _last
    write_json(spark, f"{_log(out)}/new", f"{now}-{uuid.uuid4().hex[:12]}.json", record | {"logged_at": now})


def delete_manifest(spark: SparkSession, place: TableDir) -> None:
    """Let an earlier export count no more, before its files are replaced; its record stays in the history."""
    _append(spark, place.out, {"schema": place.schema, "table": place.table, "removed": True})
    delete_folder(spark, place.refusal)


def forget_export(spark: SparkSession, place: TableDir) -> None:
    """Let the next run export a table wholly anew: neither its record nor those of its chunks count any more.

    Without the chunk records' removal, a table whose record was revoked is completed from the chunks that have records.
    """
    delete_manifest(spark, place)
    delete_folder(spark, place.chunks)


def write_manifest(
    spark: SparkSession,
    place: TableDir,
    spec: TableSpec,
    options: ExportOptions,
    stats: dict[tuple[str, str | None], str | None],
    casts: list[dict[str, object]],
    rows: int,
    bytes_: int,
    seconds: float,
    stated: dict[tuple[str, str | None], str | None] | None = None,
    chunks: int | None = None,
) -> None:
    """Record a finished export. Call it only after the data files are committed.

    ``stats`` are what the files should show when read back: counts of written values, and the source's own sums.
    ``stated`` is what the source said of itself, ``chunks`` how many parts the table was written in.
    """
    sums = [
        {"column_name": c, "agg_type": m, "value": v}
        for (m, c), v in stats.items() if m in (SUM, NON_NULL) and v is not None
    ]
    lost = [f"no sum for {c}" for (m, c), v in stats.items() if m == SUM and v is None]
    count = stats.get((ROW_COUNT, None))
    record = {
        "schema": spec.schema,
        "table": spec.table,
        "exported_at": datetime.now(timezone.utc).isoformat(),
        "fingerprint": spec.fingerprint(**options.content()),
        "fmt": options.fmt,
        "sep": options.sep,
        "row_hash": options.row_hash,
        "pk": list(spec.pk_cols),
        "columns": [
            dict(zip(("name", "type", "mode", "description"), row)) for row in schema_rows(spec, options.row_hash)
        ],
        "spec": json.dumps(asdict(spec)),
        "rows": rows,
        "bytes": bytes_,
        "seconds": seconds,
        "validation": {
            "row_count": int(count) if count is not None else None,
            "pk_hash": stats.get((PK_HASH, None)),
            "aggregates": sums or None,
            "errors": lost or None,
        },
        "casts": casts,
        "stated": None if stated is None else [{"metric": m, "column_name": c, "value": v} for (m, c), v in stated.items()],
        "chunks": chunks,
    }
    _append(spark, place.out, record)


def write_json(spark: SparkSession, folder: str, name: str, record: object) -> None:
    """A small file, without a job of its own. Readers skip the name with the underscore: it appears whole or not at all."""
    draft, fs = hadoop_path(spark, f"{folder}/_{name}")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(json.dumps(record).encode()))
    finally:
        stream.close()
    path, _ = hadoop_path(spark, f"{folder}/{name}")
    fs.delete(path, False)
    if not fs.rename(draft, path):
        raise OSError(f"could not complete {folder}/{name}")


def read_json(spark: SparkSession, folder: str, name: str) -> dict | None:
    path, fs = hadoop_path(spark, f"{folder}/{name}")
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def delete_folder(spark: SparkSession, folder: str) -> None:
    path, fs = hadoop_path(spark, folder)
    fs.delete(path, True)


REFUSAL_SCHEMA = "schema string, table string, refused_at string, metric string, column_name string, stated string, arrived string"


def write_refusal(spark: SparkSession, place: TableDir, spec: TableSpec, found: list[tuple[str, str | None, str | None, str | None]]) -> None:
    """Keep what a source said and what arrived, of a table that was refused for it."""
    when = datetime.now(timezone.utc).isoformat()
    names = ("metric", "column_name", "stated", "arrived")
    rows = [{"schema": spec.schema, "table": spec.table, "refused_at": when, **dict(zip(names, row))} for row in found]
    write_json(spark, place.refusal, "record.json", rows)


def read_refusals(spark: SparkSession, out: str) -> DataFrame:
    """What sources and arrived rows disagreed in, for every table whose last export was refused for it."""
    pattern = f"{out.rstrip('/')}/*/*/config/refusal"
    path, fs = hadoop_path(spark, pattern)
    if not fs.globStatus(path):
        return spark.createDataFrame([], REFUSAL_SCHEMA)
    return spark.read.schema(REFUSAL_SCHEMA).json(pattern)


def _entries(spark: SparkSession, out: str) -> DataFrame:
    """All entries of the log, each once."""
    found = []
    for pattern, read in (("new", spark.read.schema(_LOG_SCHEMA).json), ("compacted-*", spark.read.schema(_LOG_SCHEMA).parquet)):
        path, fs = hadoop_path(spark, f"{_log(out)}/{pattern}")
        if fs.globStatus(path):
            found.append(read(f"{_log(out)}/{pattern}"))
    if not found:
        return spark.createDataFrame([], _LOG_SCHEMA)
    both = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    return both.dropDuplicates(["schema", "table", "logged_at"])


def read_manifest(spark: SparkSession, out: str) -> DataFrame:
    """The completion records that hold now: the latest entry of each table below an output folder."""
    entries = _entries(spark, out)
    latest = entries.groupBy("schema", "table").agg(F.max_by(F.struct("*"), "logged_at").alias("r")).select("r.*")
    return latest.where(~F.coalesce("removed", F.lit(False))).drop("logged_at", "removed")


def record_history(spark: SparkSession, out: str) -> DataFrame:
    """All completion records ever written, those that were replaced too, with the time in ``logged_at`` (nanoseconds)."""
    return _entries(spark, out).where("removed IS NULL").drop("removed")


def compact_records(spark: SparkSession, out: str, files: int = LOG_FILES) -> bool:
    """Write the log as one table, if more than ``files`` files have gathered; says whether it did."""
    path, fs = hadoop_path(spark, f"{_log(out)}/new/*.json")
    new = [f.getPath() for f in fs.globStatus(path) or []]
    if len(new) <= files:
        return False
    path, fs = hadoop_path(spark, f"{_log(out)}/compacted-*")
    old = [f.getPath() for f in fs.globStatus(path) or []]
    # Only what was listed goes: entries that come in meanwhile stay.
    _entries(spark, out).repartition(1 + len(new) // 100_000).write.parquet(f"{_log(out)}/compacted-{time.time_ns()}")
    for p in [*new, *old]:
        fs.delete(p, True)
    return True


def _aggregates() -> Column:
    none = F.array().cast("array<struct<column_name: string, agg_type: string, value: string>>")
    return F.coalesce("validation.aggregates", none)


def lost_values(manifest: DataFrame) -> DataFrame:
    """(schema, table, column_name, source_values, written_values, lost) of every column of every record."""
    return manifest.select("schema", "table", F.inline("casts"))


def manifest_checks(manifest: DataFrame) -> DataFrame:
    """What each record proves, in the shape :func:`tablelift.operators.results.audit` takes."""
    return manifest.select(
        "schema", "table",
        F.col("validation.row_count").alias("row_count"),
        F.col("validation.pk_hash").alias("pk_hash"),
        F.size(F.filter(_aggregates(), lambda a: a["agg_type"] == SUM)).alias("sums"),
    )


def manifest_stats(manifest: DataFrame) -> DataFrame:
    """The recorded statistics in the long form of :func:`tablelift.operators.validate.validate`."""
    v = F.col("validation")
    row = lambda metric, column, value: F.struct(
        F.lit(metric).alias("metric"), column.alias("column_name"), value.cast("string").alias("value")
    )
    none = F.lit(None).cast("string")
    fixed = F.array(row(ROW_COUNT, none, v["row_count"]), row(PK_HASH, none, v["pk_hash"]))
    sums = F.transform(
        _aggregates(),
        lambda a: F.struct(a["agg_type"].alias("metric"), a["column_name"].alias("column_name"), a["value"].alias("value")),
    )
    return (
        manifest.select("schema", F.col("table").alias("table_name"), F.inline(F.concat(fixed, sums)))
        .where("value IS NOT NULL")
    )
