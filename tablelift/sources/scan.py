"""Source tables as DataFrames."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelift.functions.text import quoted
from tablelift.plans.options import ExportOptions
from tablelift.plans.spec import ColumnSpec, TableSpec
from tablelift.sources import chunks
from tablelift.sources.blocks import files_of, size_gb
from tablelift.sources.chunks import Chunk
from tablelift.sources.statement import statement_query, statement_rows

log = logging.getLogger(__name__)


# Source types whose values the source can order, so that they can cut a table.
_ORDERABLE = ("NUMBER", "FLOAT", "BINARY", "DATE", "TIMESTAMP", "CHAR", "NCHAR", "VARCHAR", "NVARCHAR")


@dataclass(frozen=True)
class FileSource:
    """Tables in files; the path may name ``{schema}`` and ``{table}``."""

    path: str
    fmt: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    def load(self, spark: SparkSession, spec: TableSpec, predicates: Sequence[str] | None = None) -> DataFrame:
        # Spark splits files by size, so key predicates would only scan them again.
        return spark.read.format(self.fmt).options(**self.options).load(self._path(spec))

    def _path(self, spec: TableSpec) -> str:
        return self.path.format(schema=spec.schema, table=spec.table)

    def size_gb(self, spark: SparkSession, spec: TableSpec) -> float:
        """Bytes of the files, from their listing."""
        return size_gb(self.load(spark, spec))

    def chunks(self, spark: SparkSession, spec: TableSpec, n: int, where: str | None = None) -> list[Chunk]:
        """Whole files in at most ``n`` chunks of even bytes; the rows of each come from the file footers.

        With a row filter the footers do not say how many rows will come.
        """
        files = files_of(self.load(spark, spec), self.fmt in ("parquet", "orc") and not where)
        return chunks.even_chunks(files, n)

    def load_chunk(self, spark: SparkSession, spec: TableSpec, chunk: Chunk) -> DataFrame:
        """Only the files of the chunk are opened; columns named by folders stay."""
        base, whole = self._path(spec), self.load(spark, spec)
        reader = spark.read.format(self.fmt).options(**self.options).schema(whole.schema)
        if not any(f.endswith(base) for f in chunk.files):
            reader = reader.option("basePath", base)
        return reader.load(list(chunk.files))


@dataclass(frozen=True)
class JdbcSource:
    """Tables of a database.

    ``expressions`` replaces columns by SQL of the source, for values that only
    the source can convert (geometry to text, for example); intervals and row
    addresses have default expressions. ``salt`` is a numeric source expression
    such as a hash of the row address (see ``chunks.split_predicates``), and
    ``ranges`` are predicates of the source, by "schema.table", that together match every row once,
    such as ranges of row addresses: both cut tables that no key cuts.
    ``fetch_rows`` overrides the option of the job; ``digits`` is the widest decimal of the database.
    """

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    fetch_rows: int | None = None
    expressions: Mapping[str, str] = field(default_factory=dict)
    salt: str | None = None
    ranges: Mapping[str, Sequence[str]] = field(default_factory=dict)
    digits: int = 38

    def table(self, spec: TableSpec) -> str:
        return f"{sql_name(spec.schema)}.{sql_name(spec.table)}"

    def relation(self, spec: TableSpec) -> str:
        """Query that names every physical column, so that no other column is even looked at."""
        columns = []
        for c in spec.physical:
            value = self.expressions.get(c.name) or default_expression(c)
            columns.append(f"{value} AS {sql_name(c.name)}" if value else sql_name(c.name))
        return f"(SELECT {', '.join(columns)} FROM {self.table(spec)}) t"

    def load(self, spark: SparkSession, spec: TableSpec, predicates: Sequence[str] | None = None) -> DataFrame:
        props = {**self.properties, "fetchsize": str(self.fetch_rows or ExportOptions.fetch_rows)}
        if predicates:
            return spark.read.jdbc(self.url, self.relation(spec), predicates=list(predicates), properties=props)
        return spark.read.jdbc(self.url, self.relation(spec), properties=props)

    def statement(self, spark: SparkSession, spec: TableSpec, where: str | None = None) -> DataFrame:
        """What the database itself says of the table, within the row filter; see :mod:`tablelift.sources.statement`."""
        query = statement_query(self.table(spec), spec, where, self.expressions, self.digits)
        return statement_rows(spark.read.jdbc(self.url, query, properties=dict(self.properties)), spec, self.expressions)

    def chunks(self, spark: SparkSession, spec: TableSpec, n: int, where: str | None = None) -> list[Chunk] | None:
        """About ``n`` chunks that match every row exactly once; None where nothing can cut the table.

        The caller's ranges come first. Else the first orderable key column is cut into ranges of even row count: the
        database finds the bounds itself, in its own order and within the row filter, and says how many rows each range has. Ranges
        with hot keys, and tables without such a key, are cut by the salt.
        """
        given = self.ranges.get(f"{spec.schema}.{spec.table}")
        if given:
            return [Chunk(i, p) for i, p in enumerate(given)]
        kinds = {c.name: c.raw_type.strip().upper() for c in spec.columns}
        key = next((k for k in spec.pk_cols if kinds.get(k, "").startswith(_ORDERABLE)), None)
        found = [Chunk(0, "1=1")]
        if key is not None:
            query = chunks.ledger_query(self.table(spec), sql_name(key), n, where)
            found = chunks.ledger_chunks(sql_name(key), spark.read.jdbc(self.url, query, properties=dict(self.properties)).collect())
        if self.salt:
            found = chunks.salted_chunks(found, self.salt, n)
        return found if len(found) > 1 else None

    def load_chunk(self, spark: SparkSession, spec: TableSpec, chunk: Chunk) -> DataFrame:
        return self.load(spark, spec, [chunk.predicate])


# A source is one of the above, or any function that gives the table as a DataFrame. What else a source can do is asked
# of its methods: ``statement`` (its own counts and sums), ``chunks`` and ``load_chunk`` (parts of a table), ``size_gb``.
Source = FileSource | JdbcSource | Callable[[SparkSession, TableSpec], DataFrame]


def default_expression(c: ColumnSpec) -> str | None:
    """SQL of the source for types that have no portable value."""
    name, raw = sql_name(c.name), c.raw_type.strip().upper()
    if raw.startswith(("ROWID", "UROWID")):
        return f"CAST({name} AS VARCHAR(4000))"
    if not raw.startswith("INTERVAL"):
        return None

    def part(unit: str) -> str:
        return f"ABS(EXTRACT({unit} FROM {name}))"

    if "MONTH" in raw:
        sign = f"CASE WHEN {name} < INTERVAL '0' MONTH THEN '-' ELSE '' END"
        text = f"{sign} || {part('YEAR')} || '-' || {part('MONTH')} || ' 0 0:0:0'"
    else:
        sign = f"CASE WHEN {name} < INTERVAL '0' SECOND THEN '-' ELSE '' END"
        text = f"'0-0 ' || {sign} || {part('DAY')} || ' ' || " + " || ':' || ".join(map(part, ("HOUR", "MINUTE", "SECOND")))
    return f"CASE WHEN {name} IS NOT NULL THEN {text} END"


def sql_name(name: str) -> str:
    """A quoted identifier for the source database."""
    return '"' + name.replace('"', '""') + '"'


def _load(spark: SparkSession, source: Source, spec: TableSpec, predicates: Sequence[str] | None = None) -> DataFrame:
    if isinstance(source, (FileSource, JdbcSource)):
        return source.load(spark, spec, predicates)
    return source(spark, spec)


def _finish(df: DataFrame, spec: TableSpec, where: str | None) -> DataFrame:
    if where:
        df = df.where(F.expr(where))
    return df.select(*[quoted(c.name).alias(c.name) for c in spec.physical])


def scan(
    spark: SparkSession, source: Source, spec: TableSpec, where: str | None = None, deal_bytes: int = 0
) -> DataFrame:
    """The physical columns of a table; filter and column list reach the source.

    ``deal_bytes`` deals the rows of small files out to all cores; see :func:`dealt`.
    """
    df = _load(spark, source, spec)
    if not deal_bytes:
        return _finish(df, spec, where)
    return dealt(df.where(F.expr(where)) if where else df, [c.name for c in spec.physical], deal_bytes)


def scan_chunked(
    spark: SparkSession, source: Source, spec: TableSpec, n: int, where: str | None = None
) -> DataFrame:
    """The same rows, read by about ``n`` tasks where the source needs telling.

    Each predicate of a database table is one partition of the result. Errors of the source are not swallowed: a table
    whose bounds cannot be read fails instead of being read by a single task.
    """
    if not isinstance(source, JdbcSource) or n < 2:
        return scan(spark, source, spec, where)
    found = source.chunks(spark, spec, n, where)
    if found is None:
        log.warning("%s.%s has no orderable key, ranges or salt: one task reads it", spec.schema, spec.table)
    return _finish(_load(spark, source, spec, [c.predicate for c in found] if found else None), spec, where)


def scan_chunk(spark: SparkSession, source: Source, spec: TableSpec, chunk: Chunk, where: str | None = None) -> DataFrame:
    """The physical columns of one chunk, read alone."""
    return _finish(source.load_chunk(spark, spec, chunk), spec, where)


def dealt(df: DataFrame, columns: Sequence[str], most_bytes: int = 1 << 30, tasks: int | None = None) -> DataFrame:
    """Columns of a small file scan, dealt out to all cores by file and row number.

    One row group is read by one task, so a table in few files can leave most cores idle. A row's file and number
    are the same whenever the scan is repeated, and differ for equal rows, so no value makes a task larger. Only the
    named columns are read and moved. Scans of more than ``most_bytes``, scans with enough tasks, and sources
    without row numbers stay as they are.
    """
    named = [quoted(c).alias(c) for c in columns]
    picked = df.select(*named)
    tasks = tasks or df.sparkSession.sparkContext.defaultParallelism
    plan = picked._jdf.queryExecution()
    if int(plan.optimizedPlan().stats().sizeInBytes()) > most_bytes or plan.toRdd().getNumPartitions() >= tasks:
        return picked
    try:
        place = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")]
        numbered = df.select(*named, *place)
    except AnalysisException:
        return picked
    return numbered.repartition(tasks, "__file", "__row").drop("__file", "__row")
