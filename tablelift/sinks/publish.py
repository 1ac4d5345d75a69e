"""Published tables: typed, commented, partitioned by day, clustered, with a view on top."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelift.functions.text import quoted
from tablelift.plans.spec import TableSpec
from tablelift.sinks.files import FILE, TableDir, export_schema, read_export, tie_break
from tablelift.sinks.manifest import hadoop_path


def day_name(spec: TableSpec) -> str | None:
    return f"{spec.day_column}_DAY" if spec.day_column else None


def with_day(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Add the date that partitions the table, if the spec names a partition column."""
    if not spec.day_column:
        return df
    return df.withColumn(day_name(spec), F.to_date(quoted(spec.day_column)))


def arranged(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows ordered for pruning: by day, then by the cluster columns.

    Range partitions follow a sample, and a tie-break behind the cluster columns
    lets a single day or key value span several of them. Each output task then
    holds few days, so the number of files stays close to the number of tasks.
    """
    order = [c for c in (day_name(spec), *spec.cluster_cols) if c]
    if not order:
        return df.drop(FILE)
    columns = [quoted(c) for c in order]
    breaks = tie_break(df)
    names = [f"__tie{i}" for i in range(len(breaks))]
    spread = df.withColumns(dict(zip(names, breaks)))
    return spread.repartitionByRange(*columns, *names).sortWithinPartitions(*columns).drop(FILE, *names)


def _commented(df: DataFrame, spec: TableSpec) -> DataFrame:
    notes = {f.name: f.metadata for f in export_schema(spec, row_hash=True) if f.metadata}
    return df.select(
        *[quoted(n).alias(n, metadata=notes[n]) if n in notes else quoted(n) for n in df.columns]
    )


def _sql(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _qualified(database: str | None, name: str) -> str:
    return f"{_sql(database)}.{_sql(name)}" if database else _sql(name)


# Properties of a published view: the versions behind it, oldest first.
VERSIONS = "tablelift.versions"


def publish_table(
    df: DataFrame, spec: TableSpec, database: str | None = None, location: str | None = None, max_rows_per_file: int = 0, keep: int = 1
) -> str:
    """Replace the physical table of a spec; gives its name.

    The name is a view over the newest version, a table of its own. Once the files of a new version are complete, one
    ``CREATE OR REPLACE VIEW`` gives it the name, so readers always find either the old rows or the new ones. Queries that
    are still reading keep their files: ``keep`` versions before the newest one stay, older ones are removed with
    theirs. A load that fails leaves the name as it was. ``location`` is the folder for the files; each
    load takes a new subfolder.
    """
    spark = df.sparkSession
    run = uuid.uuid4().hex[:12]
    table = f"{spec.physical_name}__{run}"
    name, new = _qualified(database, spec.physical_name), _qualified(database, table)
    writer = (
        _commented(arranged(with_day(df, spec), spec), spec)
        .write.mode("overwrite").format("parquet")
        .option("maxRecordsPerFile", max_rows_per_file)
    )
    if spec.day_column:
        writer = writer.partitionBy(day_name(spec))
    if location:
        writer = writer.option("path", f"{location.rstrip('/')}/{spec.physical_name}/{run}")
    properties = {
        "primary_key": ",".join(spec.pk_cols),
        "clustered_by": ",".join(spec.cluster_cols),
        "fingerprint": spec.fingerprint(),
    }
    try:
        writer.saveAsTable(new)
        spark.sql(f"ALTER TABLE {new} SET TBLPROPERTIES ({_properties(properties)})")
        _switch(spark, spec.physical_name, table, database, properties, keep, location)
    except Exception:
        _remove(spark, new, location)
        raise
    return name


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _properties(values: dict[str, str]) -> str:
    return ", ".join(f"'{k}' = {_text(v)}" for k, v in values.items() if v)


def published_versions(spark: SparkSession, physical_name: str, database: str | None = None) -> list[str]:
    """Names of the tables behind a published name, oldest first; the last one is what readers see."""
    name = _qualified(database, physical_name)
    if not spark.catalog.tableExists(name):
        return []
    kept = spark.sql(f"SHOW TBLPROPERTIES {name}").where(F.col("key") == VERSIONS).first()
    return json.loads(kept["value"]) if kept else []


def _switch(spark: SparkSession, physical_name: str, table: str, database: str | None, properties: dict[str, str], keep: int, location: str | None) -> None:
    """Let the name show a new version, then remove versions that are no longer kept."""
    name = _qualified(database, physical_name)
    versions = published_versions(spark, physical_name, database)
    if not versions and spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        # A table that was no view yet becomes the first version.
        versions = [f"{table}__before"]
        spark.sql(f"ALTER TABLE {name} RENAME TO {_qualified(database, versions[0])}")
    versions.append(table)
    kept = versions[-1 - keep :]
    listed = _properties(properties | {VERSIONS: json.dumps(kept)})
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ({listed}) AS SELECT * FROM {_qualified(database, table)}")
    for old in versions[: -1 - keep]:
        _remove(spark, _qualified(database, old), location)


def _remove(spark: SparkSession, table: str, location: str | None) -> None:
    """Drop a version with its files."""
    if not spark.catalog.tableExists(table):
        return
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    spark.sql(f"DROP TABLE {table}")
    if location and described:
        # Dropping an external table leaves its files; only a folder below this location is removed.
        path, fs = hadoop_path(spark, described["data_type"])
        root, _ = hadoop_path(spark, location)
        if fs.makeQualified(path).toString().startswith(f"{fs.makeQualified(root).toString()}/"):
            fs.delete(path, True)


def view_columns(spec: TableSpec, row_hash: bool = False) -> list[Column]:
    """All columns of the source table: stored ones by name, virtual ones by expression."""
    columns = [
        quoted(c.name) if c.is_physical else F.expr(c.virtual_expr or "NULL").alias(c.name)
        for c in spec.columns
    ]
    return [*columns, F.col("ROW_HASH")] if row_hash else columns


def logical_view(df: DataFrame, spec: TableSpec, row_hash: bool = False) -> DataFrame:
    """The view of a spec over its physical rows."""
    return df.select(*view_columns(spec, row_hash))


def publish_view(spark: SparkSession, spec: TableSpec, database: str | None = None, row_hash: bool = False) -> str | None:
    """Create the catalog view that restores virtual columns; None where the table has none."""
    if not spec.needs_view:
        return None
    items = [
        _sql(c.name) if c.is_physical else f"{c.virtual_expr or 'NULL'} AS {_sql(c.name)}"
        for c in spec.columns
    ]
    if row_hash:
        items.append("ROW_HASH")
    name = _qualified(database, spec.table)
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} AS SELECT {', '.join(items)} "
        f"FROM {_qualified(database, spec.physical_name)}"
    )
    return name


def load_table(
    spark: SparkSession,
    out: str,
    spec: TableSpec,
    fmt: str,
    row_hash: bool = False,
    sep: str = "\x10",
    database: str | None = None,
    location: str | None = None,
) -> str:
    """Replace the published table by all files of its export; gives the name to query."""
    place = TableDir(out, spec.schema, spec.table)
    df = read_export(spark, place.data, spec, fmt, row_hash, sep, with_file=True)
    table = publish_table(df, spec, database, location)
    return publish_view(spark, spec, database, row_hash) or table
