"""Catalog discovery: dictionary tables in, one specification per table out.

Every schema is discovered in the same job; the dictionary tables may be read
over JDBC or be any DataFrames with the column names used below.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.plans.types import map_types

TABLE = ["owner", "table_name"]
_GIB = 1024.0**3
_LAST = 2**31 - 1
# Fixed value: a source text this long may have been cut by the database driver.
LONG_EXPRESSION = 32_760


def name_set(
    spark: SparkSession,
    one: str | None = None,
    many: Iterable[str] = (),
    file: str | None = None,
    default: str | None = None,
) -> DataFrame:
    """Names from up to three places, upper-cased, each once, sorted.

    ``default`` is used only where nothing else gives a name.
    """
    given = [*([one] if one else []), *many]
    names = spark.createDataFrame([(n,) for n in given], "name string")
    if file:
        names = names.union(spark.read.text(file).toDF("name"))
    names = (
        names.select(F.upper(F.trim(F.translate("name", "\r", ""))).alias("name"))
        .where("name <> ''")
        .distinct()
    )
    if default and names.isEmpty():
        names = spark.createDataFrame([(default.upper(),)], "name string")
    return names.orderBy("name")


def list_tables(tables: DataFrame, schemas: Iterable[str] | DataFrame | None = None) -> DataFrame:
    """Tables of the given schemas (all when None), by name; a frame names them in ``name``."""
    if isinstance(schemas, DataFrame):
        wanted = schemas.select(F.upper("name").alias("__name"))
        tables = tables.join(wanted, tables["owner"] == wanted["__name"], "left_semi")
    elif schemas is not None:
        tables = tables.where(F.col("owner").isin([s.upper() for s in schemas]))
    return tables.orderBy(*TABLE)


def keep_tables(tables: DataFrame, names: DataFrame | None) -> DataFrame:
    """Only tables named in ``names.name``, in any case; None keeps all."""
    return tables if names is None else _match(tables, names, "left_semi")


def drop_tables(tables: DataFrame, names: DataFrame | None) -> DataFrame:
    """All tables but those named in ``names.name``, in any case."""
    return tables if names is None else _match(tables, names, "left_anti")


def _match(tables: DataFrame, names: DataFrame, how: str) -> DataFrame:
    wanted = names.select(F.upper("name").alias("__name"))
    return tables.join(wanted, F.upper(tables["table_name"]) == wanted["__name"], how)


def _yes(name: str) -> Column:
    return F.coalesce(F.col(name) == "YES", F.lit(False))


def columns_of(columns: DataFrame, comments: DataFrame, number_fallback: str = "string") -> DataFrame:
    """One row per user-visible column, with comment, flags and mapped types.

    Hidden columns stay only where a user made them. ``position`` orders the
    columns of a table; columns without a number come last.
    """
    keys = [*TABLE, "column_name"]
    return _uncommented(columns, number_fallback).join(comments.select(*keys, "comments"), keys, "left")


def _uncommented(columns: DataFrame, number_fallback: str) -> DataFrame:
    visible = columns.where(~_yes("hidden_column") | _yes("user_generated"))
    return map_types(visible, number_fallback).select(
        *TABLE,
        "column_name",
        F.struct(
            F.coalesce("column_id", F.lit(_LAST)).alias("column_id"),
            F.coalesce("internal_column_id", F.lit(_LAST)).alias("internal_column_id"),
        ).alias("position"),
        "data_type",
        "target_type",
        "spark_type",
        "is_transformed",
        _yes("virtual_column").alias("is_virtual"),
        F.when(_yes("virtual_column"), F.trim("data_default")).alias("virtual_expr"),
        (_yes("virtual_column") & F.coalesce(F.octet_length("data_default") >= LONG_EXPRESSION, F.lit(False))).alias("may_be_cut"),
        _yes("hidden_column").alias("is_hidden"),
        _yes("identity_column").alias("is_identity"),
    )


def virtual_exprs(columns: DataFrame) -> DataFrame:
    """Expressions of virtual columns; ``may_be_cut`` marks suspiciously long ones."""
    return columns.where(_yes("virtual_column") & F.col("data_default").isNotNull()).select(
        *TABLE,
        F.upper("column_name").alias("column_name"),
        F.trim("data_default").alias("virtual_expr"),
        (F.octet_length("data_default") >= LONG_EXPRESSION).alias("may_be_cut"),
    )


def pk_of(constraints: DataFrame, cons_columns: DataFrame) -> DataFrame:
    """(owner, table_name, position, column_name) of primary keys."""
    keys = constraints.where("constraint_type = 'P'").select(*TABLE, "constraint_name")
    members = cons_columns.select("owner", "constraint_name", "column_name", "position")
    return keys.join(members, ["owner", "constraint_name"], "inner").select(
        *TABLE, "position", "column_name"
    )


def partition_cols_of(part_keys: DataFrame) -> DataFrame:
    return part_keys.where("object_type = 'TABLE'").select(
        "owner", F.col("name").alias("table_name"), F.col("column_position").alias("position"), "column_name"
    )


def index_cols_of(indexes: DataFrame) -> DataFrame:
    """Index columns by index name and position; a column of two indexes comes twice."""
    return indexes.select(
        F.col("table_owner").alias("owner"),
        "table_name",
        F.struct("index_name", "column_position").alias("position"),
        "column_name",
    )


def _place(name, first, second) -> Column:
    """Where a member stands in its list: by name, then by two numbers."""
    fields = (("name", "string", name), ("first", "long", first), ("second", "long", second))
    return F.struct(*[(F.lit(None) if c is None else F.col(c)).cast(t).alias(n) for n, t, c in fields]).alias("place")


def table_sizes(tables: DataFrame, segments: DataFrame, own_segments: DataFrame | None = None) -> DataFrame:
    """``size_gb`` per table: all segments, else own segments, else statistics, else 0."""
    total = segments.groupBy("owner", F.col("segment_name").alias("table_name")).agg(
        F.sum("bytes").alias("__all")
    )
    sized = tables.join(total, TABLE, "left")
    estimate = F.col("num_rows").cast("double") * F.col("avg_row_len").cast("double")
    candidates = [F.col("__all").cast("double")]
    if own_segments is not None:
        own = own_segments.groupBy(F.col("segment_name").alias("table_name")).agg(
            F.sum("bytes").alias("__own")
        )
        sized = sized.join(own, "table_name", "left")
        candidates.append(F.col("__own").cast("double"))
    size = F.coalesce(*[c / F.lit(_GIB) for c in [*candidates, estimate]], F.lit(0.0))
    return sized.withColumn("size_gb", size).drop("__all", "__own")


def discover(
    tables: DataFrame,
    columns: DataFrame,
    comments: DataFrame,
    constraints: DataFrame,
    cons_columns: DataFrame,
    part_keys: DataFrame,
    indexes: DataFrame,
    segments: DataFrame,
    own_segments: DataFrame | None = None,
    number_fallback: str = "string",
) -> DataFrame:
    """One row per table with everything an export needs (``TableSpec.from_row`` reads it), by schema and name.

    ``tables`` decides which tables come out; narrow it with :func:`list_tables`,
    :func:`keep_tables` and :func:`drop_tables` first.
    """
    detail = _uncommented(columns, number_fallback)
    fields = [c for c in detail.columns if c not in (*TABLE, "position")]
    described = T.StructType([detail.schema[f] for f in fields])
    no_member, no_column = F.lit(None).cast("string").alias("member"), F.lit(None).cast(described).alias("column")
    keys = {
        "pk_cols": (pk_of(constraints, cons_columns), _place(None, "position", None)),
        "partition_cols": (partition_cols_of(part_keys), _place(None, "position", None)),
        "index_cols": (index_cols_of(indexes), _place("position.index_name", "position.column_position", None)),
    }
    # All that belongs to a table is stacked and grouped once, comments too: columns find theirs in the list of their table,
    # without a shuffle of their own. A database limits the columns of one table, so the lists stay short.
    stacked = detail.select(
        *TABLE, F.lit("columns").alias("kind"), _place(None, "position.column_id", "position.internal_column_id"),
        no_member, F.struct(*fields).alias("column"),
    )
    named = comments.select(
        *TABLE, F.lit("comments").alias("kind"), _place("column_name", None, None), F.col("comments").cast("string").alias("member"), no_column
    )
    stacked = stacked.unionByName(named)
    for kind, (rows, place) in keys.items():
        members = rows.select(*TABLE, F.lit(kind).alias("kind"), place, F.col("column_name").alias("member"), no_column)
        stacked = stacked.unionByName(members)

    def sorted_list(kind: str) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct("place", "member", "column"))))

    def listed(kind: str, value: str) -> Column:
        return F.transform(sorted_list(kind), lambda x: x[value]).alias(kind)

    def commented(c: Column) -> Column:
        """The column once for each of its comments, or once without."""
        def with_comment(text: Column) -> Column:
            return F.struct(*[c[f].alias(f) for f in fields], text.alias("comments"))

        own = F.filter("__comments", lambda x: x["place"]["name"] == c["column_name"])
        return F.when(F.size(own) == 0, F.array(with_comment(F.lit(None).cast("string")))).otherwise(F.transform(own, lambda x: with_comment(x["member"])))

    lists = [listed("columns", "column"), sorted_list("comments").alias("__comments"), *[listed(kind, "member") for kind in keys]]
    grouped = stacked.groupBy(*TABLE).agg(*lists).withColumn("columns", F.flatten(F.transform("columns", commented))).drop("__comments")
    joined = table_sizes(tables, segments, own_segments).join(grouped, TABLE, "left")
    none = F.array().cast("array<string>")
    return joined.select(
        F.col("owner").alias("schema"),
        F.col("table_name").alias("table"),
        F.coalesce("columns", F.array().cast(T.ArrayType(T.StructType([*described.fields, T.StructField("comments", T.StringType())])))).alias("columns"),
        "size_gb",
        "blocks",
        *[F.coalesce(n, none).alias(n) for n in keys],
    ).orderBy("schema", "table")
