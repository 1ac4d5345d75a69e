"""Inputs of the registered queries, derived from the given tables by Spark."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelift.session import tune
from tablelift.sources.scan import dealt

# Columns of every table in the derived dictionary (fixed values):
# name, type, precision, scale, virtual expression, hidden, made by a user, comment.
DICTIONARY_COLUMNS = [
    ("ID", "NUMBER", 10, 0, None, "NO", "YES", "key of the table"),
    ("AMOUNT", "NUMBER", 12, 2, None, "NO", "YES", None),
    ("CREATED", "DATE", None, None, None, "NO", "YES", "creation time"),
    ("CHANGED", "TIMESTAMP(6) WITH TIME ZONE", None, None, None, "NO", "YES", None),
    ("PAYLOAD", "JSON", None, None, None, "NO", "YES", "document"),
    ("NOTE", "CLOB", None, None, None, "NO", "YES", None),
    ("DOUBLED", "NUMBER", None, None, " AMOUNT * 2 ", "NO", "YES", None),
    ("SYS_NC00008$", "RAW", None, None, None, "YES", "NO", None),
    ("OLD_CODE", "VARCHAR2", None, None, None, "YES", "YES", None),
]


# What a vague, silent or outdated dictionary says of the columns of six tables (fixed values), and what their scan makes of it:
# column, dictionary type, its Spark type, the Spark type chosen, the reason. Columns left out are not in the dictionary.
VAGUE_DICTIONARY = {
    "orders": [
        ("o_orderkey", "NUMBER", "string", "bigint", "dictionary is vague"), ("o_custkey", "NUMBER(5,0)", "bigint", "bigint", "-"),
        ("o_orderstatus", "CHAR", "string", "string", "-"), ("o_totalprice", "NUMBER(12,2)", "decimal(12,2)", "double", "floating in the source"),
        ("o_orderdate", "DATE", "timestamp_ntz", "timestamp_ntz", "-"), ("o_orderpriority", "", "string", "string", "dictionary is silent"),
    ],
    "customer": [
        ("c_custkey", "NUMBER(18,0)", "bigint", "bigint", "-"), ("c_name", "ENUM8", "string", "string", "unknown to the dictionary"),
        ("c_nationkey", "NUMBER", "string", "bigint", "dictionary is vague"), ("c_acctbal", "BINARY_DOUBLE", "double", "double", "-"),
        ("c_fax", "VARCHAR2", "string", "string", "not scanned"),
    ],
    "part": [
        ("p_partkey", "", "string", "bigint", "dictionary is silent"), ("p_name", "NUMBER(9,0)", "bigint", "bigint", "text in the source"),
        ("p_size", "VARCHAR2", "string", "int", "another kind in the source"), ("p_retailprice", "NUMBER", "string", "double", "dictionary is vague"),
    ],
    "lineitem": [
        ("l_orderkey", "NUMBER", "string", "bigint", "dictionary is vague"), ("l_quantity", "NUMBER(4,0)", "bigint", "double", "floating in the source"),
        ("l_linenumber", "NUMBER(2,1)", "decimal(2,1)", "decimal(11,1)", "widened"), ("l_shipdate", "TIMESTAMP(6)", "timestamp_ntz", "timestamp_ntz", "-"),
    ],
    "events": [
        ("event_id", "NUMBER(10,0)", "bigint", "bigint", "-"), ("ts", "", "string", "timestamp_ntz", "dictionary is silent"),
        ("value", "FLOAT", "double", "double", "-"), ("props", "JSON", "string", "string", "-"),
    ],
    "supplier": [("s_suppkey", "DATE", "timestamp_ntz", "bigint", "another kind in the source"), ("s_name", "RAW", "binary", "binary", "text in the source")],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table for CPU-heavy work; only the columns it needs are read and moved."""
    df = table(spark, sf_dir, name)
    return dealt(df, columns or df.columns)


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tablelift-")


def scratch(spark: SparkSession) -> str:
    """A new folder for files that every executor can reach."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = _local_folder()
    return f"{shared.rstrip('/')}/tablelift-{uuid.uuid4().hex}"


def dictionary(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Dictionary tables that describe one source table per order."""
    orders = spread_table(
        spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_custkey"
    )
    owner = F.concat(F.lit("OWNER_"), F.col("o_orderstatus")).alias("owner")
    name = F.concat(F.lit("T"), F.col("o_orderkey").cast("string"))
    base = orders.select(
        owner, name.alias("table_name"), "o_orderstatus", "o_orderpriority", "o_totalprice", "o_custkey"
    )
    described = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(t).alias("data_type"),
                F.lit(p).cast("int").alias("data_precision"),
                F.lit(s).cast("int").alias("data_scale"),
                F.lit("YES" if e else "NO").alias("virtual_column"),
                F.lit(e).cast("string").alias("data_default"),
                F.lit(hidden).alias("hidden_column"),
                F.lit(user).alias("user_generated"),
                F.lit("YES" if c == "ID" else "NO").alias("identity_column"),
                F.lit(None if hidden == "YES" else i + 1).cast("int").alias("column_id"),
                F.lit(i + 1).alias("internal_column_id"),
                F.lit(note).cast("string").alias("comments"),
            )
            for i, (c, t, p, s, e, hidden, user, note) in enumerate(DICTIONARY_COLUMNS)
        ]
    )
    exploded = base.select("owner", "table_name", "o_orderstatus", F.inline(described))
    constraint = F.concat(F.lit("PK_"), F.col("table_name")).alias("constraint_name")

    def rows(where: str, *structs) -> DataFrame:
        return base.where(where).select("owner", "table_name", constraint, F.inline(F.array(*structs)))

    def member(column: str, position: int):
        return F.struct(F.lit(column).alias("column_name"), F.lit(position).alias("position"))

    def index(name: str, column: str, position: int):
        return F.struct(
            F.lit(name).alias("index_name"), F.lit(column).alias("column_name"),
            F.lit(position).alias("column_position"),
        )

    return {
        "tables": base.select(
            "owner", "table_name",
            F.col("o_totalprice").cast("long").alias("num_rows"),
            F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("avg_row_len"),
            F.when(F.col("o_orderstatus") != "P", F.floor("o_totalprice")).alias("blocks"),
        ),
        "columns": exploded.drop("o_orderstatus", "comments"),
        "comments": exploded.where("o_orderstatus = 'O' AND comments IS NOT NULL").select(
            "owner", "table_name", "column_name", "comments"
        ),
        "constraints": base.select(
            "owner", "table_name", constraint,
            F.when(F.col("o_orderstatus") == "F", "U").otherwise("P").alias("constraint_type"),
        ),
        "cons_columns": rows("true", member("CREATED", 2), member("ID", 1)).drop("table_name"),
        "part_keys": rows("o_orderpriority = '1-URGENT'", member("CREATED", 1)).select(
            "owner", F.col("table_name").alias("name"), F.lit("TABLE").alias("object_type"),
            "column_name", F.col("position").alias("column_position"),
        ),
        "indexes": rows(
            "o_orderpriority <> '2-HIGH'",
            index("IX_B", "AMOUNT", 1), index("IX_A", "ID", 2), index("IX_A", "AMOUNT", 1),
        ).withColumnRenamed("owner", "table_owner").drop("constraint_name"),
        "segments": rows(
            "o_orderpriority = '3-MEDIUM'",
            F.struct((F.col("o_totalprice") * 1000).cast("long").alias("bytes")),
            F.struct(F.lit(1_000_000_000).cast("long").alias("bytes")),
        ).select("owner", F.col("table_name").alias("segment_name"), "bytes"),
    }


def task_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as chunk results: one table per event type and day, one chunk per hour."""
    chunks = (
        table(spark, sf_dir, "events")
        .groupBy(
            F.upper("event_type").alias("schema"),
            F.concat(F.lit("D"), F.to_date("ts").cast("string")).alias("table"),
            F.hour("ts").cast("long").alias("chunk_id"),
        )
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.octet_length("props")).alias("bytes"),
            F.max("value").alias("seconds"),
            F.min("value").alias("lowest"),
        )
    )
    failed = F.col("lowest") < 0.5
    text = F.when(F.col("chunk_id") < 6, "").otherwise(
        F.concat(F.lit("hour "), F.col("chunk_id").cast("string"), F.lit(": "), F.col("rows").cast("string"), F.lit(" rows lost"))
    )
    return chunks.select(
        "schema", "table", "chunk_id",
        *[F.when(failed, F.lit(0)).otherwise(F.col(c)).alias(c) for c in ("rows", "bytes", "seconds")],
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(failed, text).alias("error"),
    )


def task_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables of a run: those with tasks, and one per event type that had none."""
    events = table(spark, sf_dir, "events")
    schema = F.upper("event_type").alias("schema")
    days = events.select(schema, F.concat(F.lit("D"), F.to_date("ts").cast("string")).alias("table"))
    return days.unionByName(events.select(schema, F.lit("EMPTY").alias("table"))).distinct()


def completion_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completion records of the days on which a table lost nothing, for some event types."""
    days = (
        table(spark, sf_dir, "events")
        .where("event_type <> 'view'")
        .groupBy(
            F.upper("event_type").alias("schema"),
            F.concat(F.lit("D"), F.to_date("ts").cast("string")).alias("table"),
        )
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum("event_id").cast("string").alias("pk_hash"),
            F.count(F.when(F.col("value") > 400, 1)).alias("sums"),
        )
    )
    return days.withColumn("pk_hash", F.when(F.col("schema") != "CLICK", F.col("pk_hash")))
