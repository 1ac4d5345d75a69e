"""The registered queries: every operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import tablelift as tl
from checks.frames import (
    VAGUE_DICTIONARY, completion_records, dictionary, scratch, spread_table, table, task_results, task_tables,
)
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tablelift.functions import rewrites
from tablelift.functions.text import csv_value
from tablelift.functions.widths import columnar_bytes, text_bytes
from tablelift.operators import results as reports
from tablelift.operators.validate import summed_columns, validation_record
from tablelift.plans.spec import ColumnSpec, TableSpec
from tablelift.sinks.files import TableDir
from tablelift.sinks.manifest import delete_folder, delete_manifest, lost_values, manifest_checks, read_manifest, read_refusals
from tablelift.sinks.publish import logical_view, published_versions, with_day
from tablelift.sources.catalog import drop_tables, keep_tables, list_tables, name_set
from tablelift.sources.chunks import range_predicates, split_predicates
from tablelift.sources.statement import stated_by_spark

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CHUNKS = 16
DATABASE = "tablelift_checks"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _source(sf_dir: str) -> tl.FileSource:
    return tl.FileSource(sf_dir.rstrip("/") + "/{table}.parquet")


def _spec(spark: SparkSession, sf_dir: str, name: str, **keys) -> TableSpec:
    return TableSpec.from_frame(table(spark, sf_dir, name), "TPC", name, **keys)


def _stacked(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- scans -------------------------------------------------------------------


@query
def scan_project(spark, sf_dir):
    spec = _spec(spark, sf_dir, "orders", virtual={"order_year": "year(o_orderdate)"})
    return tl.scan(spark, _source(sf_dir), spec)


@query
def scan_where(spark, sf_dir):
    spec = TableSpec.from_frame(
        table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"),
        "TPC", "lineitem",
    )
    where = "l_shipdate >= TIMESTAMP_NTZ '1998-01-01' AND l_returnflag = 'R'"
    return tl.scan(spark, _source(sf_dir), spec, where)


@query
def scan_chunks_union(spark, sf_dir):
    """A table in many files, read back as the union of chunks of whole files; each chunk opens its own files only."""
    spec, out = _spec(spark, sf_dir, "lineitem"), scratch(spark)
    rows = table(spark, sf_dir, "lineitem").count()
    tl.export_table(spark, _source(sf_dir), spec, out, tl.ExportOptions(fmt="parquet", max_rows_per_file=-(-rows // (3 * CHUNKS))))
    source = tl.FileSource(f"{out}/{{schema}}/{{table}}/data")
    chunks = source.chunks(spark, spec, CHUNKS)
    parts = [tl.scan_chunk(spark, source, spec, c).withColumns({"chunk_rows": F.lit(c.rows)}) for c in chunks]
    whole = _stacked(parts)
    return whole.withColumns({"chunks": F.lit(len(chunks)), "rows_of_chunks": F.lit(sum(c.rows for c in chunks))}).drop("chunk_rows")


@query
def chunk_text_ranges(spark, sf_dir):
    """Ranges of a text key under a case-insensitive collation: how many match each row, and whether each holds the rows its ledger says."""
    part = table(spark, sf_dir, "part")
    mixed = F.when(F.col("p_partkey") % 3 == 0, F.upper("p_name")).when(F.col("p_partkey") % 7 != 0, F.col("p_name"))
    named = part.select("p_partkey", "p_name", mixed.alias("k")).withColumn("k", F.expr("k COLLATE UTF8_LCASE"))
    chunks = tl.key_ledger(named, "k", CHUNKS)
    # What arrives by each predicate, a row once for each predicate that matches it.
    hits = F.array_compact(F.array(*[F.when(F.expr(c.predicate), F.lit(c.chunk_id)) for c in chunks]))
    stated = F.element_at(F.array(*[F.lit(c.rows) for c in chunks]), F.col("chunk_id") + 1)
    read = named.withColumn("hits", hits).select("p_partkey", "p_name", F.size("hits").alias("ranges_matched"), F.explode_outer("hits").alias("chunk_id"))
    arrived = read.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("arrived"))
    return read.join(arrived, "chunk_id", "left").select("p_partkey", "p_name", "ranges_matched", stated.eqNullSafe(F.col("arrived")).alias("as_stated"))


@query
def chunk_predicates(spark, sf_dir):
    """How many of the ranges, and of their parts by a salt that is NULL or negative for some rows, match each row."""
    lineitem = table(spark, sf_dir, "lineitem")
    key = F.when(F.col("l_quantity") != 7, F.col("l_orderkey"))
    salted = lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", key.alias("k"),
        F.when(F.col("l_linenumber") != 3, F.col("l_partkey") * F.when(F.col("l_returnflag") == "A", -1).otherwise(1)).alias("salt"),
    )
    ends = lineitem.agg(F.min("l_orderkey").alias("lo"), F.max("l_orderkey").alias("hi")).first()
    ranges = range_predicates("k", [ends["lo"] + (ends["hi"] - ends["lo"]) * i // 5 for i in range(1, 5)])
    matches = lambda tests: sum(F.coalesce(F.expr(t), F.lit(False)).cast("int") for t in tests)
    return salted.select(
        "l_orderkey", "l_linenumber", "l_quantity",
        matches(ranges).alias("ranges_matched"), matches(split_predicates(ranges, "salt", 4)).alias("parts_matched"),
    )


@query
def chunk_bounds(spark, sf_dir):
    return tl.chunk_bounds(table(spark, sf_dir, "lineitem"), "l_orderkey", CHUNKS)


@query
def plan_tasks(spark, sf_dir):
    sized = dictionary(spark, sf_dir)["tables"].select(
        F.col("owner").alias("schema"),
        F.col("table_name").alias("table"),
        (F.col("num_rows") / F.lit(100_000.0)).alias("size_gb"),
        "blocks",
    )
    tasks = tl.plan_tasks(sized, parallel=4)
    # Whole tables have no chunk: text keeps the missing numbers apart from zero.
    return tasks.select(
        "schema", "table", "file_name",
        *[F.coalesce(F.col(c).cast("string"), F.lit("-")).alias(c) for c in ("chunk_id", "block_lo", "block_hi")],
    )


@query
def table_sizes(spark, sf_dir):
    """Sizes of tables that no dictionary describes, from their files, and the scan tasks they lead to."""
    source = _source(sf_dir)
    names = [*VALIDATED, "region", "nation", "supplier", "documents"]
    specs = [_spec(spark, sf_dir, t) for t in names]
    sized = spark.createDataFrame(
        [(s.schema, s.table, source.size_gb(spark, s), len(source.chunks(spark, s, CHUNKS)), sum(c.rows for c in source.chunks(spark, s, CHUNKS))) for s in specs],
        "schema string, table string, size_gb double, blocks long, rows long",
    )
    tasks = tl.plan_tasks(sized, parallel=4)
    known = sized.select("schema", "table", "rows", (F.col("size_gb") > 0).alias("known"))
    return tasks.join(known, ["schema", "table"]).select("table", "rows", "known", "file_name", F.col("chunk_id").isNull().alias("whole"))


# --- catalog -----------------------------------------------------------------


@query
def discover_catalog(spark, sf_dir):
    frames = dictionary(spark, sf_dir)
    keep = name_set(spark, many=["owner_o", " OWNER_P ", "owner_o"])
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '4-NOT SPECIFIED'")
    excluded = urgent.select(F.concat(F.lit("t"), F.col("o_orderkey").cast("string")).alias("name"))
    included = table(spark, sf_dir, "orders").where("o_totalprice > 50000").select(
        F.concat(F.lit("t"), F.col("o_orderkey").cast("string")).alias("name")
    )
    tables = drop_tables(keep_tables(list_tables(frames.pop("tables"), keep), included), excluded)
    specs = tl.discover(tables, **frames)
    described = F.transform(
        "columns",
        lambda c: F.concat_ws(
            ":", c["column_name"], c["target_type"], c["spark_type"],
            c["is_transformed"].cast("string"), c["is_virtual"].cast("string"),
            F.coalesce(c["virtual_expr"], F.lit("-")), F.coalesce(c["comments"], F.lit("-")),
        ),
    )
    return specs.select(
        "schema", "table",
        F.array_join(described, ",").alias("columns"),
        F.round("size_gb", 9).alias("size_gb"),
        *[F.array_join(c, ",").alias(c) for c in ("pk_cols", "partition_cols", "index_cols")],
    )


@query
def map_types(spark, sf_dir):
    part = spread_table(spark, sf_dir, "part", "p_partkey", "p_size")
    names = [
        "NUMBER", "number(10,2)", "NUMBER(38)", "FLOAT", "BINARY_DOUBLE", "VARCHAR2", "NCLOB", "LONG", "LONG RAW",
        "ROWID", "UROWID", "DATE", "TIMESTAMP(9)", "TIMESTAMP(6) WITH TIME ZONE",
        "TIMESTAMP(3) WITH LOCAL TIME ZONE", "RAW", "BLOB", "XMLTYPE", "JSON", "BOOLEAN", "SDO_GEOMETRY",
        "INTERVAL YEAR(2) TO MONTH", "INTERVAL DAY(2) TO SECOND(6)", "SOMETHING_ELSE",
    ]
    typed = part.select(
        "p_partkey",
        F.explode(F.array(*[F.lit(n) for n in names])).alias("data_type"),
        F.when((F.col("data_type") == "NUMBER") & (F.col("p_size") < 45), F.least("p_size", F.lit(38))).alias("data_precision"),
        F.when((F.col("data_type") == "NUMBER") & (F.col("p_size") < 48), F.col("p_size") - 20).alias("data_scale"),
    )
    return tl.map_types(typed).select("p_partkey", "data_type", "target_type", "spark_type", "is_transformed")


@query
def refine_types(spark, sf_dir):
    """Types of six tables from a poor dictionary and the schema of their scan, and how many values each column then holds."""
    specs = []
    for name, columns in VAGUE_DICTIONARY.items():
        rows = spark.createDataFrame([(c, raw) for c, raw, *_ in columns], "column_name string, data_type string")
        mapped = {r["column_name"]: r for r in tl.map_types(rows).collect()}
        told = [(c, raw, mapped[c]["target_type"], mapped[c]["spark_type"], mapped[c]["is_transformed"]) for c, raw, *_ in columns]
        specs.append(TableSpec("TPC", name, tuple(ColumnSpec(c, raw, target, kind, is_transformed=t) for c, raw, target, kind, t in told)))
    out = []
    for refined in tl.refine_specs(spark, _source(sf_dir), specs):
        scanned = [d for d in refined.decisions if d[3] != "not scanned"]
        chosen = TableSpec("TPC", refined.spec.table, tuple(c for c in refined.spec.columns if c.name in {d[0] for d in scanned}))
        typed = tl.apply_types(tl.physical(table(spark, sf_dir, chosen.table), chosen), chosen)
        held = typed.agg(*[F.count(F.col(d[0])).alias(d[0]) for d in scanned])
        rows = [F.struct(F.lit(n).alias("column_name"), F.lit(a or "-").alias("dictionary"), F.lit(b).alias("chosen"), F.lit(why or "-").alias("note"), (F.col(n) if why != "not scanned" else F.lit(0).cast("long")).alias("n_values")) for n, a, b, why in refined.decisions]
        out.append(held.select(F.lit(chosen.table).alias("table_name"), F.inline(F.array(*rows))))
    return _stacked(out)


# --- projections -------------------------------------------------------------


@query
def apply_types(spark, sf_dir):
    text = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("cust"),
        F.col("o_totalprice").cast("string").alias("price"),
        F.col("o_orderdate").cast("string").alias("placed"),
        F.col("o_orderpriority").alias("priority"),
    )
    wanted = [
        ("o_orderkey", "NUMBER(18,0)", "INT64", "bigint"),
        ("cust", "NUMBER(18,0)", "INT64", "bigint"),
        ("price", "NUMBER(12,1)", "BIGNUMERIC", "decimal(12,1)"),
        ("placed", "DATE", "DATETIME", "timestamp_ntz"),
        ("priority", "NUMBER(38,2)", "BIGNUMERIC", "decimal(38,2)"),
    ]
    spec = TableSpec("TPC", "orders_text", tuple(ColumnSpec(*c) for c in wanted))
    typed = tl.apply_types(text, spec)
    return typed.withColumn("price", F.col("price").cast("string")).withColumn(
        "priority", F.coalesce(F.col("priority").cast("string"), F.lit("not a number"))
    )


@query
def csv_text(spark, sf_dir):
    return tl.csv_text(spread_table(spark, sf_dir, "lineitem"))


@query
def strip_newlines(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", rewrites.strip_newlines(F.col("text")).alias("text"))


@query
def xml_one_line(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    spec = TableSpec.from_frame(pages, "TPC", "pages", raw_types={"html": "XMLTYPE"})
    return tl.physical(pages, spec)


@query
def json_text(spark, sf_dir):
    props = F.col("props")
    return table(spark, sf_dir, "events").select(
        "event_id",
        rewrites.json_text(props).alias("one_line"),
        rewrites.json_text(props, normalize=True).alias("normalized"),
    )


@query
def ts_utc(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", rewrites.to_utc(F.col("ts"), "-05:00").alias("ts_utc")
    )


@query
def interval_ym(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.make_ym_interval(F.lit(0), F.col("l_quantity").cast("int") - 25).alias("span"),
    )
    return tl.physical(rows, TableSpec.from_frame(rows, "TPC", "spans"))


@query
def interval_ds(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.expr("ts - TIMESTAMP_NTZ '2024-01-15 00:00:00'").alias("span")
    )
    return tl.physical(rows, TableSpec.from_frame(rows, "TPC", "spans"))


@query
def virtual_view(spark, sf_dir):
    lineitem = table(spark, sf_dir, "lineitem")
    net = "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS STRING)"
    spec = TableSpec.from_frame(
        lineitem, "TPC", "lineitem", virtual={"net_price": net, "line_name": "concat('L', l_linenumber)", "lost": None}
    )
    return logical_view(tl.physical(lineitem, spec), spec).withColumn("lost", F.coalesce(F.col("lost").cast("string"), F.lit("none")))


@query
def partition_by_day(spark, sf_dir):
    spec = _spec(spark, sf_dir, "events", partition_cols=["ts"])
    days = with_day(table(spark, sf_dir, "events"), spec)
    return days.groupBy(F.col("ts_DAY").cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event")
    )


# --- hashing -----------------------------------------------------------------


@query
def col_hash(spark, sf_dir):
    return tl.column_hashes(spread_table(spark, sf_dir, "lineitem"))


@query
def row_hash(spark, sf_dir):
    orders = spread_table(spark, sf_dir, "orders")
    spec = TableSpec.from_frame(orders, "TPC", "orders")
    return tl.with_row_hash(tl.apply_types(tl.physical(orders, spec), spec), spec)


@query
def row_hash_wide(spark, sf_dir):
    lineitem = spread_table(spark, sf_dir, "lineitem")
    numbers = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    wide = lineitem.select(*lineitem.columns, *[(F.col(n) + i).alias(f"{n}_{i}") for i in range(1, 13) for n in numbers])
    hashed = tl.with_row_hash(wide, TableSpec.from_frame(wide, "TPC", "wide"))
    return hashed.select("l_orderkey", "l_linenumber", "ROW_HASH")


@query
def row_hash_documents(spark, sf_dir):
    documents = spread_table(spark, sf_dir, "documents")
    spec = TableSpec.from_frame(documents, "TPC", "documents")
    return tl.with_row_hash(documents, spec).select("doc_id", "ROW_HASH")


@query
def pk_hash(spark, sf_dir):
    keys = {
        "orders": ["o_orderkey"], "customer": ["c_custkey"], "events": ["event_id"],
        "lineitem": ["l_orderkey", "l_linenumber"], "conversations": ["conv_id", "turn", "role"],
    }
    return _stacked(
        [
            tl.pk_hash(spread_table(spark, sf_dir, t, *k), k).withColumn("table_name", F.lit(t))
            for t, k in keys.items()
        ]
    )


@query
def duplicate_rows(spark, sf_dir):
    documents = spread_table(spark, sf_dir, "documents", "text", "lang")
    return tl.duplicates(tl.with_row_hash(documents, TableSpec.from_frame(documents, "TPC", "documents")))


# --- validation --------------------------------------------------------------

VALIDATED = {
    "orders": ["o_orderkey"], "customer": ["c_custkey"], "part": ["p_partkey"],
    "events": ["event_id"], "lineitem": ["l_orderkey", "l_linenumber"],
}


def _all_stats(spark, sf_dir, with_pk_hash):
    def stats(name, keys):
        spec = _spec(spark, sf_dir, name, pk_cols=keys)
        needed = dict.fromkeys([*(keys if with_pk_hash else []), *summed_columns(table(spark, sf_dir, name), spec)])
        return tl.validate(spread_table(spark, sf_dir, name, *needed), spec, with_pk_hash)

    return _stacked([stats(t, k) for t, k in VALIDATED.items()])


@query
def validate_stats(spark, sf_dir):
    return validation_record(_all_stats(spark, sf_dir, True))


@query
def validate_sums(spark, sf_dir):
    return _all_stats(spark, sf_dir, False).where("metric = 'SUM'")


@query
def validate_sums_extreme(spark, sf_dir):
    """Sums of columns whose values lie from 1e-12 to 1e30 and beyond, with NaN and infinities among them."""
    lineitem = table(spark, sf_dir, "lineitem")
    price, line = F.col("l_extendedprice"), F.col("l_linenumber")
    scale = F.element_at(F.array(*[F.lit(float(x)) for x in ("1e-12", "1e-6", "1e-3", "1.0", "1e9", "1e18", "1e30")]), F.pmod(line, F.lit(7)) + 1)
    wide = lineitem.select(
        (price / F.lit(7.0)).alias("sevenths"), (price * F.lit(1e-12)).alias("tiny"), (price * scale).alias("mixed"),
        F.when(line == 1, float("nan")).when(line == 2, float("inf")).when(line == 3, float("-inf")).otherwise(price).alias("special"),
    )
    return tl.validate(wide, TableSpec.from_frame(wide, "TPC", "extreme"))


@query
def logical_bytes(spark, sf_dir):
    def sizes(name):
        df = spread_table(spark, sf_dir, name)
        names = [f"text {c}" for c in df.columns]
        both = df.select("*", *[csv_value(F.col(f.name), f.dataType).alias(n) for f, n in zip(df.schema, names)])
        return both.agg(
            F.count(F.lit(1)).alias("rows"), columnar_bytes(df.schema).alias("parquet_bytes"), text_bytes(names).alias("csv_bytes")
        ).withColumn("table_name", F.lit(name))

    return _stacked([sizes(t) for t in ("events", "documents", "orders")])


@query
def reconcile_stats(spark, sf_dir):
    whole = table(spark, sf_dir, "lineitem")
    spec = TableSpec.from_frame(whole, "TPC", "lineitem", pk_cols=["l_orderkey", "l_linenumber"])
    lineitem = spread_table(spark, sf_dir, "lineitem", *dict.fromkeys([*summed_columns(whole, spec), "l_returnflag"]))
    target = lineitem.withColumn(
        "l_tax", F.when(F.col("l_returnflag") == "A", 0.0).otherwise(F.col("l_tax"))
    )
    return tl.reconcile(tl.validate(lineitem, spec, True), tl.validate(target, spec, True))


@query
def row_diff(spark, sf_dir):
    orders = spread_table(spark, sf_dir, "orders")
    spec = TableSpec.from_frame(orders, "TPC", "orders")
    changed = orders.where("o_orderstatus <> 'P'").withColumn(
        "o_totalprice",
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
    )
    added = orders.where("o_orderpriority = '5-LOW'").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    target = changed.unionByName(added)
    return tl.diff(tl.with_row_hash(orders, spec), tl.with_row_hash(target, spec), ["o_orderkey"])


@query
def row_diff_tree(spark, sf_dir):
    """Differences of two large tables that hardly differ, by digests of key ranges; keys repeat."""
    lineitem = spread_table(spark, sf_dir, "lineitem")
    spec = TableSpec.from_frame(lineitem, "TPC", "lineitem")
    dearer = (F.col("l_orderkey") % 997 == 3) & (F.col("l_linenumber") == 1)
    kept = lineitem.where("l_orderkey % 1009 <> 5").withColumn("l_extendedprice", F.col("l_extendedprice") + F.when(dearer, 1.0).otherwise(0.0))
    target = kept.unionByName(lineitem.where("l_orderkey % 1013 = 7").withColumn("l_orderkey", -1 - F.col("l_orderkey")))
    return tl.tree_diff(tl.with_row_hash(lineitem, spec), tl.with_row_hash(target, spec), ["l_orderkey", "l_linenumber"])


# --- run reports -------------------------------------------------------------


def _results(spark, sf_dir):
    return reports.table_results(task_results(spark, sf_dir), task_tables(spark, sf_dir))


@query
def table_results(spark, sf_dir):
    return _results(spark, sf_dir).withColumn("error", F.coalesce("error", F.lit("-")))


@query
def run_summary(spark, sf_dir):
    summary = reports.run_summary(_results(spark, sf_dir))
    return summary.withColumns(
        {c: F.round(c, 6) for c in ("total_duration_seconds", "total_mb_per_sec")}
    )


@query
def results_ranked(spark, sf_dir):
    return reports.results_ranked(_results(spark, sf_dir)).select("schema", "table", "seconds", "status")


@query
def export_audit(spark, sf_dir):
    rows = reports.audit(_results(spark, sf_dir), completion_records(spark, sf_dir))
    return rows.withColumn("error", F.coalesce("error", F.lit("-"))).withColumn(
        "validated_rows", F.coalesce("validated_rows", F.lit(-1))
    )


@query
def resume_pending(spark, sf_dir):
    return reports.pending(task_tables(spark, sf_dir), completion_records(spark, sf_dir))


# --- whole jobs --------------------------------------------------------------


def _round_trip(spark, sf_dir, name, options, **keys):
    out, spec = scratch(spark), _spec(spark, sf_dir, name, **keys)
    tl.export_table(spark, _source(sf_dir), spec, out, options)
    place = TableDir(out, spec.schema, spec.table)
    return tl.read_export(spark, place.data, spec, options.fmt, options.row_hash, options.sep)


@query
def export_parquet(spark, sf_dir):
    options = tl.ExportOptions(fmt="parquet", row_hash=True)
    return _round_trip(spark, sf_dir, "lineitem", options, pk_cols=["l_orderkey", "l_linenumber"])


@query
def export_csv(spark, sf_dir):
    return _round_trip(spark, sf_dir, "lineitem", tl.ExportOptions(fmt="csv"))


@query
def export_csv_text(spark, sf_dir):
    return _round_trip(spark, sf_dir, "documents", tl.ExportOptions(fmt="csv", sep=","))


@query
def export_verified(spark, sf_dir):
    out = scratch(spark)
    spec = _spec(spark, sf_dir, "orders", pk_cols=["o_orderkey"])
    tl.export_table(spark, _source(sf_dir), spec, out, tl.ExportOptions(fmt="csv", row_hash=True))
    return tl.verify_export(spark, spec, out)


@query
def export_cast_loss(spark, sf_dir):
    """What casts lose of orders kept as text: prices with too many digits, priorities that are no numbers."""
    def source(spark, spec):
        return table(spark, sf_dir, "orders").select(
            "o_orderkey", F.col("o_totalprice").cast("string").alias("price"), F.col("o_orderpriority").alias("priority"),
            F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey").cast("string")).alias("cust"), F.col("o_orderdate").cast("string").alias("placed"),
        )

    wanted = [
        ("o_orderkey", "NUMBER(18,0)", "INT64", "bigint"), ("price", "NUMBER(7,2)", "BIGNUMERIC", "decimal(7,2)"),
        ("priority", "NUMBER(38,2)", "BIGNUMERIC", "decimal(38,2)"), ("cust", "NUMBER(18,0)", "INT64", "bigint"), ("placed", "DATE", "DATETIME", "timestamp_ntz"),
    ]
    spec, out = TableSpec("TPC", "orders_text", tuple(ColumnSpec(*c) for c in wanted)), scratch(spark)
    tl.export_table(spark, source, spec, out, tl.ExportOptions(fmt="parquet", lost_values="record"))
    return lost_values(read_manifest(spark, out)).drop("schema", "table")


@query
def export_resumed(spark, sf_dir):
    """Two tables exported, then the same run again with one more: nothing is reported as broken."""
    out, names = scratch(spark), ("orders", "customer", "part")
    specs = [_spec(spark, sf_dir, t, pk_cols=VALIDATED[t]) for t in names]
    options = tl.ExportOptions(fmt="parquet", row_hash=True)
    tl.export_tables(spark, _source(sf_dir), specs[:2], out, options)
    second = tl.export_tables(spark, _source(sf_dir), specs, out, options)
    return tl.audit(second, manifest_checks(read_manifest(spark, out))).drop("error")


@query
def awkward_types(spark, sf_dir):
    """CSV text and row hash of binary, zoned, long-text and row-address columns."""
    documents = spread_table(spark, sf_dir, "documents", "doc_id", "text", "source", "n_chars")
    wide = documents.select(
        "doc_id", F.encode("text", "utf-8").alias("raw"), F.timestamp_seconds(F.col("n_chars") * 86413 + F.col("doc_id")).alias("at"),
        F.col("text").alias("body"), F.concat(F.lit("AAA"), F.col("doc_id").cast("string")).alias("address"), (F.col("n_chars") % 2 == 0).alias("even"),
    )
    spec = TableSpec.from_frame(wide, "TPC", "awkward", raw_types={"body": "CLOB", "address": "UROWID", "raw": "RAW"})
    typed = tl.with_row_hash(tl.apply_types(tl.physical(wide, spec), spec), spec)
    return tl.csv_text(typed)


@query
def ts_region(spark, sf_dir):
    """Wall clocks of a region with clock changes, written in UTC by the projection of every export."""
    rows = table(spark, sf_dir, "events").select("event_id", (F.col("ts") + F.make_dt_interval(F.pmod("event_id", F.lit(365)).cast("int"))).alias("ts"))
    return tl.physical(rows, TableSpec.from_frame(rows, "TPC", "events", zones={"ts": "America/New_York"}))


@query
def schema_record(spark, sf_dir):
    """The recorded schema of an exported table, and the row count of its files with small row groups."""
    out, spec = scratch(spark), _spec(spark, sf_dir, "customer", pk_cols=["c_custkey"], comments={"c_name": "full name"})
    tl.export_table(spark, _source(sf_dir), spec, out, tl.ExportOptions(fmt="parquet", row_hash=True, block_bytes=1 << 16))
    rows = spark.read.parquet(TableDir(out, spec.schema, spec.table).data).agg(F.count(F.lit(1))).scalar()
    fields = read_manifest(spark, out).select(F.inline("columns"))
    return fields.withColumns({"description": F.coalesce("description", F.lit("-")), "rows": rows})


@query
def export_many(spark, sf_dir):
    specs = [_spec(spark, sf_dir, t, pk_cols=k) for t, k in VALIDATED.items()]
    specs.append(TableSpec("TPC", "no_such_table", specs[0].columns))
    results = tl.export_tables(spark, _source(sf_dir), specs, scratch(spark), tl.ExportOptions(fmt="parquet"))
    return results.select("schema", "table", "rows", "bytes", "status", F.col("error").isNotNull().alias("has_error"))


@query
def inspect_export(spark, sf_dir):
    """Column types, row count and first rows of an exported table, as an inspection of its files shows them."""
    spec = _spec(spark, sf_dir, "customer", pk_cols=["c_custkey"])
    out = scratch(spark)
    tl.export_table(spark, _source(sf_dir), spec, out, tl.ExportOptions(fmt="csv", row_hash=True))
    back = tl.read_export(spark, TableDir(out, spec.schema, spec.table).data, spec, "csv", True)
    types, rows, look = tl.describe_export(back)
    shown = look.join(table(spark, sf_dir, "customer"), "c_custkey", "left_semi").count()
    return spark.createDataFrame([(n, t, rows, shown) for n, t in types], "column_name string, type string, rows long, shown long")


@query
def run_report(spark, sf_dir):
    """The report of a run of several tables, read back from its files."""
    out = scratch(spark)
    specs = [_spec(spark, sf_dir, t, pk_cols=k) for t, k in VALIDATED.items()]
    tl.export_tables(spark, _source(sf_dir), specs, out, tl.ExportOptions(fmt="parquet"))
    summary = spark.read.json(f"{out}/report_*/summary").select("total_tasks", "success", "failed", "total_rows").first()
    details = spark.read.json(f"{out}/report_*/details").select("table", "status", "rows")
    return details.withColumns({k: F.lit(v) for k, v in summary.asDict().items()})


@query
def published_layout(spark, sf_dir):
    """Cluster columns of a published table: the files hold ranges of them that do not overlap, however the rows came."""
    lineitem = table(spark, sf_dir, "lineitem").repartition(8, "l_partkey")
    spec = TableSpec.from_frame(lineitem, "TPC", "lineitem_clustered", pk_cols=["l_orderkey"], index_cols=["l_linenumber"])
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE}")
    name = tl.publish_table(lineitem, spec, DATABASE, f"{scratch(spark)}/published", max_rows_per_file=20_000)
    version = published_versions(spark, spec.physical_name, DATABASE)[-1]
    key = F.struct("l_orderkey", "l_linenumber")
    files = spark.table(f"{DATABASE}.`{version}`").groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    # One row for each file of at most 20,000 rows.
    before = F.lag("hi").over(Window.partitionBy(F.lit(1)).orderBy("lo", "hi"))
    overlaps = files.select((before > F.col("lo")).alias("over")).where("over").agg(F.count(F.lit(1))).scalar()
    return spark.table(name).withColumn("overlaps", overlaps)


class _Lossy:
    """Lineitem as a source that states what it has, and loses some rows on the way."""

    def __init__(self, sf_dir: str, lost: str):
        self.sf_dir, self.lost = sf_dir, lost

    def __call__(self, spark, spec):
        return table(spark, self.sf_dir, "lineitem").where(f"NOT ({self.lost})")

    def statement(self, spark, spec, where=None):
        return stated_by_spark(table(spark, self.sf_dir, "lineitem"), spec)


@query
def export_source_disagrees(spark, sf_dir):
    """A table whose source says otherwise than the rows that arrive: refused, and every figure that differs kept."""
    out, spec = scratch(spark), _spec(spark, sf_dir, "lineitem", pk_cols=["l_orderkey", "l_linenumber"])
    honest = TableSpec("TPC", "lineitem_whole", spec.columns)
    tl.export_tables(spark, _Lossy(sf_dir, "l_returnflag = 'R' AND l_linenumber = 7"), [spec], out, tl.ExportOptions(fmt="parquet"))
    tl.export_tables(spark, _Lossy(sf_dir, "false"), [honest], out, tl.ExportOptions(fmt="parquet"))
    refused = read_refusals(spark, out).select("table", "metric", F.coalesce("column_name", F.lit("")).alias("column_name"), "stated", "arrived")
    recorded = read_manifest(spark, out).select("table", F.lit("RECORDED").alias("metric"), F.lit("").alias("column_name"), F.col("rows").cast("string").alias("stated"), F.col("rows").cast("string").alias("arrived"))
    return refused.unionByName(recorded)


@query
def export_restarted(spark, sf_dir):
    """A table exported in chunks; one chunk's record goes, and the next run writes that chunk alone."""
    files, out = scratch(spark), scratch(spark)
    spec = _spec(spark, sf_dir, "lineitem", pk_cols=["l_orderkey", "l_linenumber"])
    rows = table(spark, sf_dir, "lineitem").count()
    tl.export_table(spark, _source(sf_dir), spec, files, tl.ExportOptions(fmt="parquet", max_rows_per_file=-(-rows // (3 * CHUNKS))))
    source, place = tl.FileSource(f"{files}/{{schema}}/{{table}}/data"), TableDir(out, spec.schema, spec.table)
    options = tl.ExportOptions(fmt="parquet", row_hash=True, parallel=CHUNKS // 2, chunk_threshold_gb=1e-9)

    def files_now():
        return set(spark.read.option("recursiveFileLookup", True).parquet(place.data).inputFiles())

    def run(name, before):
        result = tl.export_tables(spark, source, [spec], out, options).first()
        written = len({f.rsplit("/", 2)[1] for f in files_now() - before})
        kept = len({f.rsplit("/", 2)[1] for f in files_now() & before})
        return name, result["status"], result["rows"], read_manifest(spark, out).first()["chunks"], written, kept

    runs = [run("first", set())]
    delete_manifest(spark, place)
    delete_folder(spark, f"{place.chunks}/chunk_0003.json")
    runs.append(run("again", files_now()))
    done = spark.createDataFrame(runs, "run string, status string, rows long, chunks long, chunks_written long, chunks_kept long")
    matches = tl.verify_export(spark, spec, out).agg(F.min("matches")).scalar()
    held = tl.read_export(spark, place.data, spec, "parquet", True).agg(F.count(F.lit(1))).scalar()
    return done.withColumns({"rows_in_files": held, "verified": matches})


@query
def publish_and_load(spark, sf_dir):
    out = scratch(spark)
    spec = _spec(
        spark, sf_dir, "events", pk_cols=["event_id"], partition_cols=["ts"], index_cols=["user_id", "event_id"],
        virtual={"value_text": "CAST(CAST(value AS DECIMAL(12,2)) AS STRING)"}, comments={"ts": "time of the event"},
    )
    tl.export_table(spark, _source(sf_dir), spec, out, tl.ExportOptions(fmt="parquet"))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE}")
    for _ in range(2):  # the second load replaces the first
        view = tl.load_table(spark, out, spec, "parquet", database=DATABASE, location=f"{out}/published")
    return spark.table(view)
