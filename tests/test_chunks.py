from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from tablelift.jobs import export_frame
from tablelift.plans.options import ExportOptions
from tablelift.plans.spec import ColumnSpec, TableSpec
from tablelift.plans.tasks import is_large, plan_tasks
from tablelift.sources.chunks import (
    Chunk, balanced_cuts, chunk_bounds, chunk_of, even_chunks, key_ledger, ledger_chunks, ledger_query, range_predicates,
    salted_chunks, split_predicates, with_chunk,
)
from tablelift.sources.scan import FileSource, JdbcSource, dealt, scan, scan_chunk, scan_chunked


def test_bounds_against_brute_force(spark):
    keys = [3, 3, 4, 10, 25, 26, 100, None]
    got = chunk_bounds(spark.createDataFrame([(k,) for k in keys], "k long"), "k", 4).collect()
    width = 25  # ceil((100 - 3 + 1) / 4)
    want = {}
    for k in keys:
        i = 0 if k is None else (k - 3) // width
        want[i] = want.get(i, 0) + 1
    assert {r["chunk_id"]: r["rows"] for r in got} == want
    assert all((r["lo"], r["hi"]) == (3 + r["chunk_id"] * width, 3 + (r["chunk_id"] + 1) * width) for r in got)


def test_keys_beyond_double_precision(spark):
    base = 2**60
    df = spark.range(8).select((F.col("id") + base).alias("k"))
    got = sorted(tuple(r) for r in chunk_bounds(df, "k", 4).collect())
    assert got == [(i, base + 2 * i, base + 2 * i + 2, 2) for i in range(4)]


def test_more_chunks_than_keys(spark):
    df = spark.range(3).toDF("k")
    assert sorted(r["rows"] for r in chunk_bounds(df, "k", 50).collect()) == [1, 1, 1]
    with pytest.raises(ValueError):
        chunk_bounds(df, "k", 0)


def test_every_row_is_in_exactly_one_chunk(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") * F.col("id")).alias("k"))
    assert with_chunk(df, "k", 7).count() == 1000
    for cuts in ([], [5], balanced_cuts(df, "k", 8)):
        hits = sum(F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in range_predicates("k", cuts))
        assert df.select(hits.alias("n")).where("n <> 1").count() == 0


def test_balanced_cuts_follow_the_rows(spark):
    skewed = spark.range(10000).select(F.pow(F.col("id"), 3).cast("long").alias("k"))
    cuts = balanced_cuts(skewed, "k", 4)
    sizes = [skewed.where(p).count() for p in range_predicates("k", cuts)]
    assert len(sizes) == 4 and max(sizes) < 2600


def test_predicates_on_times():
    from datetime import date, datetime

    assert range_predicates("d", [datetime(2024, 1, 2, 3), date(2024, 5, 6)])[1] == (
        "(d >= TIMESTAMP '2024-01-02 03:00:00' AND d < DATE '2024-05-06')"
    )


def test_hot_key_is_split_by_salt(spark):
    df = spark.range(9000).select(F.when(F.col("id") < 6000, 5).otherwise(F.col("id")).alias("k"), "id")
    predicates = range_predicates("k", balanced_cuts(df, "k", 3))
    split = split_predicates(predicates, "id", 4)
    sizes = [df.where(p).count() for p in split]
    assert sum(sizes) == 9000 and max(sizes) <= 2250
    assert split_predicates(predicates, "id", 1) == predicates


def test_salts_that_are_missing_or_negative_lose_no_row(spark):
    df = spark.range(100).select(F.col("id").alias("k"), F.when(F.col("id") % 4 != 0, F.col("id") * F.when(F.col("id") % 3 == 0, -1).otherwise(1)).alias("s"))
    parts = split_predicates(range_predicates("k", [30, 60]), "s", 3)
    hits = sum(F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in parts)
    assert len(parts) == 9 and df.where(hits == 1).count() == 100
    assert df.select(chunk_of(parts).alias("c")).where("c IS NULL OR c NOT BETWEEN 0 AND 8").count() == 0


def test_ranges_of_text_keys(spark):
    df = spark.createDataFrame([("a",), ("it's",), ("m",), (None,), ("z",)], "k string")
    hits = sum(F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in range_predicates("k", ["j", "n"]))
    assert df.where(hits == 1).count() == 5 and "'it''s'" in range_predicates("k", ["it's"])[0]


def test_one_rule_for_large_tables():
    assert [is_large(x, 1.0) for x in (0.5, 1.0, 1.5, 0.0, None)] == [False, False, True, True, True]


def _matched(df, chunks):
    """Matches of every row, and rows of every chunk."""
    hits = sum(F.coalesce(F.expr(c.predicate), F.lit(False)).cast("int") for c in chunks)
    return df.where(hits != 1).count(), [df.where(c.predicate).count() for c in chunks]


def test_bounds_are_found_by_the_source(spark):
    """The pushed query, run by Spark in the database's place: even ranges of any orderable key, within the filter."""
    spark.range(1000).selectExpr("concat('k', lpad(id, 4, '0')) AS K1", "id AS N").createOrReplaceTempView("source_table")
    rows = spark.sql(f"SELECT * FROM {ledger_query('source_table', 'K1', 4, 'N >= 200')}").collect()
    assert sorted((r["B"], r["LO"], r["N"], r["RISES"]) for r in rows) == [(i, f"k0{2 * i + 2}00", 200, 1) for i in range(4)]


@pytest.mark.parametrize("n", [2, 6, 50])
def test_collated_text_keys_match_each_row_once(spark, n):
    names = ["anna", "Anna", "BERT", "bert", "Bert", "carl", "Zoe", "zOE", "Émile", None, None, "dora", "a", "B", "ab"] * 2 + [f"x{i}" for i in range(20)]
    df = spark.createDataFrame([(x, i) for i, x in enumerate(names)], "k string, i int").selectExpr("k COLLATE UTF8_LCASE AS k", "i")
    df.createOrReplaceTempView("collated")
    for chunks in (ledger_chunks("k", spark.sql(f"SELECT * FROM {ledger_query('collated', 'k', n)}").collect()), key_ledger(df, "k", n)):
        wrong, sizes = _matched(df, chunks)
        assert wrong == 0 and sizes == [c.rows for c in chunks] and sum(sizes) == len(names)
        assert len(chunks) >= min(n, 12)


def test_keys_that_do_not_rise_in_the_source_are_refused(spark):
    rows = spark.createDataFrame([(0, "a", 5, 1), (1, "C", 5, 1), (2, "b", 5, 0)], "B int, LO string, N long, RISES int").collect()
    with pytest.raises(ValueError, match="orders keys otherwise than it compares them, at 'b'"):
        ledger_chunks("k", rows)


def test_ledgers_without_keys(spark):
    none = spark.createDataFrame([(-1, None, 7, 1)], "B int, LO string, N long, RISES int").collect()
    assert ledger_chunks("k", none) == [Chunk(0, "1=1", rows=7)] and ledger_chunks("k", []) == [Chunk(0, "1=1", rows=0)]
    empty = spark.createDataFrame([], "k string, m map<string,int>")
    assert key_ledger(empty, "k", 4) == [Chunk(0, "1=1", rows=0)]


def test_hot_ranges_are_salted_others_stay():
    chunks = [Chunk(0, "a", rows=10), Chunk(1, "b", rows=80), Chunk(2, "c", rows=10)]
    out = salted_chunks(chunks, "s", 10)
    assert [c.chunk_id for c in out] == list(range(10)) and [c.rows for c in out] == [10, *[None] * 8, 10]
    assert len(salted_chunks([Chunk(0, "1=1")], "s", 4)) == 4


def test_files_in_even_chunks(spark, tmp_path):
    assert [c.files for c in even_chunks([("b", 10, 1), ("a", 10, 2), ("d", 10, 3), ("c", 10, 4)], 2)] == [("a", "b"), ("c", "d")]
    assert [(len(c.files), c.rows) for c in even_chunks([("a", 100, 5), ("b", 1, None), ("c", 1, 2)], 3)] == [(1, 5), (2, None)]
    assert even_chunks([], 3) == []
    folder = str(tmp_path / "odd name" / "T")
    spark.range(1000).selectExpr("id", "id % 2 AS half").repartition(8, "id").write.partitionBy("half").parquet(folder)
    source = FileSource(str(tmp_path) + "/odd name/{table}")
    spec = TableSpec.from_frame(spark.read.parquet(folder), "S", "T")
    chunks = source.chunks(spark, spec, 4)
    parts = [scan_chunk(spark, source, spec, c) for c in chunks]
    assert len(parts) == 4 and [p.count() for p in parts] == [c.rows for c in chunks]
    assert sum(len(p.inputFiles()) for p in parts) == 16 and max(len(p.inputFiles()) for p in parts) < 8
    assert sorted(map(tuple, parts[0].union(parts[1]).union(parts[2]).union(parts[3]).collect())) == [(i, i % 2) for i in range(1000)]
    # A row filter leaves the number of rows open; a known size is no unknown size.
    assert {c.rows for c in source.chunks(spark, spec, 4, "id > 3")} == {None}
    assert 0 < source.size_gb(spark, spec) < 1e-3


def test_plan_tasks(spark):
    specs = spark.createDataFrame(
        [("S", "BIG", 2.0, 10), ("S", "SMALL", 1.0, 10), ("S", "NOSTAT", 5.0, None), ("S", "TINY", 2.0, 2)],
        "schema string, table string, size_gb double, blocks long",
    )
    rows = {}
    for r in plan_tasks(specs, 4).collect():
        rows.setdefault(r["table"], []).append((r["chunk_id"], r["block_lo"], r["block_hi"], r["file_name"]))
    assert sorted(rows["BIG"]) == [
        (0, 0, 3, "data_chunk_0000.parquet"), (1, 3, 6, "data_chunk_0001.parquet"),
        (2, 6, 9, "data_chunk_0002.parquet"), (3, 9, 10, "data_chunk_0003.parquet"),
    ]
    assert rows["SMALL"] == [(None, None, None, "data.parquet")]
    assert sorted(r[:3] for r in rows["NOSTAT"])[-1] == (3, 750, 1000) and len(rows["TINY"]) == 2
    assert {r["chunk_id"] for r in plan_tasks(specs, 1, extension="csv.gz").collect()} == {None}


SPEC = TableSpec("HR", 'my"tab', (ColumnSpec("ID", "NUMBER", "INT64", "bigint"), ColumnSpec("LOC", "SDO_GEOMETRY", "STRING", "string")))


def test_database_relation_text():
    assert JdbcSource("jdbc:x").relation(SPEC) == '(SELECT "ID", "LOC" FROM "HR"."my""tab") t'
    odd = TableSpec("HR", "T", (
        ColumnSpec("Y", "INTERVAL YEAR(2) TO MONTH", "STRING", "string"), ColumnSpec("D", "INTERVAL DAY(2) TO SECOND(6)", "STRING", "string"),
        ColumnSpec("R", "UROWID", "STRING", "string"),
    ))
    text = JdbcSource("jdbc:x").relation(odd)
    assert 'EXTRACT(YEAR FROM "Y")' in text and "' 0 0:0:0'" in text and 'EXTRACT(SECOND FROM "D")' in text and 'CAST("R" AS VARCHAR(4000)) AS "R"' in text
    wkt = JdbcSource("jdbc:x", expressions={"LOC": 'SDO_UTIL.TO_WKTGEOMETRY("LOC")'})
    assert wkt.relation(SPEC) == '(SELECT "ID", SDO_UTIL.TO_WKTGEOMETRY("LOC") AS "LOC" FROM "HR"."my""tab") t'


def test_database_tables_are_cut_by_ranges_key_or_salt(spark, monkeypatch):
    keyed = replace(SPEC, pk_cols=("LOC", "ID"))
    asked, plans = [], []

    def load(self, spark, spec, predicates=None):
        asked.append((predicates, self.fetch_rows))
        return spark.createDataFrame([(1, "p")], "ID long, LOC string")

    def jdbc(self, url, table, **more):
        plans.append(table)
        if " s" == table[-2:]:
            return spark.createDataFrame([(9, 9, 8, 45)], "N long, C0 long, C1 long, S0 long")
        return spark.createDataFrame([(1, 3, 4, 1), (0, None, 1, 1), (2, 7, 4, 1)], "B int, LO int, N long, RISES int")

    monkeypatch.setattr(JdbcSource, "load", load)
    monkeypatch.setattr(type(spark.read), "jdbc", jdbc)
    assert JdbcSource("jdbc:x").chunks(spark, keyed, 3, "ID > 1") == [Chunk(0, '("ID" < 7 OR "ID" IS NULL)', rows=5), Chunk(1, '("ID" >= 7)', rows=4)]
    assert "* 3 / COUNT(*)" in plans[-1] and "WHERE (ID > 1)" in plans[-1]
    assert len(JdbcSource("jdbc:x", salt="ORA_HASH(ROWID)").chunks(spark, keyed, 8)) == 9
    assert len(JdbcSource("jdbc:x", salt="ORA_HASH(ROWID)").chunks(spark, SPEC, 4)) == 4
    two = JdbcSource("jdbc:x", ranges={'HR.my"tab': ["a", "b"]})
    assert [c.predicate for c in two.chunks(spark, keyed, 4)] == ["a", "b"]
    assert two.chunks(spark, replace(SPEC, schema="OTHER"), 4) is None and JdbcSource("jdbc:x").chunks(spark, SPEC, 4) is None
    said = {(r.metric, r.column_name): r.value for r in JdbcSource("jdbc:x").statement(spark, keyed, "ID > 1").collect()}
    assert said == {("ROW_COUNT", None): "9", ("NON_NULL", "ID"): "9", ("NON_NULL", "LOC"): "8", ("SUM", "ID"): "45"}
    # Any table above the threshold, or of unknown size, goes this way; the option of the job sets the fetch size.
    export_frame(spark, JdbcSource("jdbc:x"), keyed, ExportOptions(parallel=3, fetch_rows=77))
    assert asked[-1] == (['("ID" < 7 OR "ID" IS NULL)', '("ID" >= 7)'], 77)
    export_frame(spark, JdbcSource("jdbc:x"), replace(keyed, size_gb=0.1), ExportOptions(parallel=3))
    assert asked[-1] == (None, 10_000)
    monkeypatch.setattr(type(spark.read), "jdbc", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        scan_chunked(spark, JdbcSource("jdbc:x"), keyed, 4)


def test_filter_and_columns_reach_the_files(spark, tmp_path):
    spark.range(100).selectExpr("id", "id * 2 AS x", "id * 3 AS y").write.parquet(str(tmp_path / "T"))
    src = FileSource(str(tmp_path) + "/{table}")
    spec = TableSpec.from_frame(spark.read.parquet(str(tmp_path / "T")).select("id"), "S", "T")
    df = scan(spark, src, spec, "x > 20")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert df.columns == ["id"] and df.count() == 89
    assert "PushedFilters: [IsNotNull(x), GreaterThan(x,20)]" in plan and "y" not in plan.split("ReadSchema")[1]
    assert scan_chunked(spark, src, spec, 4).count() == 100


def test_small_files_are_dealt_out_evenly_and_pruned(spark, tmp_path):
    spark.range(20000).selectExpr("1 AS same", "id", "id * 2 AS other").coalesce(1).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = dealt(df, ["same"], tasks=4)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert out.columns == ["same"] and len(sizes) == 4 and sum(sizes) == 20000 and max(sizes) < 6000
    assert "other" not in out._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    assert dealt(df, ["id"], most_bytes=10, tasks=4).rdd.getNumPartitions() == 1
    assert dealt(spark.range(5).toDF("id").coalesce(1), ["id"], tasks=4).rdd.getNumPartitions() == 1
