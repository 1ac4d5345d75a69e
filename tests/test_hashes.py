import hashlib

import pytest
from pyspark.sql import functions as F
from tablelift.operators.rowhash import duplicates, pk_hash, with_row_hash
from tablelift.plans.spec import TableSpec


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest().upper()


def fold(parts):
    groups = [sha("".join(parts[i : i + 50])) for i in range(0, len(parts), 50)]
    return sha("".join(groups)) if parts else sha("")


@pytest.mark.parametrize("width", [1, 49, 50, 51, 120])
def test_fold_matches_brute_force(spark, width):
    df = spark.range(3).select(*[(F.col("id") * 7 + i).alias(f"c{i}") for i in range(width)])
    got = with_row_hash(df, TableSpec.from_frame(df, "S", "T")).collect()
    for r in got:
        assert r["ROW_HASH"] == fold([sha(str(r[f"c{i}"])) for i in range(width)])


def test_null_and_empty_text_hash_alike(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "k string, v string")
    assert with_row_hash(df, TableSpec.from_frame(df, "S", "T")).select("ROW_HASH").distinct().count() == 1


def test_unhashed_columns_do_not_count(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y")], "k int, doc string")
    spec = TableSpec.from_frame(df, "S", "T", raw_types={"doc": "CLOB"})
    assert [r["ROW_HASH"] for r in with_row_hash(df, spec).collect()] == [fold([sha("1")])] * 2
    none = TableSpec.from_frame(df.select("doc"), "S", "T", raw_types={"doc": "CLOB"})
    assert with_row_hash(df.select("doc"), none).first()["ROW_HASH"] == sha("")


@pytest.mark.parametrize("zone, ansi", [("UTC", "true"), ("America/New_York", "false")])
def test_hash_depends_on_nothing_but_the_row(spark, settings, zone, ansi):
    df = spark.range(200).selectExpr(
        "id", "id / 7 AS d", "cast(id AS decimal(30,12)) AS n", "timestamp_micros(id * 1000003) AS t",
        "timestamp_ntz'2024-03-10 02:30:00' + make_dt_interval(0,0,0,id) AS u", "cast(cast(id AS string) AS binary) AS b", "id % 2 = 0 AS f",
    )
    spec = TableSpec.from_frame(df, "S", "T")
    want = {r["id"]: r["ROW_HASH"] for r in with_row_hash(df, spec).select("id", "ROW_HASH").collect()}
    settings(spark__sql__session__timeZone=zone, spark__sql__ansi__enabled=ansi)
    shuffled = with_row_hash(df.repartition(7).orderBy(F.desc("id")), spec)
    assert {r["id"]: r["ROW_HASH"] for r in shuffled.select("id", "ROW_HASH").collect()} == want


def test_key_hash_total(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "a int, b string")
    number = lambda t: int(hashlib.sha256(t.encode()).hexdigest()[:8], 16)
    assert pk_hash(df, ["a"]).first()[0] == str(number("1") + number("2"))
    assert pk_hash(df, ["a", "b"]).first()[0] == str(number("1_a") + number("2_"))


def test_duplicates_of_a_hot_row(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("k"))
    got = duplicates(with_row_hash(df, TableSpec.from_frame(df, "S", "T"))).collect()
    assert [(r["ROW_HASH"], r["copies"]) for r in got] == [(fold([sha("0")]), 1000)]


def test_hash_projection_has_no_shuffle(spark):
    df = spark.range(10)
    plan = with_row_hash(df, TableSpec.from_frame(df, "S", "T"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
