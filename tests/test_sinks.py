import pytest
from pyspark.sql import functions as F
from tablelift.operators.results import audit, run_summary, table_results
from tablelift.plans.options import ExportOptions
from tablelift.plans.spec import TableSpec
from tablelift.sinks.files import TableDir, codec_name, describe_export, read_export, write_csv, write_parquet
from tablelift.sinks.publish import arranged, logical_view, with_day
from tablelift.functions.widths import columnar_bytes

NASTY = ['plain', ' lead and trail ', 'q"uo""te', "sep\x10arator,;", "line\nfeed", "car\rriage", "both\r\n", "back\\slash\\", "#no comment", '"', "\\", "é中🎉", "\t"]


def typed(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(NASTY)], "id int, t string").selectExpr(
        "id", "t", "cast(t AS binary) AS b", "id / 3 AS d", "cast(id * 1.1 AS decimal(20,8)) AS n", "id % 2 = 0 AS f",
        "timestamp_micros(id * 1234567890123) AS z", "timestamp_ntz'1970-01-01' + make_dt_interval(id,1,2,3.000456) AS u",
        "date_add(date'2024-01-01', id) AS day", "cast(NULL AS string) AS nothing", "cast(NULL AS double) AS no_number",
    )


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("sep", ["\x10", ",", ";"])
def test_csv_round_trip(spark, settings, tmp_path, sep, zone):
    settings(spark__sql__session__timeZone=zone)
    df = typed(spark)
    spec = TableSpec.from_frame(df, "S", "T")
    write_csv(df, str(tmp_path / "x"), sep, max_rows_per_file=5)
    back = read_export(spark, str(tmp_path / "x"), spec, "csv", sep=sep)
    assert back.dtypes == df.dtypes
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert all(f.name.endswith(".csv.gz") for f in (tmp_path / "x").glob("part-*"))


def test_csv_cannot_tell_null_from_empty(spark, tmp_path):
    df = spark.createDataFrame([("",), (None,)], "t string")
    write_csv(df, str(tmp_path / "x"))
    back = read_export(spark, str(tmp_path / "x"), TableSpec.from_frame(df, "S", "T"), "csv")
    assert [r[0] for r in back.collect()] == [None, None]


@pytest.mark.parametrize("codec", ["snappy", "gzip", "zstd", "lz4", "none", "unheard-of", None])
def test_parquet_round_trip(spark, tmp_path, codec):
    df = typed(spark)
    write_parquet(df, str(tmp_path / "x"), codec, block_bytes=1 << 20)
    back = read_export(spark, str(tmp_path / "x"), TableSpec.from_frame(df, "S", "T"), "parquet")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    types, rows, look = describe_export(back)
    assert (types, rows, look.count()) == (df.dtypes, len(NASTY), 2)


def test_codecs():
    assert codec_name(None) == codec_name("what") == "zstd" and codec_name("SNAPPY") == "snappy"
    for codec in ("brotli", "LZO"):
        with pytest.raises(ValueError, match="codec"):
            codec_name(codec)


def test_layout():
    place = TableDir("s3a://b/out/", "HR", "EMP")
    assert place.data == "s3a://b/out/HR/EMP/data" and place.chunks == "s3a://b/out/HR/EMP/config/chunks"


@pytest.mark.parametrize(
    "bad", [{"parallel": 0}, {"sep": "||"}, {"sep": "é"}, {"cpu_percent": 0}, {"cpu_percent": 101}, {"fetch_rows": 0}, {"fmt": "xml"}, {"string_nulls": "?"}]
)
def test_bad_options(bad):
    with pytest.raises(ValueError):
        ExportOptions(**bad)


def test_logical_bytes_count_missing_numbers(spark):
    df = spark.createDataFrame([(1, True, "é", None), (None, None, None, bytearray(b"abc"))], "a int, f boolean, s string, b binary")
    assert df.agg(columnar_bytes(df.schema)).first()[0] == 2 * (8 + 1) + 2 + 3
    assert df.limit(0).agg(columnar_bytes(df.schema)).first()[0] == 0


def test_hot_day_and_key_are_split_and_sorted(spark):
    df = spark.range(20000).selectExpr("0 AS k", "id", "timestamp_ntz'2024-01-01' + make_dt_interval(0,0,0,id/1000) AS at")
    spec = TableSpec.from_frame(df, "S", "T", pk_cols=["k"], partition_cols=["at"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = arranged(with_day(df, spec), spec).withColumn("p", F.spark_partition_id())
        sizes = [r["count"] for r in out.groupBy("p").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 20000 and max(sizes) < 9000
    assert arranged(df, TableSpec.from_frame(df, "S", "T")) .columns == df.columns


def test_view_over_physical_rows(spark):
    df = spark.createDataFrame([(1, 10, 5.5)], "ID int, Q int, P double")
    spec = TableSpec.from_frame(df, "S", "T", virtual={"COST": "Q * P", "LOST": None})
    assert tuple(logical_view(df, spec).first()) == (1, 10, 5.5, 55.0, None)


def tasks(spark, *rows):
    return spark.createDataFrame(rows, "schema string, table string, chunk_id long, rows long, bytes long, seconds double, status string, error string")


def test_table_results(spark):
    t = tasks(
        spark,
        ("S", "OK", 0, 50, 500, 1.0, "SUCCESS", None), ("S", "OK", 1, 50, 600, 3.0, "SUCCESS", None),
        ("S", "BAD", 2, 0, 0, 9.0, "FAILED", "late"), ("S", "BAD", 0, 7, 7, 1.0, "SUCCESS", None),
        ("S", "BAD", 1, 0, 0, 1.0, "FAILED", "early"), ("S", "BAD", 3, 0, 0, 1.0, "FAILED", ""),
        ("S", "ONE", None, 5, 6, 7.0, "FAILED", "alone"),
    )
    listing = spark.createDataFrame([("S", n) for n in ("OK", "BAD", "ONE", "NONE")], "schema string, table string")
    got = {r["table"]: tuple(r)[2:] for r in table_results(t, listing).collect()}
    assert got == {
        "OK": (100, 1100, 3.0, "SUCCESS", None), "BAD": (0, 0, 0.0, "FAILED", "early; late"),
        "ONE": (5, 6, 7.0, "FAILED", "alone"), "NONE": (0, 0, 0.0, "SUCCESS", None),
    }


def test_summary_and_audit(spark):
    t = tasks(spark, ("S", "A", None, 10, 2**20, 1.0, "SUCCESS", None), ("S", "B", None, 0, 0, 0.0, "FAILED", "no"))
    s = run_summary(t, 2.0).first()
    assert (s["total_tasks"], s["success"], s["failed"], s["total_rows"], s["total_mb_per_sec"]) == (2, 1, 1, 10, 0.5)
    assert run_summary(t, 0.0).first()["total_mb_per_sec"] == 0.0
    assert run_summary(t.limit(0)).first()["total_bytes"] == 0
    records = spark.createDataFrame([("S", "A", 10, "77", 3)], "schema string, table string, row_count long, pk_hash string, sums int")
    got = {r["table"]: (r["has_key_total"], r["sum_checks"], r["rows_match"]) for r in audit(t, records).collect()}
    assert got == {"A": (True, 3, True), "B": (False, 0, False)}
