import pytest
from pyspark.sql import functions as F
from tablelift.functions import rewrites
from tablelift.operators.project import apply_types, physical, with_virtual
from tablelift.plans.spec import ColumnSpec, TableSpec


def one(spark, sql, f):
    return spark.sql(f"SELECT {sql} AS c").select(f(F.col("c"))).first()[0]


@pytest.mark.parametrize(
    "value, want",
    [
        ("interval '5-6' year to month", "5-6 0 0:0:0"),
        ("interval '-1-2' year to month", "-1-2 0 0:0:0"),
        ("interval '-0-3' year to month", "-0-3 0 0:0:0"),
        ("cast(null as interval year to month)", None),
    ],
)
def test_year_month(spark, value, want):
    assert one(spark, value, rewrites.ym_text) == want


@pytest.mark.parametrize(
    "value, want",
    [
        ("interval '3 4:5:6.789' day to second", "0-0 3 4:5:6.789"),
        ("interval '-7 8:9:10.111' day to second", "0-0 -7 8:9:10.111"),
        ("interval '3 12:30:45.123456' day to second", "0-0 3 12:30:45.123456"),
        ("interval '0 0:0:10' day to second", "0-0 0 0:0:10"),
        ("interval '-0 0:0:0.5' day to second", "0-0 -0 0:0:0.5"),
        ("cast(null as interval day to second)", None),
    ],
)
def test_day_second(spark, value, want):
    assert one(spark, value, rewrites.ds_text) == want


def test_newlines_go(spark):
    df = spark.createDataFrame([("a\r\nb\n\nc\r \t",), (None,), ("",)], "c string")
    assert [r[0] for r in df.select(rewrites.xml_text(F.col("c"))).collect()] == ["abc \t", None, ""]


def test_json_keeps_its_text_unless_normalized(spark):
    df = spark.createDataFrame([('{"b": 1.50,\n "a": [1]}',)], "c string")
    assert df.select(rewrites.json_text(F.col("c"))).first()[0] == '{"b": 1.50, "a": [1]}'
    assert df.select(rewrites.json_text(F.col("c"), normalize=True)).first()[0] == '{"a":[1],"b":1.5}'


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_utc(spark, settings, zone):
    settings(spark__sql__session__timeZone=zone)
    df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00' AS c")
    assert str(df.select(rewrites.to_utc(F.col("c"), "-05:00")).first()[0]) == "2024-03-10 07:30:00"


def test_types_that_do_not_fit_become_null(spark):
    wanted = [("n", "decimal(5,2)"), ("d", "timestamp_ntz"), ("t", "timestamp"), ("s", "string"), ("big", "decimal(38,0)")]
    spec = TableSpec("S", "T", tuple(ColumnSpec(n, "VARCHAR2", "STRING", t) for n, t in wanted))
    df = spark.createDataFrame(
        [("12.345", "2024-01-02 03:04:05.123456789", "2023-12-20 12:34:56 -05:00", None, "9" * 38), ("-12.345", "no", "x", "", "1" * 39)],
        "n string, d string, t string, s string, big string",
    )
    rows = apply_types(df, spec).select("n", "d", F.unix_seconds("t"), "s", "big").collect()
    assert [str(rows[0][0]), str(rows[0][1]), rows[0][2], rows[0][3]] == ["12.35", "2024-01-02 03:04:05.123456", 1703093696, None]
    assert str(rows[0][4]) == "9" * 38
    assert [str(rows[1][0]), *rows[1][1:]] == ["-12.35", None, None, "", None]
    assert apply_types(df, spec, "empty").where("s = ''").count() == 2


def test_physical_and_virtual_columns(spark):
    rows = spark.createDataFrame([(1, 10, 5.5), (2, 20, 10.0)], "ID int, QUANTITY int, PRICE double")
    virtual = {"TOTAL_COST": "QUANTITY * PRICE", "DESC_UPPER": "UPPER('Item ' || ID)", "LOST": None}
    spec = TableSpec.from_frame(rows, "S", "TEST_VIRTUAL_COLS", virtual=virtual)
    assert physical(with_virtual(rows, virtual), spec).columns == ["ID", "QUANTITY", "PRICE"]
    got = with_virtual(rows, virtual).select("TOTAL_COST", "DESC_UPPER", "LOST").collect()
    assert [tuple(r) for r in got] == [(55.0, "ITEM 1", None), (200.0, "ITEM 2", None)]
