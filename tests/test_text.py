import base64
import struct
from datetime import datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings as hyp, strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tablelift.functions.text import base64_line, canonical_text, csv_value, exact_double, parse_csv_value

ZONES = ["UTC", "America/New_York", "Asia/Kolkata"]


def texts(df, f=canonical_text):
    return [r[0] for r in df.select(f(F.col("c"), df.schema["c"].dataType)).collect()]


def test_doubles_are_exact_or_shortest(spark):
    values = [0.0, -0.0, 112946.26, -0.5, 1e-9, 1e300, float("nan"), float("inf"), 0.1 + 0.2, 9e12, 123456.0, 8.9e12, 9100000000000.5, 1e31, None]
    got = texts(spark.createDataFrame([(v,) for v in values], "c double"))
    assert got == [
        "0.000000", "0.000000", "112946.260000", "-0.500000", "1.0E-9", "1.0E300", "NaN", "Infinity",
        "0.30000000000000004", "9000000000000.000000", "123456.000000", "8900000000000.000000", "9100000000000.500000",
        "1.0E31", None,
    ]


def test_floats_use_their_own_precision(spark):
    assert texts(spark.createDataFrame([(0.1,)], "c float")) == ["0.100000"]


def test_different_doubles_have_different_texts(spark):
    @hyp(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.floats(allow_nan=False), min_size=20, max_size=200))
    def check(values):
        df = spark.createDataFrame([(v,) for v in values], "c double")
        rows = df.select("c", exact_double(F.col("c"), T.DoubleType()).alias("t")).collect()
        by_text = {}
        for r in rows:
            by_text.setdefault(r["t"], set()).add(struct.pack("d", r["c"] + 0.0))
        assert all(len(v) == 1 for v in by_text.values())

    check()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_decimals_never_get_an_exponent(spark, settings, ansi):
    settings(spark__sql__ansi__enabled=ansi)
    df = spark.createDataFrame([(Decimal("0"),), (Decimal("-0.000000001"),), (Decimal("1234567.5"),)], "c decimal(38,9)")
    assert texts(df) == ["0.000000000", "-0.000000001", "1234567.500000000"]


@pytest.mark.parametrize("zone", ZONES)
def test_timestamps_ignore_the_session_zone(spark, settings, zone):
    settings(spark__sql__session__timeZone=zone)
    # 02:30 does not exist on that day in New York.
    naive = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00.5' AS c")
    assert texts(naive) == ["2024-03-10 02:30:00.500000"]
    zoned = spark.sql("SELECT timestamp'2023-12-20 12:34:56 -05:00' AS c")
    assert texts(zoned) == ["2023-12-20T17:34:56.000000Z"]
    assert texts(zoned, csv_value) == ["2023-12-20 17:34:56.000000"]
    back = zoned.select(csv_value(F.col("c"), T.TimestampType()).alias("t")).select(
        (parse_csv_value(F.col("t"), T.TimestampType()) == F.expr("timestamp'2023-12-20 17:34:56Z'")).alias("same")
    )
    assert back.first()["same"]


def test_base64_stays_on_one_line(spark):
    data = bytes(range(256)) * 3
    df = spark.createDataFrame([(bytearray(data),), (bytearray(bytes.fromhex("DEADBEEF")),)], "c binary")
    assert [r[0] for r in df.select(base64_line(F.col("c"))).collect()] == [base64.b64encode(data).decode(), "3q2+7w=="]
    assert texts(df)[1] == "DEADBEEF"


def test_missing_values_are_empty_in_csv(spark):
    for ddl in ("string", "int", "double", "timestamp", "timestamp_ntz", "binary", "boolean", "decimal(20,8)"):
        assert texts(spark.createDataFrame([(None,)], f"c {ddl}"), csv_value) == [""]


def test_nested_values_are_refused(spark):
    with pytest.raises(ValueError, match="nested"):
        canonical_text(F.col("c"), T.ArrayType(T.IntegerType()))


def test_naive_timestamp_round_trip(spark):
    rows = [(datetime(2024, 2, 29, 23, 59, 59, 123456),), (datetime(1900, 1, 1),)]
    df = spark.createDataFrame(rows, "c timestamp_ntz")
    back = df.select(csv_value(F.col("c"), T.TimestampNTZType()).alias("t")).select(parse_csv_value(F.col("t"), T.TimestampNTZType()))
    assert [tuple(r) for r in back.collect()] == rows
