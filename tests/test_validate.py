from decimal import Decimal

from pyspark.sql import functions as F
from tablelift.operators.rowhash import with_row_hash
from tablelift.operators.validate import diff, reconcile, validate, validation_record
from tablelift.plans.spec import TableSpec


def stats(df, **keys):
    spec = TableSpec.from_frame(df, "S", "T", **keys)
    return {(r["metric"], r["column_name"]): r["value"] for r in validate(df, spec, bool(keys)).collect()}


def test_one_pass_over_all_columns(spark):
    df = spark.createDataFrame(
        [(1, 0.1, Decimal("1.25"), "x", None), (2, 0.2, Decimal("2.50"), "y", None)],
        "a int, b double, c decimal(10,2), s string, empty double",
    )
    got = stats(df)
    assert got == {
        ("ROW_COUNT", None): "2", ("SUM", "a"): "3", ("SUM", "b"): "0.300000", ("SUM", "c"): "3.75",
    }
    plan = validate(df, TableSpec.from_frame(df, "S", "T"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1


def test_sums_of_extreme_numbers(spark):
    def total(*values):
        return stats(spark.createDataFrame([(v,) for v in values], "v double")).get(("SUM", "v"))

    assert total(0.5, -3.0, 1.25) == "-1.250000"
    assert total(float("nan"), 1.0) == "1.000000 + 1 NaN"
    assert total(float("inf"), 1.0, float("-inf"), float("inf")) == "1.000000 + 2 Infinity + 1 -Infinity"
    assert total(None, None) is None
    assert total(0.0, -0.0) == "0.000000"
    # Nothing is rounded away, and no value changes how the others are added.
    tiny = total(*[i * 1e-9 for i in range(1000)])
    assert tiny != "0.000500" and tiny == total(*[i * 1e-9 for i in reversed(range(1000))])
    assert total(4e-7) != total(3e-7) != total(None)
    mixed = [1e40, 1e20, -1e40, 3.3e25, 1e-300, 1e300, 0.1, 7.0]
    assert total(*mixed) == total(*reversed(mixed)) and total(*mixed) != total(*mixed[:-1])
    assert total(1e300, 1e-300) != total(1e300, 2e-300)


def test_bands_add_up_to_the_exact_sum(spark):
    from fractions import Fraction
    import random
    import re

    r = random.Random(3)
    values = [r.uniform(-1, 1) * 10.0 ** r.randint(-11, 40) for _ in range(2000)]
    values = [v for v in values if abs(v) > 1e-12] + [float(i) for i in range(50)]
    text = stats(spark.createDataFrame([(v,) for v in values], "v double"))["SUM", "v"]
    got = Fraction(0)
    for figure in text.split(" + "):
        m = re.fullmatch(r"(-?[\d.]+)(?: x 2\^(-?\d+))?", figure)
        got += Fraction(m[1]) * Fraction(2) ** int(m[2] or 0)
    # Whole millionths count as their decimal digits, all others as the exact number they are.
    micros = lambda v: Fraction(round(v * 1e6), 10**6) if abs(v) < 9e9 and round(v * 1e6) / 1e6 == v else None
    assert got == sum(Fraction(v) if micros(v) is None else micros(v) for v in values)


def test_sums_do_not_overflow(spark):
    big = spark.range(5).select(F.lit(9223372036854775807).alias("v"))
    assert stats(big)[("SUM", "v")] == str(5 * 9223372036854775807)


def test_sum_does_not_depend_on_row_order(spark):
    df = spark.range(20000).select((F.col("id") / 7).alias("v"))
    assert stats(df) == stats(df.repartition(7).orderBy(F.desc("v")))


def test_record(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 3.0)], "k int, v double")
    spec = TableSpec.from_frame(df, "S", "T", pk_cols=["k"])
    r = validation_record(validate(df, spec, True)).first()
    assert (r["table_name"], r["row_count"], r["sums"]) == ("T", 2, 2) and r["pk_hash"]


def test_reconcile_finds_the_changed_column(spark):
    df = spark.range(10).select("id", (F.col("id") * 2.0).alias("v"))
    spec = TableSpec.from_frame(df, "S", "T", pk_cols=["id"])
    other = df.withColumn("v", F.when(F.col("id") == 3, 0.0).otherwise(F.col("v")))
    bad = reconcile(validate(df, spec, True), validate(other, spec, True)).where("NOT matches").collect()
    assert [(r["metric"], r["column_name"]) for r in bad] == [("SUM", "v")]


def hashed(df):
    return with_row_hash(df, TableSpec.from_frame(df, "S", "T"))


def test_diff_of_unique_keys(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    b = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "k int, v string")
    got = {r["k"]: r["status"] for r in diff(hashed(a), hashed(b), ["k"]).collect()}
    assert got == {2: "changed", 3: "missing", 4: "extra"}


def test_diff_of_repeated_and_missing_keys(spark):
    a = spark.createDataFrame([(1, "a"), (1, "b"), (2, "x"), (2, "x"), (3, "p"), (3, "q"), (None, "n")], "k int, v string")
    b = spark.createDataFrame([(1, "b"), (1, "a"), (2, "x"), (3, "p"), (3, "r"), (None, "n")], "k int, v string")
    got = {r["k"]: (r["status"], r["source_rows"], r["target_rows"]) for r in diff(hashed(a), hashed(b), ["k"]).collect()}
    assert got == {2: ("changed", 2, 1), 3: ("changed", 2, 2)}


def test_diff_combines_hot_keys_before_the_shuffle(spark):
    hot = hashed(spark.range(4000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id")).alias("k"), "id"))
    assert diff(hot, hot.repartition(5), ["k"]).count() == 0
    plan = diff(hot, hot, ["k"])._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan and "partial_sum" in plan


def test_millionths_add_up_without_decimals_for_each_row(spark):
    values = [8999999999.999999, -8999999999.999999, 8999999999.999999, -0.000001, -67.108864, 67.108865, 0.0, None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = validate(df, TableSpec.from_frame(df, "S", "T"))
    want = sum((Decimal(repr(v)).quantize(Decimal("0.000001")) for v in values if v is not None), Decimal(0))
    assert rows.where("metric = 'SUM'").first()["value"] == f"{want:f}"
    none = df.where("x IS NULL")
    assert validate(none, TableSpec.from_frame(none, "S", "T")).where("metric = 'SUM'").count() == 0
    assert "shiftright" in rows._jdf.queryExecution().optimizedPlan().toString()
