import pytest
from pyspark.sql import functions as F
from tablelift.operators import treediff
from tablelift.operators.treediff import differing_leaves, tree_diff
from tablelift.operators.validate import diff


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _tables(spark, n=4000):
    source = spark.range(n).select((F.col("id") / 2).cast("long").alias("k"), F.col("id").cast("string").alias("ROW_HASH"))
    changed = source.withColumn("ROW_HASH", F.when(F.col("k") == 77, F.concat("ROW_HASH", F.lit("x"))).otherwise(F.col("ROW_HASH"))).where("k <> 99 AND ROW_HASH <> '500'")
    target = changed.unionAll(spark.createDataFrame([(-5, "new"), (None, "no key"), (10, "20")], "k long, ROW_HASH string"))
    return source, target


@pytest.mark.parametrize("small", [1 << 20, 100, 0])
def test_same_result_as_the_plain_diff(spark, small):
    source, target = _tables(spark)
    got = _rows(tree_diff(source, target, ["k"], small=small))
    assert got == _rows(diff(source, target, ["k"])) and len(got) == 6
    assert {(r[0], r[1]) for r in got} == {(77, "changed"), (99, "missing"), (250, "changed"), (-5, "extra"), (None, "extra"), (10, "changed")}


def test_rows_that_move_follow_the_differences(spark):
    source, target = _tables(spark, 400_000)
    found = differing_leaves(source, target, ["k"])
    assert found.bits == 12 and 1 <= len(found.numbers) <= 6 and found.rows <= 6 * 2 * 2 * 400_000 / 4096
    assert found.among(source, ["k"]).count() + found.among(target, ["k"]).count() == found.rows
    finer = differing_leaves(source, target, ["k"], small=50)
    assert finer.bits == 24 and finer.rows < 50 and len(finer.numbers) == 6


def test_equal_tables_and_wholly_different_ones(spark, monkeypatch):
    source, _ = _tables(spark)
    shuffled = source.repartition(5).sort(F.rand(1))
    assert differing_leaves(source, shuffled, ["k"]).numbers == () and tree_diff(source, shuffled, ["k"]).count() == 0
    other = source.withColumn("ROW_HASH", F.concat("ROW_HASH", F.lit("!")))
    assert tree_diff(source, other, ["k"], small=0).count() == 2000
    monkeypatch.setattr(treediff, "MOST_LEAVES", 10)
    assert differing_leaves(source, other, ["k"]) is None
    assert _rows(tree_diff(source, other, ["k"])) == _rows(diff(source, other, ["k"]))


def test_copies_that_change_in_pairs_are_seen(spark):
    a = spark.createDataFrame([(1, "p"), (1, "p"), (2, "q")], "k long, ROW_HASH string")
    b = spark.createDataFrame([(1, "r"), (1, "r"), (2, "q")], "k long, ROW_HASH string")
    assert _rows(tree_diff(a, b, ["k"])) == [(1, "changed", 2, 2)]
    none = a.limit(0)
    assert tree_diff(none, none, ["k"]).count() == 0 and tree_diff(a, none, ["k"]).count() == 2


def test_tables_that_differ_everywhere_are_read_once(spark, monkeypatch):
    source, _ = _tables(spark, 40_000)
    other = source.withColumn("ROW_HASH", F.when(F.col("k") % 3 == 0, F.concat("ROW_HASH", F.lit("!"))).otherwise(F.col("ROW_HASH")))
    levels = []
    monkeypatch.setattr(treediff, "differing_leaves", lambda *a: levels.append(a))
    assert _rows(tree_diff(source, other, ["k"])) == _rows(diff(source, other, ["k"]))
    assert not levels and treediff.mostly_differ(source, other, ["k"])
    assert not treediff.mostly_differ(source, source.where("k <> 7"), ["k"]) and not treediff.mostly_differ(source.limit(0), source.limit(0), ["k"])
