"""Row differences by a digest tree: two tables that hardly differ are compared without moving them.

Each side is dealt into key ranges of a hash, the leaves of a level; a leaf's digest is its row count and two sums over its
rows' hashes, which do not depend on order and combine before the shuffle, so a level moves at most a few numbers for
each leaf and task. Only leaves whose digests differ are looked at again, in the next level with finer leaves. What is left at the end
is compared row by row; all other rows never leave their task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelift.functions.text import quoted
from tablelift.operators.validate import diff
from tablelift.plans.spec import ROW_HASH

#: Bits of the hash that each level adds, and differing leaves that are sent to all tasks at most (12 bytes each).
STEP, MOST_LEAVES = 12, 1 << 16
#: Rows of differing leaves that are compared without another level.
SMALL = 1 << 20
#: One of 2^LOOK key ranges is looked at first, to tell whether a level would find equal leaves at all.
LOOK = 6

_KEY, _LEAF = "__leaf_key", "__leaf"


@dataclass(frozen=True)
class Leaves:
    """The leaves of a level in which two tables differ, and the rows both hold there."""

    bits: int
    numbers: tuple[int, ...]
    rows: int

    def among(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The rows of a table in these leaves; nothing is shuffled."""
        listed = df.sparkSession.createDataFrame([(n,) for n in self.numbers], f"{_LEAF}_wanted long")
        placed = df.withColumn(_LEAF, _leaf(_hash(keys), self.bits))
        # At most MOST_LEAVES numbers.
        return placed.join(F.broadcast(listed), placed[_LEAF] == listed[f"{_LEAF}_wanted"], "left_semi").drop(_LEAF)


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[quoted(k) for k in keys])


def _leaf(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits)


def _level(source: DataFrame, target: DataFrame, keys: Sequence[str], hash_col: str, bits: int) -> DataFrame:
    """(leaf, rows) of the leaves whose digests differ."""

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(_leaf(_hash(keys), bits).alias("leaf"), F.xxhash64(quoted(hash_col)).alias("h"), F.lit(sign).alias("sign"))

    low, high = F.col("h").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("h", 32)
    digests = side(source, 1).unionAll(side(target, -1)).groupBy("leaf").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("sign").alias("n"), F.sum(low * F.col("sign")).alias("low"), F.sum(high * F.col("sign")).alias("high")
    )
    return digests.where("n <> 0 OR low <> 0 OR high <> 0").select("leaf", "rows")


def differing_leaves(source: DataFrame, target: DataFrame, keys: Sequence[str], hash_col: str = ROW_HASH, small: int = SMALL) -> Leaves | None:
    """The leaves in which the tables differ, as finely as it pays; None where too many do, ``numbers`` empty where none does.

    Each level reads key and hash columns of both tables once and moves digests only. A level is added while differing leaves hold
    more than ``small`` rows and most leaves of the level above were equal.
    """
    found: Leaves | None = None
    for bits in range(STEP, 64, STEP):
        ours, theirs = (found.among(source, keys), found.among(target, keys)) if found else (source, target)
        rows = _level(ours, theirs, keys, hash_col, bits).limit(MOST_LEAVES + 1).collect()
        if len(rows) > MOST_LEAVES:
            return found
        above = len(found.numbers) if found else 1
        found = Leaves(bits, tuple(r["leaf"] for r in rows), sum(r["rows"] for r in rows))
        if found.rows <= small or 2 * len(rows) > above << STEP:
            return found
    return found


def mostly_differ(source: DataFrame, target: DataFrame, keys: Sequence[str], hash_col: str = ROW_HASH) -> bool:
    """Whether most leaves of the first level differ, told from one of 2^LOOK key ranges; rows of the others are not hashed."""
    ours, theirs = (df.where(_leaf(_hash(keys), LOOK) == 0) for df in (source, target))
    return 2 * _level(ours, theirs, keys, hash_col, STEP).count() > 1 << (STEP - LOOK)


def tree_diff(source: DataFrame, target: DataFrame, keys: Sequence[str], hash_col: str = ROW_HASH, small: int = SMALL) -> DataFrame:
    """The same as :func:`tablelift.operators.validate.diff`; rows of equal leaves are not shuffled.

    Tables that differ nearly everywhere are compared row by row at once: a level would read and hash all rows for nothing.
    """
    if mostly_differ(source, target, keys, hash_col):
        return diff(source, target, keys, hash_col)
    found = differing_leaves(source, target, keys, hash_col, small)
    if found is None:
        return diff(source, target, keys, hash_col)
    return diff(found.among(source, keys), found.among(target, keys), keys, hash_col)
