"""Row hashes, key hash totals and duplicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.functions.hashes import col_hash, fold_hashes, key_number
from tablelift.functions.text import quoted
from tablelift.operators.project import field_type
from tablelift.plans.spec import ROW_HASH, TableSpec, hashable


def column_hashes(df: DataFrame) -> DataFrame:
    """Each column replaced by the hash of its value."""
    return df.select(*[col_hash(quoted(f.name), f.dataType).alias(f.name) for f in df.schema])


def with_row_hash(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Add ``ROW_HASH`` over the physical columns whose source type is hashable.

    A narrow projection: no shuffle, and the result does not depend on how rows
    are partitioned or ordered.
    """
    return df.withColumn(ROW_HASH, row_hash(df.schema, spec))


def row_hash(schema: T.StructType, spec: TableSpec) -> Column:
    """The row hash as an expression over columns of these types."""
    parts = [
        col_hash(quoted(c.name), field_type(schema, c.name))
        for c in spec.physical
        if hashable(c.raw_type)
    ]
    return fold_hashes(parts)


def key_hash_total(schema: T.StructType, keys: Sequence[str]) -> Column:
    """Aggregate: sum of 32-bit key hashes, independent of row order."""
    return F.sum(key_number([(quoted(k), field_type(schema, k)) for k in keys]))


def pk_hash(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row with the key hash total as text."""
    return df.agg(key_hash_total(df.schema, keys).cast("string").alias("pk_hash"))


def duplicates(df: DataFrame, by: str = ROW_HASH) -> DataFrame:
    """Hashes held by more than one row, with their row count.

    Copies are counted before the shuffle, so a hash shared by a large part of
    the table still arrives as one row per task.
    """
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
