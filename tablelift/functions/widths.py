"""Logical size of values, as counted in export reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.functions.text import quoted

# Bytes counted per value of a fixed-width column, NULL included.
FIXED_WIDTH = {
    T.ByteType: 8,
    T.ShortType: 8,
    T.IntegerType: 8,
    T.LongType: 8,
    T.FloatType: 8,
    T.DoubleType: 8,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
    T.DateType: 8,
    T.BooleanType: 1,
    T.DecimalType: 16,
}


def columnar_bytes(schema: T.StructType) -> Column:
    """Aggregate: logical bytes of all rows when written to a columnar file.

    Fixed-width columns need no look at the data beyond the row count.
    """
    fixed = sum(FIXED_WIDTH.get(type(f.dataType), 0) for f in schema)
    total = F.count(F.lit(1)) * F.lit(fixed)
    lengths = [
        F.coalesce(F.octet_length(quoted(f.name)), F.lit(0)).cast("long")
        for f in schema
        if type(f.dataType) not in FIXED_WIDTH
    ]
    return total + F.coalesce(F.sum(_add(lengths)), F.lit(0)) if lengths else total


def text_bytes(names: list[str]) -> Column:
    """Aggregate: bytes of all text columns of all rows."""
    return F.coalesce(
        F.sum(_add([F.coalesce(F.octet_length(quoted(n)), F.lit(0)).cast("long") for n in names])),
        F.lit(0),
    )


def _add(columns: list[Column]) -> Column:
    total = columns[0]
    for c in columns[1:]:
        total = total + c
    return total
