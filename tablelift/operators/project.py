"""Projections: physical columns, exact types, virtual columns, CSV text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.functions import rewrites
from tablelift.functions.text import csv_value, parse_csv_value, quoted
from tablelift.plans.spec import ColumnSpec, TableSpec


def field_type(schema: T.StructType, name: str) -> T.DataType:
    """Type of a column; names match without regard to case, as in Spark SQL."""
    for f in schema:
        if f.name.lower() == name.lower():
            return f.dataType
    raise ValueError(f"no column {name!r} among {schema.fieldNames()}")


def _rewrite(c: Column, dtype: T.DataType, column: ColumnSpec) -> Column:
    raw = column.raw_type.strip().upper()
    if column.zone and isinstance(dtype, T.TimestampNTZType):
        return rewrites.to_utc(c, column.zone)
    if isinstance(dtype, T.YearMonthIntervalType):
        return rewrites.ym_text(c)
    if isinstance(dtype, T.DayTimeIntervalType):
        return rewrites.ds_text(c)
    if raw == "XMLTYPE":
        return rewrites.xml_text(c.cast("string"))
    if raw == "JSON":
        return rewrites.json_text(c.cast("string"))
    return c


def physical(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The columns that go to files, in spec order, awkward types rewritten."""
    return df.select(
        *[
            _rewrite(quoted(c.name), field_type(df.schema, c.name), c).alias(c.name)
            for c in spec.physical
        ]
    )


def apply_types(df: DataFrame, spec: TableSpec, string_nulls: str = "keep") -> DataFrame:
    """Cast every physical column to its target type; what does not fit becomes NULL.

    ``string_nulls="empty"`` writes missing text as the empty text.
    """
    out = []
    for c in spec.physical:
        have = field_type(df.schema, c.name).simpleString()
        value = quoted(c.name)
        if have != c.spark_type:
            value = value.try_cast(c.spark_type)
        if string_nulls == "empty" and c.spark_type == "string":
            value = F.coalesce(value, F.lit(""))
        out.append(value.alias(c.name))
    return df.select(*out)


def with_virtual(df: DataFrame, exprs: Mapping[str, str | None]) -> DataFrame:
    """Add expression columns; a missing expression gives NULL."""
    return df.withColumns(
        {name: F.expr(expr) if expr else F.lit(None) for name, expr in exprs.items()}
    )


def csv_text(df: DataFrame) -> DataFrame:
    """Every column as the text a CSV file holds."""
    return df.select(*[csv_value(quoted(f.name), f.dataType).alias(f.name) for f in df.schema])


def from_csv_text(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed columns out of :func:`csv_text`."""
    return df.select(*[parse_csv_value(quoted(f.name), f.dataType).alias(f.name) for f in schema])
