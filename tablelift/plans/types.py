"""Source type -> target type and Spark type, as one projection over catalog rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Base names of source types by target type.
BASE_TYPES = {
    "FLOAT64": ("FLOAT", "BINARY_FLOAT", "BINARY_DOUBLE"),
    "STRING": ("CHAR", "NCHAR", "VARCHAR2", "NVARCHAR2", "LONG", "CLOB", "NCLOB", "ROWID"),
    "DATETIME": ("DATE", "TIMESTAMP"),
    "TIMESTAMP": ("TIMESTAMP WITH TIME ZONE", "TIMESTAMP WITH LOCAL TIME ZONE"),
    "BYTES": ("RAW", "BLOB", "BFILE"),
}

# Names recognised anywhere in the source type, checked before the base name.
MARKED_TYPES = (
    ("XMLTYPE|SDO_GEOMETRY|UROWID", "STRING"),
    ("JSON", "JSON"),
    ("BOOLEAN", "BOOL"),
)

# Source types that are rewritten while they are read.
TRANSFORMED = "TIME ZONE|^XMLTYPE$|^JSON$|SDO_GEOMETRY|ROWID|INTERVAL"

# Spark type of each target type that has just one.
SPARK_TYPES = {
    "INT64": "bigint",
    "FLOAT64": "double",
    "STRING": "string",
    "JSON": "string",
    "BOOL": "boolean",
    "DATETIME": "timestamp_ntz",
    "TIMESTAMP": "timestamp",
    "BYTES": "binary",
}

_UNDEFINED_SCALE = -127
_MAX_DIGITS = 38
_LONG_DIGITS = 18


def map_types(columns: DataFrame, number_fallback: str = "string") -> DataFrame:
    """Add ``target_type``, ``spark_type`` and ``is_transformed`` to catalog rows.

    Needs ``data_type``; ``data_precision`` and ``data_scale`` are used where
    present, else digits in the type text (``NUMBER(10,2)``). ``number_fallback``
    is the Spark type of a NUMBER without any precision.
    """
    raw = F.upper(F.trim("data_type"))
    precision = _digits(columns, "data_precision", raw, r"\(\s*(\d+)")
    scale = _digits(columns, "data_scale", raw, r",\s*(-?\d+)\s*\)")
    # Parsed once, in a projection of its own; the rules below only look at the results.
    # A precision without a scale means scale zero; neither means an open NUMBER.
    parsed = columns.withColumns(
        {
            "__raw": raw,
            "__base": F.trim(F.regexp_replace(raw, r"\([^)]*\)", "")),
            "__p": F.coalesce(precision, F.lit(0)),
            "__s": F.coalesce(scale, F.when(precision > 0, 0).otherwise(_UNDEFINED_SCALE)),
        }
    )
    base, p, s = F.col("__base"), F.col("__p"), F.col("__s")

    undefined = (s == _UNDEFINED_SCALE) & (p == 0)
    fits_long = (s == 0) & p.between(1, _LONG_DIGITS)
    number_target = (
        F.when(undefined, "STRING")
        .when(s == _UNDEFINED_SCALE, "FLOAT64")
        .when(fits_long, "INT64")
        .otherwise("BIGNUMERIC")
    )
    digits = (
        F.when((s == 0) & (p == 0), F.lit(_MAX_DIGITS))
        .when(p == 0, None)
        .when(s < 0, p - s)
        .otherwise(F.greatest(p, s))
    )
    number_spark = (
        F.when(undefined, number_fallback)
        .when(s == _UNDEFINED_SCALE, "double")
        .when(fits_long, "bigint")
        .when(
            digits <= _MAX_DIGITS,
            F.concat(
                F.lit("decimal("), digits.cast("string"), F.lit(","),
                F.greatest(s, F.lit(0)).cast("string"), F.lit(")"),
            ),
        )
        .otherwise("string")
    )

    marked = reduce(
        lambda rest, rule: F.when(F.col("__raw").rlike(rule[0]), rule[1]).otherwise(rest),
        reversed(MARKED_TYPES),
        F.lit(None).cast("string"),
    )
    by_base = F.create_map(*[F.lit(x) for kind, names in BASE_TYPES.items() for n in names for x in (n, kind)])
    by_target = F.create_map(*[F.lit(x) for kv in SPARK_TYPES.items() for x in kv])
    is_number = base == "NUMBER"
    target = F.coalesce(
        marked, F.when(is_number, number_target), by_base[base], F.lit("STRING")
    )
    spark_type = F.when(is_number, number_spark).otherwise(by_target[F.col("target_type")])
    return (
        parsed.withColumns({"target_type": target, "is_transformed": F.col("__raw").rlike(TRANSFORMED)})
        .withColumn("spark_type", spark_type)
        .drop("__raw", "__base", "__p", "__s")
    )


def _digits(columns: DataFrame, name: str, raw: Column, pattern: str) -> Column:
    # A cast that fails on every row is slow, so the empty match is taken out first.
    in_text = F.nullif(F.regexp_extract(raw, pattern, 1), F.lit("")).cast("int")
    return F.coalesce(F.col(name).cast("int"), in_text) if name in columns.columns else in_text
