"""Text forms of typed values.

Two forms exist: the *canonical* text that is hashed, and the text written to
CSV files. Neither depends on the session time zone or on ANSI mode, so the
same row gives the same hash on every cluster.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Up to this scale Spark prints every decimal without an exponent.
_PLAIN_SCALE = 6

# Millionths of numbers below this are whole numbers that a floating number holds exactly.
_MICROS_LIMIT = 9e9

# Numbers below this have room for six more digits in the widest decimal.
_WIDE_LIMIT = 1e31


def quoted(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def plain_decimal(c: Column, scale: int) -> Column:
    """A decimal in plain digits, with all digits of its scale."""
    if scale <= _PLAIN_SCALE:
        return c.cast("string")
    return F.replace(F.format_number(c, scale), F.lit(","), F.lit(""))


def exact_micros(c: Column, dtype: T.DataType = T.DoubleType()) -> Column:
    """A floating number in millionths, as a whole number; NULL where that is not exactly it."""
    micros = F.when(F.abs(c) < _MICROS_LIMIT, F.rint(c.cast("double") * 1e6).cast("long"))
    return F.when((micros / 1e6).cast(dtype) == c, micros)


def exact_double(c: Column, dtype: T.DataType) -> Column:
    """A floating number as six-digit decimal text where that is exact.

    Other values (more digits, beyond 31 digits before the point, NaN, infinite) keep their shortest text, so
    two different numbers never share a text; 0.0 and -0.0 are one number. Whole-number arithmetic keeps the usual
    case much cheaper than a cast to decimal, which parses text.
    """
    micros = exact_micros(c, dtype)
    wide = F.when(F.abs(c) < _WIDE_LIMIT, c).try_cast("decimal(38,6)")
    digits = F.abs(micros)
    text = F.concat(
        F.when(micros < 0, "-").otherwise(""),
        F.call_function("div", digits, F.lit(1_000_000)).cast("string"),
        F.lit("."),
        F.lpad((digits % 1_000_000).cast("string"), 6, "0"),
    )
    return F.when(micros.isNotNull(), text).when(wide.cast(dtype) == c, wide.cast("string")).otherwise(c.cast("string"))


def ntz_text(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.ffffff`` of a timestamp without time zone."""
    s = c.cast("string")
    fraction = F.when(F.contains(s, F.lit(".")), F.substring_index(s, ".", -1)).otherwise("")
    return F.concat(F.substring_index(s, ".", 1), F.lit("."), F.rpad(fraction, 6, "0"))


def utc_wall_clock(c: Column) -> Column:
    """A zoned timestamp as its UTC wall clock, without asking the session zone."""
    return F.timestamp_add(
        "MICROSECOND", F.unix_micros(c), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    )


def base64_line(c: Column) -> Column:
    """Standard base64 on one line (Spark breaks lines after 76 characters)."""
    return F.translate(F.base64(c), "\r\n", "")


def _scalar_text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.DecimalType):
        return plain_decimal(c, dtype.scale)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return exact_double(c, dtype)
    if isinstance(dtype, T.TimestampNTZType):
        return ntz_text(c)
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        raise ValueError(f"nested type {dtype.simpleString()} has no text form; rewrite it to text first")
    return c.cast("string")


def canonical_text(c: Column, dtype: T.DataType) -> Column:
    """The text that stands for a value in hashes; NULL stays NULL."""
    if isinstance(dtype, T.BinaryType):
        return F.hex(c)
    if isinstance(dtype, T.TimestampType):
        wall = ntz_text(utc_wall_clock(c))
        return F.concat(F.replace(wall, F.lit(" "), F.lit("T")), F.lit("Z"))
    return _scalar_text(c, dtype)


def csv_value(c: Column, dtype: T.DataType) -> Column:
    """The text of a value in a CSV file; NULL becomes the empty text."""
    if isinstance(dtype, T.BinaryType):
        text = base64_line(c)
    elif isinstance(dtype, T.TimestampType):
        text = ntz_text(utc_wall_clock(c))
    else:
        text = _scalar_text(c, dtype)
    return F.coalesce(text, F.lit(""))


def parse_csv_value(c: Column, dtype: T.DataType) -> Column:
    """Inverse of :func:`csv_value`; the empty text becomes NULL. Text that is no such value fails the read."""
    c = F.nullif(c, F.lit(""))
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, T.BinaryType):
        value = F.try_to_binary(c, F.lit("base64"))
    elif isinstance(dtype, T.TimestampType):
        value = F.concat(c, F.lit("+00:00")).try_cast("timestamp")
    else:
        value = c.try_cast(dtype)
    damaged = F.raise_error(F.concat(F.lit(f"a cell is no {dtype.simpleString()}: "), F.substring(c, 1, 80)))
    return F.when(c.isNotNull() & value.isNull(), damaged.cast(dtype)).otherwise(value)
