"""Rewrites of awkward source types into portable values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_newlines(c: Column) -> Column:
    """Drop line feeds and carriage returns; other characters stay."""
    return F.translate(c, "\n\r", "")


def xml_text(c: Column) -> Column:
    """XML text on one line."""
    return strip_newlines(c)


def json_text(c: Column, normalize: bool = False) -> Column:
    """JSON text on one line.

    ``normalize`` re-serialises the document compactly, which sorts keys and
    rewrites numbers; without it only line breaks go.
    """
    return F.to_json(F.parse_json(c)) if normalize else strip_newlines(c)


def to_utc(c: Column, zone: str) -> Column:
    """A local wall clock in ``zone`` as the wall clock in UTC (no session zone involved)."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), c)


def _signed(negative: Column, *parts: Column) -> Column:
    return F.concat(F.when(negative, "-").otherwise(""), *parts)


def ym_text(c: Column) -> Column:
    """Year-month interval as ``[-]Y-M 0 0:0:0``."""
    years, months = F.extract(F.lit("YEAR"), c), F.extract(F.lit("MONTH"), c)
    return _signed(
        (years < 0) | (months < 0),
        F.abs(years).cast("string"), F.lit("-"), F.abs(months).cast("string"), F.lit(" 0 0:0:0"),
    )


def ds_text(c: Column) -> Column:
    """Day-second interval as ``0-0 [-]D H:M:S``; trailing zeros of the seconds go."""
    days, hours, minutes, seconds = (
        F.extract(F.lit(f), c) for f in ("DAY", "HOUR", "MINUTE", "SECOND")
    )
    digits = F.rtrim(F.rtrim(F.abs(seconds).cast("string"), F.lit("0")), F.lit("."))
    body = _signed(
        (days < 0) | (hours < 0) | (minutes < 0) | (seconds < 0),
        F.abs(days).cast("string"), F.lit(" "),
        F.abs(hours).cast("string"), F.lit(":"),
        F.abs(minutes).cast("string"), F.lit(":"), digits,
    )
    return F.concat(F.lit("0-0 "), body)
