"""Types of a table from two sides: what the dictionary says, and what a scan of the table gives.

A dictionary can be vague (a NUMBER without digits), silent, use names this library does not know, or be out of date; the schema
of a relation that reads no row tells what values will really arrive. Where both know, the dictionary stands as long as
every scanned value fits.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tablelift.plans.spec import ColumnSpec, TableSpec, describe_type
from tablelift.plans.types import BASE_TYPES, MARKED_TYPES

# Fixed value: what a database driver reports for a number whose digits it does not know.
_DRIVER_DEFAULT = T.DecimalType(38, 10)

_WHOLE_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}
_KINDS = (
    ("number", T.NumericType), ("text", T.StringType), ("time", (T.DateType, T.TimestampType, T.TimestampNTZType)),
    ("boolean", T.BooleanType), ("binary", T.BinaryType),
)
#: Notes of :func:`refined`.
VAGUE, SILENT, UNKNOWN, WIDENED, FLOATING = "dictionary is vague", "dictionary is silent", "unknown to the dictionary", "widened", "floating in the source"
AS_TEXT, OTHER_KIND, NOT_SCANNED, NOT_LISTED = "text in the source", "another kind in the source", "not scanned", "not in the dictionary"


@dataclass(frozen=True)
class Refined:
    spec: TableSpec
    #: (column, dictionary's Spark type, chosen Spark type, note or None) of every column.
    decisions: tuple[tuple[str, str | None, str, str | None], ...]


def _digits(t: T.DataType) -> tuple[int, int] | None:
    """(digits before the point, after it) of an exact number."""
    if isinstance(t, T.DecimalType):
        return t.precision - t.scale, t.scale
    whole = _WHOLE_DIGITS.get(t.simpleString())
    return None if whole is None else (whole, 0)


def _kind(t: T.DataType) -> str | None:
    return next((name for name, kinds in _KINDS if isinstance(t, kinds)), None)


def _known(raw: str) -> bool:
    base = raw.split("(")[0].strip()
    named = base == "NUMBER" or any(base in names for names in BASE_TYPES.values()) or "INTERVAL" in raw or "TIME ZONE" in raw
    return named or any(m in raw for marks, _ in MARKED_TYPES for m in marks.split("|"))


def refined(column: ColumnSpec, scanned: T.DataType | None) -> tuple[ColumnSpec, str | None]:
    """A column with the type its values need, and why that is not what the dictionary says.

    Columns that are rewritten while they are read, and those that no scan gives, keep the dictionary's type.
    """
    raw = (column.raw_type or "").strip().upper()
    if scanned is None:
        return column, None if not column.is_physical else NOT_SCANNED
    if column.is_transformed:
        return column, None

    def typed(spark_type: T.DataType, note: str | None) -> tuple[ColumnSpec, str | None]:
        new_raw, target, transformed = describe_type(spark_type)
        changed = replace(column, raw_type=column.raw_type or new_raw, target_type=target, spark_type=spark_type.simpleString(), is_transformed=transformed)
        return changed, note

    own = T.DataType.fromDDL(column.spark_type)
    if not raw or not _known(raw):
        note = UNKNOWN if raw else SILENT
        return typed(T.LongType() if scanned.simpleString() in _WHOLE_DIGITS else scanned, note) if _kind(scanned) else (column, note)
    if raw == "NUMBER" and column.spark_type == "string":
        if _kind(scanned) != "number" or scanned == _DRIVER_DEFAULT:
            return column, None
        whole = _digits(scanned)
        return typed(T.LongType() if whole and whole[1] == 0 and scanned.simpleString() in _WHOLE_DIGITS else scanned if whole else T.DoubleType(), VAGUE)
    mine, theirs = _kind(own), _kind(scanned)
    if mine == theirs == "number":
        a, b = _digits(own), _digits(scanned)
        if a is None:
            return column, None
        if b is None:
            return typed(T.DoubleType(), FLOATING)
        if b == (28, 10) or (b[0] <= a[0] and b[1] <= a[1]):
            return column, None
        before, after = max(a[0], b[0]), max(a[1], b[1])
        if after == 0 and before <= 19:
            return typed(T.LongType(), None if own == T.LongType() else WIDENED)
        return typed(T.DecimalType(before + after, after) if before + after <= 38 else T.StringType(), WIDENED)
    if mine == theirs or (mine == "text" and raw.startswith("NUMBER")):
        # Numbers that no decimal holds stay text.
        return column, None
    if theirs == "text":
        return column, AS_TEXT
    return (typed(scanned, OTHER_KIND) if theirs else (column, OTHER_KIND))


def refine(spec: TableSpec, scanned: T.StructType) -> Refined:
    """A spec with the types its scan needs; columns that only the scan knows come last."""
    have = {f.name.lower(): f for f in scanned}
    columns, decisions = [], []
    for c in spec.columns:
        f = have.pop(c.name.lower(), None)
        new, note = refined(c, f.dataType if f else None)
        columns.append(new)
        decisions.append((c.name, c.spark_type, new.spark_type, note))
    for f in have.values():
        raw, target, transformed = describe_type(f.dataType)
        kind = "string" if transformed and target == "STRING" else f.dataType.simpleString()
        columns.append(ColumnSpec(f.name, raw, target, kind, is_transformed=transformed))
        decisions.append((f.name, None, kind, NOT_LISTED))
    return Refined(replace(spec, columns=tuple(columns)), tuple(decisions))


def refine_specs(spark: SparkSession, source: object, specs: Sequence[TableSpec]) -> list[Refined]:
    """Refine specs by the schema of each table's relation; no row is read."""
    load = getattr(source, "load", source)
    return [refine(s, load(spark, s).schema) for s in specs]
