"""What a source says of its own table before any row is moved: rows, values of each column, exact sums.

A chunk that is read twice or not at all looks right to whoever counts only the rows that arrived. So the source
aggregates for itself, in one query within the row filter, and the figures are held against those of the rows on arrival.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelift.functions.text import plain_decimal
from tablelift.operators.validate import NON_NULL, ROW_COUNT, SUM, bare, long_form, statistics
from tablelift.plans.spec import TableSpec

Figures = dict[tuple[str, str | None], str | None]

_WHOLE = ("tinyint", "smallint", "int", "bigint")


def exact_scale(spark_type: str) -> int | None:
    """Digits after the point of a type whose sums are exact in any database; None for all other types."""
    if spark_type in _WHOLE:
        return 0
    found = re.fullmatch(r"decimal\((\d+),(\d+)\)", spark_type)
    return int(found[2]) if found else None


def _summed(spec: TableSpec, expressions: Mapping[str, str]) -> list[tuple[str, int]]:
    scales = [(c.name, exact_scale(c.spark_type)) for c in spec.physical if c.name not in expressions]
    return [(n, s) for n, s in scales if s is not None]


def _name(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def statement_query(table: str, spec: TableSpec, where: str | None = None, expressions: Mapping[str, str] = {}, digits: int = 38) -> str:
    """Source query of one row: N rows, C<i> values of each physical column, S<i> the sum of each exact number.

    Floating numbers are not added: their sum depends on the order in which the source adds. Values are counted by CASE, which databases
    allow for large objects too.
    """
    parts = ["COUNT(*) AS N"]
    for i, c in enumerate(spec.physical):
        parts.append(f"SUM(CASE WHEN {_name(c.name)} IS NULL THEN 0 ELSE 1 END) AS C{i}")
    for i, (name, scale) in enumerate(_summed(spec, expressions)):
        parts.append(f"SUM(CAST({_name(name)} AS DECIMAL({digits},{scale}))) AS S{i}")
    return f"(SELECT {', '.join(parts)} FROM {table}{f' WHERE ({where})' if where else ''}) s"


def statement_rows(answer: DataFrame, spec: TableSpec, expressions: Mapping[str, str] = {}) -> DataFrame:
    """The answer to :func:`statement_query` as (metric, column_name, value)."""

    def row(metric: str, column: str | None, value):
        return F.struct(F.lit(metric).alias("metric"), F.lit(column).cast("string").alias("column_name"), value.alias("value"))

    def count(name: str):
        return F.coalesce(F.col(name).cast("decimal(38,0)").cast("string"), F.lit("0"))

    rows = [row(ROW_COUNT, None, count("N"))]
    rows += [row(NON_NULL, c.name, count(f"C{i}")) for i, c in enumerate(spec.physical)]
    rows += [row(SUM, n, plain_decimal(F.col(f"S{i}").cast(f"decimal(38,{s})"), s)) for i, (n, s) in enumerate(_summed(spec, expressions))]
    return answer.select(F.inline(F.array(*rows)))


def stated_by_spark(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The statement of a source that Spark reads: for functions whose data has a second, independent look."""
    return long_form(df, spec, statistics(df, spec, False, counts=True)).drop("table_name")


def asked(spark: SparkSession, source: object, spec: TableSpec, where: str | None) -> Figures | None:
    """The figures a source states; None where it has no way to."""
    hook = getattr(source, "statement", None)
    answer = hook(spark, spec, where) if hook else None
    # One row for each column and metric.
    return None if answer is None else {(r["metric"], r["column_name"]): r["value"] for r in answer.collect()}


def disagreements(stated: Figures, arrived: Figures) -> list[tuple[str, str | None, str | None, str | None]]:
    """(metric, column, stated, arrived) wherever the source's figure is not that of the rows that arrived.

    Only what the source states is compared. A sum that is missing stands for no values at all.
    """
    return [
        (metric, column, value, arrived.get((metric, column)))
        for (metric, column), value in stated.items()
        if bare(value) != bare(arrived.get((metric, column)))
    ]
