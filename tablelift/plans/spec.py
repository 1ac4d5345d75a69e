"""Table specifications."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T

ROW_HASH = "ROW_HASH"
ROW_HASH_COMMENT = "upper-case SHA-256 over the values of the row"

# Base names of source types that never take part in a row hash.
UNHASHED_TYPES = frozenset(
    ["BLOB", "CLOB", "NCLOB", "BFILE", "LONG", "LONG RAW", "XMLTYPE", "XML", "SDO_GEOMETRY"]
)

# Target types whose columns are summed during validation.
SUMMED_TARGETS = frozenset(["INT64", "FLOAT64", "BIGNUMERIC", "NUMERIC"])

# Fixed values: (source type, target type) that stand for a Spark column type.
_FROM_SPARK = {
    "tinyint": ("NUMBER(3,0)", "INT64"),
    "smallint": ("NUMBER(5,0)", "INT64"),
    "int": ("NUMBER(10,0)", "INT64"),
    "bigint": ("NUMBER(18,0)", "INT64"),
    "float": ("BINARY_FLOAT", "FLOAT64"),
    "double": ("BINARY_DOUBLE", "FLOAT64"),
    "string": ("VARCHAR2", "STRING"),
    "boolean": ("BOOLEAN", "BOOL"),
    "binary": ("RAW", "BYTES"),
    "date": ("DATE", "DATETIME"),
    "timestamp_ntz": ("TIMESTAMP(6)", "DATETIME"),
    "timestamp": ("TIMESTAMP(6) WITH TIME ZONE", "TIMESTAMP"),
}


def hashable(raw_type: str) -> bool:
    """Whether a column of this source type takes part in the row hash."""
    return re.split(r"\(", raw_type, maxsplit=1)[0].strip().upper() not in UNHASHED_TYPES


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    raw_type: str
    target_type: str
    spark_type: str
    is_virtual: bool = False
    virtual_expr: str | None = None
    is_transformed: bool = False
    is_hidden: bool = False
    is_identity: bool = False
    comment: str | None = None
    # The time zone whose wall clock a timestamp without zone shows; such a column is written in UTC.
    zone: str | None = None
    # The expression of a virtual column may have been cut short by the database driver.
    may_be_cut: bool = False

    @property
    def is_physical(self) -> bool:
        """Written to files; other columns live in the view only."""
        return self.is_transformed or not self.is_virtual


@dataclass(frozen=True)
class TableSpec:
    schema: str
    table: str
    columns: tuple[ColumnSpec, ...]
    size_gb: float = 0.0
    pk_cols: tuple[str, ...] = ()
    partition_cols: tuple[str, ...] = ()
    index_cols: tuple[str, ...] = ()

    @property
    def physical(self) -> tuple[ColumnSpec, ...]:
        return tuple(c for c in self.columns if c.is_physical)

    @property
    def needs_view(self) -> bool:
        return any(not c.is_physical for c in self.columns)

    @property
    def cluster_cols(self) -> tuple[str, ...]:
        """Key columns, then index columns, each once, at most four."""
        return tuple(dict.fromkeys(self.pk_cols + self.index_cols))[:4]

    @property
    def day_column(self) -> str | None:
        """The column whose days partition the published table."""
        for c in self.columns:
            if c.name in self.partition_cols and re.search("DATE|TIMESTAMP", c.target_type):
                return c.name
        return None

    @property
    def physical_name(self) -> str:
        return f"{self.table}_PHYSICAL" if self.needs_view else self.table

    def with_fallback(self, number_fallback: str) -> TableSpec:
        """The spec with another Spark type for numbers of no stated precision."""
        if number_fallback == "string":
            return self
        open_number = lambda c: c.raw_type.strip().upper() == "NUMBER" and c.spark_type == "string"
        columns = tuple(replace(c, spark_type=number_fallback) if open_number(c) else c for c in self.columns)
        return replace(self, columns=columns)

    def fingerprint(self, **job: object) -> str:
        """Identity of an export: what the spec and the job options put into its files."""
        spec = {k: v for k, v in asdict(self).items() if k != "size_gb"}
        text = json.dumps({"spec": spec, "job": job}, sort_keys=True, default=str)
        return hashlib.sha256(text.encode()).hexdigest()

    @classmethod
    def from_frame(
        cls,
        df: DataFrame,
        schema: str,
        table: str,
        raw_types: Mapping[str, str] | None = None,
        virtual: Mapping[str, str | None] | None = None,
        comments: Mapping[str, str] | None = None,
        zones: Mapping[str, str] | None = None,
        **keys: Sequence[str] | float,
    ) -> TableSpec:
        """A spec for data that already has Spark types.

        ``raw_types`` overrides source type names (``{"text": "CLOB"}`` keeps a
        column out of the hash); ``virtual`` adds view-only expressions; ``zones`` names the
        time zones of local wall clocks.
        """
        raw_types, comments, zones = raw_types or {}, comments or {}, zones or {}
        columns = []
        for f in df.schema:
            raw, target, transformed = describe_type(f.dataType)
            columns.append(
                ColumnSpec(
                    f.name,
                    raw_types.get(f.name, raw),
                    target,
                    "string" if transformed and target == "STRING" else f.dataType.simpleString(),
                    is_transformed=transformed,
                    comment=comments.get(f.name),
                    zone=zones.get(f.name),
                )
            )
        for name, expr in (virtual or {}).items():
            columns.append(
                ColumnSpec(name, "VARCHAR2", "STRING", "string", is_virtual=True, virtual_expr=expr)
            )
        lists = {k: v if k == "size_gb" else tuple(v) for k, v in keys.items()}
        return cls(schema, table, tuple(columns), **lists)

    @classmethod
    def from_row(cls, row: Row) -> TableSpec:
        """A spec from one row of :func:`tablelift.sources.catalog.discover`."""
        columns = tuple(
            ColumnSpec(
                c.column_name, c.data_type, c.target_type, c.spark_type, c.is_virtual,
                c.virtual_expr, c.is_transformed, c.is_hidden, c.is_identity, c.comments,
                may_be_cut=c["may_be_cut"] if "may_be_cut" in c else False,
            )
            for c in row["columns"]
        )
        return cls(
            row["schema"], row["table"], columns, float(row["size_gb"]),
            tuple(row["pk_cols"]), tuple(row["partition_cols"]), tuple(row["index_cols"]),
        )


def describe_type(dtype: T.DataType) -> tuple[str, str, bool]:
    """(source type, target type, whether it is rewritten) that stand for a Spark type."""
    name = dtype.simpleString()
    if isinstance(dtype, T.DecimalType):
        return f"NUMBER({dtype.precision},{dtype.scale})", "BIGNUMERIC", False
    if isinstance(dtype, T.YearMonthIntervalType):
        return "INTERVAL YEAR TO MONTH", "STRING", True
    if isinstance(dtype, T.DayTimeIntervalType):
        return "INTERVAL DAY TO SECOND", "STRING", True
    if name not in _FROM_SPARK:
        return name, "STRING", False
    raw, target = _FROM_SPARK[name]
    return raw, target, name == "timestamp"
