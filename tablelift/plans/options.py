"""Options of an export job."""

from __future__ import annotations

from dataclasses import dataclass

FORMATS = ("csv", "parquet")


@dataclass(frozen=True)
class ExportOptions:
    fmt: str = "csv"
    compression: str = "zstd"
    sep: str = "\x10"
    row_hash: bool = False
    where: str | None = None
    parallel: int | None = None
    cpu_percent: int = 50
    fetch_rows: int = 10_000
    chunk_threshold_gb: float = 1.0
    string_nulls: str = "keep"
    number_fallback: str = "string"
    max_rows_per_file: int = 5_000_000
    # Bytes of a Parquet row group; None leaves it to Spark.
    block_bytes: int | None = None
    # "fail": a table that loses values in casts fails; "record": the loss is only recorded.
    lost_values: str = "fail"
    # Files of at most this size that fewer tasks than cores would read are dealt out row by row; 0: never.
    deal_bytes: int = 1 << 30

    def __post_init__(self) -> None:
        if self.fmt not in FORMATS:
            raise ValueError(f"fmt must be one of {FORMATS}, not {self.fmt!r}")
        if self.parallel is not None and self.parallel <= 0:
            raise ValueError("parallel must be greater than 0")
        if self.fetch_rows <= 0:
            raise ValueError("fetch_rows must be greater than 0")
        if not 1 <= self.cpu_percent <= 100:
            raise ValueError("cpu_percent must lie between 1 and 100")
        if len(self.sep) != 1 or not self.sep.isascii():
            raise ValueError("sep must be one ASCII character")
        if self.lost_values not in ("fail", "record"):
            raise ValueError("lost_values must be 'fail' or 'record'")
        if self.block_bytes is not None and self.block_bytes <= 0:
            raise ValueError("block_bytes must be greater than 0")
        if self.string_nulls not in ("keep", "empty"):
            raise ValueError("string_nulls must be 'keep' or 'empty'")

    def content(self) -> dict[str, object]:
        """The options that change what the files hold."""
        return {
            "fmt": self.fmt, "compression": self.compression, "sep": self.sep,
            "row_hash": self.row_hash, "where": self.where, "string_nulls": self.string_nulls,
            "number_fallback": self.number_fallback,
        }
