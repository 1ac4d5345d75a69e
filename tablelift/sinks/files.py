"""File sinks, their layout, and reading the files back."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelift.functions.text import quoted
from tablelift.operators.project import csv_text, from_csv_text
from tablelift.plans.spec import ROW_HASH, ROW_HASH_COMMENT, TableSpec

# Codec names this Spark build can write, and names it knows but cannot.
CODECS = ("snappy", "gzip", "zstd", "lz4", "lz4_raw", "none")
MISSING_CODECS = ("brotli", "lzo")
DEFAULT_CODEC = "zstd"

FILE = "__file"


@dataclass(frozen=True)
class TableDir:
    """``<out>/<SCHEMA>/<TABLE>/{data,config}``."""

    out: str
    schema: str
    table: str

    @property
    def root(self) -> str:
        return f"{self.out.rstrip('/')}/{self.schema}/{self.table}"

    @property
    def data(self) -> str:
        return f"{self.root}/data"

    @property
    def refusal(self) -> str:
        return f"{self.root}/config/refusal"

    @property
    def chunks(self) -> str:
        return f"{self.root}/config/chunks"

    def chunk_data(self, chunk_id: int) -> str:
        return f"{self.data}/chunk_{chunk_id:04d}"


def codec_name(codec: str | None) -> str:
    """The codec to use: the default one for none given and for unknown names."""
    name = (codec or DEFAULT_CODEC).lower()
    if name in MISSING_CODECS:
        raise ValueError(f"codec {name!r} needs a library this Spark build lacks; use one of {CODECS}")
    return name if name in CODECS else DEFAULT_CODEC


def write_parquet(
    df: DataFrame, path: str, codec: str | None = None, max_rows_per_file: int = 0, block_bytes: int | None = None
) -> None:
    writer = (
        df.write.mode("overwrite")
        .option("compression", codec_name(codec))
        .option("maxRecordsPerFile", max_rows_per_file)
    )
    if block_bytes:
        writer = writer.option("parquet.block.size", block_bytes)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = "\x10", max_rows_per_file: int = 0) -> None:
    """Gzip CSV of any typed frame."""
    write_csv_text(csv_text(df), path, sep, max_rows_per_file)


def write_csv_text(text: DataFrame, path: str, sep: str = "\x10", max_rows_per_file: int = 0) -> None:
    """Gzip CSV of a frame that is text already.

    A gzip file is read back by one task, hence the bound on rows per file.
    """
    (
        text.write.mode("overwrite")
        .options(
            header=True, sep=sep, quote='"', escape='"', quoteAll=True, nullValue="", emptyValue="",
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, lineSep="\n",
            encoding="UTF-8", compression="gzip", maxRecordsPerFile=max_rows_per_file,
        )
        .option("zlib.compress.level", "BEST_SPEED")
        .csv(path)
    )


def export_schema(spec: TableSpec, row_hash: bool = False) -> T.StructType:
    """Schema of the exported files, comments in the field metadata."""
    schema = T.StructType()
    for c in spec.physical:
        schema.add(
            c.name, T.DataType.fromDDL(c.spark_type), True, {"comment": c.comment} if c.comment else None
        )
    if row_hash:
        schema.add(ROW_HASH, T.StringType(), True, {"comment": ROW_HASH_COMMENT})
    return schema


def read_export(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    fmt: str,
    row_hash: bool = False,
    sep: str = "\x10",
    with_file: bool = False,
) -> DataFrame:
    """All files of one export, written in one piece or in chunks, as one typed frame.

    CSV keeps no difference between NULL and the empty text: both come back as
    NULL. ``with_file`` adds the file of each row as ``__file``.
    """
    schema = export_schema(spec, row_hash)
    if fmt == "parquet":
        df = spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)
        return df.withColumn(FILE, F.col("_metadata.file_path")) if with_file else df
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    raw = (
        spark.read.schema(text)
        .options(
            header=True, sep=sep, quote='"', escape='"', multiLine=True, lineSep="\n", encoding="UTF-8",
            nullValue="", emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
            mode="FAILFAST", recursiveFileLookup=True,
        )
        .csv(path)
    )
    if not with_file:
        return from_csv_text(raw, schema)
    typed = from_csv_text(raw.withColumn(FILE, F.col("_metadata.file_path")), schema.add(FILE, T.StringType()))
    return typed


def describe_export(df: DataFrame) -> tuple[list[tuple[str, str]], int, DataFrame]:
    """Column types, row count and a two-row look at an export."""
    return df.dtypes, df.count(), df.limit(2)


def tie_break(df: DataFrame) -> list[Column]:
    """Values that tell apart rows with equal cluster columns, the same on every run.

    Distinct rows differ in the first one; exact copies differ by file, and files are
    bounded in rows. Without files their order within the input tells them apart, which
    is the same on every run of a scan; where it isn't, only equal rows change places.
    """
    own = [quoted(n) for n in df.columns if n != FILE]
    return [F.xxhash64(*own), F.xxhash64(FILE) if FILE in df.columns else F.monotonically_increasing_id()]
