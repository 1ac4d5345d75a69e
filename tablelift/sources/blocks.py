"""Sizes and blocks of file tables, from listings and footers: no column is read."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_GIB = 1024.0**3


def size_gb(df: DataFrame) -> float:
    """Size of a relation by Catalyst's statistics: for files the bytes of their listing; 0.0 where unknown."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    unknown = df.sparkSession.conf.get("spark.sql.defaultSizeInBytes", None)
    return 0.0 if size >= 2**62 or str(size) == unknown else size / _GIB


def block_map(df: DataFrame) -> DataFrame:
    """(file, start, length, bytes, rows) of every block of a file scan: how Spark would split the files, and their rows.

    For columnar files the rows come from the footers.
    """
    m = F.col("_metadata")
    blocks = df.select(
        m["file_path"].alias("file"), m["file_block_start"].alias("start"), m["file_block_length"].alias("length"), m["file_size"].alias("bytes")
    )
    return blocks.groupBy("file", "start", "length", "bytes").agg(F.count(F.lit(1)).alias("rows"))


def files_of(df: DataFrame, count_rows: bool) -> list[tuple[str, int, int | None]]:
    """(path, bytes, rows) of the files of a scan, one row for each file on the driver.

    Without ``count_rows`` only the listing is asked. Files without rows are left out where rows are counted.
    """
    spark = df.sparkSession

    def path_of(name: str):
        # Spark names files as URIs; readers take plain paths.
        return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name))

    if count_rows:
        try:
            files = block_map(df).groupBy("file").agg(F.max("bytes").alias("bytes"), F.sum("rows").alias("rows"))
            return [(path_of(r["file"]).toString(), r["bytes"], r["rows"]) for r in files.toLocalIterator()]
        except AnalysisException:  # a relation without file metadata
            pass
    found = []
    for name in df.inputFiles():
        path = path_of(name)
        found.append((path.toString(), path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).getLen(), None))
    return found
