"""From table specs to scan tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: block count assumed for a table without statistics.
DEFAULT_BLOCKS = 1000


def is_large(size_gb: float | None, threshold_gb: float) -> bool:
    """Whether a table is cut into chunks; one of unknown size is."""
    return not size_gb or size_gb > threshold_gb


def plan_tasks(
    specs: DataFrame, parallel: int, threshold_gb: float = 1.0, extension: str = "parquet"
) -> DataFrame:
    """One row per scan task.

    Tables above ``threshold_gb``, and those of unknown size, are cut into at most
    ``parallel`` ranges of equal block count; others stay whole (``chunk_id`` NULL). Needs ``schema``,
    ``table``, ``size_gb`` and ``blocks``.
    """
    # The same rule as is_large.
    size = F.coalesce(F.col("size_gb"), F.lit(0.0))
    chunked = ((size == 0) | (size > threshold_gb)) & F.lit(parallel > 1)
    blocks = F.coalesce(F.col("blocks").cast("long"), F.lit(DEFAULT_BLOCKS))
    per_chunk = F.greatest(F.lit(1), F.ceil(blocks / F.lit(parallel)))
    last = F.greatest(F.lit(0), F.ceil(blocks / F.col("__per")) - 1)
    ids = F.when(F.col("__chunked"), F.sequence(F.lit(0).cast("long"), last)).otherwise(
        F.array(F.lit(None).cast("long"))
    )
    lo = F.col("chunk_id") * F.col("__per")
    return (
        specs.withColumn("__chunked", chunked)
        .withColumn("__per", per_chunk)
        .withColumn("__blocks", blocks)
        .withColumn("chunk_id", F.explode(ids))
        .select(
            "schema",
            "table",
            "chunk_id",
            lo.alias("block_lo"),
            F.when(lo.isNotNull(), F.least(lo + F.col("__per"), F.col("__blocks"))).alias("block_hi"),
            F.when(F.col("chunk_id").isNull(), f"data.{extension}")
            .otherwise(F.format_string(f"data_chunk_%04d.{extension}", F.col("chunk_id")))
            .alias("file_name"),
        )
    )
