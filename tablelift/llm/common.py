"""Session helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import cache
from pathlib import Path
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of whole texts in one Arrow batch; a session may ask for fewer.
BATCH_ROWS, _BATCH_SETTING = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"

ROOT = str(Path(__file__).resolve().parents[2])


def share_code(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver found it, and get texts in small batches.

    Both are settings of the session: workers hold one batch of texts at a time, and Spark's usual 10,000 rows of
    long texts are more than they need.
    """
    if int(spark.conf.get(_BATCH_SETTING)) not in range(1, BATCH_ROWS + 1):
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = share_code(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def scratch(spark: SparkSession) -> str:
    """A new folder that every executor and the driver share."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"{tempfile.gettempdir()}/tablelift-scratch"
    return f"{base.rstrip('/')}/tablelift-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read again: lineage ends here and survives lost executors."""
    spark, path = df.sparkSession, scratch(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_memory() -> None:
    """Give memory that Python holds but no longer uses back to the system, where the system's library can."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


_Made = TypeVar("_Made", bound=Callable)
_kept: list = []


def kept_by_worker(make: _Made) -> _Made:
    """What a worker makes once and keeps for later tasks, until a task comes that has no use for it; see ``tidy``."""
    made = cache(make)
    _kept.append(made)
    return made


def forget() -> None:
    """Let a worker drop all that it keeps for later tasks."""
    if any(made.cache_info().currsize for made in _kept):
        for made in _kept:
            made.cache_clear()
        release_memory()


def tidy(
    run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keeps: bool = False
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A batch function whose worker, which goes on to tasks of other stages, keeps no memory of this one.

    Only with ``keeps`` does it find what earlier tasks left for it; else that goes first.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            forget()
        yield from run(batches)
        release_memory()

    return whole


def fold(column: str, parts: int):
    """The contract's fold of a row: crc32 of the id as text, modulo ``parts``; a null id is the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % parts


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
