"""Vectors of an Arrow batch as whole-number matrices, and their packed form."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_of(df: DataFrame, id: str, vector: str) -> DataFrame:
    """vec_id and v (array of double) of every row; other columns are left out."""
    return df.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))


def whole(batch: pa.RecordBatch, dim: int, limit: float) -> tuple[pa.Array, np.ndarray]:
    """(ids, matrix of floor(256 * c)) of the batch's vectors of this length.

    Left out are null vectors, vectors of another length, and vectors with an entry that is null, not finite, or
    whose floor is ``limit`` or more in size.
    """
    ids, lists = batch.column(0), batch.column(1)
    lengths = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    keep = np.flatnonzero(lengths == dim)
    ids, flat = ids.take(pa.array(keep)), lists.take(pa.array(keep)).flatten()
    values = flat.fill_null(float("nan")).to_numpy(zero_copy_only=False).reshape(len(keep), dim)
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(values * 256.0)
        good = (np.isfinite(x) & (np.abs(x) < limit)).all(axis=1)
    return ids.filter(pa.array(good)), x[good].astype(np.int64)


def packed(x: np.ndarray) -> list[bytes]:
    """Each row in as few bytes per entry as hold all its entries: 2 or 8. Equal rows give equal bytes."""
    small = (np.abs(x) < 1 << 15).all(axis=1) if x.size else np.ones(len(x), bool)
    short, long = x[small].astype("<i2"), x[~small].astype("<i8")
    out = np.empty(len(x), object)
    out[small] = [r.tobytes() for r in short]
    out[~small] = [r.tobytes() for r in long]
    return out.tolist()


def unpacked(rows: pa.Array, dim: int) -> np.ndarray:
    """Matrix of packed rows."""
    out = np.empty((len(rows), dim), np.int64)
    raw = rows.to_pylist()
    small = np.fromiter((len(r) == 2 * dim for r in raw), bool, len(raw))
    for chosen, kind in ((small, "<i2"), (~small, "<i8")):
        at = np.flatnonzero(chosen)
        out[at] = np.frombuffer(b"".join([raw[i] for i in at]), kind).reshape(len(at), dim)
    return out
