"""Exact copies by an extendible-hash index on shared files.

Texts are equal when identical after lower-casing A-Z. The index key is the text's 64-bit hash, taken from its
highest bits: a bucket is a key range. The directory starts with one bucket; every overfull bucket is split by one
more bit, and the directory doubles whenever a bucket as deep as itself splits. The driver holds only the sizes of
at most ``2**CELL_BITS`` cells and the directory over them. A bucket still overfull at that depth is merely longer:
owner tasks stream their key ranges in key order, hold one key's chain of different texts at a time, compare bytes,
and write the index entries as files in the shared folder.

Copies within a task are combined before they are moved, so a text that a third of all rows share reaches its owner
once per task and chunk. Documents then look up their entries by (hash, digest); only entries with copies take part.

Null texts count as empty, and all empty texts are one group. Of equal texts the row with the largest doc_id stays;
a null id counts as smaller than all others. Rows repeated with the same id all count in ``group_size``, and all of
them have ``kept`` true if their id stays. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.common import scratch, share_code, shuffle_tasks, stored, tidy
from tablelift.llm.words import lower, slices

#: Depth at which the directory stops doubling, and the bytes a bucket holds before it is split.
CELL_BITS, BUCKET_BYTES = 16, 4 << 20
#: Bytes of different texts a task gathers before it sends them on.
COMBINED_BYTES = 32 << 20


def _texts(batches):
    """(ids, normalised texts) of slices."""
    for batch in batches:
        for part, data, at in slices(batch, "text"):
            raw, bounds = lower(data).tobytes(), at.tolist()
            yield part.column(0), [raw[a:b] for a, b in zip(bounds[:-1], bounds[1:])]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _keys(batches):
    for ids, texts in _texts(batches):
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array([_signed(xxhash.xxh3_64_intdigest(t)) for t in texts], pa.int64()),
             pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()), pa.array([len(t) for t in texts], pa.int64())],
            names=["doc_id", "h", "sha", "n_bytes"],
        )


def _combined(batches):
    """Different texts of the task with their largest id and count, sent on in chunks."""
    held: dict[bytes, list] = {}
    size = 0

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array([_signed(xxhash.xxh3_64_intdigest(t)) for t in held], pa.int64()), pa.array(list(held), pa.binary()),
             pa.array([v[0] for v in held.values()], pa.int64()), pa.array([v[1] for v in held.values()], pa.int64())],
            names=["h", "text", "top", "n"],
        )

    for ids, texts in _texts(batches):
        for i, t in zip(ids.to_pylist(), texts):
            old = held.get(t)
            if old is None:
                held[t] = [i, 1]
                size += len(t)
            else:
                old[1] += 1
                if i is not None and (old[0] is None or i > old[0]):
                    old[0] = i
        if size > COMBINED_BYTES:
            yield out()
            held, size = {}, 0
    if held:
        yield out()


def grow(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Directory over key cells in key order: the bucket of each entry, and the global depth.

    ``sizes`` holds the bytes in each of 2**k equal key ranges. Starts with depth 0 and one bucket.
    """
    most = len(sizes).bit_length() - 1
    sums = np.concatenate([[0], np.cumsum(sizes)])
    depth, directory = 0, np.zeros(1, np.int64)
    local, prefix = [0], [0]
    todo = [0]
    while todo:
        bucket = todo.pop()
        width = most - local[bucket]
        if width == 0 or sums[(prefix[bucket] + 1) << width] - sums[prefix[bucket] << width] <= capacity:
            continue
        if local[bucket] == depth:
            directory, depth = np.repeat(directory, 2), depth + 1
        local[bucket] += 1
        prefix[bucket] *= 2
        local.append(local[bucket])
        prefix.append(prefix[bucket] + 1)
        new = len(local) - 1
        span = 1 << (depth - local[bucket])
        directory[prefix[new] * span : (prefix[new] + 1) * span] = new
        todo += [bucket, new]
    return directory, depth


def _chains(batches):
    """Index entries of one owner: rows come in key order; texts with one key are told apart by their bytes."""
    key, chain, buckets = None, {}, 0

    def entries(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int32()),
             pa.array([hashlib.sha256(r[3]).digest() for r in rows], pa.binary()), pa.array([r[4] for r in rows], pa.int64()), pa.array([r[5] for r in rows], pa.int64())],
            names=["bucket", "h", "chain", "sha", "keep_id", "group_size"],
        )

    done = []
    for batch in batches:
        for bucket, h, text, top, n in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if (bucket, h) != key:
                if key is not None:
                    done += [(*key, c, t, v[0], v[1]) for c, (t, v) in enumerate(chain.items())]
                key, chain = (bucket, h), {}
            old = chain.get(text)
            if old is None:
                chain[text] = [top, n]
            else:
                old[1] += n
                if top is not None and (old[0] is None or top > old[0]):
                    old[0] = top
        if done:
            yield entries(done)
            done = []
    if key is not None:
        yield entries([(*key, c, t, v[0], v[1]) for c, (t, v) in enumerate(chain.items())])


def build_index(docs: DataFrame, keys: DataFrame, capacity: int = BUCKET_BYTES, cell_bits: int = CELL_BITS) -> tuple[DataFrame, np.ndarray, int]:
    """The index written to shared files: (entries, directory, global depth)."""
    spark = share_code(docs.sparkSession)
    # h sorts as an unsigned number once its sign bit is flipped.
    cell = F.shiftrightunsigned(F.col("h").bitwiseXOR(F.lit(-(1 << 63))), 64 - cell_bits)
    sized = keys.groupBy("h").agg(F.max("n_bytes").alias("b")).groupBy(cell.alias("cell")).agg(F.sum("b").alias("b"))
    sizes = np.zeros(1 << cell_bits, np.int64)
    for r in sized.collect():
        sizes[r["cell"]] = r["b"]
    directory, depth = grow(sizes, capacity)
    shared = spark.sparkContext.broadcast(directory)

    def routed(batches):
        for batch in _combined(batches):
            h = batch.column(0).to_numpy().astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
            at = (h >> np.uint64(64 - depth)).astype(np.int64) if depth else np.zeros(len(h), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(shared.value[at]), *batch.columns], names=["bucket", *batch.schema.names])

    schema = "bucket long, h long, text binary, top long, n long"
    owned = docs.mapInArrow(tidy(routed), schema).repartition(shuffle_tasks(spark), "bucket").sortWithinPartitions("bucket", "h")
    path = scratch(spark)
    entries = owned.mapInArrow(tidy(_chains), "bucket long, h long, chain int, sha binary, keep_id long, group_size long")
    entries.write.parquet(path)
    return spark.read.schema(entries.schema).parquet(path), directory, depth


def exact_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", capacity: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row."""
    share_code(docs.sparkSession)
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    keys = stored(rows.mapInArrow(tidy(_keys), "doc_id long, h long, sha binary, n_bytes long"))
    entries, _, _ = build_index(rows, keys, capacity)
    copies = entries.where("group_size > 1").select("h", "sha", "keep_id", "group_size")
    found = keys.join(copies, ["h", "sha"], "left")
    alone = F.col("group_size").isNull()
    keep = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return found.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )
