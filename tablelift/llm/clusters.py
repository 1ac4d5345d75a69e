"""K-means over whole-number vectors with heap-ordered bounds.

Vectors live in blocks, stored tables in the shared folder; a block carries, for each cluster, a binary heap of its
vectors. A heap entry's key is the vector's gap (distance to the second nearest centroid less distance to its own)
plus the drift that the cluster had accumulated when the entry was pushed. After an update, the drift of cluster a
grows by a's own movement and by the largest movement of any other centroid, so a vector may have changed sides only
if its key is no longer above the drift: just those are popped, measured against all centroids, and pushed again. All
other vectors are neither looked at nor moved.

Assignments are exact: distances that decide are whole numbers, ties go to the smaller centroid, and the gaps, which are
doubles, are taken slightly too small and the drifts slightly too large. A block also carries the sums of the
vectors that changed sides; Spark adds these per centroid entry, and the driver keeps k x dim exact sums. Nothing is
shuffled but those; vectors have no key, so no value can make a task larger. A round is a written table,
so a lost executor costs part of one round.

Vectors are kept if they have exactly ``dim`` components, none null or non-finite; a component of 2**19 or more in
size, for which squared distances could leave 64 bits, counts as non-finite. Rows with a null or repeated id are vectors
like all others (a null id is hashed as an empty one; of rows whose ids hash alike the lesser vector comes first). With fewer kept vectors
than ``k`` there are fewer centroids; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.common import share_code, stored
from tablelift.llm.vectors import packed, rows_of, unpacked, whole

#: Components whose floor(256 * x) is this large have no safe squared distance.
LIMIT = 2.0**27
#: Vectors in a block, and bytes of blocks that a worker is handed at once.
BLOCK, _BATCH_BYTES = 4096, 16 << 20
#: Share by which gaps are taken too small and drifts too large; rounding is below a thousandth of it.
SLACK = 1e-12

_BLOCK = "ids array<long>, width int, vectors binary, keys array<double>, rows array<int>, sizes array<int>, moved array<long>, rescanned long"


def _products(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """x @ c.T of whole numbers, exact: by doubles where every partial sum stays below 2**53."""
    if x.size and c.size and int(np.abs(x).max()) * int(np.abs(c).max()) * x.shape[1] < 1 << 53:
        return (x.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    return x @ c.T


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all rows of c, exact."""
    return (x * x).sum(axis=1)[:, None] - 2 * _products(x, c) + (c * c).sum(axis=1)[None]


def nearest(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest centroid, gap to the second nearest, never too large) of each row; ties go to the smaller number."""
    d = distances(x, c)
    own = d.argmin(axis=1)
    at = np.arange(len(x))
    upper = np.sqrt(d[at, own].astype(np.float64)) * (1 + SLACK)
    if len(c) == 1:
        return own, np.full(len(x), np.inf)
    d[at, own] = np.iinfo(np.int64).max
    lower = np.sqrt(d.min(axis=1).astype(np.float64)) * (1 - SLACK)
    return own, lower - upper


@dataclass
class Block:
    """Some vectors and, for each cluster, the heap of its members as (key, row)."""

    ids: np.ndarray | list
    x: np.ndarray
    heaps: list[list[tuple[float, int]]]

    def reassign(self, centroids: np.ndarray, drift: np.ndarray) -> tuple[np.ndarray, int]:
        """Pop, rescan and push what expired; gives (sums and counts that moved, number of vectors rescanned)."""
        k, dim = centroids.shape
        rows, left = [], []
        for a, heap in enumerate(self.heaps):
            bound = drift[a] * (1 + SLACK)
            while heap and heap[0][0] <= bound:
                rows.append(heapq.heappop(heap)[1])
                left.append(a)
        moved = np.zeros((k, dim + 1), np.int64)
        if rows:
            x = self.x[rows]
            own, gap = nearest(x, centroids)
            left = np.array(left)
            for key, row, a in zip((gap + drift[own]).tolist(), rows, own.tolist()):
                heapq.heappush(self.heaps[a], (key, row))
            changed = left != own
            x, left, own = x[changed], left[changed], own[changed]
            np.subtract.at(moved[:, :dim], left, x)
            np.add.at(moved[:, :dim], own, x)
            moved[:, dim] = np.bincount(own, minlength=k) - np.bincount(left, minlength=k)
        return moved, len(rows)

    def first(self, centroids: np.ndarray) -> np.ndarray:
        """Assign all vectors for the first time: fills the heaps, gives sums and counts."""
        k, dim = centroids.shape
        own, gap = nearest(self.x, centroids)
        self.heaps = [[] for _ in range(k)]
        for row, (key, a) in enumerate(zip(gap.tolist(), own.tolist())):
            self.heaps[a].append((key, row))
        for heap in self.heaps:
            heapq.heapify(heap)
        sums = np.zeros((k, dim + 1), np.int64)
        np.add.at(sums[:, :dim], own, self.x)
        sums[:, dim] = np.bincount(own, minlength=k)
        return sums

    def clusters(self) -> np.ndarray:
        own = np.zeros(len(self.x), np.int32)
        for a, heap in enumerate(self.heaps):
            own[[row for _, row in heap]] = a
        return own


def _written(block: Block, moved: np.ndarray, rescanned: int) -> pa.RecordBatch:
    entries = [e for heap in block.heaps for e in heap]
    small = int(np.abs(block.x).max(initial=0)) < 1 << 15
    values = {
        "ids": block.ids, "width": 2 if small else 4, "vectors": block.x.astype("<i2" if small else "<i4").tobytes(), "keys": [e[0] for e in entries],
        "rows": [e[1] for e in entries], "sizes": [len(h) for h in block.heaps], "moved": moved.ravel().tolist(), "rescanned": rescanned,
    }
    kinds = [pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values.values(), kinds)], names=list(values))


def _read(row: dict, dim: int) -> Block:
    x = np.frombuffer(row["vectors"], f"<i{row['width']}").reshape(-1, dim).astype(np.int64)
    entries = list(zip(row["keys"], row["rows"]))
    heaps, at = [], 0
    for size in row["sizes"]:
        heaps.append(entries[at : at + size])
        at += size
    return Block(row["ids"], x, heaps)


def _blocks(batches, dim: int, block: int):
    """(ids, matrix) of up to ``block`` kept vectors."""
    ids, parts, held = [], [], 0
    for batch in batches:
        kept, x = whole(batch, dim, LIMIT)
        ids += kept.to_pylist()
        parts.append(x)
        held += len(x)
        while held >= block:
            x = np.concatenate(parts)
            yield ids[:block], x[:block]
            ids, parts, held = ids[block:], [x[block:]], held - block
    if held:
        yield ids, np.concatenate(parts)


def first_centroids(rows: DataFrame, k: int, dim: int, seed: int) -> np.ndarray:
    """The ``k`` kept vectors with the smallest hash of ``seed:id``, in hash order."""

    def run(batches):
        for batch in batches:
            ids, x = whole(batch, dim, LIMIT)
            yield pa.RecordBatch.from_arrays([ids, pa.array(packed(x), pa.binary())], names=["vec_id", "x"])

    kept = rows.mapInArrow(run, "vec_id long, x binary")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    least = kept.select(F.sha2(name, 256).alias("h"), "x").orderBy("h", "x").limit(k).collect()
    return unpacked(pa.array([bytes(r["x"]) for r in least], pa.binary()), dim)


@dataclass(frozen=True)
class Clustering:
    """Final centroids, the blocks after the last assignment, and how many vectors each assignment measured anew."""

    centroids: np.ndarray
    blocks: DataFrame | None
    rescanned: tuple[int, ...]


def fit(embeddings: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, seed: int = 2, block: int = BLOCK, id: str = "vec_id", vector: str = "embedding") -> Clustering:
    """Run ``rounds`` of assignment and update, and one more assignment."""
    spark = share_code(embeddings.sparkSession)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(_BATCH_BYTES))
    rows = rows_of(embeddings, id, vector)
    centroids = first_centroids(rows, k, dim, seed)
    k = len(centroids)
    if k == 0:
        return Clustering(centroids, None, ())

    def begin(batches, c=centroids):
        for ids, x in _blocks(batches, dim, block):
            own = Block(ids, x, [])
            yield _written(own, own.first(c), len(x))

    blocks = stored(rows.mapInArrow(begin, _BLOCK))
    sums = np.zeros((k, dim + 1), object)
    drift, counts = np.zeros(k), []
    for turn in range(rounds + 1):
        added = blocks.select(F.posexplode("moved").alias("i", "v")).where("v <> 0").groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).cast("string").alias("v"))
        for r in added.collect():
            sums[r["i"] // (dim + 1), r["i"] % (dim + 1)] += int(r["v"])
        counts.append(blocks.agg(F.sum("rescanned")).first()[0])
        if turn == rounds:
            break
        updated = centroids.copy()
        for a in range(k):
            if sums[a, dim]:
                updated[a] = [int(s) // int(sums[a, dim]) for s in sums[a, :dim]]
        step = np.sqrt(((updated - centroids) ** 2).sum(axis=1).astype(np.float64)) * (1 + SLACK)
        others = np.array([np.delete(step, a).max(initial=0.0) for a in range(k)])
        centroids, drift = updated, drift + step + others

        def again(batches, c=centroids, drift=drift):
            for batch in batches:
                for row in batch.to_pylist():
                    own = _read(row, dim)
                    moved, rescanned = own.reassign(c, drift)
                    yield _written(own, moved, rescanned)

        blocks = stored(blocks.mapInArrow(again, _BLOCK))
    return Clustering(centroids, blocks, tuple(counts))


def clustered(embeddings: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, seed: int = 2, block: int = BLOCK, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every kept vector."""
    spark = embeddings.sparkSession
    model = fit(embeddings, k, rounds, dim, seed, block, id, vector)
    c = model.centroids
    if model.blocks is None:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                own = _read(row, dim)
                cluster = own.clusters()
                apart = own.x - c[cluster]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own.ids, pa.int64()), pa.array(cluster), pa.array((apart * apart).sum(axis=1))], names=["vec_id", "cluster", "distance"]
                )

    placed = stored(model.blocks.select("ids", "width", "vectors", "keys", "rows", "sizes").mapInArrow(run, "vec_id long, cluster int, distance long"))
    # One row for each of at most k clusters.
    totals = {r["cluster"]: int(r["d"]) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    named = [(a, d, sum(totals.values()), hashlib.sha256(",".join(map(str, c[a].tolist())).encode()).hexdigest()) for a, d in totals.items()]
    facts = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
