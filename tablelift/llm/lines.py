"""Lines that occur in many documents, found by levelled sorted runs of line hashes, and taken out of every text.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, A-Z lower-cased; it counts once for each document
(each row) that holds it. :class:`LineRuns` takes documents batch by batch. A batch's keys, as 64-bit hashes with their
number of documents, are merge-anti-joined with the hashes that the runs already hold as common; what is left becomes a
run of its own: a table in the shared folder, dealt by hash and sorted by it. Whenever a level holds ``FANOUT`` runs, they are merged into one
run of the next level, counts added, so a key is written again once for each level, not once for each batch.
A key is common as soon as its documents reach the threshold, within a batch or when runs merge; from then on it is no
longer counted, and later batches drop it at the anti-join. At the end the runs left are merged once.

Counting is combined within tasks before it is moved, so a line that a third of all documents share is a few rows.
Taking out: where the common keys fit ``BROADCAST`` numbers of 8 bytes (8 MB), each task looks its lines up in them and no text
moves; beyond that, the documents' keys are joined with the common ones, dealt by key and salt, and each text gets the
common keys of its own lines. Both give the same rows.

A text is split at ``\\n``: a null or empty text is one empty line. Lines without a key (empty after stripping, or
shorter than ``least_chars`` code points) always stay. The other lines stay in order, joined by ``\\n``; a text that
loses all lines becomes empty. Rows with a null or repeated id are documents of their own. Other columns are ignored; an empty table gives an
empty result. Two different lines with one 64-bit hash would count as one line.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelift.llm.common import share_code, shuffle_tasks, stored
from tablelift.llm.words import is_space, lower, slices, span_hashes

#: Documents from which a line is common, and code points its key has at least.
DOCUMENTS, LEAST_CHARS = 10, 1
#: Runs of a level that are merged into one of the next, and batches that one table is dealt into at most.
FANOUT, BATCHES = 4, 8
#: Common keys that are sent to all workers; beyond it they are joined, with keys dealt to so many tasks each.
BROADCAST, SALTS = 1 << 20, 16
#: Keys a task counts before it hands them on.
COUNTED = 1 << 20


def keyed(data: np.ndarray, at: np.ndarray, least_chars: int = LEAST_CHARS):
    """Lines of a slice: (start, end, first line of each text and one more, index of lines with a key, their hashes)."""
    n = len(data)
    breaks = np.flatnonzero(data == 0x0A)
    # A text's lines begin at its start and after each of its breaks.
    per_text = np.searchsorted(breaks, at)
    first = per_text + np.arange(len(at))
    count = int(first[-1])
    begins = np.empty(count, np.int64)
    texts = np.zeros(count, bool)
    texts[first[:-1]] = True
    begins[texts], begins[~texts] = at[:-1], breaks + 1
    ends = np.empty(count, np.int64)
    last = np.zeros(count, bool)
    last[first[1:] - 1] = True
    ends[last], ends[~last] = at[1:], breaks
    marks = np.flatnonzero(~is_space(data)) if n else np.zeros(0, np.int64)
    a, b = np.searchsorted(marks, begins), np.searchsorted(marks, ends)
    full = np.flatnonzero(b > a)
    start, end = marks[a[full]], marks[b[full] - 1] + 1
    if least_chars > 1:
        heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        long = heads[end] - heads[start] >= least_chars
        full, start, end = full[long], start[long], end[long]
    return begins, ends, first, full, span_hashes(lower(data), start, end)


def _own_keys(first: np.ndarray, full: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, key) of the different keys of each text."""
    text = np.searchsorted(first, full, side="right") - 1
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (text[1:] != text[:-1]) | (h[1:] != h[:-1])
    return text[new], h[new]


def _plain(docs: DataFrame, id: str, text: str) -> DataFrame:
    share_code(docs.sparkSession)
    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def line_counts(docs: DataFrame, least_chars: int = LEAST_CHARS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(h, n): the hash of every key, and how many documents hold it; sums are partial."""

    def run(batches):
        held, size = [], 0

        def out():
            h, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])

        for batch in batches:
            for _, data, at in slices(batch, "text"):
                _, _, first, full, h = keyed(data, at, least_chars)
                held.append(_own_keys(first, full, h)[1])
                size += len(held[-1])
            if size >= COUNTED:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    return _plain(docs, id, text).mapInArrow(run, "h long, n long")


class LineRuns:
    """Levels of sorted runs (h, n), each a table in the shared folder."""

    def __init__(self, spark: SparkSession, documents: int = DOCUMENTS, least_chars: int = LEAST_CHARS, fanout: int = FANOUT):
        self.spark, self.documents, self.least_chars, self.fanout = share_code(spark), documents, least_chars, fanout
        self.levels: list[list[DataFrame]] = []

    def _all(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _run(self, counts: DataFrame) -> DataFrame:
        """Counts added, dealt by hash and sorted, as a table."""
        added = counts.groupBy("h").agg(F.sum("n").alias("n"))
        known = [run.where(F.col("n") >= self.documents).select("h") for run in self._all()]
        if known:
            added = added.join(_union(known), "h", "left_anti")
        return stored(added.repartition(shuffle_tasks(self.spark), "h").sortWithinPartitions("h"))

    def add(self, docs: DataFrame, id: str = "doc_id", text: str = "text") -> None:
        """Count a batch of documents."""
        self._push(0, self._run(line_counts(docs, self.least_chars, id, text)))

    def _push(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            merging, self.levels[level] = self.levels[level], []
            self._push(level + 1, self._run(_union(merging)))

    def common(self) -> DataFrame:
        """The hashes of all keys that reached the threshold, once each."""
        runs = self._all()
        if not runs:
            return self.spark.createDataFrame([], "h long")
        return _union(runs).groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= self.documents).select("h")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def _cleaned(part: pa.RecordBatch, data: np.ndarray, at: np.ndarray, least_chars: int, common) -> pa.RecordBatch:
    """A slice's texts without common lines; ``common(text of each key, keys)`` says which keys are."""
    begins, ends, first, full, h = keyed(data, at, least_chars)
    gone = np.zeros(len(begins), bool)
    gone[full] = common(np.searchsorted(first, full, side="right") - 1, h)
    n_lines = np.diff(first)
    dropped = np.diff(np.concatenate([[0], np.cumsum(gone)])[first])
    raw, bounds = data.tobytes(), at.tolist()
    texts: list[bytes] = []
    for i, (a, b, lost) in enumerate(zip(bounds[:-1], bounds[1:], dropped.tolist())):
        if lost:
            kept = first[i] + np.flatnonzero(~gone[first[i] : first[i + 1]])
            texts.append(b"\n".join([raw[s:e] for s, e in zip(begins[kept].tolist(), ends[kept].tolist())]))
        else:
            texts.append(raw[a:b])
    return pa.RecordBatch.from_arrays(
        [part.column(0), pa.array(n_lines), pa.array(dropped), pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "n_lines", "n_dropped", "text"]
    )


_OUT = "doc_id long, n_lines long, n_dropped long, text string"


def without_lines(docs: DataFrame, common: DataFrame, least_chars: int = LEAST_CHARS, id: str = "doc_id", text: str = "text", most: int = BROADCAST) -> DataFrame:
    """doc_id, n_lines, n_dropped and text of every row, without the lines whose key is in ``common`` (h)."""
    docs = _plain(docs, id, text)
    common = stored(common)
    if common.count() > most:
        return _joined(docs, common, least_chars)
    found = np.sort(common.toArrow()["h"].to_numpy().view(np.uint64))
    shared = docs.sparkSession.sparkContext.broadcast(found)

    def run(batches):
        table = shared.value

        def known(_, h):
            if not len(table):
                return np.zeros(len(h), bool)
            place = np.searchsorted(table, h)
            place[place == len(table)] = 0
            return table[place] == h

        for batch in batches:
            for part, data, at in slices(batch, "text"):
                yield _cleaned(part, data, at, least_chars, known)

    return docs.mapInArrow(run, _OUT)


def _joined(docs: DataFrame, common: DataFrame, least_chars: int) -> DataFrame:
    """The same by joins: rows with one id and one text share their common keys."""

    def keys(batches):
        for batch in batches:
            for part, data, at in slices(batch, "text"):
                _, _, first, full, h = keyed(data, at, least_chars)
                text, h = _own_keys(first, full, h)
                raw, bounds = data.tobytes(), at.tolist()
                digest = pa.array([xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())
                rows = pa.array(text)
                yield pa.RecordBatch.from_arrays([part.column(0).take(rows), digest.take(rows), pa.array(h.view(np.int64))], names=["doc_id", "digest", "h"])

    def digests(batches):
        for batch in batches:
            texts = batch.column(1).fill_null("").to_pylist()
            digest = pa.array([xxhash.xxh3_128_digest(t.encode()) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, digest], names=["doc_id", "text", "digest"])

    def salt(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(SALTS))

    spread = common.select("h", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    held = docs.mapInArrow(keys, "doc_id long, digest binary, h long").withColumn("salt", salt(F.col("digest")))
    gone = held.join(spread, ["h", "salt"], "left_semi").groupBy("doc_id", "digest").agg(F.collect_set("h").alias("gone"))
    rows = docs.mapInArrow(digests, "doc_id long, text string, digest binary")
    gone = gone.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "gone")
    both = rows.join(gone, rows["digest"].eqNullSafe(gone["_digest"]) & rows["doc_id"].eqNullSafe(gone["_id"]), "left")

    def run(batches):
        for batch in batches:
            for part, data, at in slices(batch, "text"):
                lists = [np.sort(np.array(x or [], np.int64)) for x in part.column(2).to_pylist()]

                def known(text, h):
                    h = h.view(np.int64)
                    cuts = np.searchsorted(text, np.arange(len(lists) + 1))
                    return np.concatenate([np.isin(h[a:b], own) for a, b, own in zip(cuts[:-1], cuts[1:], lists)] or [np.zeros(0, bool)])

                yield _cleaned(part, data, at, least_chars, known)

    return both.select("doc_id", "text", "gone").mapInArrow(run, _OUT)


def batches_of(docs: DataFrame, most: int = BATCHES) -> list[DataFrame]:
    """A scan of several files as up to ``most`` frames that read some of the files each; anything else as one frame."""
    if len(docs.inputFiles()) < 2:
        return [docs]
    which = F.pmod(F.xxhash64("_metadata.file_path"), F.lit(most))
    try:
        found = sorted(r["batch"] for r in docs.select(which.alias("batch")).distinct().collect())
    except AnalysisException:  # a frame over several scans has no single file
        return [docs]
    return [docs.where(which == b) for b in found]


def without_common_lines(docs: DataFrame, documents: int = DOCUMENTS, least_chars: int = LEAST_CHARS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_lines (before), n_dropped and text of every row, without the lines that ``documents`` rows share."""
    runs = LineRuns(docs.sparkSession, documents, least_chars)
    for batch in batches_of(docs):
        runs.add(batch, id, text)
    return without_lines(docs, runs.common(), least_chars, id, text)
