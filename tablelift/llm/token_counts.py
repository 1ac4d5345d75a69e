"""Token counts by a map-side two-tier lookup.

Tier one is a broadcast table of the corpus's most frequent pre-tokens (hash and length); tier two is a cache in
each Python worker, filled by the tokenizer library with the pre-tokens that tier one lacks. Pre-tokens are the
white-space separated words. They are never shuffled: to find the frequent ones, each task sends only its
``TASK_WORDS`` most frequent. Which words are in tier one changes the speed, never a count.

Null texts count as empty and give 0 bytes and 0 tokens. Rows may repeat: each input row gives one output row with
its own id, null ids too. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablelift.llm.common import share_code
from tablelift.llm.pieces import WordIds, ids_below, library_ids
from tablelift.llm.words import LongTable, slices, span_hashes, spans

#: Pre-tokens in the broadcast table, and those each task proposes.
TABLE_WORDS, TASK_WORDS = 1 << 14, 1 << 12
#: Distinct pre-tokens a task counts before it drops those seen once.
COUNTED_WORDS = 1 << 20


def _frequent(batches):
    """The task's most frequent words; rare ones are forgotten when the table is full."""
    counts: dict[int, list] = {}
    for batch in batches:
        for _, data, at in slices(batch, "text"):
            start, end, _ = spans(data, at)
            keys, first, n = np.unique(span_hashes(data, start, end), return_index=True, return_counts=True)
            raw = data.tobytes()
            for k, s, e, c in zip(keys.tolist(), start[first].tolist(), end[first].tolist(), n.tolist()):
                if k in counts:
                    counts[k][0] += c
                elif e - s <= 64:
                    counts[k] = [c, raw[s:e]]
            if len(counts) > COUNTED_WORDS:
                counts = {k: v for k, v in counts.items() if v[0] > 1}
                if len(counts) > COUNTED_WORDS // 2:
                    most = sorted(counts.items(), key=lambda x: -x[1][0])[: COUNTED_WORDS // 4]
                    counts = dict(most)
    top = sorted(counts.values(), key=lambda x: (-x[0], x[1]))[:TASK_WORDS]
    yield pa.RecordBatch.from_arrays(
        [pa.array([w.decode("utf-8", "replace") for _, w in top], pa.string()), pa.array([c for c, _ in top], pa.int64())],
        names=["word", "n"],
    )


def frequent_words(docs: DataFrame, text: str = "text", words: int = TABLE_WORDS) -> list[str]:
    """The corpus's most frequent words by the tasks' proposals, at most ``words``."""
    found = docs.select(F.col(text).alias("text")).mapInArrow(_frequent, "word string, n long")
    rows = found.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(words).collect()
    return [r["word"] for r in rows]


@cache
def _worker(path: str) -> WordIds:
    return WordIds(library_ids(path), ids_below(path))


def _table(words: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    raw = [w.encode() for w in words]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    end = np.cumsum(sizes)
    keys = span_hashes(np.frombuffer(b"".join(raw), np.uint8), end - sizes, end)
    return keys, np.fromiter(map(len, library_ids(path)(words)), np.int32, len(words))


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row."""
    spark = share_code(docs.sparkSession).sparkContext
    known = spark.broadcast(_table(frequent_words(docs, text), vocabulary))

    def count(batches):
        keys, lengths = known.value
        frequent = LongTable(len(keys))
        frequent.add(keys, lengths)
        rare = _worker(vocabulary)
        for batch in batches:
            for part, data, at in slices(batch, "text"):
                start, end, first = spans(data, at)
                h = span_hashes(data, start, end)
                n = frequent.find(h).astype(np.int64)
                missing = np.flatnonzero(n < 0)
                if len(missing):
                    rows = rare.rows(data, start[missing], end[missing], h[missing])
                    n[missing] = rare.length[rows]
                totals = np.concatenate([[0], np.cumsum(n)])[first]
                tokens = np.diff(totals)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(at)), pa.array(tokens), pa.array(tokens > limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
