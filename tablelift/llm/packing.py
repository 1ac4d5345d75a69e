"""Packing documents into sequences: shortest-pack-first over the length histogram.

Documents become pieces of at most ``size`` tokens. The driver sees only the histogram of piece lengths (at most
``size`` numbers): lengths are placed longest first into the open packing pattern with the most room, and pattern
counts are updated, never single documents. Each piece then finds its place by its rank among the pieces of its
length. Ranks come from per-bucket counts and small windows, so a length that a third of all pieces share is no
single group. A length adds a few patterns at most, so the table that is joined back is bounded by ``size``.

Null texts count as empty and give one piece holding only the end id. Rows may repeat (also with one id): each gives
its own pieces. Null ids are kept. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablelift.llm.common import kept_by_worker, share_code, stored, tidy
from tablelift.llm.pieces import WordIds, ids_below, library_ids, text_bounds
from tablelift.llm.words import slices, spans

#: Pieces in one rank window, about.
BUCKET_PIECES = 4096


@kept_by_worker
def _worker(path: str) -> WordIds:
    return WordIds(library_ids(path), ids_below(path))


def pieces(docs: DataFrame, vocabulary: str, size: int, end_id: int, id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, salt (and ids) of every piece."""
    share_code(docs.sparkSession)

    def run(batches):
        words = _worker(vocabulary)
        for batch in batches:
            for part, data, at in slices(batch, "text"):
                first_word, last_word, first = spans(data, at)
                ids, lengths = words.ids(words.rows(data, first_word, last_word))
                bounds = text_bounds(lengths, first)
                ids, doc, start, length, crc, total, own = ids.astype("<u4"), [], [], [], [], [], []
                for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    row = np.append(ids[a:b], np.uint32(end_id))
                    for s in range(0, len(row), size):
                        piece = row[s : s + size]
                        doc.append(i)
                        start.append(s)
                        length.append(len(piece))
                        crc.append(zlib.crc32(piece.tobytes()))
                        total.append(len(row))
                        own.append(piece)
                columns = [part.column(0).take(pa.array(doc, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
                if with_ids:
                    columns.append(pa.array([x.astype(np.int64) for x in own], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<long>" * with_ids
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(tidy(run, keeps=True), schema)


def plan(histogram: dict[int, int], size: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Packing patterns as (how many sequences, [(length, times), ...]) for a histogram of lengths.

    Lengths are placed longest first, each into the pattern with the most room, splitting a pattern's count where
    fewer pieces than sequences are left. A length adds at most a few patterns, however many pieces it has.
    """
    open_by_room: dict[int, list[tuple[int, list[tuple[int, int]]]]] = {}
    most, done = 0, []
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left > 0:
            while most >= length and not open_by_room.get(most):
                most -= 1
            if most < length:
                # Nothing has room: open sequences filled with this length as far as it goes.
                times = min(size // length, left)
                count, pattern, room = left // times, [], size
            else:
                count, pattern = open_by_room[most].pop()
                room = most
                if count > left:
                    open_by_room[most].append((count - left, pattern))
                    count = left
                times = min(room // length, left // count)
            left -= count * times
            room -= times * length
            grown = [*pattern[:-1], (length, pattern[-1][1] + times)] if pattern and pattern[-1][0] == length else [*pattern, (length, times)]
            if room:
                open_by_room.setdefault(room, []).append((count, grown))
                most = max(most, room)
            else:
                done.append((count, grown))
    return done + [x for rows in open_by_room.values() for x in rows]


def places(patterns: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (length, first rank, ranks, times, first sequence, offset): which ranks of a length go where."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for count, pattern in patterns:
        offset = 0
        for length, times in pattern:
            begin = rank.get(length, 0)
            rows.append((length, begin, count * times, times, sequence, offset))
            rank[length] = begin + count * times
            offset += length * times
        sequence += count
    return rows


def pack(docs: DataFrame, vocabulary: str, size: int = 2048, end_id: int = 1, id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """All pieces with their sequence_id and offset."""
    spark = docs.sparkSession
    found = stored(pieces(docs, vocabulary, size, end_id, id, text, with_ids))
    histogram = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = places(plan(histogram, size))
    names = "p_length long, p_first long, p_ranks long, p_times long, p_sequence long, p_offset long"
    place = spark.createDataFrame(rows, names)

    buckets = max(1, sum(histogram.values()) // BUCKET_PIECES)
    salt = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets))
    salted = found.withColumn("salt", salt)
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
        .select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")
    ranked = (
        salted.withColumn("rank", F.row_number().over(within) - 1)
        .join(base, ["length", "salt"])
        .withColumn("rank", F.col("rank") + F.col("base"))
    )
    inside = (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("p_first")) & (F.col("rank") < F.col("p_first") + F.col("p_ranks"))
    step = F.col("rank") - F.col("p_first")
    # The table of places has at most a few rows for each of ``size`` lengths and patterns.
    return ranked.join(F.broadcast(place), inside).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("p_sequence") + F.floor(step / F.col("p_times"))).cast("long").alias("sequence_id"),
        (F.col("p_offset") + F.pmod(step, F.col("p_times")) * F.col("length")).cast("long").alias("offset"),
        *(["ids"] if with_ids else []),
    )
