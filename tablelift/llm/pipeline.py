"""Cleaning and packing a corpus: five stages, each over all that its predecessor kept.

``run`` applies them to the documents table; every stage is written as Parquet in the shared folder and read again, so
a lost executor costs one stage at most. All stages but the last return the columns of documents, whatever they are called.

Rows that go are told by small keys. A sieve of bits over these keys keeps the texts of all other rows where they
are: only rows that the sieve cannot tell apart from those that go are moved and joined. With very many rows that go the sieve
lets more rows through, which costs a shuffle, never a row.

Null texts count as empty and null ids are ids like any other, but for near copies, where rows with a null id link with nothing. Rows may
repeat; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablelift.llm import exact, jaccard, packing, quality, toxicity
from tablelift.llm.common import share_code, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Bits of a sieve at most: the table of its words, which is broadcast, has a 32nd of that many rows of 16 bytes.
SIEVE_BITS = 1 << 26


def _free(docs: DataFrame, name: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _digest() -> Column:
    """SHA-256 of what tells texts apart in the exact_dedup stage: A-Z as a-z, a null text as the empty one."""
    lower = F.translate(F.coalesce(F.col("text"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.sha2(lower, 256)


def _sieved(rows: DataFrame, keys: DataFrame, by: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that are certainly in ``keys`` or may be, rows that are certainly not); no row is moved.

    ``by`` gives the value of each column of ``keys`` for a row.
    """
    count = keys.count()
    bits = min(SIEVE_BITS, max(1 << 10, 16 << count.bit_length()))

    def bit(place: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(32)).cast("int"))

    own = F.pmod(F.xxhash64(*[F.col(c) for c in by]), F.lit(bits))
    words = keys.groupBy(F.floor(own / 32).alias("word")).agg(F.bit_or(bit(own)).alias("bits"))
    word, mask = _free(rows, "_word"), _free(rows, "_bits")
    place = F.pmod(F.xxhash64(*by.values()), F.lit(bits))
    looked = rows.withColumn(word, F.floor(place / 32)).join(F.broadcast(words.select(F.col("word").alias(word), F.col("bits").alias(mask))), word, "left")
    maybe = F.coalesce(F.col(mask).bitwiseAND(bit(place)) != 0, F.lit(False))
    return looked.where(maybe).select(*rows.columns), looked.where(~maybe).select(*rows.columns)


def _split(rows: DataFrame, keys: DataFrame, by: dict[str, Column], how: str) -> tuple[DataFrame, DataFrame]:
    """(rows that the sieve lets through, joined with ``keys`` as ``how`` says; the others as they are). Nulls match nulls."""
    maybe, others = _sieved(rows, keys, by)
    names = {c: _free(rows, f"_{c}_own") for c in by}
    wanted = {c: _free(rows, f"_{c}_key") for c in by}
    valued = maybe.withColumns({names[c]: v for c, v in by.items()})
    listed = keys.select(*[F.col(c).alias(wanted[c]) for c in by])
    met = valued.join(listed, reduce(and_, [valued[names[c]].eqNullSafe(listed[wanted[c]]) for c in by]), how)
    return met.select(*rows.columns), others


def _without(rows: DataFrame, gone: DataFrame, by: dict[str, Column]) -> DataFrame:
    left, others = _split(rows, stored(gone.select(*by).distinct()), by, "left_anti")
    return others.unionByName(left)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier calls toxic go, rows of one text alike; empty texts are judged like all others."""
    return toxicity.clean_rows(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a learned rule rejects go; empty texts fail the base rule."""
    return quality.kept_rows(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays; rows repeated with one id and text stay once.

    An id may have several texts, and so may null: each row goes or stays with its own text.
    """
    groups = stored(exact.exact_groups(docs))
    by = {"doc_id": F.col("doc_id").cast("long"), "text_sha256": _digest()}
    left = _without(docs, groups.where("NOT kept"), by)
    repeated = groups.where("kept AND group_size > 1").groupBy("doc_id", "text_sha256").count().where("count > 1")
    if repeated.isEmpty():
        return left
    copies, others = _split(left, stored(repeated.select(*by)), by, "left_semi")
    digest = _free(docs, "_digest")
    return others.unionByName(copies.withColumn(digest, _digest()).dropDuplicates(["doc_id", digest]).drop(digest))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar texts the document with the smallest id stays; rows with a null id link with nothing.

    Where ids repeat, each row is a document of its own, told by a number; of a group one row with the smallest id stays.
    """
    if docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").isEmpty():
        return _without(docs, jaccard.similar_groups(docs).where("doc_id <> component_id").select("doc_id"), {"doc_id": F.col("doc_id").cast("long")})
    key = _free(docs, "_key")
    rows = stored(docs.withColumn(key, F.when(F.col("doc_id").isNotNull(), F.monotonically_increasing_id())))
    numbers = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("number"), F.col("doc_id").cast("long").alias("id"))
    groups = jaccard.similar_groups(rows, id=key).where("doc_id IS NOT NULL").select(F.col("doc_id").alias("number"), F.col("component_id").alias("of"))
    placed = stored(groups.join(numbers, "number"))
    stays = placed.groupBy("of").agg(F.min(F.struct("id", "number"))["number"].alias("number"))
    gone = placed.join(stays.select("number"), "number", "left_anti").select(F.col("number").alias("key"))
    return _without(rows, gone, {"key": F.col(key)}).drop(key)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all that is left, in sequences of at most 2048 tokens; an empty text is one piece of one id."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_poor),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("packing", pack),
]

# The classifier, the learned rules and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(share_code(spark), sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
