"""Byte-pair encoding and decoding with forced boundaries.

A pair of bytes that no vocabulary token holds side by side can never be merged over, so a word may be cut there:
the fragments are encoded independently and their ids concatenated. The last fragment of a pre-token carries the
vocabulary's word end, the others don't. Results equal the tokenizers library's on the whole text.

Null texts count as empty: no ids, empty decoded text. Rows may repeat, ids may be null and columns beside id and
text are ignored; an empty table gives an empty result. The strings of added special tokens inside a text become
their ids, as the library does by default.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablelift.llm.common import share_code
from tablelift.llm.pieces import WordIds, ids_below, load, text_bounds
from tablelift.llm.words import slices, spans

#: Fragments in each of the two generations that a worker remembers.
FRAGMENTS = 100_000


class ForcedBoundaryEncoder:
    """Ids of single words by forced cuts; ``cuts`` shows where."""

    def __init__(self, path: str):
        self.whole = load(path)
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        if spec.get("decoder"):
            raise ValueError(f"{path}: this operator decodes by joining tokens with spaces; the vocabulary has a decoder of its own")
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        spec["model"]["end_of_word_suffix"] = None
        self.last, self.inner = self.whole.model, Tokenizer.from_str(json.dumps(spec)).model
        stems = [t.removesuffix(self.suffix) for t in spec["model"]["vocab"]]
        self.joined = {t[i : i + 2] for t in stems for i in range(len(t) - 1)}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.known: dict[tuple[str, bool], list[int]] = {}
        self.older: dict[tuple[str, bool], list[int]] = {}

    def cuts(self, piece: str) -> list[str]:
        """Fragments of a pre-token in byte letters: cut wherever a pair occurs in no token."""
        joined, out, begin = self.joined, [], 0
        for i in range(1, len(piece)):
            if piece[i - 1 : i + 1] not in joined:
                out.append(piece[begin:i])
                begin = i
        out.append(piece[begin:])
        return out

    def _fragment(self, fragment: str, final: bool) -> list[int]:
        key = fragment, final
        ids = self.known.get(key)
        if ids is None:
            if len(self.known) >= FRAGMENTS:
                self.known, self.older = {}, self.known
            ids = self.older.get(key)
            if ids is None:
                ids = [t.id for t in (self.last if final else self.inner).tokenize(fragment)]
            self.known[key] = ids
        return ids

    def _plain(self, word: str) -> list[int]:
        ids: list[int] = []
        whole = self.whole
        for piece, _ in whole.pre_tokenizer.pre_tokenize_str(whole.normalizer.normalize_str(word)):
            found = self.known.get((piece, True))
            if found is not None:
                ids += found
                continue
            fragments = self.cuts(piece)
            for f in fragments[:-1]:
                ids += self._fragment(f, False)
            ids += self._fragment(fragments[-1], True)
        return ids

    def word(self, word: str) -> list[int]:
        if self.split is None or not self.split.search(word):
            return self._plain(word)
        ids: list[int] = []
        for part in self.split.split(word):
            if part in self.special:
                ids.append(self.special[part])
            elif part:
                ids += self._plain(part)
        return ids


@cache
def _worker(path: str) -> tuple[WordIds, list[str]]:
    encoder = ForcedBoundaryEncoder(path)
    tokens = [encoder.whole.id_to_token(i) or "" for i in range(encoder.whole.get_vocab_size(True))]
    return WordIds(lambda words: [encoder.word(w) for w in words], ids_below(path)), tokens


def _encoded(batches, path):
    """Slices of the input with all their ids and each text's bounds."""
    words, _ = _worker(path)
    for batch in batches:
        for part, data, at in slices(batch, "text"):
            start, end, first = spans(data, at)
            ids, lengths = words.ids(words.rows(data, start, end))
            yield part, ids, text_bounds(lengths, first)


def _rows(docs: DataFrame, id: str, text: str) -> DataFrame:
    share_code(docs.sparkSession)
    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def encode(docs: DataFrame, vocabulary: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every row."""

    def run(batches):
        for part, ids, bounds in _encoded(batches, vocabulary):
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["doc_id", "ids"])

    return _rows(docs, id, text).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(ids: list[int], tokens: list[str]) -> str:
    """Text of ids: this vocabulary has no decoder, so tokens are joined by one space."""
    return " ".join([tokens[i] for i in ids])


def decode(rows: DataFrame, vocabulary: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id and text of rows of ids; null ids count as none."""
    share_code(rows.sparkSession)

    def run(batches):
        _, tokens = _worker(vocabulary)
        for batch in batches:
            texts = [decoded(x or [], tokens) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    picked = rows.select(F.col(id).cast("long").alias("doc_id"), F.col(ids).cast("array<int>").alias("ids"))
    return picked.mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, vocabulary: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Round trip of every row without moving ids: doc_id, n_tokens, ids_sha256, decoded_sha256."""

    def run(batches):
        tokens = _worker(vocabulary)[1]
        numbers = [str(i) for i in range(len(tokens))]
        for part, ids, bounds in _encoded(batches, vocabulary):
            listed, sizes, one, two = ids.tolist(), np.diff(bounds), [], []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                own = listed[a:b]
                one.append(hashlib.sha256(" ".join([numbers[i] for i in own]).encode()).hexdigest())
                two.append(hashlib.sha256(decoded(own, tokens).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes), pa.array(one, pa.string()), pa.array(two, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _rows(docs, id, text).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
