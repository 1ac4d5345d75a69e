"""Token ids of white-space separated words, remembered by each Python worker.

Only for tokenizers that drop white space and never join text across it, so that a text's ids are its words'
ids one after the other. Whether a tokenizer is of that kind is tried on probe texts when it is loaded.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from tokenizers import Tokenizer

from tablelift.llm.common import kept_by_worker
from tablelift.llm.words import LongTable, gather, span_hashes

#: Bytes of a generation of remembered words; a worker holds two. Bounds its memory, not its results.
GENERATION_BYTES = 48 << 20
#: New words handed to the library at once: its encodings are far larger than their ids.
LOT = 1000

_PROBES = ["a  b\tc\r\nd", "it's 12,5!! \n\n é  x", " Ab\x0b\x0cCd ", "<|endoftext|> <|endoftext|>x y"]


@kept_by_worker
def load(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    for probe in _PROBES:
        parts = probe.replace("\x0b", " ").replace("\x0c", " ").split(" ")
        parts = [y for x in parts for y in x.replace("\t", " ").replace("\r", " ").replace("\n", " ").split(" ")]
        apart = [i for x in parts for i in tokenizer.encode(x, add_special_tokens=False).ids]
        if apart != tokenizer.encode(probe, add_special_tokens=False).ids:
            raise ValueError(f"{path}: ids depend on white space; this operator needs a tokenizer that drops it")
    return tokenizer


def ids_below(path: str) -> int:
    """A number that all ids of the tokenizer are below."""
    return max(load(path).get_vocab(True).values(), default=0) + 1


def library_ids(path: str) -> Callable[[list[str]], list[list[int]]]:
    """Encoder of a list of words by the library itself."""
    tokenizer = load(path)
    return lambda words: [e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]


class _Generation:
    """Words and their ids: a table from hash to row, and for each row where its ids begin and how many they are."""

    def __init__(self, kind: type):
        self.table = LongTable(1 << 12)
        self.flat, self.used = np.zeros(1 << 14, kind), 0
        self.begin, self.length, self.count = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int32), 0

    @property
    def bytes(self) -> int:
        return sum(x.nbytes for x in (self.table.keys, self.table.values, self.flat, self.begin, self.length))

    def add(self, keys: np.ndarray, flat: np.ndarray, lengths: np.ndarray) -> None:
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.count + len(keys) > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        new = slice(self.count, self.count + len(keys))
        self.flat[self.used : self.used + len(flat)] = flat
        self.begin[new], self.length[new] = self.used + np.cumsum(lengths) - lengths, lengths
        self.table.add(keys, np.arange(new.start, new.stop, dtype=np.int32))
        self.used, self.count = self.used + len(flat), new.stop

    def ids(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lengths = self.length[rows].astype(np.int64)
        return self.flat[gather(self.begin[rows], lengths)], lengths


class WordIds:
    """Ids of words; unknown words are encoded once and remembered.

    Words live in two generations. A word that is used moves to the young one; once that is full it becomes the old one, and the
    old one goes, with the words that were not used for a whole generation. Ids take two bytes where ``ids_below`` allows it.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], ids_below: int = 1 << 32, generation_bytes: int = GENERATION_BYTES):
        self.encode, self.generation_bytes = encode, generation_bytes
        self.kind = np.uint16 if ids_below <= 1 << 16 else np.uint32
        self.young, self.old = _Generation(self.kind), _Generation(self.kind)
        self.encoded = 0

    @property
    def length(self) -> np.ndarray:
        """How many ids the word of each row has."""
        return self.young.length

    def rows(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray | None = None) -> np.ndarray:
        """For each word, its row; valid until the next call."""
        h = span_hashes(data, start, end) if hashes is None else hashes
        if self.young.bytes > self.generation_bytes:
            self.young, self.old = _Generation(self.kind), self.young
        found = self.young.table.find(h)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            keys, first = np.unique(h[missing], return_index=True)
            at = missing[first]
            before = self.old.table.find(keys)
            seen = before >= 0
            if seen.any():
                self.young.add(keys[seen], *self.old.ids(before[seen]))
            self._encode(data, keys[~seen], start[at[~seen]], end[at[~seen]])
            found[missing] = self.young.table.find(h[missing])
        return found

    def _encode(self, data: np.ndarray, keys: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        self.encoded += len(keys)
        for i in range(0, len(keys), LOT):
            new = [data[s:e].tobytes().decode("utf-8", "replace") for s, e in zip(start[i : i + LOT].tolist(), end[i : i + LOT].tolist())]
            ids = self.encode(new)
            lengths = np.fromiter(map(len, ids), np.int32, len(ids))
            flat = np.fromiter((x for own in ids for x in own), self.kind, int(lengths.sum()))
            self.young.add(keys[i : i + LOT], flat, lengths)

    def ids(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of these words in order, and how many each word has."""
        flat, lengths = self.young.ids(rows)
        return flat.astype(np.uint32), lengths


def text_bounds(lengths: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where each text's ids begin, and the end of the last."""
    return np.concatenate([[0], np.cumsum(lengths)])[first]
