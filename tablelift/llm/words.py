"""Texts of an Arrow batch as one byte array, their words, and 64-bit hashes of words and spans.

A word is ``[^\\x20\\x09-\\x0D]+`` over UTF-8 bytes. All work is vectorised over a slice of a batch, so memory
is a multiple of one slice, or of the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: A slice holds at most this many bytes of text, unless one text alone is longer.
SLICE_BYTES = 1 << 19

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 bits."""
    h = h ^ (h >> _U(30))
    h *= _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next slice."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 1)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if size <= 8 * SLICE_BYTES:
            _powers[base] = have
    return have[:n]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch with their text bytes and offsets; null texts count as empty."""
    column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    at = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        yield batch.slice(first, last - first), data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all else as it is."""
    return _LOWER[data]


def is_space(data: np.ndarray) -> np.ndarray:
    return _SPACE[data]


def spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each text the index of its first word (one more at the end)."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(at), np.int64)
    space = _SPACE[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = True, space[:-1]
    after[-1], after[:-1] = True, space[1:]
    before[at[:-1][at[:-1] < n]] = True
    after[at[1:][at[1:] > 0] - 1] = True
    start = np.flatnonzero(~space & before)
    end = np.flatnonzero(~space & after) + 1
    return start, end, np.searchsorted(start, at)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """One 64-bit hash for the bytes of each span; equal bytes give equal hashes in every slice."""
    n = len(data)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * _power(_BASE, n), out=sums[1:])
    h = (sums[end] - sums[start]) * _power(_INVERSE, n + 1)[start]
    return mix(h + (end - start).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


_STEP = mix(np.arange(11, 19, dtype=np.uint64)) | _U(1)


def windows(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` word hashes."""
    count = max(0, len(words) - width + 1)
    h = np.full(count, width, dtype=np.uint64)
    for k in range(width):
        h += words[k : k + count] * _STEP[k]
    return mix(h)


class LongTable:
    """Map from 64-bit keys to small integers, with lookups and inserts over whole arrays."""

    def __init__(self, capacity: int = 1 << 14):
        self.clear(capacity)

    def clear(self, capacity: int = 1 << 14) -> None:
        size = 1 << max(4, (2 * capacity - 1).bit_length())
        self.keys, self.values, self.count = np.zeros(size, np.uint64), np.full(size, -1, np.int32), 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where it is absent."""
        mask = len(self.keys) - 1
        out = np.full(len(keys), -1, np.int32)
        at = (keys & _U(mask)).astype(np.int64)
        value = self.values[at]
        same = self.keys[at] == keys
        hit = same & (value >= 0)
        out[hit] = value[hit]
        left = np.flatnonzero(~same & (value >= 0))
        at = at[left]
        while len(left):
            at = (at + 1) & mask
            value, same = self.values[at], self.keys[at] == keys[left]
            hit = same & (value >= 0)
            out[left[hit]] = value[hit]
            go = ~same & (value >= 0)
            left, at = left[go], at[go]
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Insert distinct keys that are not in the table."""
        if 2 * (self.count + len(keys)) > len(self.keys):
            used = self.values >= 0
            old_keys, old_values = self.keys[used], self.values[used]
            self.clear(2 * (len(old_keys) + len(keys)))
            self._put(old_keys, old_values)
        self._put(keys, values)

    def _put(self, keys: np.ndarray, values: np.ndarray) -> None:
        mask = len(self.keys) - 1
        self.count += len(keys)
        at = (keys & _U(mask)).astype(np.int64)
        while len(keys):
            free = self.values[at] < 0
            self.values[at[free]], self.keys[at[free]] = values[free], keys[free]
            lost = (self.keys[at] != keys) | (self.values[at] != values)
            keys, values, at = keys[lost], values[lost], (at[lost] + 1) & mask


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the elements of many runs, one run after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)
