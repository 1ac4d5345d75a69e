import re

import numpy as np
import pyarrow as pa

from tablelift.llm import words as W
from tests.llm.conftest import odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _batch(texts):
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])


def test_words_of_slices_equal_the_pattern():
    texts = [r[1] for r in odd_rows()]
    for limit in (1, 50, 1 << 20):
        got = []
        for _, data, at in W.slices(_batch(texts), "text", limit):
            start, end, first = W.spans(data, at)
            raw = data.tobytes()
            words = [raw[a:b].decode() for a, b in zip(start, end)]
            got += [words[a:b] for a, b in zip(first[:-1], first[1:])]
        assert got == [WORD.findall(t or "") for t in texts]


def test_hashes_depend_on_bytes_only():
    a, b = np.frombuffer(b"xx stone yy", np.uint8), np.frombuffer(b"stone", np.uint8)
    one = W.span_hashes(a, np.array([0, 3, 9]), np.array([2, 8, 11]))
    assert one[1] == W.span_hashes(b, np.array([0]), np.array([5]))[0]
    assert len(set(one.tolist())) == 3


def test_table_finds_what_was_added():
    r = np.random.default_rng(3)
    keys = np.unique(r.integers(0, 1 << 63, 5000).astype(np.uint64))
    table = W.LongTable(16)
    for lot in np.array_split(keys, 7):
        table.add(lot, (lot % np.uint64(1000)).astype(np.int32))
    assert (table.find(keys) == (keys % np.uint64(1000)).astype(np.int32)).all()
    assert (table.find(keys + np.uint64(1 << 63)) == -1).all()


def test_sliced_batches_and_empty_ones():
    batch = _batch(["a b", None, "c"]).slice(1, 2)
    (_, data, at), = W.slices(batch, "text")
    assert data.tobytes() == b"c" and at.tolist() == [0, 0, 1]
    assert list(W.slices(_batch([]), "text")) == []
