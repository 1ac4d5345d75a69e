import hashlib
from collections import defaultdict

import numpy as np

from tablelift.llm import exact
from tablelift.llm.common import stored
from tests.llm.conftest import fold, odd_rows


def _wanted(rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[fold(t)].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def _got(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()), key=repr)


def test_groups(odd, none):
    assert _got(exact.exact_groups(odd)) == _wanted(odd_rows())
    assert exact.exact_groups(none).collect() == []


def test_small_buckets_and_a_hot_text(spark):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i} " + "w " * (i % 50)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert _got(exact.exact_groups(docs, capacity=200)) == _wanted(rows)


def test_directory_doubles_where_buckets_are_full():
    sizes = np.zeros(16, np.int64)
    sizes[[0, 1]] = 10
    sizes[12] = 7
    directory, depth = exact.grow(sizes, 10)
    assert depth == 4 and len(directory) == 16
    assert directory[0] != directory[1] and len(set(directory[2:4])) == 1 and len(set(directory[8:])) == 1
    held = defaultdict(int)
    for cell, size in enumerate(sizes):
        held[directory[cell]] += size
    assert max(held.values()) <= 10
    assert exact.grow(np.zeros(16, np.int64), 10)[1] == 0
    # One cell that is too full stays one bucket, whatever the depth.
    assert exact.grow(sizes * 100, 10)[1] == 4


def test_colliding_keys_are_chained_by_bytes(odd, monkeypatch):
    monkeypatch.setattr(exact.xxhash, "xxh3_64_intdigest", lambda t: len(t) % 2)
    texts = [b"aa", b"bb", b"aa", b"c"]
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([0] * 4), pa.array([0, 0, 0, 1]), pa.array(texts), pa.array([3, None, 9, 4]), pa.array([1, 1, 2, 1])], names=["bucket", "h", "text", "top", "n"])
    rows = [r for b in exact._chains([batch]) for r in b.to_pylist()]
    assert [(r["h"], r["chain"], r["keep_id"], r["group_size"]) for r in rows] == [(0, 0, 9, 3), (0, 1, None, 1), (1, 0, 4, 1)]


def test_index_files_hold_every_text_once(spark, odd):
    docs = odd.select("doc_id", "text")
    keys = stored(docs.mapInArrow(exact._keys, "doc_id long, h long, sha binary, n_bytes long"))
    entries, _, _ = exact.build_index(docs, keys, capacity=1000)
    assert entries.count() == len({fold(t) for _, t, *_ in odd_rows()})
