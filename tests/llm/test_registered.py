"""Registered queries over the whole small tables, beside plain versions of the same."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tablelift.llm import quality, queries, toxicity
from tablelift.llm.common import table
from tests.llm.test_quality import _brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def encoded(documents, vocabulary):
    library = Tokenizer.from_file(vocabulary)
    return library, {i: library.encode(t, add_special_tokens=False).ids for i, t in documents.items()}


def test_bpe(spark, encoded):
    library, ids = encoded
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op2_bpe(spark, SF).collect()}
    assert got == {i: (len(x), sha(" ".join(map(str, x))), sha(library.decode(x, skip_special_tokens=False))) for i, x in ids.items()}


def test_token_counts(spark, documents, encoded):
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.op9_token_counts(spark, SF).collect()}
    assert got == {i: (len(documents[i].encode()), len(x), len(x) > 2048) for i, x in encoded[1].items()}


def test_packing(spark, encoded):
    rows, sequences = defaultdict(list), defaultdict(list)
    for r in queries.op6_packing(spark, SF).collect():
        rows[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert rows.keys() == encoded[1].keys() and sorted(sequences) == list(range(len(sequences)))
    for i, own in rows.items():
        at, whole = 0, np.array([*encoded[1][i], 1], "<u4")
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(whole) and r.ids_crc32 == zlib.crc32(whole[at : at + r.length].tobytes())
            at += r.length
        assert at == len(whole)
    for placed in sequences.values():
        ends = [0, *np.cumsum([n for _, n in sorted(placed)])]
        assert [o for o, _ in sorted(placed)] == ends[:-1] and ends[-1] <= 2048
    used = sum(n for placed in sequences.values() for _, n in placed)
    assert len(sequences) * 2048 - used < 0.02 * used + 2048


def test_quality_rules(spark, documents):
    """Counts, the base rule, and the learned rules tried in order on each row by itself."""
    counted = quality.statistics(table(spark, SF, "documents", "doc_id", "text"))
    rules = quality.rules_of(counted, table(spark, SF, "labels", "doc_id", "quality"))
    full = {r.doc_id: r.asDict() for r in counted.collect()}
    rows = queries.op8_quality_rules(spark, SF).collect()
    assert len(rows) == len(documents) and rules

    def rejected(counts):
        def value(name):
            a, b = quality.RATIOS[name]
            return float(counts[a]) if b is None else counts[a] / counts[b] if counts[b] else 0.0

        return any(all((value(c.feature) > c.threshold) == c.above for c in rule) for rule in rules)

    for r in rows:
        own = _brute(documents[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == own
        assert r.base_failed == (own[0] < 10 or 100 * own[4] > 20 * own[0])
        assert r.kept == (not r.base_failed and not rejected(full[r.doc_id]))
    assert {r.kept for r in rows} == {True, False}


def test_toxicity(spark, documents):
    rows = queries.op4_toxicity(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(documents)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_convolutions_equal_a_plain_version():
    """Each text by itself: every window of every width, the largest answer of each filter."""
    r = np.random.default_rng(2)
    known = r.random(toxicity.BUCKETS) > 0.3
    known[0] = False
    net = toxicity._new_network(known, seed=5)
    net.bias = [r.normal(0, 0.3, toxicity.FILTERS).astype(np.float32) for _ in toxicity.WIDTHS]
    texts = [r.integers(0, toxicity.BUCKETS, (n, 2)).astype(np.int32) for n in (1, 2, 3, 9, 40, 1, 200)]
    got = net.forward(*net.padded(np.concatenate(texts), np.concatenate([[0], np.cumsum([len(t) for t in texts])])))[0]
    pad = max(toxicity.WIDTHS)
    for text, p in zip(texts, got):
        x = np.concatenate([net.embedding[np.where(known[text], text, 0)].sum(axis=1), np.zeros((pad, net.embedding.shape[1]))])
        pooled = []
        for width, w, b in zip(toxicity.WIDTHS, net.filters, net.bias):
            # Windows may begin at a word or at the pad behind the last one, and lie within the text's pads.
            begins = [k for k in range(len(text) + 1) if k + width <= len(x)]
            answers = [sum(x[k + j] @ w[j] for j in range(width)) + b for k in begins]
            pooled.append(np.max(answers, axis=0))
        z = np.tanh(np.concatenate(pooled))
        assert p == pytest.approx(1 / (1 + np.exp(-(z @ net.out + net.out_bias))), abs=1e-5)
