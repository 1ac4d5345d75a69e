import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tablelift.llm import maxent
from tablelift.llm.words import slices
from tests.llm.conftest import fold, odd_rows, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _held(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def _base(rows):
    tokens = [(i, _held(i), [*WORD.findall(fold(t)), None]) for i, t, *_ in rows]
    c = Counter(w for _, held, ws in tokens if not held for w in ws)
    total, different = sum(c.values()), len(c)
    return [(i, held, len(ws), sum(c[w] > 0 for w in ws), total, sum(math.log10((c[w] + 1) / (total + different + 1)) for w in ws)) for i, held, ws in tokens]


def _check(got, rows):
    key = lambda x: (repr(x[0]), x[2], x[5])
    for a, b in zip(sorted(got, key=key), sorted(_base(rows), key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])


def _tuples(df):
    return [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in df.collect()]


def test_odd_rows(odd, none):
    _check(_tuples(maxent.scored(odd)), odd_rows())
    assert maxent.scored(none).collect() == []


def test_infrequent_words_are_joined(odd, monkeypatch):
    monkeypatch.setattr(maxent, "BROADCAST_WORDS", 4)
    _check(_tuples(maxent.scored(odd)), odd_rows())


def test_no_training_text(spark):
    i = next(i for i in range(100) if _held(i))
    rows = maxent.scored(spark.createDataFrame([(i, "a b")], "doc_id long, text string")).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows] == [(3, 0, 0, 0.0)]


def test_held_out_texts_are_likelier_than_by_counts(spark):
    rows = []
    for i in range(400):
        words = ("lamp river stone cloud" if i % 2 else "haus baum fluss stein").split()
        rows.append((i, " ".join(words[(k * 7 + i) % 4] + ("n" if k % 3 else "m") for k in range(60))))
    got = maxent.scored(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).where("held_out").collect()
    assert sum(r.score for r in got) > 0.9 * sum(r.base_score for r in got) and all(r.score < 0 for r in got)


def test_probabilities_sum_to_one(spark):
    """Over all seen words, the end, and one unseen word of each class, after one history."""
    docs = spark.createDataFrame([(i, prose(i, 200)) for i in range(30)], "doc_id long, text string")
    model, vocabulary = maxent.fit(docs)
    own = maxent._own_classes(model.h)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["the river stone"])], names=["text"])
    (_, data, at), = slices(batch, "text")
    h, kind, bounds = maxent.tokens(data, at)
    rank = model.lookup().find(h)
    classes = maxent._classes(rank, kind, own, model.class_of)
    row = maxent.features(rank, classes, bounds)[-1:]
    p = np.exp(maxent.log_classes(model.weights, model.bias, row)[0])[0]
    sizes = model.class_total + model.class_different + 1.0
    mass = p / sizes  # one unseen word of each class
    assert mass.sum() + (p * (model.class_total + model.class_different) / sizes).sum() == pytest.approx(1)
    assert model.class_total.sum() == model.total == vocabulary.agg({"n": "sum"}).first()[0]
    assert model.class_different.sum() == model.different == vocabulary.count()


def test_history_decides_within_a_class(spark):
    """Two words of one spelling bucket, told apart by the word before."""
    common = " ".join(f"common{k}" for k in range(maxent.OWN)) + " "
    rows = []
    for i in range(200):
        pairs = ["lamp xzing" if (k * 7 + k * k // 3 + i) % 2 else "river yzing" for k in range(20)]
        rows.append((i, common * 30 + " ".join(pairs)))
    model, _ = maxent.fit(spark.createDataFrame(rows, "doc_id long, text string").repartition(2))

    def p(text):
        batch = pa.RecordBatch.from_arrays([pa.array([text])], names=["text"])
        (_, data, at), = slices(batch, "text")
        h, kind, bounds = maxent.tokens(data, at)
        rank = model.lookup().find(h)
        classes = maxent._classes(rank, kind, maxent._own_classes(model.h), model.class_of)
        rows = maxent.slot_features(rank, classes, bounds)
        every = np.exp(maxent.log_classes(model.slot_weights, model.slot_bias[classes], rows)[0])
        assert every.sum(axis=1) == pytest.approx(1, abs=1e-5)
        assert classes[1] > maxent.END_CLASS
        return every[1][maxent._slots(rank, kind, classes, model.slot_of)[1]]

    assert p("lamp xzing") > 1.5 * p("lamp yzing") and p("river yzing") > 1.5 * p("river xzing")


def test_each_round_reads_every_training_text(spark, monkeypatch):
    docs = spark.createDataFrame([(i, prose(i, 50)) for i in range(40)], "doc_id long, text string")
    seen = spark.sparkContext.accumulator(0)
    train = maxent._train_task

    def counting(batches, *args):
        def passed():
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return train(passed(), *args)

    monkeypatch.setattr(maxent, "_train_task", counting)
    maxent.fit(docs, rounds=3)
    assert seen.value == 3 * 40


def test_slots_of_a_class_add_up(spark):
    docs = spark.createDataFrame([(i, prose(i, 200)) for i in range(30)], "doc_id long, text string")
    model, vocabulary = maxent.fit(docs, rounds=1)
    assert (model.slot_total.sum(axis=1) == model.class_total).all() and (model.slot_different.sum(axis=1) == model.class_different).all()
    assert (model.slot_total >= 0).all() and model.slot_total.sum() == vocabulary.agg({"n": "sum"}).first()[0]
    single = model.slot_different[maxent.OWN + 1 :, : maxent.SINGLE]
    assert single.max() == 1 and (single == (model.slot_total[maxent.OWN + 1 :, : maxent.SINGLE] > 0)).all()


def test_a_step_adds_up_the_gradients_of_each_row():
    """Against one token at a time; pairs of classes share weight rows, as hashes may."""
    r = np.random.default_rng(5)
    n, rows, width = 300, 40, 6
    pairs = r.integers(0, 25, n).astype(np.int32)
    decided = r.integers(0, rows, (25, 2))
    columns = np.stack([r.integers(0, rows, n), decided[pairs, 0], decided[pairs, 1]], axis=1).astype(np.int32)
    weights, bias = r.normal(size=(rows, width)).astype(np.float32), r.normal(size=(1, width)).astype(np.float32)
    weights[7] += 200  # scores beyond what exponentials hold
    y, none = r.integers(0, width, n), np.zeros(n, np.int32)

    s = weights.astype(float)[columns].sum(axis=1) + bias
    p = np.exp(s - s.max(axis=1, keepdims=True))
    g = p / p.sum(axis=1, keepdims=True)
    g[np.arange(n), y] -= 1
    wanted, state = weights.astype(float), np.full(rows, 1e-2)
    for c in columns.T:
        total = np.zeros((rows, width))
        np.add.at(total, c, g / n)
        state += (total**2).sum(axis=1)
        wanted -= maxent.RATE * total / np.sqrt(state)[:, None]

    for nested in (None, (pairs, (1, 2))):
        steps = maxent._Steps(weights, bias, 1)
        steps.step(columns, none, y, nested)
        assert steps.weights == pytest.approx(wanted, abs=1e-4)
        total = g.sum(axis=0) / n
        assert steps.bias[0] == pytest.approx(bias[0] - maxent.RATE * total / np.sqrt(1e-2 + total**2), abs=1e-4)
        assert steps.met.sum() == 3 * n and steps.bias_met.sum() == n


def test_gradients_of_pairs_of_classes_are_added_up_once(spark, monkeypatch):
    """A step walks over its tokens for the words before, and once for the classes before; not for each feature and bias."""
    seen = []
    sums = maxent._Steps._sums

    def counting(self, g, flat, times=None):
        seen.append((g.shape[1], len(flat)))
        return sums(self, g, flat, times)

    monkeypatch.setattr(maxent._Steps, "_sums", counting)
    weights = np.zeros((64, maxent.CLASSES), np.float32)
    r = np.random.default_rng(3)
    pairs = r.integers(0, 9, 500).astype(np.int32)
    rows = np.stack([r.integers(0, 64, 500), pairs % 3, pairs, r.integers(0, 64, 500), r.integers(0, 64, 500)], axis=1).astype(np.int32)
    maxent._Steps(weights, weights[:1], 1).step(rows, np.zeros(500, np.int32), r.integers(0, maxent.CLASSES, 500), (pairs, (1, 2)))
    assert sorted(n for _, n in seen) == [9, 9, 9, 500, 500, 500, 500]
