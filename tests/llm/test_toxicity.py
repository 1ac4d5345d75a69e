import random

import pytest

from tablelift.llm import toxicity
from tests.llm.conftest import odd_rows


def _corpus(spark):
    r = random.Random(3)
    words = {"en": "the of and to is river stone lamp cloud tree".split(), "de": "der die und ist mit fluss stein lampe baum haus".split()}
    rude = {"en": ["fool", "vermin"], "de": ["trottel", "gesindel"]}
    rows, labels = [], []
    for i in range(1200):
        lang, bad = ("en", "de")[i % 2], i % 6 in (0, 1)
        text = [r.choice(words[lang]) + r.choice(["", "", ",", "."]) for _ in range(r.randint(5, 60))]
        if bad:
            for _ in range(2):
                text.insert(r.randrange(len(text)), r.choice(rude[lang]).upper() + r.choice(["", "!"]))
        rows.append((i, " ".join(text), "zz", 0.5))
        labels.append((i, 1, int(bad)))
    labels += [(None, 1, 1), (5, 1, None), (10**9, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double").repartition(3), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_texts_are_told_apart(spark):
    docs, labels = _corpus(spark)
    rows = toxicity.scored(docs, labels).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1200 and 150 < len(held) < 350
    assert sum(r.predicted == (r.doc_id % 6 in (0, 1)) for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    clean = toxicity.clean_rows(docs, labels)
    assert clean.columns == docs.columns and clean.count() == sum(r.predicted == 0 for r in rows)


def test_odd_rows_and_no_labels(odd, none, spark):
    labels = spark.createDataFrame([(4, 1), (5, 0), (9, 0), (12, 1), (7, 0)], "doc_id long, toxic int")
    rows = toxicity.scored(odd, labels).collect()
    assert sorted((r.doc_id for r in rows), key=repr) == sorted((i for i, *_ in odd_rows()), key=repr)
    assert all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0 for r in toxicity.scored(odd, labels.limit(0)).collect())
    assert toxicity.scored(none, labels).collect() == []


def test_thresholds_bend_to_a_half():
    import numpy as np

    p = np.linspace(0, 1, 11)
    bent = toxicity.bend(p, np.full(11, 0.3))
    assert bent[0] == 0 and bent[-1] == 1 and bent[3] == pytest.approx(0.5) and (np.diff(bent) > 0).all()
    assert toxicity._threshold(np.array([0.1, 0.2, 0.8, 0.9]), np.array([0, 0, 1, 1])) == pytest.approx(0.5)


def test_thresholds_follow_the_fold_where_the_sample_is_capped(spark):
    """Texts that say 'maybe' are toxic once in six times, but more often in a sample with as many toxic as clean texts."""
    r = random.Random(4)
    words = "the of and to is river stone lamp cloud tree".split()
    rows, labels = [], []
    for i in range(3600):
        bad, unsure = i % 15 == 0, i % 15 in (0, 1, 2, 3, 4, 5)
        bad |= i % 15 == 14
        text = [r.choice(words) for _ in range(20)]
        for _ in range(3):
            text.insert(r.randrange(len(text)), "maybe" if unsure else "vermin" if bad else "garden")
        rows.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, "doc_id long, toxic int")
    held = [x for x in toxicity.scored(docs, labels, toxic=300, clean=300).collect() if x.held_out]
    called = {k: [x.predicted for x in held if (x.doc_id % 15 < 6, x.doc_id % 15 == 14) == k] for k in ((True, False), (False, True))}
    unsure, sure = called.values()
    assert sum(unsure) < 0.1 * len(unsure) and sum(sure) > 0.9 * len(sure), (sum(unsure) / len(unsure), sum(sure) / len(sure))


def test_all_labelled_texts_are_learned_from(spark):
    """Each kind of rude word is too rare for a sample of a few texts to hold it."""
    r = random.Random(5)
    words = "the of and to is river stone lamp cloud tree".split()
    rows, labels = [], []
    for i in range(2400):
        bad = i % 4 == 0
        text = [r.choice(words) for _ in range(15)]
        text[r.randrange(15)] = f"{'zvqw'[i // 4 % 4] * 3}rude{i // 16 % 5}x" if bad else "garden"
        rows.append((i, " ".join(text)))
        labels.append((i, int(bad)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, "doc_id long, toxic int")
    held = [x for x in toxicity.scored(docs, labels, toxic=4, clean=4).collect() if x.held_out]
    assert sum(x.predicted == (x.doc_id % 4 == 0) for x in held) > 0.97 * len(held)
