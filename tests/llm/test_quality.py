import re
from collections import Counter

import numpy as np

from tablelift.llm import quality
from tests.llm.conftest import odd_rows, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _brute(text):
    text = text or ""
    w = WORD.findall(text)
    found = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if found[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def _got(df):
    return sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in df.collect()), key=repr)


def test_counts(odd, none):
    assert _got(quality.statistics(odd)) == sorted(((i, *_brute(t)) for i, t, *_ in odd_rows()), key=repr)
    assert quality.statistics(none).collect() == []


def test_counts_of_repeats(spark):
    rows = [(i, prose(i, 60) + " " + prose(i % 3, 20) * (i % 4) + "\nsame line\n\nsame line\n same line" * (i % 2)) for i in range(30)]
    assert _got(quality.statistics(spark.createDataFrame(rows, "doc_id long, text string"))) == sorted(((i, *_brute(t)) for i, t in rows), key=repr)


def _corpus(spark):
    rows, labels = [], []
    for i in range(300):
        bad = i % 5 == 0
        text = " ".join(w + ("###" if bad else "") for w in prose(i, 80).split())
        rows.append((i, text, "x", 1))
        labels.append((i, None if i % 7 == 0 else 0 if bad else 1, None))
    labels += [(None, 0, None), (10**9, 0, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, n_words int"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_learned_rules_reject_what_is_labelled_poor(spark):
    docs, labels = _corpus(spark)
    rows = quality.judged(docs, labels).collect()
    assert {r.doc_id for r in rows if not r.kept and not r.base_failed} == {i for i in range(300) if i % 5 == 0} - {r.doc_id for r in rows if r.base_failed}
    kept = quality.kept_rows(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in rows)


def test_without_labels_the_base_rule_decides(odd, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality.judged(odd, labels).collect()
    assert len(rows) == len(odd_rows()) and all(r.kept == (not r.base_failed) for r in rows)
    assert quality.judged(odd.limit(0), labels).collect() == []


def test_rules_are_pruned_and_precise():
    r = np.random.default_rng(2)
    x = r.random((2000, 3))
    y = (x[:, 0] > 0.8) & (x[:, 1] <= 0.5) | (r.random(2000) < 0.01)
    rules = quality.learn(x, y, ["a", "b", "c"])
    got = np.zeros(2000, bool)
    for rule in rules:
        got |= quality._covered(rule, x, ["a", "b", "c"])
    truth = (x[:, 0] > 0.8) & (x[:, 1] <= 0.5)
    assert (got & truth).sum() > 0.95 * truth.sum() and (got & ~truth).sum() < 25
