import random
import re

import numpy as np
import pyarrow as pa
import pytest

from checks.compare import connect, differences
from tablelift.llm import components, jaccard, queries
from tests.llm.conftest import fold, odd_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _sets(rows):
    out = {}
    for i, t, *_ in rows:
        w = WORD.findall(fold(t))
        out[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    return out


def _brute(rows):
    sets = _sets(rows)
    label = {i: i for i in sets}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    ids = [i for i in sets if i is not None]
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((root(a), root(b)))
                    label[y] = x
    return sorted(((i, len(sets[i]), None if i is None else root(i)) for i, *_ in rows), key=repr)


def _got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=repr)


def _families(seed):
    """Near copies with edits around the bound, chains, a passage in many texts, and a hot group of copies."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(60)]
    rows = []
    for family in range(12):
        text = [word() for _ in range(r.randint(20, 160))]
        for _ in range(r.randint(2, 12)):
            copy = list(text)
            for _ in range(r.randint(0, max(1, len(copy) // 25))):
                copy[r.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
            if family % 3 == 0:
                text = copy  # a chain: the ends need not link
    rows += [" ".join([word() for _ in range(r.randint(5, 90))] + passage) for _ in range(60)]
    rows += [" ".join(passage)] * 40
    r.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)]


def test_odd_rows(odd, none):
    assert _got(jaccard.similar_groups(odd)) == _brute(odd_rows())
    assert jaccard.similar_groups(none).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_no_link_is_lost(spark, monkeypatch, seed):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    rows = _families(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert _got(jaccard.similar_groups(docs)) == _brute(rows)


def test_links_across_groups_are_found(spark, monkeypatch):
    """Without groups from minima, the token-group matrix alone finds every link."""
    monkeypatch.setattr(jaccard, "_stars", lambda docs, classes: docs.sparkSession.createDataFrame([], "a long, b long"))
    rows = _families(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert _got(jaccard.similar_groups(docs)) == _brute(rows)


def test_registered_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    assert differences(queries.op5_ngram_jaccard(spark, sf), connect(sf), queries.TWINS["op5_ngram_jaccard"]) == []


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_classes_meet_members_of_larger_groups_only(size):
    """Against all pairs of rows of one token, however the rows are cut into batches."""
    r = np.random.default_rng(6)
    sets = [np.unique(r.integers(0, 400, r.integers(60, 90)).astype(np.uint64)) for _ in range(8)]
    sets += [np.unique(np.append(s[3:], r.integers(0, 400, 3).astype(np.uint64))) for s in sets for _ in range(3)]
    rows, wanted = [], set()
    for token in range(1, 7):
        own = sorted((k % 6, k) for k in range(len(sets)) if r.random() < 0.6)
        own = [(token, g, k, int(r.integers(0, 4)), int(r.integers(0, 3))) for g, k in own]
        for a, (_, g, k, place, before) in enumerate(own):
            for _, g2, k2, place2, before2 in own[:a]:
                n, m = len(sets[k]), len(sets[k2])
                fits = 100 * min(n, m) >= 75 * max(n, m) and min(n - place, m - place2) >= jaccard._overlap(n, m) and not (before and before == before2)
                if g2 != g and fits and jaccard.may_link(n, jaccard._sketch(sets[k]), m, jaccard._sketch(sets[k2])):
                    wanted.add((k, g, g2, f"{g2}/{k2 % 2}"))
        rows += own
    batch = pa.RecordBatch.from_pylist([
        dict(token=t, group_size=1, group=g, cls=k, n=len(sets[k]), place=p, before=b, salt=k % 2, short=jaccard._sketch(sets[k])) for t, g, k, p, b in rows
    ])
    got = [x for b in jaccard._queries(batch.slice(k, size) for k in range(0, len(rows), size)) for x in b.to_pylist()]
    assert wanted and {(x["q"], x["own"], x["group"], x["block"]) for x in got} == wanted


def test_rows_stay_linear_in_a_large_group(spark, monkeypatch):
    """Near copies of one text, some of them not like the least of them: candidates grow with their number, not its square."""
    r = random.Random(11)
    text = [f"w{i}" for i in range(90)]

    def copies(count):
        rows = []
        for i in range(count):
            own = list(text)
            for _ in range(r.choice([0, 1, 1, 2])):
                own[r.randrange(90)] = f"x{r.randrange(10**6)}"
            rows.append((i, " ".join(own)))
        return rows

    made = {}
    for count in (1000, 3000):
        counted = spark.sparkContext.accumulator(0)
        plain = jaccard._verify

        def verify(docs, pairs):
            counted.add(pairs.count())
            return plain(docs, pairs)

        monkeypatch.setattr(jaccard, "_verify", verify)
        docs = spark.createDataFrame(copies(count), "doc_id long, text string").repartition(4)
        rows = jaccard.similar_groups(docs).collect()
        monkeypatch.setattr(jaccard, "_verify", plain)
        assert len(rows) == count and len({x.component_id for x in rows}) == 1
        made[count] = counted.value
    assert made[3000] < 4.5 * made[1000] and made[3000] < 12 * 3000


def test_bound_never_refuses_a_link():
    r = np.random.default_rng(4)
    for _ in range(300):
        n = int(r.integers(1, 400))
        a = np.unique(r.integers(0, 1 << 62, n).astype(np.uint64))
        keep = a[r.random(len(a)) > r.random() * 0.3]
        b = np.unique(np.concatenate([keep, r.integers(0, 1 << 62, int(r.integers(0, len(a) // 4 + 2))).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        link = len(b) > 0 and 100 * both >= 75 * (len(a) + len(b) - both)
        assert jaccard.linked(a, b) == link if len(b) else True
        if not len(a) or not len(b):
            continue
        may = jaccard.may_link(len(a), jaccard._sketch(a), len(b), jaccard._sketch(b))
        assert may or not link
        rows = pa.RecordBatch.from_pylist([dict(block="b", role=k, cls=k, n=len(t), sketch=jaccard._sketch(t)) for k, t in enumerate((a, b))])
        assert [r for x in jaccard._near_blocks([rows]) for r in x.to_pylist()] == ([{"q": 1, "x": 0, "block": "b"}] if may else [])


def test_frequent_tokens_are_counted_over_all(spark):
    rows = [(i, f"u{i} v{i} w{i} one two three four five six") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    tokens, _, bits = jaccard.frequent_tokens(docs, 200)
    assert len(tokens) == 2 and bits >= 32  # "one .. five" and "two .. six"
    assert len(jaccard.frequent_tokens(docs, 200, most=1)[0]) == 0


def test_components(spark):
    r = random.Random(7)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5)]
    label = {}

    def root(x):
        label.setdefault(x, x)
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        label[y] = x
    wanted = {(x, root(x)) for e in edges for x in e if any(x in f and f[0] != f[1] for f in edges)}
    got = {(x.node, x.component) for x in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == wanted
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []
