import hashlib
from collections import Counter

import numpy as np
import pytest

from checks.compare import connect, differences
from tablelift.llm import clusters, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, cluster int, distance string, ids binary"


def _frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 9, "clash", None) for i, v in rows], SCHEMA).repartition(parts)


def _wanted(rows, k, rounds, dim):
    """Brute force: every vector against every centroid in every round."""
    x = {i: [int(np.floor(256 * float(np.float32(c)))) for c in v] for i, v in rows}
    order = sorted(x, key=lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest())
    centroids = [x[i] for i in order[:k]]

    def assign():
        return {i: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids)) for i, v in x.items()}

    for _ in range(rounds):
        own = assign()
        for n in range(len(centroids)):
            members = [x[i] for i, (_, m) in own.items() if m == n]
            if members:
                centroids[n] = [sum(col) // len(members) for col in zip(*members)]
    own = assign()
    per = Counter()
    for d, n in own.values():
        per[n] += d
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((i, n, d, per[n], sum(per.values()), name[n]) for i, (d, n) in own.items())


def test_registered_query_equals_sql(spark):
    assert differences(queries.op12_heap_clusters(spark, SF), connect(SF), queries.TWINS["op12_heap_clusters"]) == []


@pytest.mark.parametrize("seed", range(4))
def test_many_rounds_equal_brute_force(spark, seed):
    r = np.random.default_rng(seed)
    # Small whole numbers: many ties between centroids.
    values = r.integers(-3, 4, size=(150, 3)) / 256 if seed % 2 else r.normal(size=(150, 3))
    rows = [(i, v) for i, v in enumerate(values.tolist())]
    got = clusters.clustered(_frame(spark, rows), k=7, rounds=8, dim=3, block=40)
    assert sorted(map(tuple, got.collect())) == _wanted(rows, 7, 8, 3)


def test_only_expired_gaps_are_rescanned(spark):
    r = np.random.default_rng(3)
    centres = r.normal(size=(6, 8)) * 20
    rows = [(i, (centres[i % 6] + r.normal(size=8)).tolist()) for i in range(600)]
    model = clusters.fit(_frame(spark, rows), k=6, rounds=5, dim=8, block=100)
    assert model.rescanned[0] == 600 and 0 < model.rescanned[1] < 600 and model.rescanned[-2:] == (0, 0)


def test_copies_bad_vectors_few_and_none(spark):
    copies = [(i, [1.0, 2.0]) for i in range(60)] + [(60, [5.0, 5.0])]
    bad = [(70, None), (71, []), (72, [1.0]), (73, [1.0, None]), (74, [float("nan"), 1.0]), (75, [float("inf"), 1.0]), (76, [1e20, 1.0]), (77, [1.0, 2.0, 3.0])]
    got = clusters.clustered(_frame(spark, copies + bad), k=3, rounds=2, dim=2, block=16)
    assert sorted(map(tuple, got.collect())) == _wanted(copies, 3, 2, 2)
    few = clusters.clustered(_frame(spark, copies[:1] + copies[-1:]), k=9, dim=2)
    assert sorted(map(tuple, few.collect())) == _wanted(copies[:1] + copies[-1:], 9, 5, 2)
    again = clusters.clustered(_frame(spark, [(None, [1.0, 2.0])] * 2 + [(1, [3.0, 3.0])] * 2), k=2, dim=2).collect()
    assert sorted((str(r.vec_id), r.inertia) for r in again) == [("1", again[0].inertia)] * 2 + [("None", again[0].inertia)] * 2
    none = clusters.clustered(_frame(spark, bad[:2]), k=3, dim=2)
    assert none.collect() == [] and none.columns == got.columns


def test_large_components_are_exact():
    x = np.array([[2**27 - 1, -(2**27) + 1], [0, 3]])
    assert clusters.distances(x, x[:1]).tolist() == [[0], [(2**27 - 1) ** 2 + (2**27 + 2) ** 2]]
