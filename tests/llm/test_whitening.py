import math

import numpy as np
import pytest

from tablelift.llm import queries, whitening
from tablelift.llm.vectors import packed, unpacked

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, n int, component string, x binary"


def _frame(spark, vectors, ids=None, parts=3):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, 9, "clash", None) for i, v in zip(ids, vectors)], SCHEMA).repartition(parts)


def _wanted(vectors, k):
    """Brute force: eigenvectors of the fit list's covariance by numpy."""
    x = [[math.floor(256 * float(np.float32(c))) for c in v] for v in vectors]
    fit = np.array(sorted(set(map(tuple, x))), dtype=float)
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    centred = fit - np.array(sums) / n
    values, components = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:k]
    return x, n, sums, values[order], components[:, order], values.sum()


def _check(rows, vectors, k=4):
    x, n, sums, values, components, trace = _wanted(vectors, k)
    assert len(rows) == len(vectors) * k
    signs = {}
    for r in rows:
        own, c = x[r.vec_id], r.component - 1
        assert r.n == n and r.deviation == sum((n * a - s) ** 2 for a, s in zip(own, sums))
        assert r.explained == pytest.approx(values[c] / trace, rel=1e-9)
        assert r.identity_error < 1e-9
        value = float((np.array(own) - np.array(sums) / n) @ components[:, c] / math.sqrt(values[c]))
        sign = signs.setdefault(c, 1.0 if r.whitened * value >= 0 else -1.0)
        assert r.whitened * sign == pytest.approx(value, abs=1e-7)


def test_registered_query_equals_numpy(spark):
    rows = queries.op11_whitening(spark, SF).collect()
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    _check(rows, [vectors[i] for i in range(len(vectors))])


def test_copies_bad_entries_and_lengths(spark):
    r = np.random.default_rng(5)
    good = (r.normal(size=(40, 6)) * [3, 2, 1, 0.5, 0.1, 0.02]).tolist()
    vectors = good + [good[0]] * 50
    bad = [None, [], [1.0] * 5, [1.0] * 7, [1.0, None, 1.0, 1.0, 1.0, 1.0], [float("nan")] + [1.0] * 5, [float("inf")] + [1.0] * 5, [-1e30] + [1.0] * 5]
    df = _frame(spark, vectors + bad, parts=5)
    _check(whitening.whitened(df).collect(), vectors)
    again = _frame(spark, vectors, ids=[None] * 3 + [1] * (len(vectors) - 3))
    assert whitening.whitened(again).count() == 4 * len(vectors)


def test_low_rank_single_and_empty(spark):
    line = [[float(i), 2.0 * i, 0.0] for i in range(10)]
    rows = whitening.whitened(_frame(spark, line)).collect()
    assert {r.component for r in rows} == {1} and len(rows) == 10
    assert all(r.explained == pytest.approx(1.0) for r in rows)
    assert whitening.whitened(_frame(spark, [[1.0, 2.0]] * 4)).collect() == []
    assert whitening.whitened(_frame(spark, [[], []])).collect() == []
    none = whitening.whitened(spark.createDataFrame([], SCHEMA))
    assert none.collect() == [] and none.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_huge_entries_stay_exact(spark):
    vectors = [[float(2**50), 1.0], [float(-(2**50)), 3.0], [5.0, -(2.0**40)]]
    rows = whitening.whitened(_frame(spark, vectors)).collect()
    x, n, sums, *_ = _wanted(vectors, 2)
    for r in rows:
        assert int(r.deviation) == sum((n * a - s) ** 2 for a, s in zip(x[r.vec_id], sums)) > 2**63


def test_factor_and_rotation():
    r = np.random.default_rng(1)
    b = r.normal(size=(30, 9)) * 10.0 ** (-0.6 * np.arange(9))
    a = b.T @ b
    low, order = whitening.pivoted_cholesky(a)
    assert np.allclose(low, np.tril(low)) and np.allclose(low @ low.T, a[np.ix_(order, order)], rtol=1e-10, atol=1e-14)
    assert list(np.diagonal(low)) == sorted(np.diagonal(low), reverse=True)
    turned = whitening.jacobi_columns(low)
    norms = (turned * turned).sum(axis=0)
    assert np.allclose(norms, np.sort(np.linalg.svd(b)[1] ** 2)[::-1], rtol=1e-8)
    gram = turned.T @ turned / np.sqrt(np.outer(norms, norms))
    assert np.abs(gram - np.eye(9)).max() < 1e-13
    assert whitening.pivoted_cholesky(np.zeros((3, 3)))[0].shape == (3, 0)
    # Equal columns: rank one.
    assert whitening.pivoted_cholesky(np.ones((4, 4)))[0].shape == (4, 1)


def test_packed_rows_come_back():
    import pyarrow as pa

    x = np.array([[1, -2], [40_000, 0], [-32_768, 32_767], [-(2**60), 5]])
    assert [len(p) for p in packed(x)] == [4, 16, 16, 16]
    assert (unpacked(pa.array(packed(x), pa.binary()), 2) == x).all()
    assert unpacked(pa.array([], pa.binary()), 2).shape == (0, 2)
