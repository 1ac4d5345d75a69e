import contextlib
import io
import random

from tablelift.llm import components as stars


def _least_of(edges):
    of = {n: n for e in edges for n in e if e[0] != e[1]}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a != b and of[a] != of[b]:
                of[a] = of[b] = min(of[a], of[b])
                changed = True
    return of


def _found(spark, edges):
    rows = stars.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len({r.node for r in rows}) == len(rows)
    return {r.node: r.component for r in rows}


def test_components_of_odd_graphs(spark):
    r = random.Random(4)
    chain = [(k, k + 1) if k % 2 else (k + 1, k) for k in range(-20, 20)]
    wheel = [(100, 100 + k) for k in range(1, 30)] + [(131, 100 + k) for k in range(1, 30, 3)]
    loose = [(r.randrange(200, 300), r.randrange(200, 300)) for _ in range(70)]
    edges = chain + wheel + loose + loose[:9] + [(7000, 7000)]
    assert _found(spark, edges) == _least_of(edges)
    assert _found(spark, []) == {} == _found(spark, [(1, 1)])


def test_queries_of_a_round_stay_small(spark, monkeypatch):
    """Whole rounds as one query had some twenty aggregates and six joins; AQE repeats its plan for each stage that ends."""
    seen, write = [], stars.stored

    def counting(df):
        with contextlib.redirect_stdout(io.StringIO()) as plan:
            df.explain()
        seen.append((plan.getvalue().count("HashAggregate"), plan.getvalue().count("Join ")))
        return write(df)

    monkeypatch.setattr(stars, "stored", counting)
    _found(spark, [(k, k + 1) for k in range(12)])
    assert len(seen) > 2 and max(n for n, _ in seen) <= 4 and max(n for _, n in seen) <= 1


def test_stars_need_no_round(spark, monkeypatch):
    seen, write = [], stars.stored
    monkeypatch.setattr(stars, "stored", lambda df: seen.append(1) or write(df))
    assert _found(spark, [(k // 5 * 5, k) for k in range(30)]) == {k: k // 5 * 5 for k in range(30)}
    assert len(seen) == 1
