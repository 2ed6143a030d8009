import math

import numpy as np
import pytest

from riskloom.llm import neighbours

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, size string, region string, vec int"


@pytest.fixture
def vectors(make):
    return lambda rows: make([(i, v, 1, "x", "y", "z", 0) for i, v in rows], SCHEMA)


def brute(rows, asked, k=10):
    """Every query against every row, component by component."""
    usable = lambda v: v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    rows = [(i, tuple(map(np.float32, v))) for i, v in rows if i is not None and usable(v)]
    out = {}
    for query, vec in dict.fromkeys((i, v) for i, v in rows if asked(i)):
        near = out.setdefault(query, [])
        for other, at in rows:
            if other != query and len(at) == len(vec):
                total = 0.0
                for x, y in zip(vec, at):
                    total += (float(x) - float(y)) * (float(x) - float(y))
                near.append((math.sqrt(total), other))
    return {(q, n, i): s for q, near in out.items() for n, (s, i) in enumerate(sorted(near)[:k], 1)}


def found(vectors, rows, k=10, factor=1.0):
    df = vectors(rows)
    got = neighbours.nearest(df, df.where("vec_id % 10 = 0"), k, factor).collect()
    answer = {(r["query_id"], r["rank"], r["vec_id"]): r["score"] for r in got}
    assert len(answer) == len(got)
    return answer


@pytest.fixture
def small_shards(monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD_BYTES", 40 * 8 * 6)
    monkeypatch.setattr(neighbours, "SHARD_QUERIES", 7)
    monkeypatch.setattr(neighbours, "LEAF", 5)


def clustered(n, seed=1, size=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, size)) * 5
    return [(i, (centres[rng.integers(9)] + rng.normal(size=size)).astype(np.float32).tolist()) for i in range(n)]


def test_factor_one_equals_brute_force(vectors, small_shards):
    rows = clustered(600)
    assert found(vectors, rows) == brute(rows, lambda i: i % 10 == 0)


def test_a_third_of_equal_vectors(vectors, small_shards):
    rows = clustered(400)
    rows = [(i, rows[0][1] if i % 3 == 0 else v) for i, v in rows]
    assert found(vectors, rows, 4) == brute(rows, lambda i: i % 10 == 0, 4)


def test_relaxed_pruning_keeps_its_promise(vectors, small_shards):
    rows = clustered(600, 2)
    exact = brute(rows, lambda i: i % 10 == 0)
    exact = {(q, n): s for (q, n, _), s in exact.items()}
    got = {(q, n): s for (q, n, _), s in found(vectors, rows, factor=1.5).items()}
    assert got.keys() == exact.keys() and all(exact[k] <= got[k] <= 1.5 * exact[k] + 1e-9 for k in exact)


def test_relaxed_pruning_looks_at_less():
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.normal(c, 1, (400, 4)) for c in (0, 4, 8)])
    tree = neighbours.VantageTree(points, np.arange(len(points)), 8)
    seen = {}
    for factor in (1.0, 3.0):
        looked = 0


        real = neighbours.distances

        def counting(left, right):
            nonlocal looked
            looked += len(left) * len(right)
            return real(left, right)

        neighbours.distances = counting
        try:
            tree.search(points[::40], np.arange(0, len(points), 40), 10, np.full(30, np.inf), factor)
        finally:
            neighbours.distances = real
        seen[factor] = looked
    assert seen[3.0] < seen[1.0] < 30 * len(points)


def test_odd_rows(vectors, make):
    nan, inf = float("nan"), float("inf")
    rows = [(10, None), (20, []), (30, [0.0, 0.0]), (40, [1.0, None]), (50, [nan, 1.0]), (60, [inf, 1.0]), (None, [1.0, 1.0])]
    assert found(vectors, rows) == {} and found(vectors, []) == {}
    rows += [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 1.0]), (3, [3.0, 1.0, 2.0]), (70, [3.0, 1.0, 1.0]), (80, [5.0])]
    rows += [(0, [1.0, 0.0]), (2, [0.0, 1.0]), (90, [2.0, 2.0]), (90, [2.0, 3.0])]
    got = neighbours.nearest(vectors(rows), vectors(rows).where("vec_id % 10 = 0"), 3).collect()
    want = brute(rows, lambda i: i % 10 == 0, 3)
    assert {(r["query_id"], r["rank"], r["vec_id"]): r["score"] for r in got} == want
    with pytest.raises(ValueError):
        neighbours.nearest(vectors(rows), vectors(rows), factor=0.5)
