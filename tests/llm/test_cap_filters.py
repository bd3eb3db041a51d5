"""Near vectors against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from releasekit.llm import cap_filters

SCHEMA = "vec_id long, embedding array<float>, label int, node long, filter string, n long"


def brute(rows, cosine=0.93):
    """``vec_id -> (n_links, component_id)`` of rows with distinct ids."""
    good = {i: (np.array(e, np.float32).astype(float), k) for i, e, k in rows
            if i is not None and k is not None and e and None not in e and np.isfinite(e).all() and np.any(e)}
    near = {i: [j for j, (w, b) in good.items() if j != i and a == b and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= cosine] for i, (v, a) in good.items()}
    out = {}
    for i, *_ in rows:
        seen, todo = {i}, [i]
        while todo:
            new = [j for j in near.get(todo.pop(), []) if j not in seen]
            seen.update(new)
            todo += new
        out[i] = (len(near.get(i, [])), min(seen) if i is not None else None)
    return out


def result(spark, rows):
    df = spark.createDataFrame([(i, [float(x) if x is not None else None for x in e] if e is not None else None, k, 0, "x", 1) for i, e, k in rows], SCHEMA)
    return cap_filters.near_vectors(df).collect()


def test_clusters_chains_and_copies(spark):
    rng = np.random.default_rng(5)
    rows = []
    for c in range(30):  # clusters, some tight, some a chain across the threshold
        v = rng.standard_normal(64)
        for _ in range(int(rng.integers(1, 9))):
            v = v + rng.standard_normal(64) * rng.choice([0.05, 0.3, 0.42])
            rows.append((len(rows), v.tolist(), c % 3))
    v = rng.standard_normal(64)
    rows += [(1000 + k, (v * (1 + k)).tolist(), k % 2) for k in range(6)] + [(2000 + k, v.tolist(), 0) for k in range(5)]
    rows += [(3000 + k, rng.standard_normal(64).tolist(), 0) for k in range(300)]
    want = brute(rows)
    assert sum(n for n, _ in want.values()) > 100
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in result(spark, rows)} == want


def test_one_large_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(cap_filters, "BLOCK", 50)
    rng = np.random.default_rng(6)
    v = rng.standard_normal(64)
    rows = [(k, (v + rng.standard_normal(64) * 0.2).tolist(), 1) for k in range(400)]
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in result(spark, rows)} == brute(rows)


@pytest.mark.parametrize("dims", [1, 2, 5])
def test_few_coordinates(spark, dims):
    rng = np.random.default_rng(dims)
    rows = [(k, rng.standard_normal(dims).tolist(), k % 4) for k in range(60)]
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in result(spark, rows)} == brute(rows)


def test_edge_rows(spark):
    a, b = [1.0, 2.0, 3.0], [1.0, 2.0, 3.01]
    nan, inf = float("nan"), float("inf")
    rows = [(1, a, 1), (2, b, 1), (3, a, 2), (4, a, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1), (8, [1.0, nan, 3.0], 1), (9, [1.0, inf, 3.0], 1), (10, [1.0, None, 3.0], 1),
            (11, [1.0, 2.0], 1), (12, [-1.0, -2.0, -3.0], 1), (13, [1e30, 2e30, 3e30], 1), (None, a, 1)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in result(spark, rows)}
    assert got == {i: (n, c, i is None or i == c) for i, (n, c) in brute(rows).items()} and got[1] == (2, 1, True) and got[13] == (2, 1, False) and got[None] == (0, None, True)
    twice = result(spark, [(1, a, 1), (1, a, 1), (2, b, 1)])
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in twice) == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)]
    assert cap_filters.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    assert cap_filters.near_vectors(spark.createDataFrame([(1, a, 1, 0, "x", 1)], SCHEMA).withColumn("label", F.lit("de"))).collect()[0]["kept"]


@pytest.mark.parametrize("rows,dims", [(100, 64), (5_000, 64), (100_000, 64), (5_000, 3), (5_000, 256)])
def test_recall_at_the_threshold(rows, dims):
    """Pairs at exactly 0.93, the hardest: one in a hundred at most shares no filter."""
    rng, n = np.random.default_rng(rows + dims), 2000
    u, z = rng.standard_normal((2, n, dims))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    z -= (z * u).sum(axis=1, keepdims=True) * u
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    lists = [set(zip(*map(np.ndarray.tolist, cap_filters.decode(x, *cap_filters.plan(rows, dims, 0.93))))) for x in (u, 0.93 * u + np.sqrt(1 - 0.93**2) * z)]
    assert len({row for row, _ in lists[0] & lists[1]}) >= 0.99 * n


def test_listed_directions_are_all_that_exceed():
    rng = np.random.default_rng(9)
    x = rng.standard_normal((20, 40))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for blocks in (2, 3):
        turn, vectors = cap_filters.code(40, blocks, 15, 0)
        row, number = cap_filters.listed(x, 0.3, turn, vectors)
        whole = np.array([np.concatenate([vectors[b][i] for b, i in enumerate(np.unravel_index(k, (15,) * blocks))]) for k in range(15**blocks)])
        assert sorted(zip(row.tolist(), number.tolist())) == sorted(zip(*map(np.ndarray.tolist, np.nonzero((x.astype(np.float32) @ turn) @ whole.T >= 0.3))))
