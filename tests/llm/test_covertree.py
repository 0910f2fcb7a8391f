"""Hard negatives against brute force."""

import tracemalloc
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kensa.llm import common, covertree

SCHEMA = "vec_id long, embedding array<double>, label int, row long, v string, anchor int"


def brute(rows, is_anchor, positives=5, negatives=10, low=30, high=90, scale=256):
    """All pairs; ``rows``: (id, vector, label)."""
    rows = [(i, np.floor(scale * np.array(v, float)), c) for i, v, c in rows
            if i is not None and v is not None and c is not None and len(v) and None not in v and np.isfinite(np.array(v, float)).all()]
    width = max({len(v) for _, v, _ in rows}, key=lambda n: (sum(len(v) == n for _, v, _ in rows), n)) if rows else 0
    rows, out = [r for r in rows if len(r[1]) == width], []
    for n, (i, q, c) in enumerate(rows):
        if not is_anchor(i):
            continue
        scored = [(-int(q @ v), j, d) for m, (j, v, d) in enumerate(rows) if m != n]
        for s, p, _ in sorted(r for r in scored if r[2] == c)[:positives]:
            fit = sorted(r for r in scored if r[2] != c and low * -s <= 100 * -r[0] <= high * -s)
            out += [(i, p, k + 1, j, -s, -t) for k, (t, j, _) in enumerate(fit[:negatives])]
    return sorted(out)


def mined(df, **more):
    return sorted(tuple(r) for r in covertree.mine(df, F.col("vec_id") % 100 == 0, **more).collect())


def vectors(n, dim, groups, seed):
    """Groups of near copies, plain noise, exact copies and a hot vector."""
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(groups, dim))
    x = centre[rng.integers(0, groups, n)] + 0.1 * rng.normal(size=(n, dim))
    x[: n // 5] = rng.normal(size=(n // 5, dim))
    x[n // 5: n // 3] = x[n // 5]
    return (x / np.linalg.norm(x, axis=1, keepdims=True))[rng.permutation(n)]


@pytest.mark.parametrize("seed,dim,groups", [(1, 8, 12), (2, 3, 40), (3, 24, 2)])
def test_equal_to_brute_force(spark, monkeypatch, seed, dim, groups):
    monkeypatch.setattr(covertree, "BLOCK", (100, 200))     # many nodes and blocks
    monkeypatch.setattr(covertree, "SLICE", 5)
    monkeypatch.setattr(covertree, "SAMPLE", 150)
    x, rng = vectors(1500, dim, groups, seed), np.random.default_rng(seed)
    rows = [(i, v.tolist(), int(rng.integers(0, 4))) for i, v in enumerate(x)]
    df = spark.createDataFrame([(*r, 1, "c", 2) for r in rows], SCHEMA).repartition(5)
    assert mined(df) == brute(rows, lambda i: i % 100 == 0)
    assert mined(df, positives=1, negatives=3, low=95, high=100) == brute(rows, lambda i: i % 100 == 0, 1, 3, 95, 100)


def test_bounds_hold_and_leave_nodes_out():
    x = np.floor(256 * vectors(3000, 6, 30, 5)) * np.random.default_rng(0).integers(1, 4, (3000, 1))
    largest = float(np.sqrt((x ** 2).sum(1).max()))
    tree = covertree.CoverTree(x, largest)
    leaves = [r for r in tree.leaf if r is not None]
    assert sorted(np.concatenate(leaves).tolist()) == list(range(3000)) and len(leaves) > 20
    q = x[::100]
    low, high = covertree.bounds(q, tree.unit[tree.centre], np.array(tree.radius), largest)

    def below(node):
        return tree.leaf[node] if tree.leaf[node] is not None else np.concatenate([below(c) for c in tree.children[node]])

    for node in range(len(tree.centre)):
        s = q @ x[below(node)].T
        assert (s >= low[:, [node]]).all() and (s <= high[:, [node]]).all()
    opened, best = defaultdict(int), covertree.Best(np.broadcast_to([-np.inf, np.inf], (len(q), 1, 2)).copy(), 5)

    def score(anchors, rows, products):
        for a in anchors:
            opened[int(a)] += len(rows)
        best.take(anchors, products, np.ones(products.shape, bool), rows, rows)

    tree.search(q, best.wanted, score)
    assert sum(opened.values()) < 0.7 * len(q) * len(x)
    for i in range(len(q)):
        s = q[i] @ x.T
        assert list(zip(-best.score[i, 0], best.id[i, 0])) == sorted(zip(-s, range(len(x))))[:5]


def test_windows_end_the_descent():
    x = np.floor(256 * vectors(2000, 4, 20, 7))
    tree = covertree.CoverTree(x, float(np.sqrt((x ** 2).sum(1).max())))
    q = x[:40]
    s, seen = q @ x.T, np.zeros(40, int)
    window = np.stack([0.3 * s.max(1), 0.5 * s.max(1)], 1)[:, None]
    best = covertree.Best(window.copy(), 3)

    def score(anchors, rows, products):
        seen[anchors] += len(rows)
        best.take(anchors, products, np.ones(products.shape, bool), rows, rows)

    tree.search(q, best.wanted, score)
    assert seen.sum() < 0.8 * s.size
    for i in range(40):
        fit = [(-a, j) for j, a in enumerate(s[i]) if window[i, 0, 0] <= a <= window[i, 0, 1]]
        assert [(-a, j) for a, j in zip(best.score[i, 0], best.id[i, 0]) if a > -np.inf] == sorted(fit)[:3]


def test_edges(spark):
    common.prepare(spark)
    one = [1.0, 0.5]
    rows = [(0, one, 1), (1, one, 1), (2, [0.9, 0.4], 2), (3, [0.2, 0.1], 2), (4, None, 1), (5, [1.0, None], 1), (6, [float("nan"), 1.0], 1), (7, [float("inf"), 1.0], 2),
            (8, one, None), (None, one, 1), (9, [1.0], 1), (10, [], 2), (11, [0.0, 0.0], 2), (100, [0.0, 0.0], 2), (2, [0.9, 0.4], 2), (0, one, 1), (200, [-1.0, -1.0], 3), (300, [0.6, 0.3], 1), (12, [0.5, 0.4], 3)]
    df = spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA).coalesce(3)
    want = brute(rows, lambda i: i % 100 == 0)
    assert want and mined(df) == want
    assert mined(df.limit(0)) == [] and mined(df.where("vec_id % 100 != 0")) == [] and mined(df.where("embedding is null")) == []
    huge = spark.createDataFrame([(0, [1e9], 1, 0, "", 0)], SCHEMA)
    with pytest.raises(ValueError):
        mined(huge)


def test_top_centres_hold_only_centres():
    """Memory of the driver follows the sample, not the sample times the number of centres."""
    unit = np.random.default_rng(1).standard_normal((2048, 65))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    tracemalloc.start()
    try:
        centres = covertree.top_centres(unit, 512)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(centres) == 512
    assert peak < 6 * unit.nbytes
