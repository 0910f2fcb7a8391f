"""Nearest neighbours: ties, repeated ids, few candidates, calibration on queries of its own."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kensa.llm import ann, common

SCHEMA = "vec_id long, embedding array<double>, id long, v string, leaf int, slice string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if x is None else [None if c is None else float(c) for c in x], 1, "c", 2, "s") for i, x in rows], SCHEMA).repartition(4)


def found(df, queries, k=20):
    out = {}
    for r in ann.search(df, queries, "vec_id", "embedding", k).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def test_equal_vectors_go_by_id(spark, monkeypatch):
    common.prepare(spark)
    monkeypatch.setattr(ann, "BLOCK", 50)
    monkeypatch.setattr(ann, "SLICE", 7)
    rng = np.random.default_rng(1)
    hot, x = rng.normal(size=16), 0.1 * rng.normal(size=(300, 16))
    rows = [(i, hot) for i in range(1000, 1400)] + [(i, v) for i, v in enumerate(x)]
    got = found(frame(spark, rows), frame(spark, [(1000, hot), (5, hot), (1399, hot)]))
    own = float((hot * hot).sum())
    assert [g[1] for g in got[1000]] == list(range(1001, 1021)) and [g[1] for g in got[5]] == list(range(1000, 1020)) == [g[1] for g in got[1399]]
    assert {g[2] for q in got.values() for g in q} == {own}


def test_few_candidates_repeated_ids_and_no_queries(spark):
    common.prepare(spark)
    rows = [(1, [1, 0]), (2, [0, 1]), (2, [2, 2]), (3, None), (4, [0, 0]), (5, [1, None]), (6, [float("inf"), 1]), (7, [1, 2, 3]), (None, [1, 1])]
    df = frame(spark, rows)
    assert found(df, df, k=5) == {1: [(1, 2, 2.0), (2, 2, 0.0)], 2: [(1, 1, 2.0), (2, 1, 0.0)]}     # both rows of id 2 ask
    for none in (df.where("vec_id > 100"), df.where("vec_id = 4")):
        assert ann.search(df, none, "vec_id", "embedding").count() == 0
        assert ann.search(none, df, "vec_id", "embedding").count() == 0


def test_exact_within_opened_leaves_and_recall_on_other_queries(spark, monkeypatch):
    common.prepare(spark)
    monkeypatch.setattr(ann, "SAMPLE", (800, 800))
    monkeypatch.setattr(ann, "CALIBRATION", 60)
    monkeypatch.setattr(ann, "BLOCK", 300)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 12))[rng.integers(0, 60, 4000)] + 0.4 * rng.normal(size=(4000, 12))
    df = frame(spark, list(enumerate(x)))
    opened = []
    monkeypatch.setattr(ann, "enough", lambda d, o, f=ann.enough: opened.append(f(d, o)) or opened[-1])
    got, hit = found(df, df.where("vec_id % 7 = 0")), 0
    for q in range(0, 4000, 7):
        s = x @ x[q]
        s[q] = -np.inf
        hit += len(set(np.lexsort((np.arange(4000), -s))[:20]) & {g[1] for g in got[q]})
        assert [g[0] for g in got[q]] == list(range(1, 21)) and all(g[2] == pytest.approx(s[g[1]], abs=1e-9) for g in got[q])
    tree = ann.grow(x[:800])
    assert hit / (20 * len(got)) >= 0.9 and opened[0] < tree.n_leaves


def test_enough_widens_for_the_other_half():
    owner, depth = np.repeat(np.arange(10), 20), np.ones(200, int)
    depth[owner % 2 == 1] = 9
    assert ann.enough(depth, owner) >= 9 and ann.enough(np.ones(20, int), np.zeros(20, int)) == 1 and ann.enough(np.zeros(0), np.zeros(0)) == 1
