"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from kensa.llm import common, periods, queries

SF = "/root/testdata/sf0.001"


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def brute(w, shortest=24, times=3):
    """All stretches of every period, the smallest period of each."""
    out = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(shortest, times * q):
                out.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted(((a, n, q) for (a, n), q in out.items()), key=lambda r: (r[0], r[2]))


def stay(w, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


@pytest.mark.parametrize("shortest", [3, 6, 24])
def test_runs_equal_brute_force(shortest):
    rng = random.Random(shortest)
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(0, 4)):
            n, letters = rng.randint(0, 120), rng.randint(1, 4)
            w = [rng.randint(0, letters) for _ in range(n)]
            if n and rng.random() < 0.6:
                a = rng.randrange(n)
                w = [w[i if i < a else a + (i - a) % (1 + (n - a) // 4)] for i in range(n)]
            if rng.random() < 0.2:                       # Fibonacci words: repeats at every scale
                x, y = [0], [0, 1]
                while len(y) < n:
                    x, y = y, y + x
                w = y[:n]
            texts.append(w)
        first = np.concatenate([[0], np.cumsum([len(w) for w in texts])]).astype(np.int64)
        got = list(zip(*(x.tolist() for x in periods.find_runs(np.array(sum(texts, []), np.uint64), first, shortest))))
        assert got == [(a + int(first[i]), n, q) for i, w in enumerate(texts) for a, n, q in brute(w, shortest)]


def test_query_against_brute_force(spark):
    docs = {r["doc_id"]: words(r["text"]) for r in common.documents(spark, SF).collect()}
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op11_periodic_runs(spark, SF).collect()}
    assert set(got) == set(docs) and sum(r[0] > 0 for r in got.values()) > 5
    for i, w in docs.items():
        h, n = zlib.crc32(str(i).encode()), len(w)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            w = [w[k if k < a else a + (k - a) % (1 + (n - a) // (3 + g % 8))] for k in range(n)]
        runs = brute(w)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
        digest = hashlib.sha256("".join(f"{a},{k},{q}\n" for a, k, q in runs).encode()).hexdigest()
        assert got[i] == (len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest, hashlib.sha256(stay(w, runs).encode()).hexdigest())


def test_edges(spark):
    common.prepare(spark)
    verse = " ".join(f"w{i}" for i in range(40)) + "\n"
    texts = [None, "", " \t\n", "word", "a " * 24, "a " * 23, verse * 2, verse * 3, "x " + verse * 4 + "y", "ä b " * 30, "a b " * 12 + "c " * 30,
             " ".join(f"u{i % 5003}" for i in range(60_000)), "z" * 3_000_000 + " q" * 40]
    rows = [(i, t, "k", 1, "n") for i, t in enumerate(texts)] + [(4, texts[4], "again", 2, "n"), (None, "b " * 30, None, None, None)]
    schema = "doc_id long, text string, words string, runs long, collapsed string"
    df = spark.createDataFrame(rows, schema).coalesce(2)
    got = periods.periodic_runs(df, keep=("words",)).collect()
    assert len(got) == len(rows)
    for r in got:
        t = next(t for i, t, k, *_ in rows if (i, k) == (r["doc_id"], r[1]))
        w = words(t)
        runs = [tuple(x) for x in r["runs"]]
        want = brute(w) if len(w) < 1000 else [(0, 60_000, 5003)] if r["doc_id"] == 11 else None
        assert r["n_words"] == len(w) and runs == want and r["collapsed"] == stay(w, want)
    assert periods.periodic_runs(spark.createDataFrame([], schema)).count() == 0
    swapped = periods.periodic_runs(df.where("doc_id = 3"), reorder=lambda k, n: np.zeros(30, np.int64)[:n]).first()
    assert swapped["collapsed"] == "word"
    with pytest.raises(ValueError):
        periods.find_runs(np.zeros(9, np.uint64), np.array([0, 9]), times=2)
    assert df.select(F.count("*")).first()[0] == len(rows)
