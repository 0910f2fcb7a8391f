"""Packing: ids against the tokenizers library, plans against their own rules and exhaustive search."""

import random
import zlib
from collections import defaultdict
from functools import lru_cache
from pathlib import Path

import numpy as np
import pytest

from kensa.llm import common, packing, queries

SF = "/root/testdata/sf0.001"
FILE = Path(queries.BYTE_BPE).read_bytes()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(FILE.decode())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def lengths_of(strips, capacity):
    """Lengths in each sequence, after checking that strips are gapless and hold each rank once."""
    held, ranks = defaultdict(list), defaultdict(list)
    for length, rank, pieces, each, sequence, offset in strips.tolist():
        for k in range(pieces):
            held[sequence + k // each].append((offset + k % each * length, length))
            ranks[length].append(rank + k)
    for row in held.values():
        at = 0
        for offset, length in sorted(row):
            assert offset == at
            at += length
        assert 0 < at <= capacity
    assert all(sorted(r) == list(range(len(r))) for r in ranks.values())
    return held, {k: len(r) for k, r in ranks.items()}


def fewest(lengths, capacity):
    """Exhaustive: the fewest sequences for a few pieces."""
    @lru_cache(None)
    def go(i, rooms):
        if i == len(lengths):
            return 0
        best = 1 + go(i + 1, tuple(sorted([*rooms, capacity - lengths[i]])))
        for j, r in enumerate(rooms):
            if r >= lengths[i] and r not in rooms[:j]:
                best = min(best, go(i + 1, tuple(sorted([*rooms[:j], *rooms[j + 1:], r - lengths[i]]))))
        return best

    lengths = sorted(lengths, reverse=True)
    return go(0, ())


def test_ids_equal_the_library(library):
    rng = random.Random(0)
    odd = "".join(chr(rng.choice([32, 9, 10, 65, 97, 48, 0xE9, 0x3042, 0x1F389, 0x300, 0xA0, 0x2003, 39, 115, 0, 0xFFFD, 0x85])) for _ in range(20_000))
    for t in ("", " ", "it's  a\n\n x", odd, "a <|endoftext|> b<|endoftext|>", "a" * 100_000, " " * 50_000 + "x", "日本語" * 5000):
        assert packing.token_ids(FILE, t).tolist() == library(t)


def test_plans_hold_every_piece():
    rng = np.random.default_rng(2)
    for capacity in (1, 7, 64, 2048):
        for many in (0, 1, 5, 300, 20_000):
            lengths = np.minimum(rng.integers(1, capacity + 1, many), rng.integers(1, capacity + 1, many)) if many % 2 == 0 else rng.integers(1, capacity + 1, many)
            counts = np.bincount(lengths, minlength=capacity + 1)
            held, seen = lengths_of(packing.make_plan(counts, capacity), capacity)
            assert seen == {int(n): int(c) for n, c in enumerate(counts) if c}
            if many >= 300:
                assert len(held) <= 1.02 * max(lengths.sum() / capacity, (lengths > capacity / 2).sum()) + 2


def test_plans_of_a_few_pieces_are_near_the_fewest():
    rng = random.Random(4)
    more = 0
    for _ in range(60):
        lengths = [rng.randint(1, 60) for _ in range(rng.randint(1, 9))]
        held, _ = lengths_of(packing.make_plan(np.bincount(lengths, minlength=61), 60), 60)
        more += len(held) - fewest(tuple(lengths), 60)
        assert len(held) <= fewest(tuple(lengths), 60) + 1
    assert more <= 3


def test_configurations_solve_the_programme():
    # three sizes; 0.5 + 0.5 and 0.4 + 0.6 fill sequences, so 5 + 4 are needed
    used, amount = packing.configurations(np.array([40, 50, 60]), np.array([4.0, 10.0, 4.0]), 100)
    assert amount.sum() == pytest.approx(9) and all((u * [40, 50, 60]).sum() <= 100 for u in used)
    assert (used * amount[:, None]).sum(0) == pytest.approx([4, 10, 4])


def test_few_lengths_make_few_sequences():
    # half of the pieces need 1,200, half 848: best fit and the programme both must pair them
    counts = np.zeros(2049, np.int64)
    counts[[1200, 848, 2048, 1]] = 10**12, 10**12, 7, 5
    strips = packing.make_plan(counts)
    assert len(strips) < 100 and (strips[:, 4] + -(-strips[:, 2] // strips[:, 3])).max() == 10**12 + 8


def test_query_against_the_library(spark, library):
    docs = {r["doc_id"]: [*library(r["text"]), 0] for r in common.documents(spark, SF).collect()}
    rows, held = queries.op13_best_fit_packing(spark, SF).collect(), defaultdict(list)
    pieces = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
    for i, ids in docs.items():
        own = sorted(pieces.pop(i), key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own))) and own[0]["start"] == 0 and sum(r["length"] for r in own) == len(ids)
        for n, r in enumerate(own):
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes())
            assert r["length"] == 2048 or n == 0
            assert n == 0 or r["start"] == own[n - 1]["start"] + own[n - 1]["length"]
    assert not pieces
    for row in held.values():
        row.sort()
        assert row[0][0] == 0 and all(b[0] == a[0] + a[1] for a, b in zip(row, row[1:])) and row[-1][0] + row[-1][1] <= 2048
    assert len(held) <= 1.01 * sum(map(len, docs.values())) / 2048 + 1


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None, 1, 2), (2, "", 1, 2), (3, "a b", None, None), (3, "a b", None, None), (None, long, 5, 6), (None, None, None, None)]
    schema = "doc_id long, text string, offset long, sequence_id long"
    df = spark.createDataFrame(rows, schema).coalesce(3)
    cut = packing.tokenise(df, FILE, capacity=1000)
    got = cut.collect()
    assert [len(r["ids"]) for r in got] == [4 * r["length"] for r in got] and sum(r["length"] == 1 for r in got) == 3
    back = b"".join(r["ids"] for r in sorted(got, key=lambda r: r["piece"]) if r["doc_id"] is None and r["length"] > 1)
    assert np.frombuffer(back, "<u4").tolist() == [*packing.token_ids(FILE, long).tolist(), 0]
    packed = packing.pack(cut.drop("ids"), capacity=1000)
    assert packed.columns == ["doc_id", "piece", "start", "length", "sequence_id", "offset"] and packed.count() == len(got)
    assert packing.pack(packing.tokenise(df.limit(0), FILE)).count() == 0
    sizes = spark.createDataFrame([(5, 1), (None, 2), (5, 3)], "length int, offset int")
    placed = sorted(((r["length"] or 0, r["sequence_id"], r["offset"]) for r in packing.pack(sizes, capacity=10).collect()), key=str)
    assert placed == [(0, None, None), (5, 0, 0), (5, 0, 5)]
    for bad in (-1, 11, 0):
        with pytest.raises(Exception):
            packing.pack(spark.createDataFrame([(bad,)], "length int"), capacity=10).collect()


def test_a_length_that_most_pieces_share(spark):
    df = spark.range(0, 30_000, 1, 7).selectExpr("id", "if(id % 10 = 0, id % 50 + 1, 33) as length")
    got = packing.pack(df, capacity=100).toPandas()
    assert len(got) == 30_000 and got["id"].is_unique
    assert (got.groupby("sequence_id")["length"].sum() <= 100).all()
    got = got.sort_values(["sequence_id", "offset"])
    assert (got.groupby("sequence_id")["length"].cumsum() - got["length"] == got["offset"]).all()
