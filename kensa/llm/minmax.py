"""Near-duplicate groups by min-max hashing.

Every permutation of the 32-bit hash space gives two signature values, the
smallest and the largest hash of a text's shingles, so ``N_PERMUTATIONS``
evaluations give twice as many values.  Runs of ``ROWS`` values are band keys;
texts that share a band key are candidates, and candidates whose signatures
agree too little to be similar (six standard deviations) are given up.  All
others are confirmed on their full shingle sets.

Texts with equal sets are one class from the start and are never paired.  In a
bucket of classes, two members are pivots, one after the other: the others are paired with
the first, then those of other components than the second with that.
Where a bucket then still holds several components, its classes are compared in
blocks, and only links between different components leave that step: no candidate is
lost, and a large group does not become all its pairs.  (Banding itself misses a
pair at a similarity of exactly 0.8 with a chance of about 3 in a million, and less above.)
Full sets are made again from the texts, for the classes that need them.

Words are runs without white space, A-Z lower-cased.  A text with fewer words
than a shingle is one shingle; null texts and texts without words have an empty
set and are linked with nothing.  Rows without an id take no part: no component,
kept.  Rows that repeat an id and a text are one document; an id with several
texts is linked by each of them.  Extra columns are not touched.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kensa.llm import common
from kensa.operators.joins import checked_small

N_PERMUTATIONS = 80
ROWS = 5
N_BANDS = 2 * N_PERMUTATIONS // ROWS
SLACK = 0.2            # how far below the threshold a signature may agree
BLOCK = 128            # classes of a block in the comparison across components
BLOCK_BYTES = 8 << 20  # and bytes of their sets
LONG_ROWS = 1000       # rows with a text or a set that go to a Python worker at once
BLOCK_ROWS = 64        # and rows with one or two blocks

_RNG = np.random.default_rng(77)
_MUL = _RNG.integers(0, 2**32, N_PERMUTATIONS, dtype=np.uint32) | np.uint32(1)
_XOR = _RNG.integers(0, 2**32, N_PERMUTATIONS, dtype=np.uint32)


def shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, sorted within the row, and each row's first."""
    data = common.LOWER[data]
    starts, ends, first = common.find_words(data, offsets)
    h = common.hash_words(data, starts, ends)
    n_words = np.diff(first)
    length = np.minimum(n_words, k)
    own = np.maximum(n_words - k + 1, (n_words > 0).astype(np.int64))  # shingles of a row
    row = np.repeat(np.arange(len(own)), own)
    at = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(own) - own, own)
    out = np.full(len(row), 0x51ED270B, np.uint64)
    for i in range(k):
        there = i < length[row]
        out = np.where(there, common.mix(out * np.uint64(0x9FB21C651E98DF25) + h[np.where(there, at + i, 0)]) if len(h) else out, out)
    order = np.lexsort((out, row))
    out, row = out[order], row[order]
    fresh = np.ones(len(out), bool)
    fresh[1:] = (out[1:] != out[:-1]) | (row[1:] != row[:-1])
    out, row = out[fresh], row[fresh]
    return out, np.searchsorted(row, np.arange(len(own) + 1))


def fingerprints(sets: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over the members of each set."""
    out = []
    for c in (0x2545F4914F6CDD1D, 0x8CB92BA72F3D8DD7):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(common.mix(sets ^ np.uint64(c)), dtype=np.uint64)])
        out.append((sums[first[1:]] - sums[first[:-1]]).view(np.int64))
    return out[0], out[1]


def signatures(sets: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows x 2 N_PERMUTATIONS smallest and largest hashes; every set has a member."""
    x = (sets >> np.uint64(32)).astype(np.uint32) ^ sets.astype(np.uint32)
    out = np.empty((len(first) - 1, 2 * N_PERMUTATIONS), np.uint32)
    for j in range(N_PERMUTATIONS):
        h = (x ^ _XOR[j]) * _MUL[j]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        out[:, 2 * j] = np.minimum.reduceat(h, first[:-1])
        out[:, 2 * j + 1] = np.maximum.reduceat(h, first[:-1])
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """Rows x N_BANDS keys (from the low 16 bits of each value); a band's number is part of its key."""
    signature = signature.astype(np.uint16)
    keys = np.empty((len(signature), N_BANDS), np.uint64)
    for b in range(N_BANDS):
        key = np.full(len(signature), b + 1, np.uint64)
        # values j, j + N_BANDS, ...: the two values of one permutation are never in one band
        for j in range(ROWS):
            key = common.mix(key * np.uint64(0x9FB21C651E98DF25) + signature[:, b + j * N_BANDS].astype(np.uint64))
        keys[:, b] = key
    return keys.view(np.int64)


def signed(df: DataFrame, k: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, f1, f2, sig) of every row, written once."""
    kind = "doc_id long, n_shingles long, f1 long, f2 long, sig binary"

    def run(batches):
        for batch in batches:
            for rows, data, offsets in common.pieces(batch, "__text", common.PIECE_BYTES // 2):
                sets, first = shingles(data, offsets, k)
                sizes = np.diff(first)
                f1, f2 = fingerprints(sets, first)
                some = np.flatnonzero(sizes > 0)
                sigs = [None] * len(sizes)
                if len(some):
                    for i, s in zip(some.tolist(), signatures(sets, np.append(first[some], first[-1])).astype(np.uint16)):
                        sigs[i] = s.tobytes()
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(sizes), pa.array(f1), pa.array(f2), pa.array(sigs, pa.binary())],
                                                 names=["doc_id", "n_shingles", "f1", "f2", "sig"])
        common.release()

    return common.scratch(df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("__text")).mapInArrow(run, kind), "minmax")


def _bands(batches):
    """One row for each class and band key."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 2048):
            b = batch.slice(lo, 2048)
            keys = band_keys(np.frombuffer(b"".join(b.column("sig").to_pylist()), np.uint16).reshape(b.num_rows, -1))
            yield pa.RecordBatch.from_arrays([b.column("cls").take(pa.array(np.repeat(np.arange(len(keys)), N_BANDS))), pa.array(keys.ravel())], names=["cls", "key"])
    common.release()


def _agree(least: float):
    def run(batches):
        for b in batches:
            if b.num_rows:
                x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(b.num_rows, -1) for c in ("sa", "sb"))
                keep = pa.array((x == y).mean(1) >= least)
                yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(keep)
        common.release()
    return run


def _confirm(num: int, den: int):
    def run(batches):
        for batch in batches:
            a, b, xs, ys = (batch.column(c).to_pylist() for c in ("a", "b", "xa", "xb"))
            ok = []
            for x, y in zip(xs, ys):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(x) + len(y) - len(np.union1d(x, y))
                ok.append(den * both >= num * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))
        common.release()
    return run


def groups(df: DataFrame, k: int, num: int = 80, den: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row; linked where den * both >= num * union."""
    sig = signed(df, k, key, text)
    some = sig.where("n_shingles > 0 and doc_id is not null")
    classes = some.groupBy("f1", "f2").agg(F.min("doc_id").alias("cls"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"))
    classes = common.scratch(classes, "classes", clean=True)
    rows = classes.select("cls", "sig").mapInArrow(_bands, "cls long, key long")
    shared = rows.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key")
    buckets = common.scratch(rows.join(shared, "key").select("key", "cls"), "buckets", clean=True)

    light = classes.select("cls", "n", "sig")

    def full_sets(wanted: DataFrame) -> DataFrame:
        """(cls, x): the full sets of some classes, from their texts.  Few classes are sent to
        where the texts are read, many meet them in a shuffle."""
        ids, few = checked_small(wanted.distinct().join(classes.select("cls", "f1", "f2"), "cls"))
        texts = df.select(F.col(key).cast("long").alias("cls"), F.col(text).alias("__text")).where("__text is not null")
        texts = texts.join(F.broadcast(ids) if few else ids, "cls").select("cls", "f1", "f2", "__text")

        def full(batches):
            for batch in batches:
                for part, data, offsets in common.pieces(batch, "__text", common.PIECE_BYTES // 2):
                    sets, first = shingles(data, offsets, k)
                    f1, f2 = fingerprints(sets, first)
                    own = (f1 == part.column("f1").to_numpy()) & (f2 == part.column("f2").to_numpy())
                    yield pa.RecordBatch.from_arrays([part.column("cls").filter(pa.array(own)), pa.array([sets[first[i]:first[i + 1]].tobytes() for i in np.flatnonzero(own)], pa.binary()),
                                                      part.column("f1").filter(pa.array(own)), part.column("f2").filter(pa.array(own))], names=["cls", "x", "f1", "f2"])
            common.release()

        sets = common.scratch(texts.mapInArrow(full, "cls long, x binary, f1 long, f2 long"), "sets", clean=True, batch=LONG_ROWS)
        if not _unique(sets):  # ids given to several rows
            sets = common.scratch(sets.groupBy("cls", "f1", "f2").agg(F.first("x").alias("x")), "sets", clean=True)
        return sets.select("cls", "x")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Links among candidate pairs (a < b): those whose signatures agree are compared on their full sets."""
        pairs = pairs.join(light.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa")), "a") \
            .join(light.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb")), "b") \
            .where((den * F.least("na", "nb") >= num * F.greatest("na", "nb")))
        pairs = common.scratch(pairs.select("a", "b", "sa", "sb").mapInArrow(_agree(num / den - SLACK), "a long, b long"), "agreeing", clean=True)
        sets = full_sets(pairs.select(F.col("a").alias("cls")).union(pairs.select("b")))
        small, few = checked_small(pairs)
        full_pairs = sets.select(F.col("cls").alias("a"), F.col("x").alias("xa")).join(F.broadcast(small) if few else small, "a") \
            .join(sets.select(F.col("cls").alias("b"), F.col("x").alias("xb")), "b")
        return full_pairs.select("a", "b", "xa", "xb").mapInArrow(_confirm(num, den), "a long, b long").distinct()

    def placed(found: DataFrame | None) -> DataFrame:
        """(key, cls, comp) of the buckets that hold several components."""
        where = buckets.withColumn("comp", F.col("cls")) if found is None else \
            buckets.join(found, F.col("cls") == F.col("node"), "left").select("key", "cls", F.coalesce("component", "cls").alias("comp"))
        where = common.scratch(where, "placed", clean=True)
        split = where.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("key")
        return common.scratch(where.join(split, "key"), "split", clean=True)

    # the first pivot of a bucket is its smallest class, the second one by a hash of class and bucket;
    # what the first has brought together needs no second
    first = buckets.groupBy("key").agg(F.min("cls").alias("a"))
    pairs = buckets.join(first, "key").where("cls != a").select("a", F.col("cls").alias("b")).distinct()
    found = _joined(None, common.scratch(confirmed(pairs), "pairs", clean=True, batch=LONG_ROWS))
    apart = placed(found)
    second = apart.groupBy("key").agg(F.min(F.struct(F.xxhash64("cls", "key").alias("h"), F.col("cls").alias("p"), F.col("comp").alias("of"))).alias("s")).select("key", "s.p", "s.of")
    pairs = apart.join(second, "key").where("comp != of").select(F.least("cls", "p").alias("a"), F.greatest("cls", "p").alias("b")).distinct()
    links = common.scratch(confirmed(pairs), "pairs", clean=True, batch=LONG_ROWS)
    if not links.isEmpty():
        found = _joined(found, links)
        apart = placed(found)
    found = _joined(found, common.scratch(_across(apart, full_sets, light, num, den), "pairs", clean=True, batch=BLOCK_ROWS))
    members = some.select("doc_id", "f1", "f2").distinct().join(classes.select("f1", "f2", "cls"), ["f1", "f2"])
    if found is not None:
        members = members.join(found, F.col("cls") == F.col("node"), "left").select("doc_id", "f1", "f2", F.coalesce("component", "cls").alias("component_id"))
    else:
        members = members.select("doc_id", "f1", "f2", F.col("cls").alias("component_id"))
    out = sig.select("doc_id", "n_shingles", "f1", "f2").join(members, ["doc_id", "f1", "f2"], "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def _joined(found: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """(node, component) after more links (a, b); only components known so far are linked, not their members."""
    if links.isEmpty():
        return found
    if found is None:
        return common.scratch(common.smallest_labels(links), "labels", clean=True)
    for end in ("a", "b"):
        links = links.join(found, F.col(end) == F.col("node"), "left").withColumn(end, F.coalesce("component", end)).drop("node", "component")
    above = common.smallest_labels(links).select(F.col("node").alias("component"), F.col("component").alias("above"))
    # a component's own label is no node of ``found``, nor is a class that was alone
    moved = found.join(above, "component", "left").select("node", F.coalesce("above", "component").alias("component"))
    return common.scratch(moved.unionByName(above.select(F.col("component").alias("node"), F.col("above").alias("component"))), "labels", clean=True)


def _unique(sets: DataFrame) -> bool:
    n = sets.agg(F.count("*").alias("n"), F.countDistinct("cls").alias("m")).first()
    return n["n"] == n["m"]


def _across(placed: DataFrame, full_sets, light: DataFrame, num: int, den: int) -> DataFrame:
    """Links between classes that share a bucket (key, cls, comp) and are in different components.

    A bucket is cut by a hash into blocks of about ``BLOCK`` classes, or fewer where
    their sets are large.  In a bucket of several blocks the largest component lies
    apart from the others: its blocks need no comparison among themselves, so a large
    group that is one component costs only its outsiders times its size.  The other
    pairs of blocks are compared on signatures first; only classes whose signature agrees
    with one of another component get their full sets, and their blocks are compared by
    matrix products of membership matrices.  Only links leave.
    """
    sized = placed.join(light.select("cls", (F.col("n") * 8).alias("b")), "cls")
    main = sized.groupBy("key", "comp").agg(F.count("*").alias("c"), F.sum("b").alias("b")) \
        .withColumn("c", F.greatest(F.col("c") / BLOCK, F.col("b") / BLOCK_BYTES)) \
        .groupBy("key").agg(F.max(F.struct("c", "comp")).alias("main"), F.sum("c").alias("all"))
    inner = (F.col("comp") == F.col("main.comp")) & (F.col("all") > 1)
    cut = placed.join(main, "key").withColumn("inner", inner) \
        .withColumn("of", F.when(F.col("all") <= 1, 1).when(F.col("inner"), F.col("main.c")).otherwise(F.col("all") - F.col("main.c"))) \
        .select("key", "cls", "comp", "inner", F.pmod(F.xxhash64("cls", F.lit(3)), F.ceil("of")).alias("blk"))
    cut = common.scratch(cut, "cut", clean=True)

    signed_ = cut.join(light.select("cls", "sig"), "cls")
    blocks = signed_.groupBy("key", "inner", "blk").agg(F.collect_list(F.struct("cls", "comp", "sig")).alias("own"))
    pairs = blocks.where("not inner").select("key", F.col("blk").alias("other"), F.col("own").alias("theirs")).join(blocks, "key") \
        .where("inner or blk <= other").select("own", "theirs")

    def near(batches):
        """The members of two blocks that may be similar, as a group of its own; equal groups of several buckets have one name."""
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                sides = sorted(sorted((r["cls"], r["comp"]) for r in side) for side in _near(row["own"], row["theirs"], num / den - SLACK))
                if sides[0]:
                    name = int.from_bytes(hashlib.blake2b(repr(sides).encode(), digest_size=8).digest(), "little", signed=True)
                    cls, comp = np.array(sides[0] + sides[1], np.int64).T
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cls), name)), pa.array(np.repeat([0, 1], [len(sides[0]), len(sides[1])])), pa.array(cls), pa.array(comp)],
                                                     names=["grp", "side", "cls", "comp"])
        common.release()

    groups_ = common.scratch(pairs.mapInArrow(near, "grp long, side long, cls long, comp long").distinct(), "near", clean=True, batch=BLOCK_ROWS)
    full = groups_.join(full_sets(groups_.select("cls")), "cls").groupBy("grp").agg(F.collect_list(F.struct("side", "cls", "comp", "x")).alias("members"))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                members = batch.slice(i, 1).column("members").to_pylist()[0]
                own, theirs = ([r for r in members if r["side"] == side] for side in (0, 1))
                a, b = _links(own, theirs, num, den) if own and theirs else ([], [])
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
        common.release()

    return full.select("members").mapInArrow(run, "a long, b long").distinct()


def _near(own: list[dict], theirs: list[dict], least: float) -> tuple[list[dict], list[dict]]:
    """The members of two blocks whose signature agrees enough with one of another component."""
    x, y = (np.frombuffer(b"".join(r["sig"] for r in rows), np.uint16).reshape(len(rows), -1) for rows in (own, theirs))
    comp_x, comp_y = (np.array([r["comp"] for r in rows]) for rows in (own, theirs))
    near = np.stack([(s == y).mean(1) for s in x]) >= least
    near &= comp_x[:, None] != comp_y[None, :]
    return [own[i] for i in np.flatnonzero(near.any(1))], [theirs[j] for j in np.flatnonzero(near.any(0))]


def _links(own: list[dict], theirs: list[dict], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of the two blocks, of different components, that are similar enough."""
    mine, others = [np.frombuffer(r["x"], np.uint64) for r in own], [np.frombuffer(r["x"], np.uint64) for r in theirs]
    na, nb = np.array([len(x) for x in mine]), np.array([len(x) for x in others])
    ka, kb = np.concatenate(mine), np.concatenate(others)
    ra, rb = np.repeat(np.arange(len(na)), na), np.repeat(np.arange(len(nb)), nb)
    shared = np.intersect1d(ka, kb)
    both = np.zeros((len(na), len(nb)))
    pa_, pb_ = np.searchsorted(shared, ka), np.searchsorted(shared, kb)
    ina, inb = pa_ < len(shared), pb_ < len(shared)
    ina[ina] = shared[pa_[ina]] == ka[ina]
    inb[inb] = shared[pb_[inb]] == kb[inb]
    pa_, ra, pb_, rb = pa_[ina], ra[ina], pb_[inb], rb[inb]
    for lo in range(0, len(shared), 16_384):   # the shared shingles a slice at a time, to bound memory
        x, y = np.zeros((len(na), 16_384), np.float32), np.zeros((len(nb), 16_384), np.float32)
        for matrix, place, row in ((x, pa_, ra), (y, pb_, rb)):
            here = (place >= lo) & (place < lo + 16_384)
            matrix[row[here], place[here] - lo] = 1
        width = min(16_384, len(shared) - lo)
        both += x[:, :width] @ y[:, :width].T
    comp_a, comp_b = np.array([r["comp"] for r in own]), np.array([r["comp"] for r in theirs])
    i, j = np.nonzero((den * both >= num * (na[:, None] + nb[None, :] - both)) & (comp_a[:, None] != comp_b[None, :]))
    return np.array([r["cls"] for r in own], np.int64)[i], np.array([r["cls"] for r in theirs], np.int64)[j]
