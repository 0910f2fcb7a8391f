"""Nearest neighbours by inner product: hierarchical k-means tree, best bin first.

The tree is fitted on a bounded sample; every vector is then sent down it to a
leaf.  A query walks the tree with a priority queue: the child with the largest
inner product of query and centre is opened first, and leaves come out in that
order.  How many leaves are opened is calibrated: for a bounded set of queries
the true neighbours are found by brute force over all vectors.  The number of
leaves that meets the wanted share of them for one half of these queries is widened
until it does so for the other half too, which was not used to find it.

Neighbouring leaves are stored together as blocks of bounded size, and a leaf that holds
a third of all vectors is many blocks.  A query is sent once to each block of which it opens
leaves; the task that holds the block gives it its best rows there, and the best of those are
kept.  Scores are inner products in double precision on the original vectors, added up
in one order whatever the block, so equal vectors have equal scores; ties go to the
smaller id.  Vectors that are null, zero, of another length than the most common, or
hold null or non-finite components take no part, neither as queries nor as
neighbours.  A repeated id is one row each time it occurs, but a query never meets its
own id (and repeated queries of one id share their ranks).  Fewer candidates than
``k``: all of them.  No usable vector or no query: an empty result.  Other columns are left out.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kensa.llm import common

SAMPLE = (20_000, 131_072)  # vectors the tree is fitted on: a sixteenth of all, in these bounds
BRANCH = 8             # children of a node
LEAF_SAMPLE = 64       # a node with fewer sampled vectors is a leaf
CALIBRATION = 200      # queries with brute-force neighbours
TARGET = 0.94          # recall wanted on them
BLOCK = 4096           # vectors of a block (expected)
SLICE = 65536          # queries searched against one copy of a block


@dataclass
class Tree:
    centres: list[np.ndarray]      # per inner node: BRANCH x dimension
    children: list[list[int]]      # per inner node: >= 0 inner node, < 0 leaf -(i + 1)
    n_leaves: int

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        work = [(0, np.arange(len(x)))]
        if not self.centres:
            return out
        while work:
            node, rows = work.pop()
            c = self.centres[node]
            near = (x[rows] @ c.T - 0.5 * (c ** 2).sum(1)).argmax(1)
            for j, child in enumerate(self.children[node]):
                own = rows[near == j]
                if len(own):
                    if child < 0:
                        out[own] = -child - 1
                    else:
                        work.append((child, own))
        return out

    def best_first(self, q: np.ndarray):
        """Leaves from the most to the least promising."""
        queue, tick = [(-np.inf, 0, 0 if self.centres else -1)], 0
        while queue:
            _, _, node = heapq.heappop(queue)
            if node < 0:
                yield -node - 1
                continue
            for child, s in zip(self.children[node], self.centres[node] @ q):
                tick += 1
                heapq.heappush(queue, (-s, tick, child))


def grow(x: np.ndarray, seed: int = 3) -> Tree:
    rng = np.random.default_rng(seed)
    tree = Tree([], [], 0)

    def leaf() -> int:
        tree.n_leaves += 1
        return -tree.n_leaves

    def build(rows: np.ndarray) -> int:
        points = np.unique(rows, axis=0)
        if len(rows) < LEAF_SAMPLE or len(points) < 2 * BRANCH:
            return leaf()
        c = points[rng.choice(len(points), BRANCH, replace=False)]
        for _ in range(12):
            near = (rows @ c.T - 0.5 * (c ** 2).sum(1)).argmax(1)
            c = np.array([rows[near == j].mean(0) if (near == j).any() else c[j] for j in range(BRANCH)])
        near = (rows @ c.T - 0.5 * (c ** 2).sum(1)).argmax(1)
        if len(np.unique(near)) < 2:
            return leaf()
        node = len(tree.centres)
        tree.centres.append(c)
        tree.children.append([])
        tree.children[node] = [build(rows[near == j]) for j in range(BRANCH)]
        return node

    if len(x):
        build(x)
    tree.n_leaves = max(1, tree.n_leaves)
    return tree


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): vectors that take part, as arrays of double."""
    v = F.col(vector).cast("array<double>")
    good = F.col(key).isNotNull() & v.isNotNull() & (F.size(v) > 0)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return df.select(F.col(key).cast("long").alias("id"), v.alias("v")).where(good).where(finite & F.exists("v", lambda x: x != 0))


def _vectors(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 0))


def _bytes(x: np.ndarray) -> pa.Array:
    return pa.array([v.tobytes() for v in np.ascontiguousarray(x)], pa.binary())


def _doubles(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist())).reshape(len(column), width)


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


class Block:
    """Vectors of some leaves, the distinct ones of each leaf once, with their smallest ids."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, leaf: np.ndarray, k: int):
        same = np.unique(np.ascontiguousarray(x).view(f"V{x.itemsize * x.shape[1]}").ravel(), return_inverse=True)[1]
        order = np.lexsort((ids, same, leaf))
        ids, same, leaf = ids[order], same[order], leaf[order]
        new = np.ones(len(ids), bool)
        new[1:] = (same[1:] != same[:-1]) | (leaf[1:] != leaf[:-1])
        group = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        # no query wants more than k of equal vectors, and one of them may be its own
        keep = np.arange(len(ids)) - first[group] <= k
        self.k, self.ids = k, ids[keep]
        self.many = np.bincount(group[keep], minlength=len(first))
        self.first = np.concatenate([[0], np.cumsum(self.many)])[:-1]
        self.x, self.leaf = x[order[first]], leaf[first]

    def best(self, own: np.ndarray, q: np.ndarray, opened: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score, leaf) of the k best rows of each query in the leaves it opens (None: all)."""
        scores = np.full((len(q), len(self.x)), -np.inf)
        if opened is None:
            scores[:] = q @ self.x.T
        else:
            query, leaf = np.repeat(np.arange(len(q)), [len(o) for o in opened]), np.concatenate(opened)
            order = np.argsort(leaf, kind="stable")
            query, leaf = query[order], leaf[order]
            cuts = np.flatnonzero(np.append(True, leaf[1:] != leaf[:-1]))
            for lo, hi in zip(cuts, np.append(cuts[1:], len(leaf))):
                a, z = np.searchsorted(self.leaf, [leaf[lo], leaf[lo] + 1])
                scores[query[lo:hi], a:z] = q[query[lo:hi]] @ self.x[a:z].T
        most = self.k + 1                         # one may be the query itself
        if scores.shape[1] > most:
            cut = -np.partition(-scores, most - 1, axis=1)[:, most - 1:most]
            # the product's last bits depend on its shape, so what is about as good goes on
            with np.errstate(invalid="ignore"):
                r, c = np.nonzero((scores >= cut - 1e-9 * np.abs(cut)) & (scores > -np.inf))
        else:
            r, c = np.nonzero(scores > -np.inf)
        exact = (q[r] * self.x[c]).sum(1)         # each pair by itself
        there = self.many[c]
        r, c, exact = np.repeat(r, there), np.repeat(c, there), np.repeat(exact, there)
        ids = self.ids[self.first[c] + np.arange(len(c)) - np.repeat(np.cumsum(there) - there, there)]
        ok = ids != own[r]
        r, c, exact, ids = r[ok], c[ok], exact[ok], ids[ok]
        order = np.lexsort((ids, -exact, r))
        r, c, exact, ids = r[order], c[order], exact[order], ids[order]
        keep = np.arange(len(r)) - np.searchsorted(r, r) < self.k
        return r[keep], ids[keep], exact[keep], self.leaf[c[keep]]


def enough(depth: np.ndarray, owner: np.ndarray) -> int:
    """Leaves to open, from the places of true neighbours' leaves in their queries' orders:
    what half of the queries need for the target, widened until it serves the other half."""
    if not len(depth):
        return 1
    half = owner % 2 == 0
    fit, test = depth[half] if half.any() else depth, depth[~half] if (~half).any() else depth
    visits = int(np.quantile(fit, TARGET, method="higher"))
    while (test <= visits).mean() < TARGET:
        visits = int(np.ceil(visits * 1.05)) + 1
    return visits


def search(df: DataFrame, queries: DataFrame, key: str, vector: str, k: int = 20) -> DataFrame:
    """The ``k`` nearest found in ``df`` for each row of ``queries`` (same columns): query_id, rank, <key>, score."""
    spark = df.sparkSession
    result = f"query_id long, rank int, `{key}` long, score double"
    rows, asked = usable(df, key, vector), usable(queries, key, vector)
    common_size = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common_size is None:
        return spark.createDataFrame([], result)
    dim, n = common_size["d"], common_size["count"]
    rows, asked = rows.where(F.size("v") == dim), asked.where(F.size("v") == dim)
    n_asked = asked.count()
    if not n_asked:
        return spark.createDataFrame([], result)

    def some(d: DataFrame, many: int, salt: int) -> pa.Table:
        """``many`` rows by hash, however often an id occurs."""
        return d.orderBy(F.xxhash64("id", "v", F.lit(salt)), "id").limit(many).toArrow().combine_chunks()

    sample = some(rows, min(max(n // 16, SAMPLE[0]), SAMPLE[1]), 1)
    tree = grow(_vectors(sample["v"].chunk(0)))
    shared = spark.sparkContext.broadcast(tree)

    def to_leaves(batches):
        for b in batches:
            if b.num_rows:
                x = _vectors(b.column("v"))
                yield pa.RecordBatch.from_arrays([b.column("id"), _bytes(x), pa.array(shared.value.leaf_of(x))], names=["id", "v", "leaf"])

    placed = common.scratch(rows.mapInArrow(to_leaves, "id long, v binary, leaf long"), "ann")
    asked = asked.withColumn("slice", F.pmod(F.xxhash64("id", F.lit(3)), F.lit(-(-n_asked // SLICE))).cast("int"))

    # calibration: rank, in best-first order, of the leaf of every true neighbour
    sample = some(asked.select("id", "v"), CALIBRATION, 2)
    cal_ids, cal = _numbers(sample["id"].chunk(0)), _vectors(sample["v"].chunk(0))
    exact = spark.sparkContext.broadcast((cal_ids, cal))

    def brute(batches):
        own, q = exact.value
        held = None
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK):
                part = b.slice(lo, BLOCK)
                got = Block(_numbers(part.column("id")), _doubles(part.column("v"), dim), _numbers(part.column("leaf")), k).best(own, q)
                held = got if held is None else tuple(np.concatenate(p) for p in zip(held, got))
                order = np.lexsort((held[1], -held[2], held[0]))
                held = tuple(h[order] for h in held)
                keep = np.arange(len(held[0])) - np.searchsorted(held[0], held[0]) < k
                held = tuple(h[keep] for h in held)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(h) for h in held], names=["q", "id", "score", "leaf"])

    w = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    truth = placed.mapInArrow(brute, "q long, id long, score double, leaf long").withColumn("r", F.row_number().over(w)).where(F.col("r") <= k)
    truth = truth.select("q", "leaf").toPandas()
    depth = []
    for q, leaf in zip(truth["q"], truth["leaf"]):
        if not depth or depth[-1][0] != q:
            order = {x: i + 1 for i, x in enumerate(tree.best_first(cal[q]))}
        depth.append((q, order[leaf]))
    visits = enough(np.array([d for _, d in depth]), np.array([q for q, _ in depth]))

    # blocks: leaves one after the other while they fit, large ones cut by hash
    sizes = {r["leaf"]: r["count"] for r in placed.groupBy("leaf").count().collect()}   # bounded by the sample
    block_of, many, at, room = {}, {}, -1, 0
    for leaf in sorted(sizes):
        many[leaf] = -(-sizes[leaf] // BLOCK)
        if many[leaf] > 1 or sizes[leaf] > room:
            at, room = at + 1, BLOCK
        block_of[leaf] = at
        room -= sizes[leaf]
        if many[leaf] > 1:
            at, room = at + many[leaf] - 1, 0
    where = spark.createDataFrame([(x, block_of[x], many[x]) for x in sizes], "leaf long, first long, many long")
    known = spark.sparkContext.broadcast((visits, sizes, block_of, many))
    slices = -(-n_asked // SLICE)
    schema = "block long, slice int, kind int, id long, v binary, leaf long, leaves binary"
    held = placed.join(F.broadcast(where), "leaf").select(
        (F.col("first") + F.pmod(F.xxhash64("id", "v"), F.col("many"))).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"),
        F.lit(0).alias("kind"), "id", "v", "leaf", F.lit(None).cast("binary").alias("leaves"))

    def walk(batches):
        """Blocks each query visits and the leaves it opens there: the calibrated number, and more until k candidates are certain."""
        limit, size, block, cut = known.value
        for whole in batches:
            for lo in range(0, whole.num_rows, 1024):
                b = whole.slice(lo, 1024)
                v = _vectors(b.column("v"))
                place, blocks, opened = [], [], []
                for i, q in enumerate(v):
                    met, leaves = 0, {}
                    for j, leaf in enumerate(shared.value.best_first(q)):
                        if j >= limit and met > k:
                            break
                        if leaf in size:
                            met += size[leaf]
                            for m in range(cut[leaf]):
                                leaves.setdefault(block[leaf] + m, []).append(leaf)
                    place += [i] * len(leaves)
                    blocks += leaves
                    opened += [np.array(x, np.int64).tobytes() for x in leaves.values()]
                take = pa.array(place, pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), b.column("slice").take(take), pa.array(np.ones(len(place), np.int32)), b.column("id").take(take),
                                                  _bytes(v).take(take), pa.nulls(len(place), pa.int64()), pa.array(opened, pa.binary())], names=["block", "slice", "kind", "id", "v", "leaf", "leaves"])

    # a block's vectors, then the queries that visit it: no task holds more than a block and a batch
    parts = common.parts_for(df)
    met = held.unionByName(asked.mapInArrow(walk, schema)).repartition(parts, "block", "slice").sortWithinPartitions("block", "slice", "kind")

    def match(batches):
        current, rows, block = None, [], None
        for b in batches:
            at = np.stack([_numbers(b.column(c)) for c in ("block", "slice", "kind")], 1) if b.num_rows else np.zeros((0, 3), np.int64)
            cuts = np.flatnonzero(np.append(True, (at[1:] != at[:-1]).any(1))) if len(at) else []
            for a, z in zip(cuts, [*cuts[1:], len(at)]):
                part, here = b.slice(a, z - a), tuple(at[a, :2].tolist())
                if here != current:
                    current, rows, block = here, [], None
                if at[a, 2] == 0:
                    rows.append((_numbers(part.column("id")), _doubles(part.column("v"), dim), _numbers(part.column("leaf"))))
                    continue
                if not rows:                      # a part of a cut leaf that got none
                    continue
                block = block or Block(*(np.concatenate(p) for p in zip(*rows)), k)
                for lo in range(0, part.num_rows, 512):
                    q = part.slice(lo, 512)
                    own = _numbers(q.column("id"))
                    r, i, s, _ = block.best(own, _doubles(q.column("v"), dim), [np.frombuffer(x, np.int64) for x in q.column("leaves").to_pylist()])
                    yield pa.RecordBatch.from_arrays([pa.array(own[r]), pa.array(i), pa.array(s)], names=["query_id", "id", "score"])

    found = met.mapInArrow(match, "query_id long, id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(key), "score")
