"""Hard negatives by inner product: cover trees over norm-augmented vectors.

Components are made whole numbers, so scores are exact.  A vector ``x`` gets one more
component ``sqrt(M^2 - |x|^2)``, ``M`` the largest length; then all vectors lie on one
sphere, and the inner product with an anchor ``q`` (extra component 0) is ``|q| M cos``
of their angle.  A node of a cover tree has a centre and the largest angle ``t`` from it
to any of its vectors, its covering radius: if ``f`` is the angle from the anchor to the
centre, all of the node's inner products lie between ``|q| M cos(f + t)`` and
``|q| M cos(f - t)``.

The tree's top level is made from a bounded sample; every vector goes to its nearest
centre, whose radius is then measured over all of them.  Below it a node is cut by hash
into blocks of bounded size (a node with a third of all vectors is many blocks), each of which
grows its own tree in the task that searches it, level by level with shrinking radii.

Two searches follow, first for each anchor's positives, then for the negatives in each
positive's window of scores.  An anchor is sent to the blocks of every top node whose
bounds reach the scores it is after (they start from what the sample holds); there it
descends best first: it opens its most promising leaf, scores it exactly, and goes on until
no leaf can hold anything better.  Nodes wholly outside all windows of an anchor are
skipped.  Where bounds tell nothing apart, as among vectors without groups, all leaves
are opened and the search is one of matrix products.

Results are exact and do not depend on the tree.  Rows with a null key, label or vector, or a null
or non-finite component take no part, nor do vectors of another length than the most
common (the longest of equally common); zero vectors do.  Rows that repeat a key are rows of their
own, also to each other.  Fewer rows than asked for: all there are.  An empty table, or
one without anchors, gives an empty one.  Other columns are left out.  Inner products
must stay below 2^53 / 100, which is checked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kensa.llm import common

SAMPLE = 8192          # vectors of the top level's sample
TOP = 1024             # centres of the top level
BLOCK = (1024, 65536)  # least and most vectors of a block (expected)
SLICE = 65536          # anchors searched against one copy of a block
LEAF = 128
BASE = 1.3             # radii shrink by this from level to level
_NONE = -np.inf


def on_sphere(x: np.ndarray, largest: float) -> np.ndarray:
    """Unit vectors of the norm-augmented rows."""
    if largest == 0:
        return np.concatenate([x, np.ones((len(x), 1))], 1)
    rest = np.maximum(largest ** 2 - (x ** 2).sum(1), 0)
    return np.concatenate([x, np.sqrt(rest)[:, None]], 1) / largest


def bounds(q: np.ndarray, centres: np.ndarray, radius: np.ndarray, largest: float) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) inner product of each anchor with any vector of each node; rounded outwards."""
    size = np.sqrt((q ** 2).sum(1))
    unit = q / np.where(size > 0, size, 1)[:, None]
    angle = np.arccos(np.clip(unit @ centres[:, :-1].T, -1, 1))
    scale, slack = (size * largest)[:, None], 1e-6
    low = scale * (np.cos(np.minimum(angle + radius, np.pi)) - slack) - slack
    high = scale * (np.cos(np.maximum(angle - radius, 0)) + slack) + slack
    return low, high


class CoverTree:
    """Nodes over rows ``x``; ``leaves`` are the rows of nodes without children."""

    def __init__(self, x: np.ndarray, largest: float):
        self.x, self.largest = x, largest
        self.unit = on_sphere(x, largest)
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.children: list[list[int]] = []
        self.leaf: list[np.ndarray | None] = []
        if len(x):
            self._build()

    def _node(self, rows: np.ndarray, centre: int) -> int:
        self.centre.append(centre)
        self.radius.append(float(np.arccos(np.clip((self.unit[rows] @ self.unit[centre]).min(), -1, 1))))
        self.children.append([])
        self.leaf.append(rows)
        return len(self.centre) - 1

    def _build(self) -> None:
        work = [(self._node(np.arange(len(self.x)), 0), 0)]
        while work:
            node, level = work.pop()
            rows, centre, reach = self.leaf[node], self.centre[node], 2 * np.sin(self.radius[node] / 2)
            while 2 * BASE ** -level >= reach and level < 60:
                level += 1
            if len(rows) <= LEAF or reach < 1e-6:
                continue
            most = 4 * len(rows) // LEAF
            parts = self.cover(rows, centre, 2 * BASE ** -level, most)
            if len(parts) > most:                 # vectors that are far from each other: nodes would hold too few
                continue
            self.leaf[node] = None
            for own, c, whole in parts:
                child = self._node(own, c)
                self.children[node].append(child)
                if whole:
                    work.append((child, level))

    def cover(self, rows: np.ndarray, centre: int, reach: float, most: int) -> list[tuple[np.ndarray, int, bool]]:
        """Rows around centres so that all are within ``reach``, and those left after ``most`` centres."""
        parts = []
        while len(rows) and len(parts) < most:
            c = int(rows[0]) if parts else centre
            near = 2 - 2 * (self.unit[rows] @ self.unit[c]) <= reach ** 2
            near |= rows == c
            if near.any():
                parts.append((rows[near], c, True))
            rows = rows[~near]
        return [*parts, (rows, centre, False)] if len(rows) else parts

    def search(self, q: np.ndarray, wanted: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray], score: Callable[[np.ndarray, np.ndarray, np.ndarray], None]) -> None:
        """Best-first descent of all anchors ``q`` at once.

        ``wanted(anchors, low, high)``: which of these bounds may hold anything an anchor still
        wants; ``score(anchors, rows, products)`` is given each opened leaf's exact inner products.
        """
        if not self.centre or not len(q):
            return
        centres, radius = self.unit[self.centre], np.array(self.radius)
        everyone = np.arange(len(q))
        least, most = np.full((len(q), len(self.centre)), _NONE), np.full((len(q), len(self.centre)), _NONE)
        level, leaves = [0], []
        least[:, 0], most[:, 0] = (b[:, 0] for b in bounds(q, centres[:1], radius[:1], self.largest))
        while level:                              # down the levels: children of nodes that some anchor wants
            below = []
            for node in level:
                if self.leaf[node] is not None:
                    leaves.append(node)
                    continue
                ask = everyone[(most[:, node] > _NONE) & wanted(everyone, least[:, node:node + 1], most[:, node:node + 1])[:, 0]]
                kids = self.children[node]
                if len(ask):
                    low, high = bounds(q[ask], centres[kids], radius[kids], self.largest)
                    least[np.ix_(ask, kids)], most[np.ix_(ask, kids)] = low, np.minimum(high, most[ask, node][:, None])
                    below += kids
            level = below
        least, most, leaves = least[:, leaves], most[:, leaves], np.array(leaves)
        live = everyone
        while len(live):                          # each anchor opens its best leaf that may still hold something
            high = np.where(wanted(live, least[live], most[live]), most[live], _NONE)
            best = high.argmax(1)
            ok = high[np.arange(len(live)), best] > _NONE
            live, best = live[ok], best[ok]
            for b in np.unique(best):
                own, rows = live[best == b], self.leaf[leaves[b]]
                score(own, rows, q[own] @ self.x[rows].T)
                most[own, b] = _NONE


def top(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``k`` best of every row, ties to smaller ids, best first; minus infinity is no score."""
    if scores.shape[1] > k:
        cut = -np.partition(-scores, k - 1, axis=1)[:, k - 1:k]
    else:
        cut = np.full((len(scores), 1), _NONE)
    r, c = np.nonzero((scores >= cut) & (scores > _NONE))
    order = np.lexsort((ids[r, c] if ids.ndim == 2 else ids[c], -scores[r, c], r))
    r, c = r[order], c[order]
    keep = np.arange(len(r)) - np.searchsorted(r, r) < k
    return r[keep], c[keep]


class Best:
    """The ``k`` best rows so far of each anchor in each of its windows."""

    def __init__(self, windows: np.ndarray, k: int):
        """``windows``: anchors x windows x (low, high); a window with low over high is none."""
        self.windows, self.k = windows, k
        shape = (*windows.shape[:2], k)
        self.score, self.id, self.row = np.full(shape, _NONE), np.zeros(shape, np.int64), np.zeros(shape, np.int64)

    def floor(self) -> np.ndarray:
        """What a score must reach to be among the best of a window (anchors x windows)."""
        return np.maximum(self.score[:, :, -1], self.windows[:, :, 0])

    def wanted(self, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        floor, upto = self.floor()[anchors], self.windows[anchors, :, 1]
        out = np.zeros(low.shape, bool)
        for w in range(floor.shape[1]):
            out |= (high >= floor[:, w, None]) & (low <= upto[:, w, None]) & (floor[:, w, None] <= upto[:, w, None])
        return out

    def take(self, anchors: np.ndarray, products: np.ndarray, ok: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        for w in range(self.windows.shape[1]):
            low, high = self.floor()[anchors, w], self.windows[anchors, w, 1]
            some = np.flatnonzero(low <= high)
            inside = ok[some] & (products[some] >= low[some, None]) & (products[some] <= high[some, None])
            reached = inside.any(1)
            some = some[reached]
            if not len(some):
                continue
            new = np.where(inside[reached], products[some], _NONE)
            own = anchors[some]
            n = np.broadcast_to(ids, new.shape), np.broadcast_to(rows, new.shape)
            r, c = top(new, n[0], self.k)
            # the best of these beside the best so far
            s = np.full((len(some), 2 * self.k), _NONE)
            i, u = np.zeros(s.shape, np.int64), np.zeros(s.shape, np.int64)
            s[:, :self.k], i[:, :self.k], u[:, :self.k] = self.score[own, w], self.id[own, w], self.row[own, w]
            at = self.k + np.arange(len(r)) - np.searchsorted(r, r)
            s[r, at], i[r, at], u[r, at] = new[r, c], ids[c], rows[c]
            r, c = top(s, i, self.k)
            at = np.arange(len(r)) - np.searchsorted(r, r)
            self.score[own, w] = _NONE
            self.score[own[r], w, at], self.id[own[r], w, at], self.row[own[r], w, at] = s[r, c], i[r, c], u[r, c]


def top_centres(unit: np.ndarray, limit: int) -> np.ndarray:
    """Up to ``limit`` sampled vectors that cover the sample with the least radius of the level-wise scale."""
    found, reach = unit[:1], 2.0
    while len(found) < limit and reach > 1e-6:
        reach /= BASE
        rest, cover = unit, []
        while len(rest) and len(cover) < limit:
            cover.append(rest[0].copy())   # a view would keep all of this round's rest
            rest = rest[2 - 2 * (rest @ rest[0]) > reach ** 2][: len(rest) - 1]
        found = np.array(cover)
    return found


def _doubles(column: pa.Array, width: int) -> np.ndarray:
    """Vectors that are written as the bytes of their components."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data).reshape(len(column), width)


def _numbers(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


def usable(df: DataFrame, anchor: Column, key: str, vector: str, label: str, scale: float) -> DataFrame:
    """row, id, label, anchor, v (bytes of floor(scale * component)), size (squared length): rows that take part."""
    v = F.col(f"`{vector}`").cast("array<double>")
    asked = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"), v.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    asked = asked.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).where((F.size("v") > 0) & finite)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column("v")
            x = np.floor(v.flatten().to_numpy(zero_copy_only=False) * scale)
            cuts = np.concatenate([[0], np.cumsum(v.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            size = np.add.reduceat(x * x, cuts[:-1]) if len(v) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([x[a:z].tobytes() for a, z in zip(cuts, cuts[1:])], pa.binary()), pa.array(size)], names=["id", "label", "anchor", "v", "size"])

    rows = asked.mapInArrow(whole, "id long, label long, anchor boolean, v binary, size double")
    return common.scratch(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")


def mine(df: DataFrame, anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label", positives: int = 5, negatives: int = 10,
         low: int = 30, high: int = 90, scale: float = 256.0) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows for which ``anchor`` holds.  An anchor's positives are the ``positives`` other
    rows of its label with the largest inner products (ties: smaller key); for each of them follow,
    best first, the ``negatives`` best rows of other labels whose score is ``low`` to ``high`` per
    cent of the positive's.
    """
    spark = df.sparkSession
    common.prepare(spark)
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = usable(df, anchor, key, vector, label, scale)
    by_size = F.length("v")
    most = rows.groupBy(by_size.alias("bytes")).agg(F.count("*").alias("n"), F.max("size").alias("size"), F.count_if("anchor").alias("anchors")).orderBy(F.desc("n"), F.desc("bytes")).first()
    if most is None or not most["anchors"]:
        return spark.createDataFrame([], result)
    if not most["size"] < 2 ** 53 / 100:
        raise ValueError("components are too large for exact inner products")
    width, n, largest = most["bytes"] // 8, most["n"], float(np.sqrt(most["size"]))
    rows = rows.where(by_size == most["bytes"]).drop("size")

    # the top level: centres from a bounded sample, then where every row belongs
    sample = rows.orderBy(F.xxhash64("row", F.lit(5)), "row").limit(SAMPLE).toArrow().combine_chunks()
    held = _doubles(sample["v"], width), *(_numbers(sample[c]) for c in ("row", "id", "label"))
    parts = common.parts_for(df)
    block = min(max(n // (4 * parts), BLOCK[0]), BLOCK[1])
    centres = top_centres(on_sphere(held[0], largest), int(min(max(n // block, 1), TOP)))
    shared = spark.sparkContext.broadcast(centres)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cos = on_sphere(_doubles(b.column("v"), width), largest) @ shared.value.T
            node = cos.argmax(1) if len(cos) else np.zeros(0, np.int64)
            angle = np.arccos(np.clip(cos[np.arange(len(cos)), node], -1, 1))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(node), pa.array(angle)], names=[*b.schema.names, "node", "angle"])

    placed = common.scratch(rows.select("row", "id", "label", "anchor", "v").mapInArrow(nearest, "row long, id long, label long, anchor boolean, v binary, node long, angle double"), "placed")
    nodes = placed.groupBy("node").agg(F.count("*").alias("n"), F.max("angle").alias("angle")).orderBy("node").collect()    # at most TOP rows
    many = np.array([-(-r["n"] // block) for r in nodes])
    first = np.concatenate([[0], np.cumsum(many)])
    known = spark.sparkContext.broadcast((centres[[r["node"] for r in nodes]], np.array([r["angle"] for r in nodes]), first, held))
    slices = -(-most["anchors"] // SLICE)
    cut = spark.createDataFrame([(r["node"], int(a), int(m)) for r, a, m in zip(nodes, first, many)], "node long, first long, many long")
    candidates = placed.join(F.broadcast(cut), "node").select(
        (F.col("first") + F.pmod(F.xxhash64("row"), F.col("many"))).alias("block"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), F.lit(0).alias("kind"),
        "row", "id", "label", "v", F.lit(None).cast("binary").alias("windows"))
    schema = "block long, slice int, kind int, row long, id long, label long, v binary, windows binary"

    def searched(anchors: DataFrame, windows_of, same: bool, k: int) -> DataFrame:
        """The ``k`` best rows of each anchor in each of its windows: anchor, window, row, id, score."""

        def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centre, radius, first, (x, own_row, own_id, own_label) = known.value
            for whole_batch in batches:
                for at in range(0, whole_batch.num_rows, 1024):
                    b = whole_batch.slice(at, 1024)
                    q, row, label = _doubles(b.column("v"), width), _numbers(b.column("row")), _numbers(b.column("label"))
                    best = Best(windows_of(b), k)
                    everyone = np.arange(len(q))
                    best.take(everyone, q @ x.T, ((own_label == label[:, None]) == same) & (own_row != row[:, None]), own_id, own_row)
                    best.windows[:, :, 0] = best.floor()
                    i, node = np.nonzero(best.wanted(everyone, *bounds(q, centre, radius, largest)))
                    there = first[node + 1] - first[node]
                    i, blocks = np.repeat(i, there), np.repeat(first[node + 1] - np.cumsum(there), there) + np.arange(there.sum())
                    take = pa.array(i)
                    windows = pa.array([w.tobytes() for w in best.windows], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(blocks), *(b.column(c).take(take) for c in ("slice", "kind", "row", "id", "label", "v")), windows.take(take)],
                                                     names=["block", "slice", "kind", "row", "id", "label", "v", "windows"])

        asked = anchors.withColumn("slice", F.pmod(F.xxhash64("row", F.lit(3)), F.lit(slices)).cast("int")).withColumn("kind", F.lit(1)).mapInArrow(visits, schema)
        # a block's vectors, then the anchors that visit it: no task holds more than a block and a batch
        met = candidates.unionByName(asked).repartition(parts, "block", "slice").sortWithinPartitions("block", "slice", "kind")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            current, held, tree = None, [], None
            for b in batches:
                where = np.stack([_numbers(b.column(c)) for c in ("block", "slice", "kind")], 1) if b.num_rows else np.zeros((0, 3), np.int64)
                cuts = np.flatnonzero(np.append(True, (where[1:] != where[:-1]).any(1))) if len(where) else []
                for a, z in zip(cuts, [*cuts[1:], len(where)]):
                    part, here, kind = b.slice(a, z - a), tuple(where[a, :2].tolist()), where[a, 2]
                    if here != current:
                        current, held, tree = here, [], None
                    if kind == 0:
                        held.append((_doubles(part.column("v"), width), *(_numbers(part.column(c)) for c in ("row", "id", "label"))))
                        continue
                    if tree is None:
                        x, row, ident, label = (np.concatenate(p) for p in zip(*held))
                        tree = CoverTree(x, largest)
                    for lo in range(0, part.num_rows, 1024):
                        some = part.slice(lo, 1024)
                        own_row, own_label = _numbers(some.column("row")), _numbers(some.column("label"))
                        best = Best(np.frombuffer(b"".join(some.column("windows").to_pylist())).reshape(some.num_rows, -1, 2).copy(), k)

                        def score(anchors, rows, products):
                            ok = ((label[rows] == own_label[anchors, None]) == same) & (row[rows] != own_row[anchors, None])
                            best.take(anchors, products, ok, ident[rows], row[rows])

                        tree.search(_doubles(some.column("v"), width), best.wanted, score)
                        i, w, j = np.nonzero(best.score > _NONE)
                        yield pa.RecordBatch.from_arrays([pa.array(own_row[i]), pa.array(w), pa.array(best.row[i, w, j]), pa.array(best.id[i, w, j]), pa.array(best.score[i, w, j].astype(np.int64))],
                                                         names=["anchor", "window", "row", "id", "score"])

        found = met.mapInArrow(run, "anchor long, window long, row long, id long, score long")
        order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id", "row")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    anchors = placed.where("anchor").select("row", "id", "label", "v")
    best = searched(anchors, lambda b: np.broadcast_to([_NONE, np.inf], (b.num_rows, 1, 2)).copy(), True, positives)
    pairs = common.scratch(best.select("anchor", (F.col("rank") - 1).cast("long").alias("window"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    scores = pairs.groupBy("anchor").agg(F.transform(F.sort_array(F.collect_list(F.struct("window", "positive_score"))), lambda r: r["positive_score"]).alias("scores"))   # at most ``positives`` each

    def between(b: pa.RecordBatch) -> np.ndarray:
        """Whole scores from ``low`` to ``high`` per cent of each positive's; none where there is no positive."""
        out = np.empty((b.num_rows, positives, 2))
        out[:, :, 0], out[:, :, 1] = np.inf, _NONE
        for i, of in enumerate(b.column("scores").to_pylist()):
            for w, s in enumerate(of):
                out[i, w] = -(-low * s // 100), high * s // 100
        return out

    far = searched(anchors.join(scores, F.col("row") == F.col("anchor")).drop("anchor"), between, False, negatives)
    far = far.select("anchor", "window", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = pairs.join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    return far.join(named, ["anchor", "window"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
