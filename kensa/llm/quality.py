"""Quality scores: random Fourier features of document statistics, ridge, isotonic calibration.

Statistics of the whole text (lengths, character classes, repetition, line
shape) are standardised and mapped to random cosines, which approximate a
Gaussian kernel.  Ridge weights come from normal equations summed per partition;
an isotonic fit on the other half of the learning rows turns scores into
probabilities.  Null and empty texts have all-zero counts and are scored like
any other, whole texts of any length; repeated rows and ties get equal scores; extra columns
are not touched; an empty table gives an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kensa.llm import common

N_LEARN = 60_000      # labelled rows learnt from at most (expected number, by a hash of the key)
N_COSINES = 256
BANDWIDTH = 4.0
RIDGE = 1e-3
THRESHOLD = 0.3

_CLASS = np.zeros(256, np.int64)  # 0 other symbol, 1 lower, 2 upper, 3 digit, 4 blank, 5 newline, 6 sentence mark, 7 non-ASCII
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[[32, 9, 11, 12, 13]], _CLASS[10], _CLASS[128:] = 1, 2, 3, 4, 5, 7
_CLASS[[ord(c) for c in ".,;:?'-\"()"]] = 6
N_STATS = 20


def _per_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return sums[first[1:]] - sums[first[:-1]]


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of ``N_STATS`` numbers for each text."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    kinds = np.bincount(np.repeat(np.arange(n), np.diff(offsets)) * 8 + _CLASS[data], minlength=8 * n).reshape(n, 8)
    share = kinds / np.maximum(size, 1)[:, None]
    starts, ends, first = common.find_words(data, offsets)
    h = common.hash_words(data, starts, ends)
    words = np.diff(first).astype(float)
    some = np.maximum(words, 1)
    row = common.row_of(first)
    length = (ends - starts).astype(float)
    head = data[starts] if len(starts) else np.zeros(0, np.uint8)
    tail = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    order = np.lexsort((h, row))
    fresh = np.ones(len(h), bool)
    fresh[1:] = (row[order][1:] != row[order][:-1]) | (h[order][1:] != h[order][:-1])
    distinct = _per_row(fresh, first)
    again = np.zeros(len(h))
    again[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    mean = _per_row(length, first) / some
    spread = np.sqrt(np.maximum(_per_row(length ** 2, first) / some - mean ** 2, 0))
    tails = _CLASS[tail]
    alone = (ends - starts == 1) & (_CLASS[head] == 0) if len(starts) else np.zeros(0)
    entropy = -(share * np.log(np.maximum(share, 1e-12))).sum(1)
    pair = np.zeros(len(h), np.uint64)
    pair[:-1] = common.mix(h[:-1] * np.uint64(3) + h[1:])
    order = np.lexsort((pair, row))
    fresh = np.ones(len(h), bool)
    fresh[1:] = (row[order][1:] != row[order][:-1]) | (pair[order][1:] != pair[order][:-1])
    return np.column_stack([
        np.log1p(size), np.log1p(words), mean, spread, *share.T,
        distinct / np.maximum(words, 1) ** 0.8, _per_row(fresh, first) / some, _per_row(again, first) / some,
        _per_row((tails == 0) & (length > 1), first) / some, _per_row(alone, first) / some,
        _per_row(_CLASS[head] == 2, first) / some, np.log1p(kinds[:, 5]), entropy])


def with_statistics(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    narrow = df.select(*keep, F.col(text).alias("__text"))

    def run(batches):
        for batch in batches:
            for rows, data, offsets in common.pieces(batch, "__text", common.PIECE_BYTES // 2):
                s = np.ascontiguousarray(statistics(data, offsets))
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array([r.tobytes() for r in s], pa.binary())], names=[*keep, "stats"])
        common.release()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1])
    return narrow.mapInArrow(run, f"{schema}, stats binary")


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: np.ndarray    # isotonic knots: score
    levels: np.ndarray   # and calibrated value

    def cosines(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        return np.column_stack([np.sqrt(2 / N_COSINES) * np.cos(z @ self.waves + self.phases), np.ones(len(z))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.cosines(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.steps, self.levels), 0, 1)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots of a non-decreasing fit of y on x."""
    xs, inverse = np.unique(x, return_inverse=True)
    total, weight = np.bincount(inverse, y), np.bincount(inverse).astype(float)
    pools: list[list[float]] = []
    for i in range(len(xs)):
        pools.append([total[i], weight[i], xs[i], xs[i]])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            t, w, _, hi = pools.pop()
            pools[-1][0] += t
            pools[-1][1] += w
            pools[-1][3] = hi
    steps = np.array([v for p in pools for v in p[2:]])
    levels = np.repeat([(p[0] + 0.5) / (p[1] + 1) if p[1] < 20 else p[0] / p[1] for p in pools], 2)
    return steps, np.maximum.accumulate(levels)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    values = batch.column(batch.schema.get_field_index("stats"))
    return np.frombuffer(b"".join(values.to_pylist()), float).reshape(-1, N_STATS)


def fit(learn: DataFrame, seed: int = 5) -> Model:
    """Learn from rows with ``stats``, ``quality`` (0/1, others are left out) and ``h`` (a hash of the key).

    About ``N_LEARN`` rows at most, chosen by ``h``; two thirds give the ridge
    weights, the others the calibration.  Without a labelled row every score is a half.
    """
    spark = learn.sparkSession
    rows = learn.where(F.col("quality").isin(0, 1)).select("stats", F.col("quality").cast("double").alias("y"), "h")
    n = rows.count()
    if n == 0:
        return Model(np.zeros(N_STATS), np.ones(N_STATS), np.zeros((N_STATS, N_COSINES)), np.zeros(N_COSINES), np.zeros(N_COSINES + 1), np.zeros(1), np.full(1, 0.5))
    if n > N_LEARN:
        rows = rows.where(F.pmod("h", F.lit(1_000_003)) < int(1_000_003 * N_LEARN / n))
    rows = common.scratch(rows.repartition(16, "h"), "quality")

    def moments(batches):
        out = np.zeros((2, N_STATS))
        n = 0
        for b in batches:
            x = _matrix(b)
            out += [x.sum(0), (x ** 2).sum(0)]
            n += len(x)
        yield pa.RecordBatch.from_pydict({"sums": [out.tobytes()], "n": [n]})

    got = rows.mapInArrow(moments, "sums binary, n long").collect()
    n = sum(r["n"] for r in got)
    first, second = sum(np.frombuffer(r["sums"]).reshape(2, -1) for r in got) / n
    scale = np.sqrt(np.maximum(second - first ** 2, 1e-12))
    scale[scale < 1e-6] = 1
    rng = np.random.default_rng(seed)
    model = Model(first, scale, rng.normal(0, 1 / BANDWIDTH, (N_STATS, N_COSINES)), rng.uniform(0, 2 * np.pi, N_COSINES), np.zeros(N_COSINES + 1), np.zeros(1), np.zeros(1))
    third = F.pmod(F.hash("h"), F.lit(3)) == 0
    shared = spark.sparkContext.broadcast(model)

    def normal(batches):
        gram, right = np.zeros((N_COSINES + 1, N_COSINES + 1)), np.zeros(N_COSINES + 1)
        for b in batches:
            x = shared.value.cosines(_matrix(b))
            gram += x.T @ x
            right += x.T @ b.column("y").to_numpy()
        yield pa.RecordBatch.from_pydict({"gram": [gram.tobytes()], "right": [right.tobytes()]})

    got = rows.where(~third).mapInArrow(normal, "gram binary, right binary").collect()
    gram = sum(np.frombuffer(r["gram"]).reshape(N_COSINES + 1, -1) for r in got)
    right = sum(np.frombuffer(r["right"]) for r in got)
    weights = np.linalg.solve(gram + RIDGE * max(1.0, gram[-1, -1]) / N_COSINES * np.eye(N_COSINES + 1), right)
    model = Model(first, scale, model.waves, model.phases, weights, np.zeros(1), np.zeros(1))
    fitted = spark.sparkContext.broadcast(model)

    def raw(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"x": fitted.value.raw(_matrix(b)), "y": b.column("y")})

    held = rows.where(third)
    held = rows if held.isEmpty() else held
    table = held.mapInArrow(raw, "x double, y double").toPandas()
    steps, levels = isotonic(table["x"].to_numpy(), table["y"].to_numpy())
    return Model(first, scale, model.waves, model.phases, weights, steps, levels)


def score(df: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Calibrated score and prediction of rows with ``stats``."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    narrow = df.select(*keep, "stats")

    def run(batches):
        for b in batches:
            if b.num_rows:
                s = shared.value.score(_matrix(b))
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], names=[*keep, "score", "predicted"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1])
    return narrow.mapInArrow(run, f"{schema}, score double, predicted int")


def accepted(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``df`` whose text scores ``THRESHOLD`` or more, with all their columns."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for rows, data, offsets in common.pieces(batch, text, common.PIECE_BYTES // 2):
                yield rows.filter(pa.array(shared.value.score(statistics(data, offsets)) >= THRESHOLD))
        common.release()

    return df.mapInArrow(run, df.schema)
