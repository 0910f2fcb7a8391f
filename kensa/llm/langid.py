"""Language ID by a string kernel.

Kernel: two texts share the n-grams (1 to 3 lower-cased characters, the blended
spectrum) present in both; k(x, y) = |x & y| / sqrt(|x| |y|) over the n-grams
that occur in the landmark texts.  Nystroem landmarks are a bounded sample of
learning texts; one-versus-rest ridge regression on the landmark features is
solved from normal equations summed per partition.  A batch of texts becomes a
presence matrix, and its scores are matrix products.

Text decides alone.  Null text, or text without a letter: ``und``, score 0.
Texts sharing no n-gram with any landmark get the prior of the ridge bias.
Whole texts are read, however long; repeated rows are scored alike; an empty
table gives an empty result; columns beside the named ones are not touched.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kensa.llm import common

N_LANDMARKS = 96          # landmark texts, spread evenly over the languages
N_LEARN = 4000            # learning rows, spread evenly over the languages (expected number)
LANDMARK_CHARS = 20_000   # characters of a text that a landmark takes; learning and predictions take whole texts
DENSE = 1 << 22           # largest n-gram table kept dense; larger ones are searched
RIDGE = 1e-3
ROWS_AT_ONCE = 64


class Steps:
    """Number of each (state, character) step, 0 for steps that no landmark makes."""

    def __init__(self, codes: np.ndarray, states: int, chars: int):
        """``codes``: state * chars + character of steps 1, 2, ..., ascending."""
        self.chars, self.count = chars, len(codes) + 1
        self.codes, self.dense = codes, None
        if states * chars <= DENSE:
            self.dense = np.zeros(states * chars, np.int32)
            self.dense[codes] = np.arange(1, self.count)

    def __getitem__(self, at: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        code = at[0] * self.chars + at[1]
        if self.dense is not None:
            return self.dense[code]
        if not len(self.codes):
            return np.zeros(len(code), np.int64)
        place = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[place] == code, place + 1, 0)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    lower: np.ndarray      # code point -> landmark alphabet id (0: none)
    two: Steps             # (char, char) -> bigram id (0: not in any landmark)
    three: Steps           # (bigram, char) -> trigram id
    landmarks: np.ndarray  # n-grams x landmarks, scaled by 1 / sqrt(|landmark|)
    weights: np.ndarray    # landmarks + 1 x languages


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 rows, and each row's first."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), np.uint32)
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    return points, heads[offsets]


def _grams(model: Model, points: np.ndarray, first: np.ndarray):
    """n-gram ids at each place and the places where they may start (inside one row)."""
    one = model.lower[points].astype(np.int64)
    left = np.repeat(first[1:], np.diff(first)) - np.arange(len(points))  # characters to the row's end
    two = model.two[one[:-1], one[1:]] if len(one) > 1 else np.zeros(0, np.int64)
    two = np.where(left[:len(two)] >= 2, two, 0)
    three = model.three[two[:-1], one[2:]] if len(one) > 2 else np.zeros(0, np.int64)
    three = np.where(left[:len(three)] >= 3, three, 0)
    a, b = model.two.chars, model.two.count
    return one, np.where(two > 0, two + a - 1, 0), np.where(three > 0, three + a + b - 2, 0)


def features(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Landmark kernel values of each row (with a bias column), and whether it has a letter."""
    points, first = _points(data, offsets)
    n = len(offsets) - 1
    out = np.zeros((n, model.landmarks.shape[1] + 1))
    out[:, -1] = 1
    letters = np.add.reduceat(np.append(_letters()[points], False).astype(np.int64), first[:-1]) * (np.diff(first) > 0) > 0
    for lo in range(0, n, ROWS_AT_ONCE):
        hi = min(n, lo + ROWS_AT_ONCE)
        span = first[lo:hi + 1]
        part = span - span[0]
        row = common.row_of(part)
        present = np.zeros((hi - lo, model.landmarks.shape[0]), np.float32)
        for ids in _grams(model, points[span[0]:span[-1]], part):
            present[row[:len(ids)], ids] = 1
        present[:, 0] = 0
        size = np.maximum(present.sum(1, dtype=np.float64), 1)
        out[lo:hi, :-1] = (present @ model.landmarks) / np.sqrt(size)[:, None]
    return out, letters


def _compile(texts: list[str]) -> tuple:
    """Alphabet and n-gram tables of the landmark texts, and their presence matrix."""
    texts = [t.lower() for t in texts]
    chars = {c: i + 1 for i, c in enumerate(sorted(set("".join(texts))))}
    lower = np.zeros(0x110000, np.int32)
    for c, i in chars.items():
        lower[ord(c)] = i
        for up in {c.upper(), c.title()}:
            if len(up) == 1:
                lower[ord(up)] = i
    twos = {g: i + 1 for i, g in enumerate(sorted({t[i:i + 2] for t in texts for i in range(len(t) - 1)}))}
    threes = {g: i + 1 for i, g in enumerate(sorted({t[i:i + 3] for t in texts for i in range(len(t) - 2)}))}
    width = len(chars) + 1
    two = Steps(np.array([chars[g[0]] * width + chars[g[1]] for g in twos], np.int64), width, width)
    three = Steps(np.array([twos[g[:2]] * width + chars[g[2]] for g in threes], np.int64), len(twos) + 1, width)
    return lower, two, three, 1 + len(chars) + len(twos) + len(threes)


def fit(spark, learn: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model:
    """Learn from the rows of ``learn`` (text, lang, key); rows without text or lang are left out.

    A bounded sample, alike for every language: about ``N_LEARN`` rows in all (one of each
    language at least), chosen by a hash of the key.  Landmarks are rows of it, alike for the
    languages, or for the most frequent ones where there are more languages than landmarks;
    texts of 20 to ``LANDMARK_CHARS`` characters come before others.  Where nothing can be
    learnt, every prediction is ``und``.
    """
    rows = learn.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(F.col(key).cast("string"), F.lit(17)).alias("h")) \
        .where(F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = common.scratch(rows.groupBy("lang").agg(F.count("*").alias("n"), F.min(F.pmod("h", F.lit(1_000_000))).alias("least")), "languages")
    names = [r["lang"] for r in counts.orderBy(F.desc("n"), "lang").collect()]    # what is learnt: one name and one column of weights each
    if not names:
        return Model((), *_compile([])[:3], np.zeros((1, 0), np.float32), np.zeros((1, 0)))
    languages = tuple(sorted(names))
    share = F.least(F.lit(1.0), F.lit(N_LEARN / len(names)) / F.col("n"))
    limit = counts.select("lang", F.greatest((share * 1_000_000).cast("long"), F.col("least")).alias("limit"))
    sample = common.scratch(rows.join(limit, "lang").where(F.pmod("h", F.lit(1_000_000)) <= F.col("limit")).drop("limit"), "langid")
    each, most = max(1, N_LANDMARKS // len(languages)), names[:N_LANDMARKS]
    from pyspark.sql import Window
    fit_length = F.length("text").between(20, LANDMARK_CHARS)
    ranked = sample.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc(fit_length), "h", "text"))).where((F.col("r") <= each) & F.col("lang").isin(most))
    marks = [r["text"] for r in ranked.orderBy("lang", "r").select(F.substring("text", 1, LANDMARK_CHARS).alias("text")).collect()]
    lower, two, three, n_grams = _compile(marks)
    model = Model(languages, lower, two, three, np.zeros((n_grams, 0), np.float32), np.zeros((1, len(languages))))
    grams = np.zeros((n_grams, len(marks)), np.float32)
    for j, mark in enumerate(marks):
        points = np.frombuffer(mark.encode("utf-32-le", "replace"), np.uint32)
        for ids in _grams(model, points, np.array([0, len(points)])):
            grams[ids, j] = 1
    grams[0] = 0
    grams /= np.sqrt(np.maximum(grams.sum(0), 1))
    model = Model(languages, lower, two, three, grams, np.zeros((len(marks) + 1, len(languages))))
    shared = spark.sparkContext.broadcast(model)
    place = {k: i for i, k in enumerate(languages)}

    def sums(batches):
        m = shared.value
        width = m.landmarks.shape[1] + 1
        gram, right = np.zeros((width, width)), np.zeros((width, len(place)))
        for batch in batches:
            for rows, data, offsets in common.pieces(batch):
                x, _ = features(m, data, offsets)
                y = np.zeros((len(x), len(place)))
                y[np.arange(len(x)), [place[v] for v in rows.column("lang").to_pylist()]] = 1
                gram += x.T @ x
                right += x.T @ y
        yield pa.RecordBatch.from_pydict({"gram": [gram.tobytes()], "right": [right.tobytes()]})

    parts = sample.select("text", "lang").repartition(8).mapInArrow(sums, "gram binary, right binary").collect()
    width = len(marks) + 1
    gram = sum(np.frombuffer(p["gram"]).reshape(width, width) for p in parts)
    right = sum(np.frombuffer(p["right"]).reshape(width, -1) for p in parts)
    weights = np.linalg.solve(gram + RIDGE * max(1.0, gram[-1, -1]) / width * np.eye(width), right)
    return Model(languages, lower, two, three, grams, weights)


def predict(df: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus lang_pred and score for every row."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(model)
    narrow = df.select(*keep, F.col(text).alias("__text"))

    def score(batches):
        m = shared.value
        names = np.array([*m.languages, "und"], dtype=object)
        for batch in batches:
            for rows, data, offsets in common.pieces(batch, "__text"):
                x, letters = features(m, data, offsets)
                y = x @ m.weights
                if not m.languages:
                    y, letters = np.zeros((len(x), 1)), np.zeros(len(x), bool)
                best = np.where(letters, y.argmax(1), len(m.languages))
                top = np.where(letters, np.clip(y.max(1), 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(names[best], pa.string()), pa.array(top)], names=[*keep, "lang_pred", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1])
    return narrow.mapInArrow(score, f"{schema}, lang_pred string, score double")
