"""Model jobs: feature clean-up (M3), forest fit and predict (M4, M5), the
training run and trials (M6) and image scoring (M7, A7, C20).

Training and prediction are Spark ML pipelines: the data stays partitioned
on the executors and only split statistics and the fitted trees reach the
driver.  Scoring with an arbitrary Python model runs in ``mapInPandas``: the
model is built once per task and fed batches of at most 64 images.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kensa.functions.errors import capture_error
from kensa.operators import images as im
from kensa.operators.encoding import apply_codes, fit_codes, string_columns
from kensa.operators.filters import drop_datetime, fill_zero
from kensa.operators.history import sample_input
from kensa.operators.metrics import weighted_f1
from kensa.operators.partitioning import spread
from kensa.session import cut_lineage, ship_package

FOREST_TREES, FOREST_SEED, FOREST_DEPTH = 100, 42, 8


# ---- M3: feature clean-up -------------------------------------------------------

@dataclass
class Sanitiser:
    """Fitted clean-up: drop time columns, code text columns, fill zeros."""
    codes: dict[str, DataFrame]
    keep: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        out = apply_codes(drop_datetime(df).select(*self.keep), self.codes)
        return fill_zero(out)


def fit_sanitiser(train: DataFrame, exclude: tuple = ()) -> Sanitiser:
    """M3: codes are fitted on the training rows only; null and values never
    seen in training become -1 in every split."""
    kept = drop_datetime(train)
    text = [c for c in string_columns(kept) if c not in exclude]
    return Sanitiser(fit_codes(kept, text), kept.columns)


def sanitise(df: DataFrame, split_col: str = "split", train_value: str = "train",
             exclude: tuple = ()) -> DataFrame:
    """M3 on a table that carries its split column."""
    train = df.where(F.col(split_col) == train_value)
    return fit_sanitiser(train, exclude=(split_col, *exclude)).transform(df)


# ---- M4 / M5: forest ------------------------------------------------------------

def feature_frame(df: DataFrame, feature_cols: list[str], out: str = "features") -> DataFrame:
    """One ML vector column from numeric and array columns, built in the JVM
    (``concat`` of double arrays, then ``array_to_vector``)."""
    parts = []
    for c in feature_cols:
        dt = df.schema[c].dataType
        parts.append(F.col(c).cast("array<double>") if isinstance(dt, T.ArrayType)
                     else F.array(F.col(c).cast("double")))
    vec = F.concat(*parts) if len(parts) > 1 else parts[0]
    return df.withColumn(out, array_to_vector(vec))


def fit_forest(train: DataFrame, label: str, feature_cols: list[str], num_trees: int = FOREST_TREES,
               max_depth: int = FOREST_DEPTH, seed: int = FOREST_SEED, per_split: str = "auto") -> PipelineModel:
    """M4: fit a seeded random forest on the assembled features; ``per_split``:
    which of them each split looks at (``featureSubsetStrategy``)."""
    forest = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=num_trees,
                                    maxDepth=max_depth, seed=seed, featureSubsetStrategy=per_split)
    return Pipeline(stages=[forest]).fit(feature_frame(train, feature_cols))


def predict(model: PipelineModel, df: DataFrame, feature_cols: list[str]) -> DataFrame:
    """M5: predictions plus the class probabilities as an array."""
    out = model.transform(feature_frame(df, feature_cols))
    return (out.withColumn("probability", vector_to_array("probability"))
               .drop("features", "rawPrediction"))


def save_model(model: PipelineModel, path: str) -> str:
    """Keep a fitted model in a shared folder, for other jobs and streams."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_importances(model: PipelineModel, feature_cols: list[str]) -> list[tuple[str, float]]:
    forest = model.stages[-1]
    return list(zip(feature_cols, forest.featureImportances.toArray().tolist()))


# ---- M6: the training run ---------------------------------------------------------

def run_training(df: DataFrame, label: str, feature_cols: list[str] | None = None, split_col: str = "split",
                 run_id: str | None = None, table: str | None = None,
                 num_trees: int = FOREST_TREES, max_depth: int = FOREST_DEPTH,
                 seed: int = FOREST_SEED, exclude: tuple = ()) -> DataFrame:
    """M6: fit on ``train``, score ``val``, compute the weighted F1 and return
    the run record ``(run_id, metric, value)`` (appended to ``table`` when
    given).  The split must already be assigned (``splits.assign_split``).
    Without ``feature_cols`` the table is raw: it is cleaned first (M3) and
    every column left is a feature but the label, the split and ``exclude``."""
    run_id = run_id or uuid.uuid4().hex
    if feature_cols is None:
        df = sanitise(df, split_col, exclude=(label, *exclude))
        feature_cols = [c for c in df.columns if c not in (label, split_col, *exclude)]
    # Read three times (fit, validation, counts): keep it between the steps.
    own_cache = not df.is_cached
    if own_cache:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    train = df.where(F.col(split_col) == "train")
    val = df.where(F.col(split_col) == "val")
    model = fit_forest(train, label, feature_cols, num_trees, max_depth, seed)
    scored = predict(model, val, feature_cols)
    f1 = weighted_f1(scored.withColumn("prediction", F.col("prediction").cast(
        df.schema[label].dataType)), label, "prediction")
    counts = df.groupBy(split_col).agg(F.count(F.lit(1)).cast("double").alias("value"))
    record = (f1.select(F.lit("val_f1_score").alias("metric"), F.col("f1").alias("value"))
              .unionByName(counts.select(F.concat(F.lit("n_"), F.col(split_col)).alias("metric"), "value"))
              .select(F.lit(run_id).alias("run_id"), "metric", "value"))
    record = cut_lineage(record)  # a few rows; computed once, then the cache can go
    if own_cache:
        df.unpersist()
    if table:
        record.write.mode("append").saveAsTable(table)
    return record


TRIAL_SCHEMA = "run_id string, trial int, num_trees int, max_depth int, val_f1_score double, is_best boolean, model_path string"


def run_trials(df: DataFrame, label: str, feature_cols: list[str], grid: list[dict], path: str, key: str,
               split_col: str = "split", run_id: str | None = None, table: str | None = None,
               parallelism: int = 4, seed: int = FOREST_SEED) -> DataFrame:
    """M6 over a parameter grid (``num_trees``, ``max_depth``): one record per trial.

    Trials are fitted on ``train`` and judged by weighted F1 on ``val``, ``parallelism`` at a
    time (Spark runs their jobs side by side).  The best one -- the first of equally good --
    is flagged, and kept under ``path`` with a sample input (T6, by ``key``): ``<path>/model``,
    ``<path>/sample_input``.  Records are appended to ``table`` when given.
    """
    spark, run_id = df.sparkSession, run_id or uuid.uuid4().hex
    ready = feature_frame(df, feature_cols).select(key, *feature_cols, label, split_col, "features").persist(StorageLevel.MEMORY_AND_DISK)
    train, val = ready.where(F.col(split_col) == "train"), ready.where(F.col(split_col) == "val")
    forest = RandomForestClassifier(labelCol=label, featuresCol="features", seed=seed)
    params = [{forest.numTrees: g.get("num_trees", FOREST_TREES), forest.maxDepth: g.get("max_depth", FOREST_DEPTH)} for g in grid]
    fitted = forest.fitMultiple(train, params)       # safe to draw from by several threads

    def trial(_):
        i, model = next(fitted)
        scored = model.transform(val).withColumn("prediction", F.col("prediction").cast(df.schema[label].dataType))
        return i, model, weighted_f1(scored, label, "prediction").first()["f1"]

    with ThreadPool(max(1, min(parallelism, len(grid)))) as pool:
        done = sorted(pool.imap_unordered(inheritable_thread_target(spark)(trial), range(len(grid))), key=lambda t: t[0])
    best = max(done, key=lambda t: (-1.0 if t[2] is None else t[2], -t[0]))
    save_model(PipelineModel([best[1]]), f"{path}/model")
    sample_input(train.select(key, *feature_cols), key).write.mode("overwrite").parquet(f"{path}/sample_input")
    ready.unpersist()
    rows = [(run_id, i, p[forest.numTrees], p[forest.maxDepth], f1, i == best[0], f"{path}/model" if i == best[0] else None)
            for (i, _, f1), p in zip(done, params)]
    record = spark.createDataFrame(rows, TRIAL_SCHEMA)
    if table:
        record.write.mode("append").saveAsTable(table)
    return record


# ---- M7: batch image scoring ------------------------------------------------------

Scorer = Callable[[list[np.ndarray]], list[tuple[str, float]]]

SCORE_SCHEMA = T.StructType([
    T.StructField("label", T.StringType()), T.StructField("score", T.DoubleType()),
    T.StructField("error", T.StringType()), T.StructField("elapsed_s", T.DoubleType())])


class BrightnessScorer:
    """A stand-in model with no network: ``damaged`` when the mean intensity
    of the resized image is above ``threshold``; score = that mean / 255
    (unrounded)."""

    def __init__(self, threshold: float = 128.0):
        self.threshold = threshold

    def __call__(self, images: list[np.ndarray]) -> list[tuple[str, float]]:
        out = []
        for img in images:
            m = float(img.mean())
            out.append(("damaged" if m > self.threshold else "normal", m / 255.0))
        return out


@capture_error
def _square_of(img, size: int) -> np.ndarray:
    if img is None or img["data"] is None or img["height"] < 1:
        raise ValueError("unreadable image")
    rgb = im.image_to_rgb(int(img["height"]), int(img["width"]), int(img["nChannels"]), img["data"])
    return im.square_resize_np(rgb, size)


def score_chunk(pdf: pd.DataFrame, model: Scorer, image: str = "image", keep: tuple = (),
                size: int = im.SCORE_SIZE) -> pd.DataFrame:
    """One batch of M7: ``keep`` and the columns of ``SCORE_SCHEMA``."""
    t0 = time.perf_counter()
    ready, idx, errors = [], [], [None] * len(pdf)
    for i, img in enumerate(pdf[image]):
        rgb, errors[i] = _square_of(img, size)
        if errors[i] is None:
            ready.append(rgb)
            idx.append(i)
    labels, scores = [None] * len(pdf), [None] * len(pdf)
    try:
        for i, (lab, sc) in zip(idx, model(ready) if ready else []):
            labels[i], scores[i] = lab, float(sc)
    except Exception as e:  # noqa: BLE001 - whole batch failed in the model
        for i in idx:
            errors[i] = f"{type(e).__name__}: {e}"
    out = pdf[list(keep)].reset_index(drop=True).copy()
    out["label"], out["score"], out["error"] = labels, scores, errors
    out["elapsed_s"] = (time.perf_counter() - t0) / max(len(pdf), 1)
    return out


def score_images(df: DataFrame, scorer_factory: Callable[[], Scorer], image: str = "image",
                 keep: tuple = (), size: int = im.SCORE_SIZE, batch_rows: int = im.BATCH_ROWS) -> DataFrame:
    """M7: image -> RGB -> centre square, nearest resize -> scorer -> (label,
    score).  ``scorer_factory`` runs once per task (model load); batches hold
    at most ``batch_rows`` images (I8).  A row whose image cannot be read or
    scored gets an ``error`` text and no score (C20); ``elapsed_s`` is the
    batch's wall time per row (A7)."""
    ship_package(df.sparkSession)
    keep = tuple(keep)
    schema = T.StructType([*[df.schema[k] for k in keep], *SCORE_SCHEMA.fields])

    def run(batches: Iterable[pd.DataFrame]):
        model = scorer_factory()
        for pdf in im.in_batches(batches, batch_rows):
            yield score_chunk(pdf, model, image, keep, size)

    return spread(df.select(*keep, image)).mapInPandas(run, schema)


def score_vectors(model: PipelineModel, df: DataFrame, vector: str = "vector",
                  labels: tuple = ("normal", "damaged")) -> DataFrame:
    """Score model inputs with a fitted forest, all in the JVM: label (``labels`` by class),
    score (probability of that class) and an error where there is no input.  ``df`` must not
    have columns of these names."""
    if clash := {"label", "score", "error"} & set(df.columns):
        raise ValueError(f"rename {sorted(clash)}: the scores take these names")
    width = model.stages[-1].numFeatures
    v = F.col(vector).cast("array<double>")
    usable = F.coalesce(F.size(v) == width, F.lit(False))
    ready = df.withColumn("features", array_to_vector(F.when(usable, v).otherwise(F.array_repeat(F.lit(0.0), width)))).withColumn("_usable", usable)
    out = model.transform(ready)
    at = F.col("prediction").cast("int")
    named = out.select(*df.columns, "_usable", F.get(F.array(*map(F.lit, labels)), at).alias("label"),
                       F.get(vector_to_array("probability"), at).alias("score"))
    error = F.when(~F.col("_usable"), F.lit("unreadable image"))
    return named.select(*df.columns, F.when(F.col("_usable"), F.col("label")).alias("label"),
                        F.when(F.col("_usable"), F.col("score")).alias("score"), error.alias("error"))


def score_images_with(model: PipelineModel, df: DataFrame, side: int, image: str = "image", keep: tuple = (),
                      labels: tuple = ("normal", "damaged")) -> DataFrame:
    """M7 with a fitted forest: image -> ``side`` x ``side`` vector -> (keep, label, score, error).
    The same for a table and for a stream of images."""
    vectors = im.image_vector(df.select(*keep, image), side, image, "_vector").select(*keep, "_vector")
    return score_vectors(model, vectors, "_vector", labels).drop("_vector")


def score_timing(scored: DataFrame) -> DataFrame:
    """Scoring time per image: median (approximate), mean and max, in
    seconds rounded to 3 decimals; one aggregate with partial merges."""
    e = F.col("elapsed_s")
    return scored.agg(F.count(F.lit(1)).alias("n"),
                      F.round(F.percentile_approx(e, 0.5), 3).alias("p50_s"),
                      F.round(F.avg(e), 3).alias("mean_s"), F.round(F.max(e), 3).alias("max_s"),
                      F.count_if(F.col("error").isNotNull()).alias("n_errors"))
