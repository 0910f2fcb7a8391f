"""Registered model queries: clean-up, forest, training run, scoring (M3-M7,
A7, I8).  The forest runs on ``features`` with the planted label."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kensa.operators import images as im
from kensa.operators import ml
from kensa.operators import splits as sp
from kensa.plans import views as v
from kensa.operators.metrics import weighted_f1
from kensa.plans.image_queries import _PIXELS_SQL, SIDE, _gray_images
from kensa.plans.registry import register
from kensa.session import scratch_path
from kensa.sources.tables import table

FEATURES = ["embedding"]


def _code_sql(col: str) -> str:
    return f"""{col}_codes AS (SELECT v, CAST(dense_rank() OVER (ORDER BY v) - 1 AS INTEGER) AS code
      FROM (SELECT DISTINCT {col} AS v FROM s WHERE split = 'train' AND {col} IS NOT NULL))"""


@register("M3_sanitise", f"""
WITH s AS (SELECT *, {sp.split_sql('o_orderkey')} AS split FROM orders),
{_code_sql('o_orderstatus')}, {_code_sql('o_orderpriority')}
SELECT s.o_orderkey, coalesce(s.o_custkey, 0) AS o_custkey, coalesce(a.code, -1) AS o_orderstatus,
       coalesce(s.o_totalprice, 0) AS o_totalprice, coalesce(b.code, -1) AS o_orderpriority, s.split
FROM s LEFT JOIN o_orderstatus_codes a ON s.o_orderstatus = a.v
       LEFT JOIN o_orderpriority_codes b ON s.o_orderpriority = b.v""")
def m3(spark, sf_dir):
    df = sp.assign_split(table(spark, sf_dir, "orders"), "o_orderkey")
    return ml.sanitise(df)


def _split_features(spark, sf_dir):
    return sp.assign_split(v.features(spark, sf_dir), "vec_id")


_SAVED: dict[tuple[str, str, str], str] = {}


def _saved(spark, sf_dir, kind: str, fit) -> str:
    """Where the model of ``kind`` for this input is kept: fitted and saved by the first
    query of an application that needs it, loaded by the others."""
    at = (spark.sparkContext.applicationId, sf_dir, kind)
    if at not in _SAVED:
        _SAVED[at] = ml.save_model(fit(), scratch_path(spark, f"model-{kind}"))
    return _SAVED[at]


def _fit(spark, sf_dir):
    return ml.fit_forest(_split_features(spark, sf_dir).where(F.col("split") == "train"), "planted", FEATURES)


def _forest(spark, sf_dir):
    return ml.load_model(_saved(spark, sf_dir, "features", lambda: _fit(spark, sf_dir)))


def saved_image_forest(spark, sf_dir) -> str:
    """A forest fitted on the images of the training split, as a path.  Each split looks
    at all pixels: the planted label hangs on one of them."""
    def fit():
        images = sp.assign_split(v.features(spark, sf_dir), "vec_id").where(F.col("split") == "train")
        pixels = im.pixels_from_floats("embedding")
        images = images.select("planted", im.gray_image_struct("vec_id", pixels, SIDE, SIDE).alias("image"))
        return ml.fit_forest(im.image_vector(images, SIDE).select("planted", "vector"), "planted", ["vector"], num_trees=20, per_split="all")
    return _saved(spark, sf_dir, "images", fit)


# Labels are compared where the planted one is clear, scores by their range.
CLEAR = 0.05
FOREST_SQL = f"""CASE WHEN abs(embedding[1]) > {CLEAR} THEN CASE WHEN embedding[1] > 0 THEN 'damaged' ELSE 'normal' END END AS label,
       true AS scored, CAST(NULL AS VARCHAR) AS error"""


def clear_label(scored):
    """``scored`` (with the embedding) in the form of ``FOREST_SQL``."""
    return scored.withColumn("label", F.when(F.abs(F.col("embedding")[0].cast("double")) > CLEAR, F.col("label"))) \
        .withColumn("scored", F.col("score").between(0.5, 1.0))


@register("M7_score_images_forest", v.with_views(["features"], f"SELECT vec_id, {FOREST_SQL} FROM features"))
def m7_forest(spark, sf_dir):
    """Fitted on the training split, saved, loaded, and applied to all images."""
    images = _gray_images(spark, sf_dir)
    scored = ml.score_images_with(ml.load_model(saved_image_forest(spark, sf_dir)), images, SIDE, keep=("vec_id",))
    return clear_label(scored.join(v.features(spark, sf_dir).select("vec_id", "embedding"), "vec_id")).select("vec_id", "label", "scored", "error")


@register("M4_fit_forest")
def m4(spark, sf_dir):
    forest = _fit(spark, sf_dir).stages[-1]
    imp = forest.featureImportances.toArray().tolist()  # one value per feature
    return spark.createDataFrame([(i, float(x)) for i, x in enumerate(imp)], "feature int, importance double")


# The feature most correlated with the label is the one the forest must find.
@register("M4_forest_summary", v.with_views(["features"], """
SELECT max(n) AS n_features, CAST(round(sum(share), 6) AS DOUBLE) AS importance_sum, arg_max(i, r) AS top_feature
FROM (SELECT *, r / sum(r) OVER () AS share
      FROM (SELECT i, max(len(embedding)) AS n, abs(corr(embedding[i + 1], planted)) AS r
            FROM features, range(64) AS s(i) GROUP BY i))"""))
def m4_summary(spark, sf_dir):
    return m4(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_features"), F.round(F.sum("importance"), 6).alias("importance_sum"),
                                 F.max_by("feature", "importance").alias("top_feature"))


# The forest looks at 8 of 64 features at a split, so only clearly planted rows are sure to be right.
@register("M5_predict_rows", v.with_views(["features"], f"""
SELECT vec_id, planted, true AS sums_to_one, CASE WHEN abs(embedding[1]) > 0.2 THEN CAST(planted AS DOUBLE) END AS clear_prediction
FROM features WHERE {sp.split_sql('vec_id')} = 'val'"""))
def m5_rows(spark, sf_dir):
    val = _split_features(spark, sf_dir).where(F.col("split") == "val")
    out = ml.predict(_forest(spark, sf_dir), val, FEATURES)
    total = F.aggregate("probability", F.lit(0.0), lambda a, x: a + x)
    clear = F.abs(F.col("embedding")[0].cast("double")) > 0.2
    return out.select("vec_id", "planted", (F.abs(total - 1) < 1e-9).alias("sums_to_one"), F.when(clear, F.col("prediction")).alias("clear_prediction"))


# Quality as it was marked, from counts of signs: no feature holds the label.
_GRID = [{"num_trees": n, "max_depth": d} for n in (10, 40) for d in (2, 6)]


def _document_features(spark, sf_dir):
    text, words = F.col("text"), F.split("text", r"\s+")
    n = F.greatest(F.length(text), F.lit(1))
    share = lambda pattern: F.regexp_count(text, F.lit(pattern)) / n
    labelled = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")
    return sp.assign_split(labelled.where("text is not null and quality is not null").select(
        "doc_id", "quality", F.length(text).cast("double").alias("chars"), share("[A-Za-z]").alias("letters"), share("[0-9]").alias("digits"),
        share(r"\s").alias("spaces"), share(r"[^\sA-Za-z0-9]").alias("signs"), (F.size(F.array_distinct(words)) / F.size(words)).alias("distinct_words")), "doc_id")


@register("M6_trials", "SELECT * FROM (VALUES " + ", ".join(f"({i}, {g['num_trees']}, {g['max_depth']}, true, true, true, CAST(1 AS BIGINT))" for i, g in enumerate(_GRID))
          + ") AS t(trial, num_trees, max_depth, judged, good_best, kept_best, n_best)")
def m6_trials(spark, sf_dir):
    """One row per trial; the best one's F1 is 0.9 or more, and the model kept for it gives it again."""
    df, path = _document_features(spark, sf_dir), scratch_path(spark, "m6-trials")
    features = [c for c in df.columns if c not in ("doc_id", "quality", "split")]
    record = ml.run_trials(df, "quality", features, _GRID, path, "doc_id")
    again = ml.predict(ml.load_model(f"{path}/model"), df.where("split = 'val'"), features)
    f1 = weighted_f1(again.withColumn("prediction", F.col("prediction").cast("int")), "quality", "prediction").first()["f1"]
    sample = spark.read.parquet(f"{path}/sample_input").count()
    best = Window.partitionBy()
    return record.select("trial", "num_trees", "max_depth", F.col("val_f1_score").between(0, 1).alias("judged"), (F.max("val_f1_score").over(best) >= 0.9).alias("good_best"),
                         ((F.abs(F.max(F.when(F.col("is_best"), F.col("val_f1_score"))).over(best) - f1) < 1e-9) & F.lit(sample == 1)).alias("kept_best"), F.count_if("is_best").over(best).alias("n_best"))


@register("M6_training_on_raw_columns", f"""
WITH s AS (SELECT {sp.split_sql('o_orderkey')} AS split FROM orders)
SELECT 'n_' || split AS metric, CAST(count(*) AS DOUBLE) AS value, false AS good_f1 FROM s GROUP BY split
UNION ALL SELECT 'val_f1_score' AS metric, NULL AS value, count(*) > 0 AS good_f1 FROM s""")
def m6_raw(spark, sf_dir):
    """Orders as they are (dates, text, numbers), labelled by price: split
    counts, and whether F1 is at least 0.9."""
    df = table(spark, sf_dir, "orders").withColumn("costly", (F.col("o_totalprice") > 250000).cast("int"))
    record = ml.run_training(sp.assign_split(df, "o_orderkey"), "costly", run_id="kensa-m6-raw", exclude=("o_orderkey",))
    f1 = F.col("metric") == "val_f1_score"
    return record.select("metric", F.when(~f1, F.col("value")).alias("value"), (f1 & (F.col("value") >= 0.9)).alias("good_f1"))


@register("M5_predict")
def m5(spark, sf_dir):
    val = _split_features(spark, sf_dir).where(F.col("split") == "val")
    out = ml.predict(_forest(spark, sf_dir), val, FEATURES)
    return out.select("vec_id", "planted", "prediction", F.element_at("probability", 2).alias("p_damaged"))


@register("M6_run_training")
def m6(spark, sf_dir):
    return ml.run_training(_split_features(spark, sf_dir), "planted", FEATURES, run_id="kensa-m6")


_SCORE_SQL = v.with_views(["features"], f"""
SELECT vec_id, CASE WHEN list_avg(p) > 128 THEN 'damaged' ELSE 'normal' END AS label,
       list_avg(p) / 255.0 AS score, CAST(NULL AS VARCHAR) AS error
FROM ({_PIXELS_SQL})""")


def _scored(spark, sf_dir, batch_rows):
    return ml.score_images(_gray_images(spark, sf_dir), ml.BrightnessScorer, keep=("vec_id",),
                           batch_rows=batch_rows)


@register("M7_score_images", _SCORE_SQL)
def m7(spark, sf_dir):
    return _scored(spark, sf_dir, 64).drop("elapsed_s")


@register("I8_score_batches", _SCORE_SQL)
def i8(spark, sf_dir):
    # An odd batch size must not change any result.
    schema = T.StructType([T.StructField("vec_id", T.LongType()), *ml.SCORE_SCHEMA.fields])
    out = im.score_batches(_gray_images(spark, sf_dir), lambda pdf: ml.score_chunk(pdf, ml.BrightnessScorer(), keep=("vec_id",)),
                           schema, rows=7)
    return out.drop("elapsed_s")


@register("A7_score_timing")
def a7(spark, sf_dir):
    return ml.score_timing(_scored(spark, sf_dir, 64))
