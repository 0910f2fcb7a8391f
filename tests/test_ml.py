import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from kensa.operators import ml
from kensa.operators import splits as sp
from kensa.operators.images import gray_image_struct
from kensa.operators.metrics import per_class_f1, weighted_f1
from kensa.plans import views as v
from kensa.sources import files as fs


def test_weighted_f1_matches_hand_computation(spark):
    pairs = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(1, 0)] * 1 + [(2, 1)] * 2
    df = spark.createDataFrame(pairs, "label int, pred int")
    got = weighted_f1(df, "label", "pred").first().f1
    # per class: 0: p=5/6 r=5/7; 1: p=3/7 r=3/4; 2: p=0 r=0
    f = lambda p, r: 0 if p + r == 0 else 2 * p * r / (p + r)
    want = (f(5 / 6, 5 / 7) * 7 + f(3 / 7, 3 / 4) * 4 + 0 * 2) / 13
    assert abs(got - want) < 1e-12
    assert per_class_f1(df, "label", "pred").count() == 3


def test_sanitise_codes_fitted_on_train(spark):
    df = spark.createDataFrame([
        (1, "b", 1.0, "train"), (2, "a", None, "train"), (3, None, 2.0, "train"),
        (4, "zz", 3.0, "val"), (5, "b", 4.0, "val")], "k int, s string, x double, split string")
    got = {r.k: (r.s, r.x) for r in ml.sanitise(df).collect()}
    assert got == {1: (1, 1.0), 2: (0, 0.0), 3: (-1, 2.0), 4: (-1, 3.0), 5: (1, 4.0)}


def test_training_run_on_planted_label(spark):
    df = sp.assign_split(v.features(spark, SF_MID), "vec_id")
    rec = {r.metric: r.value for r in ml.run_training(df, "planted", ["embedding"], run_id="t").collect()}
    assert rec["val_f1_score"] > 0.9
    assert rec["n_train"] + rec["n_val"] + rec["n_test"] == 500


def test_score_images_reports_errors_per_row(spark, image_tree):
    root, files = image_tree
    df = fs.read_images(spark, str(root), glob=fs.IMAGE_GLOB)
    out = ml.score_images(df.withColumn("origin", F.col("image.origin")), ml.BrightnessScorer,
                          keep=("origin",), batch_rows=2).collect()
    bad = [r for r in out if r.origin.endswith("broken.jpg")]
    assert len(bad) == 1 and bad[0].score is None and bad[0].error
    good = [r for r in out if r.error is None]
    assert len(good) == len(files) and all(r.label in ("damaged", "normal") for r in good)
    t = ml.score_timing(spark.createDataFrame(out)).first()
    assert t.n == len(out) and t.n_errors == 1


def test_failing_model_gives_error_rows_not_failure(spark):
    class Broken:
        def __call__(self, images):
            raise RuntimeError("model down")
    pix = list(range(64))
    df = spark.createDataFrame([(1, pix)], "vec_id long, p array<int>").select(
        "vec_id", gray_image_struct("vec_id", F.col("p"), 8, 8).alias("image"))
    r = ml.score_images(df, Broken, keep=("vec_id",)).first()
    assert r.label is None and "model down" in r.error


def test_code_tables_small_and_large_paths_agree(spark):
    from kensa.operators.encoding import apply_codes, fit_codes
    df = spark.createDataFrame([(i, f"v{i % 37:03d}" if i % 11 else None) for i in range(500)], "k int, s string")
    small = {r.k: r.s for r in apply_codes(df, fit_codes(df, ["s"])).collect()}
    large = {r.k: r.s for r in apply_codes(df, fit_codes(df, ["s"], max_bytes=5)).collect()}
    assert small == large
    assert min(small.values()) == -1 and max(small.values()) == 36


def test_codes_follow_each_type_order(spark):
    from kensa.operators.encoding import category_codes
    df = spark.createDataFrame([(1, 9, "b"), (2, 10, "a"), (3, 100, "c")], "k int, n int, s string")
    got = {r.k: (r.n, r.s) for r in category_codes(df, ["n", "s"]).collect()}
    assert got == {1: (0, 1), 2: (1, 0), 3: (2, 2)}  # 9 < 10 < 100 numerically


def _labelled(spark, n=400):
    return sp.assign_split(spark.range(n).selectExpr("id", "double(id % 20) x", "double(id % 7) y", "int(id % 20 > 11) label"), "id")


def test_trials_keep_the_best_model(spark, tmp_path):
    df, path, table = _labelled(spark), str(tmp_path / "run"), "kensa_trials"
    grid = [{"num_trees": 1, "max_depth": 0}, {"num_trees": 5, "max_depth": 4}, {"num_trees": 5, "max_depth": 4}]
    try:
        rec = ml.run_trials(df, "label", ["x", "y"], grid, path, "id", run_id="r", table=table, parallelism=3).collect()
        assert [r.trial for r in rec] == [0, 1, 2] and [r.is_best for r in rec] == [False, True, False]     # the first of equally good ones
        assert rec[0].val_f1_score < 0.9 < rec[1].val_f1_score and rec[1].model_path == f"{path}/model" and rec[0].model_path is None
        assert spark.table(table).count() == 3
        out = ml.predict(ml.load_model(rec[1].model_path), df.where("split = 'val'"), ["x", "y"])
        f1 = weighted_f1(out.withColumn("prediction", F.col("prediction").cast("int")), "label", "prediction").first().f1
        assert abs(f1 - rec[1].val_f1_score) < 1e-12
        first = df.where("split = 'train'").orderBy("id").first()
        assert spark.read.parquet(f"{path}/sample_input").collect()[0].asDict() == {"id": first.id, "x": first.x, "y": first.y}
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_images_scored_by_a_saved_forest(spark, image_tree, tmp_path):
    from kensa.operators import images as im
    from kensa.session import scratch_path
    from kensa.streaming import streams as st
    bright = spark.range(60).selectExpr("id", "transform(sequence(0, 15), k -> int(if(id % 2 = 0, 30, 200) + (id * 7 + k) % 20)) p")
    images = bright.select("id", F.expr("int(id % 2)").alias("label"), gray_image_struct("id", F.col("p"), 4, 4).alias("image"))
    model = ml.fit_forest(im.image_vector(images, 4).select("label", "vector"), "label", ["vector"], num_trees=5)
    path = ml.save_model(model, str(tmp_path / "m"))
    with pytest.raises(ValueError):
        ml.score_images_with(ml.load_model(path), images, 4, keep=("id", "label"))
    kept = images.withColumnRenamed("label", "planted")
    got = {r.id: r for r in ml.score_images_with(ml.load_model(path), kept, 4, keep=("id", "planted")).collect()}
    assert all(r.label == ("damaged" if r.planted else "normal") and 0.5 <= r.score <= 1 and r.error is None for r in got.values()) and len(got) == 60
    root, files = image_tree
    batch = ml.score_images_with(ml.load_model(path), fs.read_images(spark, str(root), glob=fs.IMAGE_GLOB).withColumn("origin", F.col("image.origin")), 4, keep=("origin",))
    streamed = st.drain(st.score_stream_with(spark, str(root), path, 4, glob=fs.IMAGE_GLOB), "t_forest", scratch_path(spark, "tf"), checkpoint=scratch_path(spark, "tf-ck"))
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect())) and streamed.count() == len(files) + 1
    bad = streamed.where("error is not null").collect()
    assert [r.origin.rsplit("/", 1)[1] for r in bad] == ["broken.jpg"] and bad[0].label is None and bad[0].score is None


def test_scoring_refuses_vectors_of_another_width(spark):
    df = _labelled(spark)
    model = ml.fit_forest(df, "label", ["x", "y"], num_trees=2)
    got = ml.score_vectors(model, spark.createDataFrame([([1.0, 2.0],), ([1.0],), (None,)], "vector array<double>")).collect()
    assert [r.error is None for r in got] == [True, False, False] and got[0].label in ("normal", "damaged")
