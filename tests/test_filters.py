import datetime as dt

import pytest
from pyspark.sql import functions as F

from kensa.operators import filters as fl


def test_non_blank_treats_unicode_spaces_as_blank(spark):
    texts = ["hello", "   ", "\t\t", "　 ", "", None, " x "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    kept = sorted(r.id for r in fl.non_blank(df, "text").collect())
    assert kept == [i for i, t in enumerate(texts) if t is not None and t.strip()]


def test_prefix_filter_empty_keeps_nulls(spark):
    df = spark.createDataFrame([("red a",), ("blue",), (None,)], "name string")
    assert fl.prefix_filter(df, "name", "").count() == 3
    assert [r.name for r in fl.prefix_filter(df, "name", "red").collect()] == ["red a"]


def test_drop_datetime_and_missing_columns(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), dt.date(2024, 1, 1), "x")],
                               "a int, t timestamp, d date, s string")
    assert fl.drop_datetime(df).columns == ["a", "s"]
    assert fl.drop_columns(df, "s", "nope").columns == ["a", "t", "d"]


def test_fill_zero_numbers_only(spark):
    df = spark.createDataFrame([(None, None, None)], "a int, b double, s string")
    r = fl.fill_zero(df).first()
    assert (r.a, r.b, r.s) == (0, 0.0, None)


def test_default_prediction_flagged(spark):
    df = spark.createDataFrame([(1, None), (2, ("damaged", 0.9))],
                               "id int, prediction struct<label string, score double>")
    got = {r.id: (r.prediction.label, r.prediction.score, r.is_default)
           for r in fl.with_default_prediction(df).collect()}
    assert got == {1: ("normal", 0.85, True), 2: ("damaged", 0.9, False)}


def test_check_names(spark):
    ok = spark.createDataFrame([("main",)], "n string")
    assert fl.check_names(ok, "n").count() == 1
    bad = spark.createDataFrame([("spark_catalog",)], "n string")
    with pytest.raises(Exception, match="reserved"):
        fl.check_names(bad, "n").collect()
    with pytest.raises(ValueError):
        fl.check_name("hive_metastore")


def test_image_suffix_filter(spark):
    names = ["a.jpg", "b.JPEG", "c.png", "d.PnG", "e.gif", "f.jpg.txt", "g.jpe"]
    df = spark.createDataFrame([(n,) for n in names], "path string")
    assert sorted(r.path for r in fl.filter_image_files(df).collect()) == ["a.jpg", "b.JPEG", "c.png", "d.PnG"]


def test_manifest_filter(spark):
    df = spark.createDataFrame([("NOTICE", "u1"), ("x.png", "u2"), ("a-NOTICE.md", "u3")], "name string, url string")
    assert [r.url for r in fl.filter_manifest(df).collect()] == ["u2"]


def test_select_training_prunes_scan(spark, tmp_path):
    p = str(tmp_path / "t")
    spark.createDataFrame([(b"x", "bent", 1, "big")], "content binary, label string, a int, b string").write.parquet(p)
    out = fl.select_training(spark.read.parquet(p))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<content:binary,label:string>" in plan
    assert F.col  # noqa
