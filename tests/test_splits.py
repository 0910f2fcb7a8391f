from pyspark.sql import functions as F

from kensa.operators import splits as sp


def test_split_disjoint_complete_and_layout_free(spark):
    df = spark.range(0, 20000).withColumnRenamed("id", "k")
    a = sp.assign_split(df, "k")
    b = sp.assign_split(df.repartition(13), "k")
    assert a.count() == 20000 and a.select("k").distinct().count() == 20000
    assert a.exceptAll(b).count() == 0
    counts = {r.split: r["count"] for r in a.groupBy("split").count().collect()}
    assert abs(counts["train"] / 20000 - 0.7) < 0.02 and abs(counts["test"] / 20000 - 0.1) < 0.02


def test_holdout_two_way(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "k")
    s = {r.split for r in sp.holdout(df, "k", 0.1).select("split").distinct().collect()}
    assert s == {"train", "test"}


def test_thresholds_end_at_full_range():
    cuts = sp.thresholds(sp.DEFAULT_WEIGHTS)
    assert cuts[-1][1] == 1 << 32 and [c for _, c in cuts] == sorted(c for _, c in cuts)


def test_seed_changes_assignment(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "k")
    a = sp.assign_split(df, "k", seed=1).select("k", F.col("split").alias("a"))
    b = sp.assign_split(df, "k", seed=2).select("k", F.col("split").alias("b"))
    assert a.join(b, "k").where("a != b").count() > 0
