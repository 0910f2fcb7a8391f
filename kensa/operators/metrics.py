"""Counts and model metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def is_empty(df: DataFrame) -> bool:
    """A4: existence, not a count: reads at most one row."""
    return df.isEmpty()


def emptiness(df: DataFrame) -> DataFrame:
    """A4 as a one-row DataFrame ``is_empty`` (lazy; limit 1 under the count)."""
    return df.limit(1).agg((F.count(F.lit(1)) == 0).alias("is_empty"))


def split_counts(df: DataFrame, col: str = "split") -> DataFrame:
    """Rows per split."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Confusion counts ``(label, pred, n)``: one partial + final aggregate."""
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("pred")).agg(
        F.count(F.lit(1)).alias("n"))


def per_class_f1(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Precision, recall, F1 and support per class; 0 where undefined.

    Each confusion cell counts once for its true class (support, true
    positives) and once for its predicted class (predictions), so one
    aggregate gives every class -- no join between per-class tables."""
    cm = confusion(df, label, pred)
    hit = F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(F.lit(0))
    sides = F.array(
        F.struct(F.col("label").alias("cls"), F.col("n").alias("support"), hit.alias("tp"),
                 F.lit(0).cast("bigint").alias("predicted")),
        F.struct(F.col("pred").alias("cls"), F.lit(0).cast("bigint").alias("support"),
                 F.lit(0).cast("bigint").alias("tp"), F.col("n").alias("predicted")))
    per = (cm.select(F.inline(sides)).groupBy("cls")
             .agg(F.sum("support").alias("support"), F.sum("tp").alias("tp"),
                  F.sum("predicted").alias("predicted")))
    p = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    r = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(F.lit(0.0))
    return per.withColumn("precision", p).withColumn("recall", r).withColumn("f1", f1)


def weighted_f1(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Support-weighted mean of per-class F1 (the scikit-learn 'weighted'
    average); one row ``f1``.  Only the first aggregate touches the data."""
    pc = per_class_f1(df, label, pred)
    return pc.agg((F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("f1"))
