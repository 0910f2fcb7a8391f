"""Spreading CPU-heavy per-row work over every core.

A table stored as one large row group is read by one task, so a heavy
per-row step (image decoding, tokenising long texts) would run on one core.
``spread`` repartitions round-robin only when the input has fewer
partitions than the cluster's parallelism; on a large cluster reading many
files it does nothing, so it adds no shuffle at scale.  Call it before the
rows grow (before decoding or exploding), while they are cheap to move.
"""

from __future__ import annotations

from pyspark.errors import PySparkAttributeError
from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    if df.isStreaming:  # micro-batches are planned per trigger
        return df
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        # What comes out of a shuffle is spread already, and asking for its partitions would run it.
        if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
            return df
        current = df.rdd.getNumPartitions()
    except (PySparkAttributeError, RuntimeError):  # Spark Connect: no view of plan or RDD; leave the layout to the server
        return df
    if current >= target:
        return df
    return df.repartition(target)
