"""Driver tables: one parquet file (or folder) per table under an ``sf`` folder."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one table; Catalyst prunes columns and pushes filters into it."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Register every table as a temp view of the same name (for SQL callers)."""
    for name in TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)
