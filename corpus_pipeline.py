"""The corpus pipeline: STAGES over documents, each written and reread; registered as query ``pipeline``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kensa.llm import pipeline as _pipeline

STAGES = _pipeline.STAGES
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order to ``documents``."""
    return _pipeline.run(spark, sf_dir)
