"""Registry of named queries: a Spark builder and, where SQL can express it,
the equivalent DuckDB SQL used as the oracle.

Every query reads the whole driver tables under ``sf_dir`` (or views Spark
derives from them); nothing is sampled, capped or filtered to a subset.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from kensa.plans import (questions, relational, payload_queries, image_queries,  # noqa: F401
                             model_queries, stream_queries, storage_queries)
