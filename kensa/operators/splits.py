"""Train / validation / test splits (M1, M2).

The default split hashes (seed, key): a row lands in the same split whatever
the partitioning, file order or cluster size, and no shuffle is needed.
``randomSplit`` is available for callers who want Spark's sampler.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_WEIGHTS = (("train", 0.7), ("val", 0.2), ("test", 0.1))
_SPACE = 1 << 32


def hash_unit(key: str, seed: int) -> Column:
    """A uniform integer in [0, 2^32): first 8 hex digits of md5('seed:key')."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def thresholds(weights) -> list[tuple[str, int]]:
    """Cumulative integer cut points on [0, 2^32) for named weights."""
    total = float(sum(w for _, w in weights))
    cuts, acc = [], 0.0
    for name, w in weights:
        acc += w
        cuts.append((name, round(acc / total * _SPACE)))
    cuts[-1] = (cuts[-1][0], _SPACE)
    return cuts


def assign_split(df: DataFrame, key: str, weights=DEFAULT_WEIGHTS, seed: int = 42,
                 col: str = "split") -> DataFrame:
    """M1: add a ``split`` column by seeded hash of ``key``."""
    u = hash_unit(key, seed)
    cuts = thresholds(weights)
    expr = None
    for name, cut in cuts[:-1]:
        expr = F.when(u < cut, F.lit(name)) if expr is None else expr.when(u < cut, F.lit(name))
    expr = F.lit(cuts[-1][0]) if expr is None else expr.otherwise(F.lit(cuts[-1][0]))
    return df.withColumn(col, expr)


def split_sql(key_sql: str, weights=DEFAULT_WEIGHTS, seed: int = 42) -> str:
    """The same split as DuckDB SQL (for the oracle)."""
    u = f"('0x' || substr(md5('{seed}:' || CAST({key_sql} AS VARCHAR)), 1, 8))::UBIGINT"
    cuts = thresholds(weights)
    whens = " ".join(f"WHEN {u} < {cut} THEN '{name}'" for name, cut in cuts[:-1])
    return f"CASE {whens} ELSE '{cuts[-1][0]}' END"


def holdout(df: DataFrame, key: str, test: float = 0.1, seed: int = 42) -> DataFrame:
    """M2: two-way split; every row is in exactly one of train / test."""
    return assign_split(df, key, (("train", 1.0 - test), ("test", test)), seed)


def random_split(df: DataFrame, weights=DEFAULT_WEIGHTS, seed: int = 42) -> dict[str, DataFrame]:
    """Spark's sampler (depends on partitioning; seeded)."""
    parts = df.randomSplit([w for _, w in weights], seed)
    return {name: p for (name, _), p in zip(weights, parts)}
