"""Run listings: filter (P6), newest run (T1), staleness."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kensa.functions.scalar import RUN_STAMP_PATTERN, parse_stamp, run_stamp

_DAY_US = 86_400_000_000


def filter_runs(df: DataFrame, object_type: str, contains: str = "automl") -> DataFrame:
    """Entries of one type whose path contains ``contains`` and a run stamp."""
    return df.where((F.col("object_type") == object_type)
                    & F.col("path").contains(contains)
                    & F.col("path").rlike(RUN_STAMP_PATTERN))


def latest_run(df: DataFrame, ties: str = "run_key") -> DataFrame:
    """The entry with the greatest path text (not the latest parsed time);
    of equal paths the smallest ``ties`` column.
    Planned as a top-1 (``TakeOrderedAndProject``), never a full sort."""
    return df.orderBy(F.desc("path"), F.asc(ties)).limit(1)


def require_latest_run(df: DataFrame, ties: str = "run_key") -> dict:
    """T1 with the reference's failure: error when there is no run at all."""
    rows = latest_run(df, ties).collect()  # at most one row
    if not rows:
        raise LookupError("no run found: run the training job first")
    return rows[0].asDict()


def staleness(df: DataFrame, as_of: dt.datetime | str, max_days: int = 30) -> DataFrame:
    """Whole 24-hour periods from each run's stamp to ``as_of`` (floored,
    like a Python ``timedelta.days``) and whether that is over ``max_days``.

    ``as_of`` is a parameter, never the clock, so results are repeatable.
    """
    as_of_lit = F.lit(str(as_of)).cast("timestamp_ntz")
    ts = parse_stamp(run_stamp("path"))
    us = F.timestamp_diff("MICROSECOND", ts, as_of_lit)
    days = F.floor(us / F.lit(_DAY_US)).cast("bigint")
    return (df.withColumn("run_ts", ts).withColumn("days", days)
              .withColumn("is_stale", F.col("days") > F.lit(max_days)))


def require_fresh(row: dict, max_days: int = 30) -> dict:
    """T2's failure on the driver, for the one newest run (a row of
    ``staleness``)."""
    if row.get("days") is None:
        raise ValueError(f"run path has no valid stamp: {row.get('path')}")
    if row["days"] > max_days:
        raise RuntimeError(f"newest run is {row['days']} days old (limit {max_days}); retrain first")
    return row
