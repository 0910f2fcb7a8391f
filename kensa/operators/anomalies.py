"""Inspection questions: verdicts, anomaly shares and counts, counts per line.

Inputs are inspection facts ``(item_id, unit_id, kind, label, ...)`` where
``kind`` may hold several kinds joined by commas, and a production table
``(unit_id, line)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kensa.operators.numbering import dense_rank_desc

DAMAGED = "damaged"


def _kinds(col: str = "kind") -> Column:
    """The kinds of one item as an array (several kinds per item allowed)."""
    return F.transform(F.split(F.col(col), ","), lambda k: F.trim(k))


def verdict(df: DataFrame, label: str = "label", present: str | None = None) -> DataFrame:
    """``damaged`` -> ``anomaly``; any other label, also a missing one -> ``normal``.

    ``is_unknown`` marks rows whose label was missing (shown as normal, never
    mistaken for a checked one).  When ``present`` names a boolean column,
    rows where it is false get no verdict at all (an empty prediction list).
    """
    lab = F.coalesce(F.col(label), F.lit("unknown"))
    v = F.when(lab == DAMAGED, F.lit("anomaly")).otherwise(F.lit("normal"))
    unknown = F.col(label).isNull()
    if present is not None:
        v = F.when(F.col(present), v)
        unknown = F.when(F.col(present), unknown)
    return df.withColumn("verdict", v).withColumn("is_unknown", unknown)


def anomalies(df: DataFrame, label: str = "label") -> DataFrame:
    return df.where(F.col(label) == DAMAGED)


def with_line(inspections: DataFrame, production: DataFrame) -> DataFrame:
    """Each anomaly with the production line of the unit that made it
    (null line when the unit is unknown).  A plain equi join: AQE picks a
    broadcast only if the measured production side is small."""
    anom = anomalies(inspections)
    return anom.join(production.select("unit_id", "line"), "unit_id", "left")


def anomaly_share(df: DataFrame, kind: str) -> DataFrame:
    """How many anomalies are of ``kind``, out of how many, and the share.

    One global aggregate: partial counts per task, one tiny final merge.
    """
    anom = anomalies(df)
    return anom.agg(
        F.count_if(F.array_contains(_kinds(), kind)).alias("n_kind"),
        F.count(F.lit(1)).alias("n_anomalies"),
    ).select(
        F.lit(kind).alias("kind"), "n_kind", "n_anomalies",
        F.try_divide(F.col("n_kind").cast("double"), F.col("n_anomalies")).alias("share"))


def anomaly_counts(df: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    """Count of anomalies per kind; an item with two kinds counts for both."""
    out = anomalies(df).select(F.explode(_kinds()).alias("kind"))
    if exclude:
        out = out.where(~F.col("kind").isin(*exclude))
    return out.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def anomalies_by_line(inspections: DataFrame, production: DataFrame,
                      kind: str | None = None, distinct_items: bool = True) -> DataFrame:
    """Anomaly count and number of distinct items (unless ``distinct_items`` is off) and
    units per (line, kind).

    Counts are first reduced to one row per (unit, kind) -- map-side partial
    aggregation, so a unit that makes a third of all items costs one row -- and only
    then joined to the production table.  The joins are plain equi
    joins: AQE turns them into broadcasts when a side is small and splits skewed
    partitions otherwise.  Units with no production row keep a null line instead of
    being dropped.  An item that stands under several units of a line counts once:
    distinct (line, kind, item) are made by item first, so a line with a third of all
    items is spread over all tasks, and then counted by line.
    """
    anom = anomalies(inspections).select("unit_id", "item_id", F.explode(_kinds()).alias("kind"))
    if kind is not None:
        anom = anom.where(F.col("kind") == kind)
    lines = production.select("unit_id", "line")
    per_unit = anom.groupBy("unit_id", "kind").agg(F.count(F.lit(1)).alias("n"))
    counts = per_unit.join(lines, "unit_id", "left").groupBy("line", "kind").agg(
        F.sum("n").alias("n_anomalies"), F.count(F.lit(1)).alias("n_units"))
    if not distinct_items:
        return counts.select("line", "kind", "n_anomalies", "n_units")
    items = anom.where(F.col("item_id").isNotNull()).join(lines, "unit_id", "left").select("line", "kind", "item_id").distinct()
    distinct = items.groupBy("line", "kind").agg(F.count(F.lit(1)).alias("n_items")).select(F.col("line").alias("_line"), F.col("kind").alias("_kind"), "n_items")
    same = F.col("line").eqNullSafe(F.col("_line")) & F.col("kind").eqNullSafe(F.col("_kind"))
    return counts.join(distinct, same, "left").select("line", "kind", "n_anomalies", F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), "n_units")


def rank_lines(by_line: DataFrame, kind: str) -> DataFrame:
    """Lines ranked by the count of one kind (1 = most, dense ranks).

    The input is already one row per line; it is materialised and measured,
    and only a frame within the broadcast limit is ranked by a single
    ordered window (``numbering.dense_rank_desc``); a larger one is ranked
    by the distributed numbering."""
    return dense_rank_desc(by_line.where(F.col("kind") == kind), "n_anomalies", "rank")
