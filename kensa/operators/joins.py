"""Joins (J1, J3, J4) and the mirror fallback.

No join here forces a broadcast: each side can grow with the data, so the
plan is a plain equi join and Spark decides at run time.  AQE replans to a
broadcast hash join only when a side's measured size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` and splits skewed
partitions of sort-merge joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kensa.session import cut_lineage

# Largest side, by its values' bytes, that is broadcast or handled by one task after
# a size check; beyond it a plain join.
SMALL_BYTES = 32 << 20


def value_bytes(col: Column, kind: T.DataType) -> Column:
    """About the bytes a value takes: texts and binaries by their length, the members
    of nested values one by one, others by their fixed size."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(col)
    elif isinstance(kind, T.StructType):
        size = sum((value_bytes(col[f.name], f.dataType) for f in kind.fields), F.lit(0))
    elif isinstance(kind, T.ArrayType):
        size = F.aggregate(col, F.lit(0).cast("long"), lambda n, x: n + F.coalesce(value_bytes(x, kind.elementType), F.lit(0)).cast("long"))
    elif isinstance(kind, T.MapType):
        size = value_bytes(F.map_keys(col), T.ArrayType(kind.keyType)) + value_bytes(F.map_values(col), T.ArrayType(kind.valueType))
    else:
        size = F.lit(16 if isinstance(kind, T.DecimalType) else 8)
    return F.coalesce(size, F.lit(0)).cast("long") + F.lit(8).cast("long")


def checked_small(df: DataFrame, max_bytes: int = SMALL_BYTES) -> tuple[DataFrame, bool]:
    """Materialise ``df`` once in the shared checkpoint folder and sum the bytes of
    its values there; returns the materialised frame and whether it is small.  For sides that come out of an aggregate or a window, whose size the
    planner cannot estimate but which are small by construction."""
    m = cut_lineage(df)
    row = sum((value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(0))
    return m, (m.agg(F.sum(row).alias("bytes")).first()["bytes"] or 0) <= max_bytes


def join_checked(big: DataFrame, small: DataFrame, on, how: str = "inner",
                 max_bytes: int = SMALL_BYTES) -> DataFrame:
    """Equi join that broadcasts ``small`` only after its size is checked."""
    s, ok = checked_small(small, max_bytes)
    return big.join(F.broadcast(s) if ok else s, on, how)


def label_images(images: DataFrame, labels: DataFrame, key: str | list[str]) -> DataFrame:
    """Every image with its annotation (null label when none)."""
    return images.join(labels, key, "left")


def reports_for(lines: DataFrame, reports: DataFrame, line: str = "line") -> DataFrame:
    """Reports of the given lines (semi join: each report at most once,
    however many times its line is listed).

    There are few lines, so hashing reports by line would pile each line's
    reports into one task; the line list is checked and broadcast instead,
    and the reports are filtered where they are read, without a shuffle."""
    return join_checked(reports, lines.select(line).distinct(), line, "left_semi")


def unmatched(left: DataFrame, right: DataFrame, key: str,
              left_name: str = "left", right_name: str = "right") -> DataFrame:
    """Keys present on one side only, with the side they are missing from.

    Distinct keys per side (partial aggregation: a hot key costs one row),
    then one full outer join; both distinct outputs are already hashed on
    the key, so the join adds no shuffle -- two shuffles in all, where two
    anti joins would shuffle each side twice.  A null key matches nothing,
    so it is reported as unmatched, as an anti join would."""
    lk = left.select(key).distinct().withColumn("_in_left", F.lit(True))
    rk = right.select(key).distinct().withColumn("_in_right", F.lit(True))
    j = lk.join(rk, key, "full_outer")
    return (j.where(F.col("_in_left").isNull() | F.col("_in_right").isNull())
             .select(key, F.when(F.col("_in_right").isNull(), F.lit(right_name))
                            .otherwise(F.lit(left_name)).alias("missing_in")))


def prefer_source(manifest: DataFrame, mirror: DataFrame, origin: DataFrame,
                  key: str, value: str = "content") -> DataFrame:
    """Take each entry from the mirror, fall back to the origin.

    Which copy to use is decided on keys alone; then the origin's content is read
    only for the keys the mirror lacks (a semi join that filters at the scan when
    these keys are few enough to broadcast), so the content of no entry is moved
    twice.  A copy without content is no copy.  ``source`` tells which copy was
    used (null when neither has it); a key that a source holds more than once gives a
    row for each.
    """
    m = mirror.where(F.col(value).isNotNull()).select(key, F.col(value).alias("_m"))
    o = origin.where(F.col(value).isNotNull()).select(key, F.col(value).alias("_o"))
    lacking = manifest.select(key).distinct().join(m.select(key).distinct(), key, "left_anti")
    j = manifest.join(m, key, "left").join(join_checked(o, lacking, key, "left_semi"), key, "left")
    src = F.when(F.col("_m").isNotNull(), F.lit("mirror")).when(F.col("_o").isNotNull(), F.lit("origin"))
    return (j.withColumn(value, F.coalesce("_m", "_o")).withColumn("source", src)
             .drop("_m", "_o"))
