"""Category codes for text columns (C21; the feature step of M3).

Codes are 0-based ranks of the distinct values in ascending order; null and
values unseen at fit time get -1 (pandas' category-code convention).  The
code table is a distributed DataFrame joined back on the value -- AQE makes
the join a broadcast only when the measured table is small -- so no value
list ever passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kensa.operators.joins import SMALL_BYTES, value_bytes
from kensa.operators.numbering import number_rows
from kensa.session import cut_lineage

UNKNOWN_CODE = -1


def fit_codes(df: DataFrame, cols: list[str], max_bytes: int = SMALL_BYTES) -> dict[str, DataFrame]:
    """Code tables ``(value, code)`` per column, fitted on ``df``.

    Columns of one data type are fitted in one pass: one scan and one
    shuffle produce the distinct ``(column, value)`` pairs, which are
    materialised once and their bytes summed per column (values keep
    their type, so codes follow the type's own order).  A column within
    ``max_bytes`` is small by proof: its codes come from a window over these
    values and its table is broadcast, so the coded table is never hashed on a
    low-cardinality column.  A larger column is numbered
    by the distributed, skew-safe numbering and joined normally (AQE splits
    skewed partitions)."""
    by_type: dict[str, list[str]] = {}
    for c in cols:
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    out: dict[str, DataFrame] = {}
    for group in by_type.values():
        out.update(_fit_same_type(df, group, max_bytes))
    return {c: out[c] for c in cols}


def _fit_same_type(df: DataFrame, cols: list[str], max_bytes: int) -> dict[str, DataFrame]:
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).alias("value")) for c in cols]))
    values = df.select(pairs.alias("p")).select("p.*").where(F.col("value").isNotNull()).distinct()
    values = cut_lineage(values)
    size = value_bytes(F.col("value"), values.schema["value"].dataType)
    sizes = {r["col"]: r["bytes"] for r in values.groupBy("col").agg(F.sum(size).alias("bytes")).collect()}
    small = [c for c in cols if sizes.get(c, 0) <= max_bytes]
    large = [c for c in cols if c not in small]
    out = {}
    if small:
        w = Window.partitionBy("col").orderBy("value")
        ranked = values.where(F.col("col").isin(*small)).withColumn("code", F.row_number().over(w) - 1)
        for c in small:
            out[c] = F.broadcast(ranked.where(F.col("col") == c).select(F.col("value").alias(c), "code"))
    if large:
        numbered = number_rows(values.where(F.col("col").isin(*large)), ["col"], ["value"], out="_n")
        for c in large:
            out[c] = numbered.where(F.col("col") == c).select(F.col("value").alias(c), (F.col("_n") - 1).alias("code"))
    return out


def apply_codes(df: DataFrame, codes: dict[str, DataFrame]) -> DataFrame:
    """Replace each coded column by its code; null / unseen -> -1."""
    out = df
    for c, tbl in codes.items():
        tmp = f"__code_{c}"
        out = (out.join(tbl.withColumnRenamed("code", tmp), c, "left")
                  .withColumn(c, F.coalesce(F.col(tmp), F.lit(UNKNOWN_CODE)).cast("int"))
                  .drop(tmp))
    return out.select(*df.columns)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "varchar", "char")]


def category_codes(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Code the given (default: all string) columns, fitted on ``df`` itself."""
    cols = string_columns(df) if cols is None else cols
    return apply_codes(df, fit_codes(df, cols))
