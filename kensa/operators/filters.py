"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Image file suffixes the upload accepts (jpg, jpeg, png, any case).
IMAGE_SUFFIX_PATTERN = r"(?i)\.(jpe?g|png)$"
# Catalog names the set-up refuses.
RESERVED_CATALOGS = ("hive_metastore", "spark_catalog")
# Answer used when no scorer is available.
DEFAULT_LABEL, DEFAULT_SCORE = "normal", 0.85


def select_training(df: DataFrame, content: str = "content", label: str = "label") -> DataFrame:
    """Keep only the model input and its label (the scan reads nothing else)."""
    return df.select(F.col(content).alias("content"), F.col(label).alias("label"))


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns by name; names that do not exist are ignored."""
    return df.drop(*names)


def drop_datetime(df: DataFrame) -> DataFrame:
    """Drop every timestamp / timestamp_ntz / date column."""
    kinds = (T.TimestampType, T.TimestampNTZType, T.DateType)
    keep = [f.name for f in df.schema.fields if not isinstance(f.dataType, kinds)]
    return df.select(*keep)


def fill_zero(df: DataFrame) -> DataFrame:
    """Missing numbers -> 0 (strings are left alone)."""
    return df.na.fill(0)


def take_split(df: DataFrame, split: str, col: str = "split") -> DataFrame:
    """P5: rows of one split; pushed into the scan when the split is a column."""
    return df.where(F.col(col) == F.lit(split))


def prefix_filter(df: DataFrame, col: str, prefix: str) -> DataFrame:
    """Names starting with ``prefix``; an empty prefix keeps every row,
    also rows without a name."""
    if prefix == "":
        return df
    return df.where(F.col(col).isNotNull() & F.col(col).startswith(prefix))


def non_blank(df: DataFrame, col: str) -> DataFrame:
    """Rows whose text has a non-space character.  ``(?U)`` makes ``\\S``
    treat Unicode spaces (no-break, full-width) as blank, as Python's
    ``str.strip`` does; ``trim`` would keep tab-only texts."""
    return df.where(F.col(col).isNotNull() & F.col(col).rlike(r"(?U)\S"))


def filter_image_files(df: DataFrame, col: str = "path") -> DataFrame:
    """Keep jpg / jpeg / png files (any letter case)."""
    return df.where(F.col(col).rlike(IMAGE_SUFFIX_PATTERN))


def filter_manifest(df: DataFrame, name: str = "name", url: str = "url",
                    exclude: str = "NOTICE") -> DataFrame:
    """Drop listing entries whose name contains ``exclude``; keep the URL."""
    return df.where(~F.col(name).contains(exclude)).select(url)


def with_default_prediction(df: DataFrame, pred: str = "prediction") -> DataFrame:
    """Where no prediction exists, answer ``normal`` with 0.85 and flag it
    with ``is_default`` so it is never mistaken for a real score."""
    missing = F.col(pred).isNull()
    default = F.struct(F.lit(DEFAULT_LABEL).alias("label"), F.lit(DEFAULT_SCORE).alias("score"))
    return (df.withColumn("is_default", missing)
              .withColumn(pred, F.when(missing, default).otherwise(F.col(pred))))


def check_names(df: DataFrame, col: str, reserved=RESERVED_CATALOGS) -> DataFrame:
    """P12 in a plan: fail the job if any value of ``col`` is a reserved name."""
    bad = F.col(col).isin(*reserved)
    checked = F.when(bad, F.raise_error(F.concat(F.lit("reserved name: "), F.col(col)))) \
               .otherwise(F.col(col))
    return df.withColumn(col, checked.cast(df.schema[col].dataType))


def flag_names(df: DataFrame, col: str, reserved=RESERVED_CATALOGS, out: str = "error") -> DataFrame:
    """P12 without stopping the job: an error text beside each reserved name,
    null beside the others."""
    return df.withColumn(out, F.when(F.col(col).isin(*reserved), F.concat(F.lit("reserved name: "), F.col(col))))


def check_name(name: str, reserved=RESERVED_CATALOGS) -> str:
    """P12 on the driver, for a single configuration value."""
    if name in reserved:
        raise ValueError(f"catalog name {name!r} is reserved; choose another")
    return name
