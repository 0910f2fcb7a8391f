"""Tables, schemas and the catalog."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kensa.operators.filters import check_name
from kensa.sources import files as fs


def overwrite_table(df: DataFrame, name: str, partition_by: list[str] | None = None,
                    path: str | None = None, buckets: tuple[int, str] | None = None) -> None:
    """Replace a table's content, at ``path`` when given.  For a Parquet
    table the old files go before the new ones are written, so a failed job
    leaves no content; run it again then.  ``buckets`` (number, column): the table is
    bucketed and sorted by the column."""
    if buckets:
        df = df.repartition(*buckets)
    w = df.write.mode("overwrite")
    if path:
        w = w.option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if buckets:
        w = w.bucketBy(*buckets).sortBy(buckets[1])
    w.saveAsTable(name)


def write_split(df: DataFrame, path: str, split_col: str | None = "split") -> None:
    """Write a split training set as Parquet (no index column); one folder
    per split so readers of one split skip the others' files."""
    w = df.write.mode("overwrite")
    if split_col:
        w = w.partitionBy(split_col)
    w.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """S10."""
    return spark.table(name)


def list_tables(spark: SparkSession, db: str) -> DataFrame:
    """Tables of a schema as rows (namespace, tableName, isTemporary)."""
    return spark.sql(f"SHOW TABLES IN `{db}`")


def list_catalogs(spark: SparkSession) -> DataFrame:
    """Catalogs as rows, with the current one flagged."""
    current = spark.catalog.currentCatalog()
    return spark.sql("SHOW CATALOGS").selectExpr("catalog", f"catalog = '{current}' AS is_current")


def setup_schema(spark: SparkSession, db: str, reset: bool = False, catalog: str | None = None,
                 reserved: tuple = ()) -> str:
    """U4: optionally drop the schema with everything in it, then create it if
    missing and make it current.  Errors are raised, not hidden."""
    if catalog is not None:
        check_name(catalog, reserved)
        spark.catalog.setCurrentCatalog(catalog)
    if reset:
        spark.sql(f"DROP DATABASE IF EXISTS `{db}` CASCADE")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    spark.catalog.setCurrentDatabase(db)
    return db


@dataclass
class LoadConfig:
    """Sources and target tables; ``labels_key`` is the CSV column that holds an image's path
    below ``images_src``.  Both tables are bucketed by it, as ``key``.  ``folder``: where the
    tables' files go (default: the warehouse)."""
    images_src: str
    labels_src: str
    images_table: str
    labels_table: str
    reset: bool = False
    labels_schema: T.StructType = field(default_factory=lambda: fs.ANNOTATION_SCHEMA)
    labels_key: str = "image"
    buckets: int = 16
    folder: str | None = None


def ensure_loaded(spark: SparkSession, cfg: LoadConfig) -> str:
    """Load images and labels only when asked to reset or when either
    target is missing or empty; returns ``loaded`` or ``kept``.  Both tables have a
    ``key`` column (``files.relative_key``) for J1; bad CSV lines stay in the labels table, with their text."""
    def missing(t: str) -> bool:
        return not spark.catalog.tableExists(t) or spark.table(t).isEmpty()

    if not (cfg.reset or missing(cfg.images_table) or missing(cfg.labels_table)):
        return "kept"
    at = (lambda t: f"{cfg.folder}/{t}") if cfg.folder else (lambda t: None)
    fs.ingest_files(spark, cfg.images_src, cfg.images_table, buckets=cfg.buckets, path=at(cfg.images_table))
    labels = fs.read_labels(spark, cfg.labels_src, cfg.labels_schema).withColumn("key", F.col(cfg.labels_key))
    overwrite_table(labels, cfg.labels_table, path=at(cfg.labels_table), buckets=(cfg.buckets, "key"))
    return "loaded"


def wait_for_table(spark: SparkSession, name: str, timeout: float = 120.0, poll: float = 1.0) -> None:
    """Block until the table exists and has a row; error after ``timeout``
    seconds.  Each poll reads at most one row."""
    deadline = time.monotonic() + timeout
    while True:
        if spark.catalog.tableExists(name) and not spark.table(name).isEmpty():
            return
        if time.monotonic() >= deadline:
            raise TimeoutError(f"table {name} missing or empty after {timeout}s")
        time.sleep(poll)
