"""File sources: image trees, raw bytes, annotation CSV, folder checks
(S1, S2, S3, S6, A5).

Scans are Spark file sources, so reading is split across tasks; nothing is
downloaded or copied through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urlparse

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kensa.session import cut_lineage, ship_package
from kensa.sources.sink import filesystem

# Fixed value: the scan-time glob for supported image files, in any letter case.
IMAGE_GLOB = "*.{[jJ][pP][gG],[jJ][pP][eE][gG],[pP][nN][gG]}"

ANNOTATION_SCHEMA = T.StructType([
    T.StructField("image", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("mask", T.StringType()),
])
CORRUPT = "_corrupt_record"


def read_images(spark: SparkSession, path: str, drop_invalid: bool = False,
                glob: str | None = None) -> DataFrame:
    """Decoded images ``image struct<origin, height, width, nChannels, mode,
    data>`` (BGR(A) byte order).  An unreadable file gives a row with
    height/width -1 and empty data, or is dropped with ``drop_invalid``."""
    r = (spark.read.format("image").option("dropInvalid", drop_invalid)
         .option("recursiveFileLookup", "true"))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)


def read_image_bytes(spark: SparkSession, path: str, glob: str | None = IMAGE_GLOB) -> DataFrame:
    """Raw file bytes ``path, modificationTime, length, content``.
    Select only metadata columns for listings: ``content`` is then never read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path)


def read_labels(spark: SparkSession, path: str, schema: T.StructType = ANNOTATION_SCHEMA) -> DataFrame:
    """S3: the annotation CSV with an explicit schema; malformed lines are kept
    with their text in ``_corrupt_record`` instead of failing the load."""
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (spark.read.schema(full).option("header", "true").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", "false")
            .csv(path))


def quarantine_labels(spark: SparkSession, src: str, out: str, schema: T.StructType = ANNOTATION_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """S3 in two tables, written in one pass over the CSV: (good rows, bad lines).

    A bad line (text in a number column, too many or too few fields) is kept as it stands, with
    the name of its file.  ``out`` is replaced.
    """
    bad = F.col(CORRUPT).isNotNull()
    rows = read_labels(spark, src, schema).withColumn("file", F.col("_metadata.file_name"))
    rows.select("*", bad.alias("bad")).write.mode("overwrite").partitionBy("bad").parquet(out)
    # the schema is given, as a file without bad lines (or without rows) has none of their folders
    both = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("bad", T.BooleanType())])).parquet(out)
    return both.where("not bad").select(*schema.names), both.where("bad").select(F.col(CORRUPT).alias("line"), "file")


def relative_key(path: Column | str, root: str, encoded: bool = False) -> Column:
    """Key of a file: its path below ``root``, without folders named ``name=value``.

    So ``Normal/000.JPG`` and ``Anomaly/000.JPG`` differ.  ``encoded``: the path is a
    URI with escapes, as the image source gives its ``origin``.
    """
    path = F.col(path) if isinstance(path, str) else path
    if encoded:
        path = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    folder = F.lit(urlparse(root).path.rstrip("/") + "/")
    below = F.substr(path, F.instr(path, folder) + F.length(folder))
    return F.regexp_replace(below, r"(?<=^|/)[^/=]+=[^/]*/", "")


def read_keyed_images(spark: SparkSession, root: str, glob: str | None = IMAGE_GLOB) -> DataFrame:
    """S2 with the key each file has below ``root``."""
    return read_image_bytes(spark, root, glob).withColumn("key", relative_key("path", root))


def ingest_files(spark: SparkSession, src: str, table_name: str, glob: str | None = IMAGE_GLOB,
                 buckets: int | None = None, path: str | None = None, only_new: bool = False, load: int | None = None) -> DataFrame:
    """S6 + S8: bulk load of a file tree into a table, keyed by relative path.

    ``buckets``: the table is bucketed and sorted by key, so a join with a table
    bucketed alike moves no content.  ``only_new``: rows are added for files whose key,
    length and time the table doesn't hold yet (an anti join of the listings; content
    is read for new files only); otherwise the table is replaced.  ``load``: a number
    for this load, kept with its rows.
    """
    df, mode = read_keyed_images(spark, src, glob), "overwrite"
    if only_new and spark.catalog.tableExists(table_name):
        same = ["key", "length", "modificationTime"]
        new = df.select("path", *same).join(spark.table(table_name).select(*same), same, "left_anti").select("path")
        df, mode = df.join(new, "path", "left_semi"), "append"
    if load is not None:
        df = df.withColumn("load", F.lit(load))
    w = df.repartition(buckets, "key").write if buckets else df.write
    w = w.mode(mode).format("parquet")
    if path:
        w = w.option("path", path)
    if buckets:
        w = w.bucketBy(buckets, "key").sortBy("key")
    w.saveAsTable(table_name)
    return spark.table(table_name)


def folder_is_empty(spark: SparkSession, path: str) -> bool:
    """A5: true when the folder has no visible file at any depth, or does not exist.
    The listing is read step by step and left at the first file.  Any other
    error is raised (not taken as 'empty')."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        found = fs.listFiles(at, True)
        below = len(fs.makeQualified(at).toUri().getPath())
        while found.hasNext():
            name = found.next().getPath().toUri().getPath()[below:]
            if not any(s[0] in "_." for s in name.split("/") if s):
                return False
    except Py4JJavaError as e:
        if "java.io.FileNotFoundException" in str(e.java_exception.getClass()):
            return True
        raise
    return True


def any_folder_empty(spark: SparkSession, paths: list[str]) -> bool:
    return any(folder_is_empty(spark, p) for p in paths)


def file_counts(spark: SparkSession, path: str) -> DataFrame:
    """A5 as a table: number of visible files per folder that has any (folder, n_files).

    Folders are listed by tasks, one level of the tree after the other; only the
    number of folders of a level reaches the driver.
    """
    ship_package(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileSelector, FileType
        for batch in batches:
            for folder in batch["folder"]:
                fs, at = filesystem(folder)
                seen = [f for f in fs.get_file_info(FileSelector(at, allow_not_found=True)) if f.base_name[0] not in "_."]
                below = [f"{folder}/{f.base_name}" for f in seen if f.type == FileType.Directory]
                yield pd.DataFrame({"folder": [folder, *below], "n_files": [sum(f.type == FileType.File for f in seen), *([None] * len(below))]}).astype({"n_files": "Int64"})

    level, found = spark.createDataFrame([(path.rstrip("/"),)], "folder string"), None
    while True:
        out = cut_lineage(level.repartition(tasks, "folder").mapInPandas(listed, "folder string, n_files long"))
        done = out.where("n_files > 0")
        found = done if found is None else found.unionByName(done)
        level = out.where("n_files is null").select("folder")
        if level.isEmpty():
            return found
