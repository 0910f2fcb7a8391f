"""Continuous intake and stream management.

New image files and new inspection rows arrive as file streams; verdicts
and scores are the same DataFrame functions as in batch, applied to a
streaming DataFrame.  Every query is named and writes its progress to a
checkpoint under the shared ``spark.checkpoint.dir``, so a restarted or
re-planned query resumes where it stopped.
"""

from __future__ import annotations

import os
import threading
import time
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kensa.operators.anomalies import verdict
from kensa.session import ensure_checkpoint_dir

# Spark's image source schema, needed to open it as a stream.
IMAGE_STRUCT = T.StructType([
    T.StructField("origin", T.StringType()), T.StructField("height", T.IntegerType()),
    T.StructField("width", T.IntegerType()), T.StructField("nChannels", T.IntegerType()),
    T.StructField("mode", T.IntegerType()), T.StructField("data", T.BinaryType())])
IMAGE_SCHEMA = T.StructType([T.StructField("image", IMAGE_STRUCT)])
BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])

FILES_PER_BATCH = 10_000
SMALL_FILE = 64 << 10     # what opening a small file counts for, in bytes


def stream_images(spark: SparkSession, path: str, decoded: bool = True, glob: str | None = None,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of newly arriving image files (decoded, or raw bytes)."""
    r = spark.readStream.option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    r = r.schema(IMAGE_SCHEMA).format("image") if decoded else r.schema(BINARY_FILE_SCHEMA).format("binaryFile")
    with _settings(spark, {_LISTED: "0"}):  # what is there is listed here, and again by the stream
        return r.load(path)


def stream_table_files(spark: SparkSession, folder: str, schema: T.StructType,
                       glob: str | None = None, fmt: str = "parquet") -> DataFrame:
    """A stream over the files of one table (new files are new rows)."""
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.format(fmt).load(folder)


def stream_verdicts(src: DataFrame, label: str = "label") -> DataFrame:
    """The batch verdict rule (P9) applied to each arriving row; a
    stateless, append-only stream."""
    return verdict(src, label)


def score_stream(spark: SparkSession, path: str, scorer_factory, glob: str | None = None,
                 batch_rows: int = 64) -> DataFrame:
    """X1 + M7 + P9: new image files -> scores -> verdicts, as a stream.
    The same functions as batch scoring; a bad file gives an ``error`` row
    (and no verdict), never a failed micro-batch."""
    from kensa.operators.ml import score_images  # image stack only when used
    images = stream_images(spark, path, glob=glob).withColumn("origin", F.col("image.origin"))
    scored = score_images(images, scorer_factory, keep=("origin",), batch_rows=batch_rows)
    present = F.col("error").isNull()
    return verdict(scored.withColumn("_present", present), "label", present="_present").drop("_present")


def score_stream_with(spark: SparkSession, path: str, model_path: str, side: int, glob: str | None = None,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """X1 + M7: new image files scored with a model that was fitted and saved before, at most
    ``max_files_per_trigger`` (``FILES_PER_BATCH``) of them in a batch, as the driver holds a
    batch's listing and plan."""
    from kensa.operators.ml import load_model, score_images_with
    images = stream_images(spark, path, glob=glob, max_files_per_trigger=max_files_per_trigger or FILES_PER_BATCH).withColumn("origin", F.col("image.origin"))
    return score_images_with(load_model(model_path), images, side, keep=("origin",))


def checkpoint_location(spark: SparkSession, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark).rstrip("/"), "kensa-streams", name)


def start_append(df: DataFrame, name: str, path: str, fmt: str = "parquet",
                 available_now: bool = False, processing_time: str | None = None,
                 checkpoint: str | None = None) -> StreamingQuery:
    """X2 sink: append-only file sink, named, with a checkpoint (exactly-once
    file output)."""
    w = (df.writeStream.queryName(name).outputMode("append").format(fmt)
         .option("checkpointLocation", checkpoint or checkpoint_location(df.sparkSession, name)))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start(path)


# ---- X3-X5: managing running streams --------------------------------------------

def _matches(q: StreamingQuery, prefix: str) -> bool:
    """Prefix test on the name; a stream without one is read as the empty text."""
    return (q.name or "").startswith(prefix)


def matching_streams(spark: SparkSession, prefix: str = "") -> list[StreamingQuery]:
    return [q for q in spark.streams.active if _matches(q, prefix)]


ACTIVE_SCHEMA = "name string, id string, run_id string, is_active boolean, message string, batch_id long"


def active_streams(spark: SparkSession, prefix: str = "") -> DataFrame:
    """The running streams whose name starts with ``prefix``, as rows."""
    rows = []
    for q in matching_streams(spark, prefix):
        prog = q.lastProgress or {}
        rows.append((q.name, str(q.id), str(q.runId), q.isActive, q.status.get("message"),
                     prog.get("batchId")))
    return spark.createDataFrame(rows, ACTIVE_SCHEMA)


def stop_streams(spark: SparkSession, prefix: str = "", delay: float = 0.0,
                 background: bool = False):
    """Stop matching streams after ``delay`` seconds.  Returns a list of
    ``(name, error)`` -- failures are reported, not hidden -- or, with
    ``background``, the thread doing it (its ``result`` attribute holds the
    list when it ends)."""
    def work():
        time.sleep(delay)
        out = []
        for q in matching_streams(spark, prefix):
            try:
                q.stop()
                out.append((q.name, None))
            except Exception as e:  # noqa: BLE001 - reported per stream
                out.append((q.name, f"{type(e).__name__}: {e}"))
        return out

    if not background:
        return work()
    t = threading.Thread(target=lambda: setattr(t, "result", work()), daemon=True)
    t.result = None
    t.start()
    return t


def await_streams(spark: SparkSession, prefix: str = "", timeout: float = 60.0) -> bool:
    """Wait until every matching stream has ended (only those, not any
    stream); false when ``timeout`` seconds pass first."""
    deadline = time.monotonic() + timeout
    for q in matching_streams(spark, prefix):
        left = deadline - time.monotonic()
        if left <= 0 or not q.awaitTermination(left):
            return False
    return True


_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_LISTED = "spark.sql.hive.filesourcePartitionFileCacheSize"
_OPEN_COST = "spark.sql.files.openCostInBytes"


@contextmanager
def _settings(spark: SparkSession, new: dict[str, str]) -> Iterator[None]:
    """Session settings for a while, then put back."""
    before = {k: spark.conf.get(k) for k in new}
    for k, value in new.items():
        spark.conf.set(k, value)
    try:
        yield
    finally:
        for k, value in before.items():
            spark.conf.set(k, value)


def few_listing_tasks(spark: SparkSession, open_cost: int | None = None) -> AbstractContextManager[None]:
    """Files of a batch are looked up by a few tasks a core, instead of a task each (up to
    10,000) whose start and report cost more than the look-up, and the driver does not keep what
    was found; with ``open_cost`` they are also read by fewer tasks, as opening one counts for so
    many bytes of a task's share.  Set while a stream is run here, then put back."""
    new = {_LISTING: str(min(int(spark.conf.get(_LISTING)), 4 * spark.sparkContext.defaultParallelism)), _LISTED: "0"}
    return _settings(spark, new if open_cost is None else new | {_OPEN_COST: str(open_cost)})


def run_until_batch(df: DataFrame, name: str, out_path: str, checkpoint: str, batches: int = 1, timeout: float = 600.0) -> int:
    """Run a stream until it has completed ``batches`` batches and stop it there, ready to
    be started again from its checkpoint; returns the number of completed batches."""
    with few_listing_tasks(df.sparkSession):
        q = start_append(df, name, out_path, processing_time="0 seconds", checkpoint=checkpoint)
        deadline = time.monotonic() + timeout
        try:
            while q.isActive and len({p["batchId"] for p in q.recentProgress if p["numInputRows"]}) < batches:
                if time.monotonic() >= deadline:
                    raise TimeoutError(f"stream {name} did not complete {batches} batches in {timeout}s")
                time.sleep(0.05)
            if q.exception() is not None:
                raise q.exception()
            return len({p["batchId"] for p in q.recentProgress if p["numInputRows"]})
        finally:
            q.stop()


def drain(df: DataFrame, name: str, out_path: str, timeout: float | None = None,
          checkpoint: str | None = None, open_cost: int | None = None) -> DataFrame:
    """Run a stream over everything available now, then read its output with
    the stream's schema (an empty input gives an empty table).  There is no
    time limit unless one is given.  ``open_cost`` (``SMALL_FILE`` for many small files): bytes
    that opening a file counts for when files are dealt to tasks."""
    with few_listing_tasks(df.sparkSession, open_cost):
        q = start_append(df, name, out_path, available_now=True, checkpoint=checkpoint)
        if timeout is None:
            q.awaitTermination()
        elif not q.awaitTermination(timeout):
            q.stop()
            raise TimeoutError(f"stream {name} did not finish in {timeout}s")
        if q.exception() is not None:
            raise q.exception()
    return df.sparkSession.read.schema(df.schema).parquet(out_path)
