"""Helpers shared by the training-data operators.

Texts reach Python as Arrow record batches.  A batch is cut into pieces of a few
megabytes and worked on as flat NumPy arrays (bytes, word starts, word hashes),
so a task's memory follows the piece, or the longest single text, not the table.
"""

from __future__ import annotations

import ctypes
import os
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kensa import session as _session
from kensa.sources.tables import table

PIECE_BYTES = 2 << 20
SEGMENT_BYTES = 1 << 20

# White space of the word rule: space and U+0009 to U+000D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BYTE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)


def prepare(spark: SparkSession) -> None:
    """Make the package importable in Python workers."""
    _session.ship_package(spark)


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def scratch(df: DataFrame, name: str, clean: bool = False, batch: int | None = None) -> DataFrame:
    """Write ``df`` once under the shared ``spark.checkpoint.dir`` and read it back.

    Cuts lineage: later steps reread the files, also after an executor is lost.
    ``clean``: Spark removes the write's shuffle files at its end instead of at some
    later garbage collection.  ``batch``: at most so many rows go to a Python worker at once,
    for rows that are long.  (Both are set for this write alone, then put back.)
    """
    spark = df.sparkSession
    path = _session.ensure_checkpoint_dir(spark).rstrip("/") + f"/kensa-{name}-{uuid.uuid4().hex}"
    if getattr(_TRACKED, "made", None) is not None:
        _TRACKED.made.append(path)
    settings = ({_CLEAN: "true"} if clean else {}) | ({_BATCH: str(batch)} if batch else {})
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, value in settings.items():
            spark.conf.set(k, value)
        df.write.parquet(path)
    finally:
        for k, value in before.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)
    return spark.read.schema(df.schema).parquet(path)


_TRACKED = threading.local()


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """What ``scratch`` writes inside is removed at the end.  Only for steps whose result has
    been written by then: whatever still reads the scratch data would find it gone."""
    made: list[str] = []
    before = getattr(_TRACKED, "made", None)
    _TRACKED.made = made
    try:
        yield
    finally:
        _TRACKED.made = before
        for path in made:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder, wherever the session's file systems keep it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def bucket(column: Column | str, n: int) -> Column:
    """crc32 of a value written as text, mod ``n`` (null stays null)."""
    c = F.col(column) if isinstance(column, str) else column
    return F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(n))


def pieces(batch: pa.RecordBatch, column: str = "text", size: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch by the bytes of a text column: (rows, bytes, offsets of each row)."""
    i = batch.schema.get_field_index(column)
    text = batch.column(i)
    if not pa.types.is_large_string(text.type):
        text = text.cast(pa.large_string())
    n = len(text)
    if n == 0:
        return
    offsets = np.frombuffer(text.buffers()[1], np.int64, n + 1, text.offset * 8)
    data = np.frombuffer(text.buffers()[2], np.uint8) if text.buffers()[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, "right")) - 1)
        hi = min(hi, n)
        yield batch.slice(lo, hi - lo), data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def release() -> None:
    """Give freed memory back to the machine at the end of a task: workers live on, and the next
    stage's workers share the executor's memory with what they still hold."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def find_words(data: np.ndarray, offsets: np.ndarray, not_word: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the first word of each row (one more entry at the end)."""
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    word = ~not_word[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    inner = offsets[(offsets > 0) & (offsets < n)]
    start[inner] = word[inner]
    end = word.copy()
    end[:-1] &= ~word[1:]
    end[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(SEGMENT_BYTES + 1, _BASE, np.uint64), np.full(SEGMENT_BYTES + 1, _BASE_INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word: polynomial over random byte codes, by prefix sums.

    Words are taken a segment of bytes at a time (a longer word in segments of its own),
    so the memory needed besides the result doesn't follow the text.
    """
    h = np.zeros(len(starts), np.uint64)
    up, down = _powers()
    lo = 0
    while lo < len(starts):
        at = int(starts[lo])
        hi = int(np.searchsorted(ends, at + SEGMENT_BYTES, "right"))
        if hi > lo:
            part = data[at:int(ends[hi - 1])]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_BYTE[part] * up[:len(part)], out=sums[1:])
            h[lo:hi] = (sums[ends[lo:hi] - at] - sums[starts[lo:hi] - at]) * down[starts[lo:hi] - at]
        else:
            hi, end, total = lo + 1, int(ends[lo]), 0
            for a in range(at, end, SEGMENT_BYTES):
                part = data[a:min(a + SEGMENT_BYTES, end)]
                total += int((_BYTE[part] * up[:len(part)]).sum(dtype=np.uint64)) * pow(_BASE, a - at, 2**64)
            h[lo] = total % 2**64
        lo = hi
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def row_of(first: np.ndarray) -> np.ndarray:
    """Row number of each item, from the first item of every row."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def parts_for(df: DataFrame) -> int:
    """Partitions for a shuffle of this session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def smallest_labels(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge table: (node, component), the smallest reachable node.

    Alternates large-star and small-star steps: each hangs a node's neighbours on
    the smallest of them, so long chains fold in a logarithmic number of rounds.
    All steps are joins and partial aggregates on the edge table; only a count
    and a checksum reach the driver.  It ends: no step hangs a node on a larger one than
    before, so the labels fall until none can.
    """
    edges = scratch(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct(), "links")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        edges = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        hung = edges.join(low, "u")
        edges = scratch(hung.select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .unionByName(low.select("u", F.col("m").alias("v"))).where("u != v").distinct(), "links")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == seen:
            return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
        seen = now
