"""Questions from texts to a table of hashed keys, and the answers back, in packed form.

Texts are written once as chunks (about ``CHUNK_WORDS`` words, compressed).  A
chunk asks about its distinct keys: for each bucket of the key space one row
with the sorted keys and a value for each.  A bucket sees all chunks' keys that
fall in it, whatever their number of documents, and answers each row with one
value per key.  A key asked by a third of all documents is one entry per chunk,
and buckets are cut from the hash space so that each holds about
``BUCKET_KEYS`` entries: their number grows with the input, not their size.

Keys travel as 48 bits beside the bucket, which is cut from the upper 24 bits of
the 64-bit key: with b buckets, two keys are confused with chance 2^-48 / b.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kensa.llm import common

CHUNK_BYTES = 1_500_000
BUCKET_KEYS = 2_000_000
_KIND = "cid long, n_words long, ids binary, null_ids binary, offsets binary, packed binary"


def chunks(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write (key, text) rows as compressed chunks; null texts count as empty."""
    def run(batches):
        from pyspark import TaskContext
        n, squeeze = 0, zstandard.ZstdCompressor(level=3)
        part = TaskContext.get().partitionId()
        for batch in batches:
            for rows, data, offsets in common.pieces(batch, "__text", CHUNK_BYTES):
                starts = common.find_words(data, offsets)[0]
                ids = rows.column(0).fill_null(0).to_numpy()
                nulls = rows.column(0).is_null().to_numpy(zero_copy_only=False)
                values = [(part << 32) + n, len(starts), ids.astype(np.int64).tobytes(), nulls.tobytes(), offsets.astype(np.int64).tobytes(), squeeze.compress(data.tobytes())]
                n += 1
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, [pa.int64()] * 2 + [pa.binary()] * 4)], names=["cid", "n_words", "ids", "null_ids", "offsets", "packed"])

    return common.scratch(df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("__text")).mapInArrow(run, _KIND), "chunks")


class Chunk:
    """An unpacked chunk: ids, offsets, bytes and words of its texts."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.null_ids = np.frombuffer(row["null_ids"], bool)
        self.offsets = np.frombuffer(row["offsets"], np.int64)
        self.data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["packed"], max_output_size=max(1, int(self.offsets[-1]))), np.uint8)
        self.starts, self.ends, self.first = common.find_words(self.data, self.offsets)
        self.words = common.hash_words(self.data, self.starts, self.ends)

    def id_column(self) -> pa.Array:
        return pa.array(self.ids, mask=self.null_ids)


def _each(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def bucket_count(df: DataFrame, words: DataFrame, per_word: float) -> int:
    total = words.agg(F.sum("n_words")).first()[0] or 0
    return int(max(common.parts_for(df), total * per_word // BUCKET_KEYS + 1))


def _squeeze(values: np.ndarray) -> bytes:
    """Values column by column of bytes, compressed: small numbers take about a byte."""
    flat = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(flat.T).tobytes())


def _open(data: bytes, value_type) -> np.ndarray:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(value_type).itemsize, -1)
    return np.ascontiguousarray(flat.T).view(value_type).ravel()


def _bucket(keys: np.ndarray, n: int) -> np.ndarray:
    return ((keys >> np.uint64(40)) * np.uint64(n) >> np.uint64(24)).astype(np.int64)


def ask(chunked: DataFrame, n_buckets: int, question: Callable) -> DataFrame:
    """Rows (bucket, cid, keys, values); ``question(row)`` gives sorted distinct uint64 keys and a values array."""
    def run(batches):
        for row in _each(batches):
            keys, values = question(row)
            at = _bucket(keys, n_buckets)
            cuts = np.flatnonzero(np.diff(at, prepend=-1))
            ends = np.append(cuts[1:], len(keys))
            if len(cuts):
                low = keys.view(np.uint8).reshape(-1, 8)[:, :6]
                yield pa.RecordBatch.from_arrays([pa.array(at[cuts].astype(np.int32)), pa.array([row["cid"]] * len(cuts), pa.int64()),
                                                  pa.array([low[a:z].tobytes() for a, z in zip(cuts, ends)], pa.binary()), pa.array([_squeeze(values[a:z]) for a, z in zip(cuts, ends)], pa.binary())],
                                                 names=["bucket", "cid", "keys", "vals"])

    return chunked.mapInArrow(run, "bucket int, cid long, keys binary, vals binary")


def answer(asked: DataFrame, n_buckets: int, value_type, reply: Callable) -> DataFrame:
    """(cid, answers): ``reply(inverse, n_keys, values)`` gives one value per asked entry of a bucket."""
    def settle(bucket, cids, keys, values):
        sizes = [len(k) // 6 for k in keys]
        wide = np.zeros((sum(sizes), 8), np.uint8)
        wide[:, :6] = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, 6)
        distinct, inverse = np.unique(wide.view(np.uint64).ravel(), return_inverse=True)
        said = reply(inverse, len(distinct), np.concatenate([_open(v, value_type) for v in values]))
        ends = np.cumsum(sizes)
        return pa.RecordBatch.from_arrays([pa.array(cids, pa.int64()), pa.array([bucket] * len(cids), pa.int32()), pa.array([_squeeze(said[z - n:z]) for z, n in zip(ends, sizes)], pa.binary())], names=["cid", "bucket", "said"])

    def run(batches):
        held: tuple[int, list, list, list] | None = None
        for batch in batches:
            for bucket, cid, keys, vals in zip(*(batch.column(c).to_pylist() for c in ("bucket", "cid", "keys", "vals"))):
                if held and held[0] != bucket:
                    yield settle(*held)
                    held = None
                held = held or (bucket, [], [], [])
                for store, value in zip(held[1:], (cid, keys, vals)):
                    store.append(value)
        if held:
            yield settle(*held)

    parts = max(common.parts_for(asked), n_buckets // 4)
    back = asked.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(run, "cid long, bucket int, said binary")
    return back.groupBy("cid").agg(F.collect_list(F.struct("bucket", "said")).alias("answers"))


def told(row: dict, value_type) -> np.ndarray:
    """The answers of a chunk in the order of its keys."""
    got = sorted(row["answers"] or [], key=lambda a: a["bucket"])
    return np.concatenate([np.zeros(0, value_type), *(_open(a["said"], value_type) for a in got)])
