"""Language-model scores by stupid backoff over count tables of the corpus.

Words are runs without white space.  Counts of words and of runs of two and of
``order`` words are taken over all texts; a text is scored by the counts of all
other texts (its own are subtracted), so what is found elsewhere scores high and
what is seen nowhere else backs off:

    S(w | u v) = c(u v w) / c(u v)     if the triple occurs elsewhere
               = 0.4 * S(w | v)        else
    S(w | v)   = c(v w) / c(v)         if the pair occurs elsewhere
               = 0.4 * c(w) / N        else, c(w) at least 1/2

A text's score is the sum of log S over its words (the first word by its own
frequency, the second by pairs, and so on).  The tables are partitioned by hash:
chunks of texts ask each partition for the total counts of their distinct runs
(with their own counts, which make the totals), and the answers meet the chunk
again.  This is done order by order, the highest first: a chunk keeps the sum of
each text so far and at which order each word was settled (a byte a word,
compressed), so the tables of one order are gone before those of the next are made.

Null and empty texts have no words and score 0.  Ties, repeated rows and long
texts need nothing special: each row is its own text.  Extra columns are left out.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kensa.llm import common, packed

BACKOFF = 0.4
_PAIR = np.uint64(0x9FB21C651E98DF25)


def grams(chunk: packed.Chunk, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all runs of ``k`` words within a text, and the places where they end."""
    ends = np.flatnonzero(_place(chunk) >= k - 1)
    keys = common.mix(chunk.words[ends] ^ np.uint64(0x1F123BB5 if k == 1 else 0))
    for back in range(1, k):
        keys = common.mix(chunk.words[ends - back] * _PAIR + keys)
    return keys, ends


def _place(chunk: packed.Chunk) -> np.ndarray:
    """The place of each word in its text, from 0."""
    return np.arange(len(chunk.words)) - np.repeat(chunk.first[:-1], np.diff(chunk.first))


def _question(row: dict, k: int = 1):
    keys, counts = np.unique(grams(packed.Chunk(row), k)[0], return_counts=True)
    return keys, counts.astype(np.uint32)


def _total(inverse, n, values):
    # totals above 2**53 would lose their last digits
    return np.bincount(inverse, values, n).astype(np.uint64)[inverse].astype(np.uint64)


def _per_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(values)])
    return sums[first[1:]] - sums[first[:-1]]


def _own(keys: np.ndarray, row: np.ndarray) -> np.ndarray:
    """How often each item's key occurs in the item's own row."""
    order = np.lexsort((keys, row))
    k, r = keys[order], row[order]
    fresh = np.append(True, (k[1:] != k[:-1]) | (r[1:] != r[:-1])) if len(k) else np.zeros(0, bool)
    group = np.cumsum(fresh) - 1
    out = np.empty(len(k), np.int64)
    out[order] = np.bincount(group)[group] if len(k) else 0
    return out


def _settle(row: dict, chunk: packed.Chunk, k: int, order: int, total: float) -> tuple[np.ndarray, np.ndarray]:
    """The sum of each text and the order of each word (0: not settled) after the counts of runs of ``k`` words."""
    keys, ends = grams(chunk, k)
    asked = np.unique(keys)
    said = packed.told(row, np.uint64).astype(np.int64)
    at = common.row_of(chunk.first)
    count = np.zeros(len(chunk.words), np.int64)
    if len(ends):
        count[ends] = said[np.searchsorted(asked, keys)] - _own(keys, at[ends])
    if k == order:
        sums, level = np.zeros(len(chunk.first) - 1), np.zeros(len(chunk.words), np.uint8)
    else:
        sums = np.frombuffer(row["sums"], np.float64)
        level = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["level"], max_output_size=max(1, len(chunk.words))), np.uint8).copy()
    s = np.zeros(len(chunk.words))
    above = np.flatnonzero(level == k + 1)
    s[above] = -np.log(np.maximum(count[above - 1], 1))
    here = (level == 0) & ((count > 0) | (k == 1))
    value = np.maximum(count, 0.5) / (np.maximum(total - np.diff(chunk.first), 1)[at] if k == 1 else 1.0)
    steps = np.minimum(_place(chunk) + 1, order) - k
    s[here] = np.log(value[here]) + steps[here] * np.log(BACKOFF)
    level[here] = k
    return sums + _per_row(s, chunk.first), level


def score(df: DataFrame, key: str = "doc_id", text: str = "text", order: int = 2) -> DataFrame:
    """doc_id, n_words, n_backoff (words scored by backoff), score (sum of log S), per_word."""
    chunked = packed.chunks(df, key, text)
    n = packed.bucket_count(df, chunked, 1.0)
    total = float(chunked.agg(F.sum("n_words")).first()[0] or 0)

    def step(batches, k):
        for row in packed._each(batches):
            sums, level = _settle(row, packed.Chunk(row), k, order, total)
            yield pa.RecordBatch.from_arrays([pa.array([row["cid"]], pa.int64()), pa.array([sums.tobytes()], pa.binary()), pa.array([zstandard.ZstdCompressor(level=3).compress(level.tobytes())], pa.binary())],
                                             names=["cid", "sums", "level"])

    def last(batches):
        for row in packed._each(batches):
            chunk = packed.Chunk(row)
            sums, level = _settle(row, chunk, 1, order, total)
            sizes = np.diff(chunk.first)
            low = level < np.minimum(_place(chunk) + 1, order)
            yield pa.RecordBatch.from_arrays([chunk.id_column(), pa.array(sizes), pa.array(_per_row(low, chunk.first).astype(np.int64)), pa.array(sums), pa.array(sums / np.maximum(sizes, 1))],
                                             names=["doc_id", "n_words", "n_backoff", "score", "per_word"])

    state = chunked
    for k in range(order, 0, -1):
        totals = packed.answer(packed.ask(chunked, n, partial(_question, k=k)), n, np.uint32, _total)
        met = state.join(totals, "cid", "left")
        if k == 1:
            return met.mapInArrow(last, "doc_id long, n_words long, n_backoff long, score double, per_word double")
        kept = common.scratch(met.mapInArrow(partial(step, k=k), "cid long, sums binary, level binary"), "orders", clean=True)
        state = chunked.join(kept, "cid")
