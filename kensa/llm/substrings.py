"""Repeated word windows removed by recompression.

A text is a sequence of words.  One round names runs (a word repeated k times
becomes one symbol), the next rounds name pairs: every symbol is left or right
by a bit of its hash, and a left symbol followed by a right one becomes one
symbol.  Names are hashes of what they stand for, so they are global: equal
word sequences get equal symbols, except where a symbol at an edge might be
joined with what lies outside.  That is decided by the window's own words: a
leading or trailing run may go on outside, a leading right or trailing left
symbol may be paired outside; all symbols further inside are the same wherever
the window stands.

Each window of ``WINDOW`` words is represented by one inner symbol of the highest
level at which it has any (the one with the smallest hash).  First all texts ask
which of these symbols occur in more than one document.  Windows whose symbol is
shared are then verified: they ask, by a hash of all their words, for the
smallest document they start in.  A word is removed when a window covering it
also starts in a document with a smaller id.  Windows are judged on the input.

Words are runs without white space, unchanged; null text has none.  Texts
shorter than a window keep everything.  Rows that repeat an id are one document
for this purpose (none is smaller than the other); rows with a null id remove
nothing and are no source.  Long texts are read whole.  Extra columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kensa.llm import common, packed

WINDOW = 13
ROUNDS = 3             # rounds of pairs after the round of runs
_C = np.uint64(0x9FB21C651E98DF25)


def windows(first: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """Starts of all windows inside one text."""
    n = int(first[-1])
    left = np.repeat(first[1:], np.diff(first)) - np.arange(n)
    return np.flatnonzero(left >= size)


def window_hashes(words: np.ndarray, starts: np.ndarray, size: int = WINDOW) -> np.ndarray:
    out = np.zeros(len(starts), np.uint64)
    for i in range(size):
        out = common.mix(out * _C + words[starts + i])
    return out


def anchors(words: np.ndarray, first: np.ndarray, starts: np.ndarray, size: int = WINDOW) -> np.ndarray:
    """The representing symbol (with its level) of every window."""
    sym, row = words, common.row_of(first)
    lo, hi = starts.copy(), starts + size
    found = np.zeros(len(starts), np.uint64)
    alive = np.arange(len(starts))

    def settle(which, level, lo, hi):
        """Smallest hash in [lo, hi) of the current symbols."""
        if len(which):
            key = common.mix(sym + np.uint64(level * 0x632BE59BD9B4E019 % 2**64))
            best = key[lo]
            for j in range(1, int((hi - lo).max())):
                at = np.minimum(lo + j, hi - 1)
                best = np.minimum(best, key[at])
            found[which] = best

    def narrow(level, lo2, hi2):
        """Go on with windows that keep a symbol; the others are settled at this level."""
        nonlocal alive, lo, hi
        ok = lo2 < hi2
        settle(alive[~ok], level, lo[~ok], hi[~ok])
        alive, lo, hi = alive[ok], lo2[ok], hi2[ok]

    def rename(joined, new):
        """``joined[i]``: symbol i goes into the one before."""
        nonlocal sym, row, lo, hi
        index = np.cumsum(~joined) - 1
        lo, hi = index[lo], index[hi - 1] + 1
        sym, row = new[~joined], row[~joined]

    if not len(starts):
        return found
    # runs: the first and the last run of a window may go on outside
    same = np.zeros(len(sym), bool)
    same[1:] = (sym[1:] == sym[:-1]) & (row[1:] == row[:-1])
    heads = np.flatnonzero(~same)
    run_of = np.cumsum(~same) - 1
    lengths = np.diff(np.append(heads, len(sym)))
    narrow(0, np.append(heads, len(sym))[run_of[lo] + 1], heads[run_of[hi - 1]])
    new = sym.copy()
    long = lengths > 1
    new[heads[long]] = common.mix(sym[heads[long]] * _C + lengths[long].astype(np.uint64))
    rename(same, new)
    for level in range(1, ROUNDS + 1):
        if not len(alive):
            return found
        right = (common.mix(sym ^ np.uint64(level * 0xA0761D6478BD642F % 2**64)) & np.uint64(1)).astype(bool)
        lo2 = lo + right[lo]
        narrow(level, lo2, hi - ~right[hi - 1])
        pair = np.zeros(len(sym), bool)   # second of a pair
        pair[1:] = right[1:] & ~right[:-1] & (row[1:] == row[:-1])
        new = sym.copy()
        second = np.flatnonzero(pair)
        new[second - 1] = common.mix(sym[second - 1] * _C ^ common.mix(sym[second]))
        rename(pair, new)
    settle(alive, ROUNDS + 1, lo, hi)
    return found


def _spread(keys: np.ndarray, docs: np.ndarray):
    """Sorted distinct keys with the smallest and largest document of each."""
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[heads], docs[heads], docs[np.append(heads[1:], len(keys)) - 1] if len(keys) else docs


def _sources(chunk: packed.Chunk):
    """Windows of texts with an id, their document and their representing symbol."""
    starts = windows(chunk.first)
    row = common.row_of(chunk.first)[starts]
    starts, row = starts[~chunk.null_ids[row]], row[~chunk.null_ids[row]]
    return starts, chunk.ids[row], anchors(chunk.words, chunk.first, starts)


def _ask_symbols(row: dict):
    _, docs, symbols = _sources(packed.Chunk(row))
    keys, low, high = _spread(symbols, docs)
    return keys, np.stack([low, high], 1).reshape(-1, 2)


def _shared(inverse, n, values):
    """Whether a symbol stands in more than one document."""
    low, high = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
    pairs = values.reshape(-1, 2)
    np.minimum.at(low, inverse, pairs[:, 0])
    np.maximum.at(high, inverse, pairs[:, 1])
    return (low < high)[inverse].astype(np.uint8)


def _candidates(row: dict):
    """Windows of a chunk whose symbol is shared: chunk, starts, documents, hashes."""
    chunk = packed.Chunk(row)
    starts, docs, symbols = _sources(chunk)
    shared = packed.told(row, np.uint8).astype(bool)
    keep = shared[np.searchsorted(np.unique(symbols), symbols)] if len(symbols) else np.zeros(0, bool)
    return chunk, starts[keep], docs[keep], window_hashes(chunk.words, starts[keep])


def _ask_windows(row: dict):
    _, _, docs, hashes = _candidates(row)
    keys, low, _ = _spread(hashes, docs)
    return keys, low


def _smallest(inverse, n, values):
    low = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(low, inverse, values)
    return low[inverse]


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by one blank) of every row."""
    chunked = packed.chunks(df, key, text)
    n = packed.bucket_count(df, chunked, 0.3)
    shared = packed.answer(packed.ask(chunked, n, _ask_symbols), n, np.int64, _shared)
    first = chunked.join(common.scratch(shared, "shared"), "cid", "left")  # flags of one byte per symbol
    asked = packed.ask(first, n, _ask_windows)
    low = packed.answer(asked, n, np.int64, _smallest).withColumnRenamed("answers", "low")
    both = first.join(low, "cid", "left")

    def run(batches):
        for row in packed._each(batches):
            chunk, starts, docs, hashes = _candidates(row)
            low = packed.told({"answers": row["low"]}, np.int64)
            old = low[np.searchsorted(np.unique(hashes), hashes)] < docs if len(hashes) else np.zeros(0, bool)
            cover = np.zeros(len(chunk.words) + 1, np.int64)
            np.add.at(cover, starts[old], 1)
            np.add.at(cover, starts[old] + WINDOW, -1)
            gone = np.cumsum(cover)[:-1] > 0
            counts = np.concatenate([[0], np.cumsum(gone)])
            body = chunk.data.tobytes()
            kept = []
            for r in range(len(chunk.ids)):
                a, z = chunk.first[r], chunk.first[r + 1]
                left = np.flatnonzero(~gone[a:z]) + a
                kept.append(b" ".join([body[s:e] for s, e in zip(chunk.starts[left].tolist(), chunk.ends[left].tolist())]))
            yield pa.RecordBatch.from_arrays([chunk.id_column(), pa.array(np.diff(chunk.first)), pa.array(counts[chunk.first[1:]] - counts[chunk.first[:-1]]), pa.array(kept, pa.binary()).cast(pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "kept"])

    return both.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")
