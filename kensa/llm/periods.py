"""Periodic runs of words, found with a dictionary of basic factors.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are identical) that is at least ``times * q`` and ``shortest`` words long
and that no neighbouring word extends.

The dictionary names every stretch of 1, 2, 4, ... words of a text: a stretch
of ``2l`` words is named by the pair of names of its halves, so equal names are
equal words.  A stretch that occurs once in its text has no name; its longer
stretches cannot repeat either and are left out, so prose costs little beyond its
first names.  At length ``l`` every occurrence looks at its successor, the next
occurrence of its name.  Successors at a distance ``d <= 2l`` of neighbouring
occurrences form arithmetic progressions with step ``d``: each proposes period ``d``
for the words it covers.  The proposal is extended word by word on either side, and
of proposals for one stretch the smallest period is kept.

None is lost: for a run of period ``q`` let ``l`` be the power of two with
``q <= l < 2q``.  The run has at least ``3q > q + l`` words, so its first stretch of
``l`` words occurs again ``q`` later, and no sooner, as two periods on ``q + l`` words
or more would leave a smaller one.  (``times`` is therefore 3 at least.)

Texts are worked on whole, many short ones at a time, within one task and without a
shuffle; memory follows the longest single text.  Null and empty texts have no words
and no runs; ties, repeated rows and a null id need nothing special, each row is its
own text; an empty table gives an empty table.  Other columns are left out unless
named in ``keep``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kensa.llm import common

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def find_runs(words: np.ndarray, first: np.ndarray, shortest: int = 24, times: int = 3) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs in texts laid end to end.

    ``words``: a number for each word; ``first``: the first word of each text, and the
    end of the last.  Ordered by start, then period.
    """
    if times < 3:
        raise ValueError("times must be 3 or more")
    n, size = len(words), np.diff(first)
    low, high = np.repeat(first[:-1], size), np.repeat(first[1:], size)   # bounds of each word's text
    name = np.full(n, -1, np.int64)
    place = np.flatnonzero(high - low >= max(shortest, times))
    key = words[place]
    found: list[np.ndarray] = []
    l = 1
    while len(place):
        order = np.argsort(key, kind="stable")
        at, k = place[order], key[order]
        new = np.ones(len(at), bool)
        new[1:] = (k[1:] != k[:-1]) | (low[at[1:]] != low[at[:-1]])
        # proposals: successors within twice the length, joined to progressions
        step = np.zeros(n, np.int64)
        near = np.flatnonzero(~new[1:] & (at[1:] - at[:-1] <= 2 * l)) if len(at) > 1 else np.zeros(0, np.int64)
        step[at[near]] = at[near + 1] - at[near]
        begins = np.flatnonzero((step > 0) & (step != np.concatenate([[0], step[:-1]])))
        if len(begins):
            ends = np.flatnonzero((step > 0) & (step != np.concatenate([step[1:], [0]])))
            d = step[begins]
            found.append(_extend(words, low, high, begins, ends + l + d, d, shortest, times))
        # names of the next length: pairs of names that both repeat
        alone = new.copy()
        alone[:-1] &= new[1:]
        name[:] = -1
        name[at[~alone]] = np.cumsum(new)[~alone]
        place = np.sort(at[~alone])
        place = place[(place + 2 * l <= high[place]) & (times * (l + 1) <= high[place] - low[place])]
        second = name[place + l]
        place, second = place[second >= 0], second[second >= 0]
        key = (name[place].astype(np.uint64) << np.uint64(32)) | second.astype(np.uint64)
        l *= 2
    if not found:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    start, end, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    one = np.ones(len(start), bool)
    one[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[one], end[one], period[one]
    order = np.lexsort((period, start))
    return start[order], (end - start)[order], period[order]


def _extend(words, low, high, start, end, d, shortest, times) -> np.ndarray:
    """Stretches of period ``d`` made as long as their text allows; those long enough.

    A stretch grows to the right until it shares a whole period with the next stretch of
    its period, and is one with it then; so words between stretches are compared once.
    """
    order = np.lexsort((start, d))
    start, end, d = start[order], end[order].copy(), d[order]
    top = high[start]
    goal = np.full(len(start), np.iinfo(np.int64).max)
    goal[:-1] = np.where((d[1:] == d[:-1]) & (top[1:] == top[:-1]), start[1:] + d[1:], goal[:-1])
    live = np.arange(len(start))
    while len(live):
        live = live[end[live] < np.minimum(top[live], goal[live])]
        live = live[words[end[live]] == words[end[live] - d[live]]]
        end[live] += 1
    last = end < goal
    head = np.concatenate([[True], last[:-1]])
    start, end, d = start[head].copy(), np.maximum.reduceat(end, np.flatnonzero(head)), d[head]
    live = np.arange(len(start))
    while len(live):
        live = live[start[live] > low[start[live]]]
        live = live[words[start[live] - 1] == words[start[live] - 1 + d[live]]]
        start[live] -= 1
    keep = end - start >= np.maximum(shortest, times * d)
    return np.stack([start[keep], end[keep], d[keep]])


def collapsed(n: int, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay when each run is cut to its first period."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    return np.cumsum(depth)[:n] == 0


def periodic_runs(df: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = 24, times: int = 3,
                  reorder: Callable[[object, int], np.ndarray | None] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """<key>, <keep>, n_words, runs (start, length, period; by start, then period), collapsed.

    ``collapsed``: the words that no run contains after its first period, joined by one
    space.  ``reorder`` may give, for an id and its number of words, the places of the
    words to read instead of 0, 1, 2, ... (None: as they stand).
    """
    common.prepare(df.sparkSession)
    fields = df.select(key, *keep).schema.fields
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    # a private name, so that no column of the caller's can clash
    asked = df.select(*[F.col(f"`{f.name}`") for f in fields], F.col(f"`{text}`").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, data, offsets in common.pieces(batch, "__text"):
                yield _piece(rows, data, offsets, shortest, times, reorder, len(fields))

    return asked.mapInArrow(run, f"{kept}, n_words bigint, runs {RUNS}, collapsed string")


def _piece(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, shortest: int, times: int, reorder, width: int) -> pa.RecordBatch:
    starts, ends, first = common.find_words(data, offsets)
    size = np.diff(first)
    order = np.arange(len(starts))
    if reorder is not None:
        for i, k in enumerate(rows.column(0).to_pylist()):
            if size[i] and (places := reorder(k, int(size[i]))) is not None:
                order[first[i]:first[i + 1]] = first[i] + places
    words = common.hash_words(data, starts, ends)[order]
    s, length, period = find_runs(words, first, shortest, times)
    stays = collapsed(len(words), s, length, period)
    text_of = np.searchsorted(first, s, "right") - 1
    per = np.searchsorted(text_of, np.arange(len(rows) + 1))
    runs = pa.ListArray.from_arrays(pa.array(per, pa.int32()), pa.StructArray.from_arrays(
        [pa.array(s - first[text_of]), pa.array(length), pa.array(period)], fields=list(_RUN.value_type)))
    return pa.RecordBatch.from_arrays([*rows.columns[:width], pa.array(size), runs, join_words(data, starts, ends, order[stays], np.concatenate([[0], np.cumsum(stays)])[first])],
                                      names=[*rows.schema.names[:width], "n_words", "runs", "collapsed"])


def join_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, order: np.ndarray, first: np.ndarray) -> pa.Array:
    """Texts of the words ``order`` (numbers of words), joined by one space; ``first``: where each text begins in it."""
    size = (ends - starts)[order] + 1           # each word and a space
    at = np.concatenate([[0], np.cumsum(size)])
    out = np.full(at[-1], 0x20, np.uint8)
    lo = 0
    while lo < len(order):                      # some words at a time, as the places of bytes need memory
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + common.PIECE_BYTES, "right")) - 1)
        long = size[lo:hi] - 1
        shift = starts[order[lo:hi]] - (at[lo:hi] - at[lo])
        places = np.arange(at[hi] - at[lo])
        inside = np.ones(len(places), bool)
        inside[at[lo:hi] - at[lo] + long] = False
        out[at[lo]:at[hi]][inside] = data[(places + np.repeat(shift, long + 1))[inside]]
        lo = hi
    some = np.diff(first) > 0
    stay = np.ones(len(out), bool)
    stay[at[first[1:]][some] - 1] = False       # no space behind the last word of a text
    size = np.diff(at[first]) - some
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(some), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(out[stay])))
