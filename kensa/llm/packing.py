"""Best-fit packing of tokenised texts by a linear grouping scheme.

Texts become token ids and an end mark; one longer than a sequence is cut into whole
sequences and a shorter first piece.  The plan is made from the number of pieces
of each length, at most ``capacity`` numbers however many pieces there are:

1. Lengths above ``SMALL`` of a sequence are laid out by size and cut into groups of
   equal cardinality; a group's lengths count as its largest.
2. How many sequences to fill with which groups (a configuration) is a covering
   linear programme over the few group sizes, solved by column generation: a knapsack
   over the capacity finds the next configuration worth using.
3. A share of its answer, in whole sequences, is filled with actual pieces.  They are
   shorter than their groups' sizes, and the last of them is chosen to fill the rest.
4. All other pieces, first of all the small ones, go by best fit, the longest first, into
   the fullest sequence that has room, or into new ones.

Step 3 keeps to the programme, step 4 to what is really left, and which of them errs less
depends on the lengths; so plans are made with each of ``TRIES`` (groups, share), and the
one with the fewest sequences is taken.

A plan is a list of strips: pieces number ``rank`` to ``rank + pieces`` of one length go
into sequences from ``sequence`` on, ``each`` to a sequence, from ``offset``.  Its size
follows the capacity and the groups, not the table (``MAX_STRIPS`` is checked).  It is
broadcast; pieces learn their number within their length from a count made while they are
written and from the counts of the partitions before theirs, so a length that most
pieces share is no hot group.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kensa.llm import common

CAPACITY = 2048
SMALL = 1 / 8          # of a sequence: lengths up to this are packed by best fit alone
TRIES = ((16, 0.5), (16, 0.75), (64, 0.5), (64, 0.75))   # number of groups, share of the programme's answer that is used
ROUNDS = 4000          # steps of the programme after which its answer is taken as it is (any answer is a valid plan)
MAX_STRIPS = 2_000_000


def configurations(sizes: np.ndarray, need: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(configurations, how often): fewest sequences in which each size has its need, fractions allowed.

    Column generation: ``prices`` says what a piece of each size is worth; a knapsack finds
    the most valuable configuration, which enters while it is worth more than a sequence.
    """
    k = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1.0 / np.diag(basis))
    amount = inverse @ need
    for step in range(ROUNDS):
        prices = inverse.sum(0)
        column, worth = _knapsack(sizes, prices, capacity)
        if worth <= 1 + 1e-7:
            break
        change = inverse @ column
        ratio = np.where(change > 1e-9, amount / np.where(change > 1e-9, change, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        basis[:, out] = column
        if step % 50 == 49:
            inverse = np.linalg.inv(basis)
        else:
            pivot = inverse[out] / change[out]
            inverse -= np.outer(change, pivot)
            inverse[out] = pivot
        amount = np.maximum(inverse @ need, 0)
    return basis.T.astype(np.int64), amount


def _knapsack(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """The configuration of the largest total price (each size any number of times)."""
    value = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1, np.int64)
    worth = [i for i in np.argsort(-prices / sizes, kind="stable").tolist() if prices[i] > 1e-12]
    for i in worth:
        s, p = int(sizes[i]), prices[i]
        for _ in range(capacity // s):           # each pass may add one more of the size
            better = value[:-s] + p
            up = np.flatnonzero(better > value[s:] + 1e-12)
            if not len(up):
                break
            value[up + s] = better[up]
            last[up + s] = i
    column, at = np.zeros(len(sizes)), capacity
    best = float(value[capacity])
    while at > 0:
        if last[at] < 0:
            at -= 1
            continue
        if value[at - 1] >= value[at]:
            at -= 1
            continue
        column[last[at]] += 1
        at -= int(sizes[last[at]])
    return column, best


class _Rows:
    """Sequences planned so far, by the room they have left, and the strips that fill them."""

    def __init__(self, counts: np.ndarray, capacity: int):
        self.capacity, self.left, self.rank = capacity, counts.copy(), np.zeros(len(counts), np.int64)
        self.room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]   # (first sequence, how many)
        self.some = np.zeros(capacity + 1, bool)
        self.strips: list[tuple[int, int, int, int, int, int]] = []
        self.sequences = 0

    def strip(self, length: int, pieces: int, each: int, sequence: int, offset: int) -> None:
        self.strips.append((length, int(self.rank[length]), pieces, each, sequence, offset))
        self.rank[length] += pieces
        self.left[length] -= pieces

    def add(self, room: int, sequence: int, many: int) -> None:
        if many and room:
            self.room[room].append((sequence, many))
            self.some[room] = True

    def new(self, many: int) -> int:
        self.sequences += many
        return self.sequences - many

    def best_fit(self) -> None:
        """All pieces left, the longest first, each into the least room that holds it."""
        for s in np.flatnonzero(self.left)[::-1].tolist():
            room = s
            while self.left[s]:
                many = int(self.left[s])
                at = int(np.argmax(self.some[room:])) + room if self.some[room:].any() else 0
                if at:
                    room = at
                    sequence, there = self.room[at].pop()
                    self.some[at] = bool(self.room[at])
                else:
                    room = at = self.capacity
                    there = -(-many // (at // s))
                    sequence = self.new(there)
                each = at // s
                full = min(there, many // each)
                if full:
                    self.strip(s, full * each, each, sequence, self.capacity - at)
                    self.add(at - full and at - each * s, sequence, full)
                if full < there:
                    rest = many - full * each if many - full * each < each else 0
                    if rest:
                        self.strip(s, rest, rest, sequence + full, self.capacity - at)
                        self.add(at - rest * s, sequence + full, 1)
                        full += 1
                    self.add(at, sequence + full, there - full)


def make_plan(counts: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Strips (length, rank, pieces, each, sequence, offset) for ``counts[length]`` pieces of every length."""
    if counts[0]:
        raise ValueError("a piece without length has no place")
    solved = {groups: _solve(counts, capacity, groups) for groups in {g for g, _ in TRIES}}
    best = min((_plan(counts, capacity, *solved[g], share) for g, share in TRIES), key=lambda p: p.sequences)
    if len(best.strips) > MAX_STRIPS:
        raise ValueError(f"{len(best.strips)} strips of a plan; at most {MAX_STRIPS} are broadcast")
    strips = np.array(best.strips, np.int64).reshape(-1, 6)
    return strips[np.lexsort((strips[:, 1], strips[:, 0]))]


def _solve(counts: np.ndarray, capacity: int, groups: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Lengths of each group, configurations, and how often each is used (fractions)."""
    large = np.flatnonzero(counts[:capacity])
    large = large[large > SMALL * capacity]
    if not len(large):
        return [], np.zeros((0, 0), np.int64), np.zeros(0)
    # groups of equal cardinality; a length that goes over a border stays whole
    upto = np.cumsum(counts[large])
    group = (upto - counts[large] // 2 - 1) * groups // upto[-1]
    cuts = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    sizes = np.append(large[cuts[1:] - 1], large[-1])
    members = [large[a:z] for a, z in zip(cuts, np.append(cuts[1:], len(large)))]
    return members, *configurations(sizes, np.add.reduceat(counts[large], cuts).astype(float), capacity)


def _plan(counts: np.ndarray, capacity: int, members: list[np.ndarray], used: np.ndarray, amount: np.ndarray, share: float) -> _Rows:
    rows = _Rows(counts, capacity)
    for configuration, many in zip(used, np.floor(share * amount + 1e-6).astype(np.int64).tolist()):
        _fill(rows, [g for g in range(len(members) - 1, -1, -1) for _ in range(configuration[g])], many, members)
    rows.best_fit()
    return rows


def _fill(rows: _Rows, places: list[int], many: int, groups: list[np.ndarray]) -> None:
    """``many`` sequences of one configuration (numbers of groups, the largest first).

    Actual pieces are shorter than their groups' sizes.  The first places take the longest
    piece left of their groups; the last two (of a configuration of one place: it, and the
    room beside it) take a piece of the first one's group and one that fills the rest to the
    last token, as near to the second one's group as there is; if there is none, the two
    longest that fit.
    """
    *front, x_of, y_of = places if len(places) > 1 else [*places, None]
    aim = int(groups[y_of][-1]) if y_of is not None else 0
    while many > 0:
        left, lengths = rows.left.copy(), []
        for g in front:
            of = groups[g][left[groups[g]] > 0]
            if len(of):
                lengths.append(int(of[-1]))
                left[lengths[-1]] -= 1
        room = rows.capacity - sum(lengths)
        x = groups[x_of][(left[groups[x_of]] > 0) & (groups[x_of] < room)]
        y = room - x
        exact = left[y] > (x == y)
        if exact.any():
            best = int(np.where(exact, np.abs(y - aim), rows.capacity).argmin())
            lengths += [int(x[best]), int(y[best])]
        else:
            for of in (x, None):
                of = np.flatnonzero(left[:room + 1]) if of is None else of
                if len(of):
                    lengths.append(int(of[-1]))
                    left[lengths[-1]] -= 1
                    room -= lengths[-1]
        if not lengths:
            return
        run = min(many, *(int(rows.left[n]) // lengths.count(n) for n in lengths))
        sequence, offset = rows.new(run), 0
        for length in lengths:
            rows.strip(length, run, 1, sequence, offset)
            offset += length
        rows.add(rows.capacity - offset, sequence, run)
        many -= run


@lru_cache(maxsize=2)
def _encoding(data: bytes):
    """A byte-level BPE from a tokenizers file.  tiktoken gives the same ids several times faster; ranks are ids."""
    import tiktoken
    spec = json.loads(data)
    before = spec["pre_tokenizer"] or {}
    if (spec["model"]["type"], before.get("type"), before.get("add_prefix_space"), before.get("use_regex", True), spec["normalizer"]) != ("BPE", "ByteLevel", False, True, None):
        raise ValueError("only byte-level BPE files without a normaliser or prefix space are read")
    # the printable bytes stand for themselves, the others for the characters from 256 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
    ranks = {bytes(byte[c] for c in piece): i for piece, i in spec["model"]["vocab"].items()}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    # Fixed value: the word pattern of byte-level BPE files.
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    encoding = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks={k: v for k, v in ranks.items() if v not in special.values()}, special_tokens=special)
    return encoding, tuple(special)


def token_ids(data: bytes, text: str) -> np.ndarray:
    """Ids of a text as the tokenizers library gives them without special tokens added (uint32)."""
    encoding, special = _encoding(data)
    if any(t in text for t in special):
        return np.array(encoding.encode(text, allowed_special="all"), np.uint32)
    return np.array(encoding.encode_ordinary(text), np.uint32)


def tokenise(df: DataFrame, data: bytes, key: str = "doc_id", text: str = "text", end: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """<key>, piece, start, length, ids (little-endian unsigned 32 bit) of every piece of every text.

    ``data``: a tokenizers file.  Each text ends with the id ``end``, so a null or empty
    one has this id alone.  Longer texts than ``capacity`` are cut; only the first piece
    is shorter then.  Repeated rows and null keys are texts like any other, other columns
    are left out, an empty table gives an empty one.
    """
    common.prepare(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(data)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, _, _ in common.pieces(batch, "__text", common.PIECE_BYTES // 2):
                row, piece, start, size, ids = [], [], [], [], []
                for i, t in enumerate(rows.column(1).to_pylist()):
                    all_ids = np.append(token_ids(shared.value, t or ""), np.uint32(end)).astype("<u4")
                    n = len(all_ids)
                    cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                    for j, (a, z) in enumerate(zip(cuts, cuts[1:])):
                        row.append(i)
                        piece.append(j)
                        start.append(a)
                        size.append(z - a)
                        ids.append(all_ids[a:z].tobytes())
                yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(ids, pa.binary())],
                                                 names=["__key", "piece", "start", "length", "ids"])

    asked = df.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").alias("__text"))
    return asked.mapInArrow(run, f"__key {kind}, piece int, start bigint, length bigint, ids binary").withColumnRenamed("__key", key)


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset (both long): their place in sequences of at most ``capacity``.

    Lengths must be whole numbers from 1 to ``capacity``; a null one has no place (both
    null), any other is an error.  Rows may repeat; no column but ``length`` matters, and
    columns named sequence_id or offset are replaced.  An empty table gives an empty one.
    """
    spark = pieces.sparkSession
    common.prepare(spark)
    clash = [c for c in ("sequence_id", "offset") if c in pieces.columns]
    size = F.col(f"`{length}`").cast("long").alias("__size")
    asked = pieces.drop(*clash).select("*", size)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Within a partition: how many pieces of its length stand before each."""
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            n = batch.column(batch.num_columns - 1).fill_null(0).to_numpy(zero_copy_only=False)
            if len(n) and (n.min() < 0 or n.max() > capacity):
                raise ValueError(f"lengths must be from 1 to {capacity}")
            order = np.argsort(n, kind="stable")
            s = n[order]
            rank = np.empty(len(n), np.int64)
            rank[order] = np.arange(len(n)) - np.searchsorted(s, s) + seen[s]
            seen += np.bincount(n, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rank)], names=[*batch.schema.names, "__rank"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in asked.schema.fields)
    # written once: every later step sees the same partitions and numbers
    numbered = common.scratch(asked.mapInArrow(number, f"{fields}, __rank bigint").withColumn("__part", F.spark_partition_id()), "pieces")
    by_part = numbered.where("__size is not null").groupBy("__part", "__size").agg(F.count("*").alias("__n"))
    counts = np.zeros(capacity + 1, np.int64)
    for r in by_part.groupBy("__size").agg(F.sum("__n").alias("n")).collect():   # at most ``capacity`` rows
        counts[r["__size"]] = r["n"]
    plan = spark.sparkContext.broadcast(make_plan(counts, capacity))
    before = Window.partitionBy("__size").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    base = by_part.select("__part", "__size", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strips = plan.value
        # one ascending key of length and rank; a rank is below the number of pieces of its length
        width = int(counts.max()) + 1
        keys = strips[:, 0] * width + strips[:, 1]
        for batch in batches:
            at = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            none = at["__base"].is_null()
            n, rank = at["__size"].fill_null(0).to_numpy(zero_copy_only=False), at["__rank"].to_numpy(zero_copy_only=False) + at["__base"].fill_null(0).to_numpy(zero_copy_only=False)
            if len(strips):
                strip = strips[np.maximum(np.searchsorted(keys, n * width + rank, "right") - 1, 0)]
                k = rank - strip[:, 1]
                sequence, offset = strip[:, 4] + k // strip[:, 3], strip[:, 5] + k % strip[:, 3] * n
            else:
                sequence = offset = np.zeros(len(n), np.int64)
            empty = none.to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([*[at[c] for c in kept], pa.array(sequence, mask=empty), pa.array(offset, mask=empty)], names=[*kept, "sequence_id", "offset"])

    kept = [c for c in asked.columns if c != "__size"]
    out = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in asked.schema.fields if f.name != "__size")
    return numbered.join(base, ["__part", "__size"], "left").mapInArrow(place, f"{out}, sequence_id bigint, offset bigint")
