"""Benchmark decontamination: BM25 with block-max pruning, then question and answer overlap.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z
lower-cased.  An item of more than ``PASSAGE`` words is listed as several entries
of at most so many, a shorter one as one.  Every passage of a text (``PASSAGE``
words, a new one every ``STRIDE``) is a query against an inverted index of the
entries.  Scores are BM25 divided by the score the entry gives itself, so
``THRESHOLD`` means the same for every item of any length: of a whole copy of an
entry some passage holds at least half the weight.  All entries at or above it
are retrieved.  As in
block-max WAND, a passage is given up when the largest scores of its words over
all items cannot reach the threshold, and a block of items when their largest
scores in the block cannot; only the blocks left are scored in full.  Passages
are worked on many at a time.

A retrieved item is verified: the share of the three-word shingles of its
question, and of its answer, that stand in the text around the passage (further by
the item's length on both sides if it is longer than a passage) must both
reach ``OVERLAP``.  The answer is what follows the last ``Answer:``, or else the
last sentence; an item of one sentence is all question.  Parts shorter than three
words are looked for whole.

The index has one posting per distinct word of an entry.  It is collected and
broadcast in waves of at most ``WAVE`` entries (counted by Spark beforehand);
texts are read once per wave, and never shuffled.  All texts of one item id are in
one wave.  Each distinct pair of item id and text is an item of its own to the index,
so rows that repeat count once and an id with several texts is found by any of them,
the best one is reported.  Null or empty texts and items match nothing, repeated rows
are judged alike, an empty benchmark leaves all documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kensa.llm import common

PASSAGE, STRIDE = 96, 48
THRESHOLD = 0.4
OVERLAP = 0.6
K1, B = 1.2, 0.75
ITEM_BLOCK = 8          # items of a block
SHARD = 16_384          # index entries scored at a time
WAVE = 4_000_000        # index entries broadcast at a time
SHINGLE = 3

NOT_WORD = np.ones(256, bool)
NOT_WORD[48:58] = NOT_WORD[65:91] = NOT_WORD[97:123] = NOT_WORD[128:] = False


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = common.LOWER[data]
    starts, ends, first = common.find_words(data, offsets, NOT_WORD)
    return common.hash_words(data, starts, ends), first


def shingles(h: np.ndarray, k: int) -> np.ndarray:
    """Distinct hashes of all runs of ``k`` words."""
    if k == 0 or len(h) < k:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - k + 1, np.uint64)
    for i in range(k):
        out = common.mix(out * np.uint64(0x100000001B3) + h[i:len(h) - k + 1 + i])
    return np.unique(out)


@dataclass
class Shard:
    """Some entries: their items (internal keys) and item ids, words (sorted hashes), impacts as (word, entry, value)."""
    items: np.ndarray
    ids: list
    reach: np.ndarray  # words of the item if it is longer than a passage, else 0
    words: np.ndarray
    word: np.ndarray
    item: np.ndarray
    value: np.ndarray
    question: list[tuple[int, np.ndarray]]  # run length (shorter than SHINGLE if the part is), shingles
    answer: list[tuple[int, np.ndarray]]


def split_item(text: str) -> tuple[str, str]:
    """Question and answer part of an item."""
    at = text.lower().rfind("answer:")
    if at > 0 and text[at + 7:].strip():
        return text[:at], text[at + 7:]
    body = text.rstrip()
    cut = max(body.rfind(m, 0, len(body) - 1) for m in (". ", ".\n", "? ", "?\n", "! ", "!\n", "\n"))
    return (body[:cut + 1], body[cut + 1:]) if cut > 0 else (body, "")


def waves(benchmark: DataFrame, key: str, text: str):
    """Index shards, a list per wave.  Lengths, counts and frequencies are computed by Spark over all items."""
    items = benchmark.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("id"), F.col(text).alias("text"))
    items = common.scratch(items.distinct().withColumn("item", F.monotonically_increasing_id()), "items")

    def entries(batches):
        for batch in batches:
            for rows, data, offsets in common.pieces(batch):
                h, first = word_hashes(data, offsets)
                for i, item in enumerate(rows.column("item").to_pylist()):
                    for part, of in enumerate(np.array_split(h[first[i]:first[i + 1]], max(1, -(-int(first[i + 1] - first[i]) // PASSAGE)))):
                        own, tf = np.unique(of, return_counts=True)
                        if len(own):
                            yield pa.RecordBatch.from_arrays([pa.array([item] * len(own)), pa.array([part] * len(own), pa.int64()), pa.array(own.view(np.int64)), pa.array(tf.astype(np.int64)), pa.array([len(of)] * len(own))], names=["item", "part", "word", "tf", "len"])

    listed = common.scratch(items.mapInArrow(entries, "item long, part long, word long, tf long, len long"), "bm25")
    sizes = listed.groupBy("item", "part").agg(F.count("*").alias("entries"), F.first("len").alias("len"))
    total = sizes.agg(F.count("*").alias("n"), F.avg("len").alias("avg"), F.sum("entries").alias("entries")).first()
    if not total["n"]:
        return
    n_waves = -(-int(total["entries"]) // WAVE)
    df_ = listed.groupBy("word").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.lit(float(total["n"])) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / F.lit(float(total["avg"]))))
    impacts = listed.join(df_, "word").select("item", "part", "word", (idf * part).alias("v"))
    wave_of = F.pmod(F.xxhash64("id"), F.lit(n_waves)).alias("wave")
    impacts = common.scratch(impacts.join(impacts.groupBy("item", "part").agg(F.sum("v").alias("self")), ["item", "part"])
                             .join(items.select("item", wave_of), "item").select("item", "part", "word", (F.col("v") / F.col("self")).alias("v"), "wave"), "bm25")
    for wave in range(n_waves):
        got = impacts.where(F.col("wave") == wave).orderBy("item", "part", "word").toPandas()
        rows = items.where(wave_of == wave).collect()
        ids, texts = ({r["item"]: r[c] for r in rows} for c in ("id", "text"))
        halves = {i: [word_hashes(np.frombuffer(x.encode(), np.uint8), np.array([0, len(x.encode())]))[0] for x in split_item(t)] for i, t in texts.items()}
        sets = {i: [(min(SHINGLE, len(x)), shingles(x, min(SHINGLE, len(x)))) for x in xs] for i, xs in halves.items()}
        item, entry = got["item"].to_numpy(), got["part"].to_numpy()
        start = np.flatnonzero(np.append(True, (item[1:] != item[:-1]) | (entry[1:] != entry[:-1])) if len(got) else [])
        names, ends = item[start], np.append(start[1:], len(got))
        long = {i: sum(map(len, xs)) for i, xs in halves.items()}
        out, lo = [], 0
        while lo < len(names):
            hi = lo + 1
            while hi < len(names) and ends[hi] - start[lo] <= SHARD:
                hi += 1
            part = got.iloc[start[lo]:ends[hi - 1]]
            words, word = np.unique(part["word"].to_numpy().view(np.uint64), return_inverse=True)
            own = names[lo:hi].tolist()
            out.append(Shard(names[lo:hi], [ids[i] for i in own], np.array([long[i] if long[i] > PASSAGE else 0 for i in own]), words, word.astype(np.int32), np.repeat(np.arange(hi - lo), ends[lo:hi] - start[lo:hi]).astype(np.int32),
                             part["v"].to_numpy().astype(np.float32), [sets[i][0] for i in own], [sets[i][1] for i in own]))
            lo = hi
        yield out


def retrieve(h: np.ndarray, first: np.ndarray, shard: Shard, threshold: float = THRESHOLD):
    """All (row, first word, item, score) of passages scoring at least ``threshold``."""
    place = np.searchsorted(shard.words, h)
    place[place == len(shard.words)] = 0
    known = np.flatnonzero(shard.words[place] == h)
    row = common.row_of(first)[known]
    place, at = place[known], known - first[row]
    # a word at position p stands in the passages p // STRIDE and the one before; passages start at multiples of STRIDE
    limit = np.maximum(0, (np.diff(first) - PASSAGE + STRIDE - 1) // STRIDE)  # the last passage of a row
    base = np.concatenate([[0], np.cumsum(limit + 1)])
    found = []
    for back in range(-(-PASSAGE // STRIDE)):
        k = at // STRIDE - back
        ok = (k >= 0) & (k <= limit[row]) & (at - k * STRIDE < PASSAGE)
        found.append((base[row[ok]] + k[ok]) * len(shard.words) + place[ok])
    pair = np.unique(np.concatenate(found))
    passage, word = np.divmod(pair, len(shard.words))
    n_items = len(shard.items)
    n_blocks = -(-n_items // ITEM_BLOCK)
    full = np.zeros((len(shard.words), n_blocks * ITEM_BLOCK), np.float32)
    full[shard.word, shard.item] = shard.value
    top = full.reshape(len(shard.words), n_blocks, ITEM_BLOCK).max(2)
    hits = []
    heads = np.flatnonzero(np.diff(passage, prepend=-1))
    slack = np.float32(threshold - 1e-5)
    if len(heads):
        reach = np.add.reduceat(top.max(1)[word], heads) >= slack                 # any item at all
        pick = np.repeat(reach, np.diff(np.append(heads, len(passage))))
        passage, word = passage[pick], word[pick]
    step = 1 << 16
    heads = np.flatnonzero(np.diff(passage, prepend=-1))
    lo = 0
    while lo < len(heads):                                                        # passages at a time, to bound memory
        hi = max(lo + 1, int(np.searchsorted(heads, heads[lo] + step)))
        a, z = heads[lo], heads[hi] if hi < len(heads) else len(passage)
        own, w = heads[lo:hi] - a, word[a:z]
        bound = np.add.reduceat(top[w], own)
        sizes = np.diff(np.append(own, z - a))
        for b in np.flatnonzero((bound >= slack).any(0)):                         # blocks some passage can still reach
            some = bound[:, b] >= slack
            inside = np.repeat(some, sizes)
            heads_b = np.concatenate([[0], np.cumsum(sizes[some])[:-1]])
            score = np.add.reduceat(full[w[inside], b * ITEM_BLOCK:(b + 1) * ITEM_BLOCK], heads_b)
            p, i = np.nonzero(score >= slack)
            ok = b * ITEM_BLOCK + i < n_items
            hits.append((passage[heads[lo:hi]][some][p[ok]], b * ITEM_BLOCK + i[ok], score[p[ok], i[ok]]))
        lo = hi
    if not hits:
        return
    p, i, s = (np.concatenate(x) for x in zip(*hits))
    r = np.searchsorted(base, p, "right") - 1
    yield from zip(r.tolist(), ((p - base[r]) * STRIDE).tolist(), i.tolist(), s.tolist())


def verified(h: np.ndarray, first: np.ndarray, shards: list[Shard]) -> dict[tuple, tuple]:
    """Best verified passage of each (row, item id): (score, question share, answer share, first word)."""
    best: dict[tuple, tuple] = {}
    judged: dict[tuple, list[float]] = {}
    for shard in shards:
        for r, at, i, s in retrieve(h, first, shard):
            item, reach = shard.items[i], int(shard.reach[i])
            lo = first[r] + max(0, at - PASSAGE - reach)
            hi = min(first[r + 1], first[r] + at + 2 * PASSAGE + reach)
            if (r, item, lo, hi) not in judged:
                judged[r, item, lo, hi] = [float(np.isin(x, shingles(h[lo:hi], k)).mean()) if k else 1.0 for k, x in (shard.question[i], shard.answer[i])]
            share = judged[r, item, lo, hi]
            if min(share) >= OVERLAP and max(shard.question[i][0], shard.answer[i][0]):
                best[r, shard.ids[i]] = max(best.get((r, shard.ids[i]), (-1.0,)), (s, *share, at))
    return best


def contaminated(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document row and benchmark item it holds: key, item, score, question_overlap, answer_overlap, first_word."""
    spark = df.sparkSession
    schema = f"`{key}` {dict(df.dtypes)[key]}, `{item}` {dict(benchmark.dtypes)[item]}, score double, question_overlap double, answer_overlap double, first_word long"
    out = spark.createDataFrame([], schema)
    for shards in waves(benchmark, item, item_text):
        shared = spark.sparkContext.broadcast(shards)

        def run(batches, shared=shared):
            for batch in batches:
                for rows, data, offsets in common.pieces(batch, "__text"):
                    h, first = word_hashes(data, offsets)
                    got = [(rows.column(0)[r], i, *v) for (r, i), v in verified(h, first, shared.value).items()]
                    if got:
                        cols = list(zip(*got))
                        yield pa.RecordBatch.from_arrays([pa.array([v.as_py() for v in cols[0]], rows.schema.field(0).type), pa.array(list(cols[1])), *(pa.array(c, pa.float64()) for c in cols[2:5]), pa.array(cols[5], pa.int64())],
                                                         names=[key, item, "score", "question_overlap", "answer_overlap", "first_word"])

        out = out.unionByName(df.select(key, F.col(text).alias("__text")).mapInArrow(run, schema))
    return out


def clean(df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``df`` that hold no benchmark item, with all their columns."""
    for shards in waves(benchmark, item, item_text):
        shared = df.sparkSession.sparkContext.broadcast(shards)

        def run(batches, shared=shared):
            for batch in batches:
                for rows, data, offsets in common.pieces(batch, text):
                    h, first = word_hashes(data, offsets)
                    bad = {r for r, _ in verified(h, first, shared.value)}
                    yield rows.filter(pa.array([r not in bad for r in range(rows.num_rows)], pa.bool_()))

        df = df.mapInArrow(run, df.schema)
    return df
