"""The registered query of each training-data operator, over its whole table."""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kensa.llm import ann, common, covertree, decontamination, langid, licenses, lm, minmax, packing, periods, pii, quality, substrings, wfst
from kensa.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_language_id(spark, sf_dir):
    """Language of every document, learnt from three quarters of them."""
    common.prepare(spark)
    docs = common.documents(spark, sf_dir).withColumn("held_out", common.bucket("doc_id", 4).eqNullSafe(2))
    model = langid.fit(spark, docs.where("not held_out"))
    return langid.predict(docs, model, keep=("doc_id", "held_out")).select("doc_id", "held_out", "lang_pred", "score")


@query
def op7_quality_classifier(spark, sf_dir):
    """Quality score of every document, learnt from four fifths of the labels."""
    common.prepare(spark)
    docs = common.documents(spark, sf_dir)
    stats = common.scratch(quality.with_statistics(docs).withColumn("held_out", common.bucket("doc_id", 5).eqNullSafe(0)), "stats")
    return quality.score(stats, quality_model(spark, sf_dir, stats.where("not held_out")), keep=("doc_id", "held_out"))


def quality_model(spark, sf_dir, stats):
    """Fit on the labelled rows among ``stats`` (doc_id, stats)."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return quality.fit(stats.join(labels, "doc_id").withColumn("h", F.xxhash64(F.col("doc_id").cast("string"), F.lit(7))))


@query
def op5_nearest_neighbours(spark, sf_dir):
    """The 20 nearest vectors of every twentieth one."""
    common.prepare(spark)
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.search(vectors, vectors.where("vec_id % 20 = 0"), "vec_id", "embedding", k=20)


@query
def op8_license_scan(spark, sf_dir):
    """License phrases and notices in every document."""
    return licenses.scan(common.documents(spark, sf_dir))


ORACLE["op8_license_scan"] = licenses.oracle()


@query
def op1_decontamination(spark, sf_dir):
    """Documents that hold a benchmark item, and which."""
    common.prepare(spark)
    return decontamination.contaminated(common.documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@query
def op6_near_duplicates(spark, sf_dir):
    """Groups of documents whose two-word shingles are 0.8 or more alike."""
    common.prepare(spark)
    return minmax.groups(common.documents(spark, sf_dir), k=2)


@query
def op3_substring_dedup(spark, sf_dir):
    """Words left when windows of 13 that a smaller document holds are removed."""
    common.prepare(spark)
    kept = substrings.remove_repeats(common.documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


TOKENIZER = os.environ.get("KENSA_TOKENIZER", "/opt/tokenizers/piece_bpe_32k.model")


@query
def op10_sentencepiece(spark, sf_dir):
    """Piece ids of every document (number and checksum), and whether decoding gives the normalised text back."""
    common.prepare(spark)
    model = Path(TOKENIZER).read_bytes()
    ids = wfst.encode(common.documents(spark, sf_dir).select("doc_id", "text"), model, normal="normal")
    back = wfst.decode(ids.drop("text"), model)
    return back.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", " ").cast("binary"), 256).alias("ids_sha256"),
                       F.col("decoded").eqNullSafe(F.col("normal")).alias("round_trip"))


@query
def op4_personal_data(spark, sf_dir):
    """Every document with surrogates for personal data, and how many entities it held."""
    common.prepare(spark)
    docs = common.documents(spark, sf_dir).select("doc_id", "text")
    return pii.pseudonymise(docs, pii.demo_key("documents"), count="n_entities")


@query
def op9_lm_scores(spark, sf_dir):
    """Stupid-backoff score of every document under the counts of all others."""
    common.prepare(spark)
    return lm.score(common.documents(spark, sf_dir), order=3)


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Places of the words of a text; in about a tenth of them the end repeats (as op 11 is asked)."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10:
        return None
    g = h // 10
    a = g % n
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % (1 + (n - a) // (3 + g % 8)))


@query
def op11_periodic_runs(spark, sf_dir):
    """Runs of every text (planted repeats in a tenth of them) and digests of its runs and of what stays without them."""
    found = periods.periodic_runs(common.documents(spark, sf_dir), reorder=planted)
    # a quotient of two numbers under 2**26 is exact enough as a double to tell any two apart
    best = F.array_max(F.transform("runs", lambda r: F.struct((r["length"] / r["period"]).alias("x"), (-r["start"]).alias("s"), (-r["period"]).alias("p"), r["length"].alias("n"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"].cast("string"), F.lit("\n")))), "")
    found = found.withColumn("best", best)
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), F.col("best.n").alias("length"), (-F.col("best.p")).alias("period"),
                        F.expr("best.n * 1000 div -best.p").alias("exponent_milli"), F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


BYTE_BPE = os.environ.get("KENSA_BYTE_BPE", "/opt/tokenizers/byte_bpe_50k.json")


@query
def op13_best_fit_packing(spark, sf_dir):
    """Every text as token ids with a 0 behind, packed into sequences of 2,048; a checksum stands for a piece's ids."""
    pieces = packing.tokenise(common.documents(spark, sf_dir), Path(BYTE_BPE).read_bytes(), end=0, capacity=2048)
    pieces = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(pieces, capacity=2048).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op12_hard_negatives(spark, sf_dir):
    """Hard negatives of every hundredth vector; every seventh vector takes the label after its own first."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return covertree.mine(vectors.select("vec_id", "embedding", label.alias("label")), F.col("vec_id") % 100 == 0, positives=5, negatives=10, low=30, high=90, scale=256.0)


ORACLE["op12_hard_negatives"] = """
WITH base AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM base a JOIN base b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
pos AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other) AS INTEGER) AS rank,
       n.other AS negative_id, p.positive_score, n.score AS negative_score
FROM pos p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
WHERE 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
QUALIFY rank <= 10"""
