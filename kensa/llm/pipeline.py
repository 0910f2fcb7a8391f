"""Stages of the corpus pipeline; ``corpus_pipeline.py`` at the top names them.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps with the
columns of ``documents``; the last returns token ids.  No SQL expresses the
classifier or the transducer; tests hold the near-duplicates stage against brute
force, the others through their operators.

Executors live through all stages, so what one stage makes them grow to is there in
the next: texts go to Python workers in batches of ``BATCH_BYTES``, a task has one
worker at a time, and no stage sorts texts.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kensa import session as _session
from kensa.llm import common, decontamination, minmax, pii, quality, queries, wfst
from kensa.sources.tables import table

BATCH_BYTES = 2 << 20   # of an Arrow batch to a Python worker
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def _prepare(spark: SparkSession) -> None:
    """Workers can import the package and get short batches, also when the stage's result is written
    later: the limit stays with the session, unless the session's owner has set one."""
    common.prepare(spark)
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier accepts; it learns from the documents and labels of ``sf_dir``."""
    _prepare(spark)
    learn = common.scratch(quality.with_statistics(common.documents(spark, sf_dir).where(~common.bucket("doc_id", 5).eqNullSafe(0))), "stats")
    model = queries.quality_model(spark, sf_dir, learn)
    return quality.accepted(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, of the smallest id, of each group that is 0.8 or more alike in five-word shingles.

    Rows are judged one by one, so ids may repeat with other texts; rows without an id stay.
    """
    _prepare(spark)
    rows = common.scratch(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    some = rows.where("doc_id is not null").select("__row", "doc_id", "text")
    judged = minmax.groups(some, k=5, key="__row").select(F.col("doc_id").alias("__row"), "n_shingles", "component_id")
    # texts without shingles are alike only to repeats of the same id and text; only these are told apart by a
    # digest, made before the join, so that no text goes through it
    digest = F.when(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(None)).otherwise(F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit("null")))
    alike = F.when(F.col("n_shingles") > 0, F.struct(F.col("component_id").alias("a"), F.lit(None).cast("string").alias("b"))) \
        .otherwise(F.struct(F.col("doc_id").cast("long").alias("a"), F.col("__digest").alias("b")))
    judged = common.scratch(judged.join(some.select("__row", "doc_id", digest.alias("__digest")), "__row").select(F.col("__row"), "doc_id", alike.alias("alike")), "judged", clean=True)
    first = judged.groupBy("alike").agg(F.min(F.struct("doc_id", "__row")).alias("f")).select(F.col("f.__row").alias("__row"))
    gone = judged.select("__row").join(first, "__row", "left_anti")
    # the few columns of ``gone`` are hashed, the texts pass by them without being sorted
    return rows.join(gone.hint("shuffle_hash"), "__row", "left_anti").select(docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    _prepare(spark)
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced; n_chars follows the new text where there is one."""
    _prepare(spark)
    new = pii.pseudonymise(docs, pii.demo_key("corpus pipeline"))
    if "n_chars" not in docs.columns:
        return new
    return new.withColumn("n_chars", F.coalesce(F.length("text").cast(dict(docs.dtypes)["n_chars"]), "n_chars"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, token ids, their number, and whether decoding gives the normalised text back.

    The ids are written between encoding and decoding: in one step every task would hold two
    Python workers with a machine each, and workers outlive the stage.
    """
    _prepare(spark)
    model = Path(queries.TOKENIZER).read_bytes()
    ids = common.scratch(wfst.encode(docs.select("doc_id", "text"), model, normal="normal").drop("text"), "ids")
    back = wfst.decode(ids, model)
    return back.select("doc_id", "ids", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), F.col("decoded").eqNullSafe(F.col("normal")).alias("round_trip"))


STAGES = [("quality", quality_stage), ("near-duplicates", near_duplicate_stage), ("decontamination", decontamination_stage),
          ("personal data", pii_stage), ("encoding", encoding_stage)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written under the shared checkpoint folder and reread.

    What a stage wrote along the way, and the stage before it, are removed when it is written.
    """
    docs, kept, limit = common.documents(spark, sf_dir), None, spark.conf.get(_BATCH, None)
    try:
        for _, stage in STAGES:
            path = _session.scratch_path(spark, "stage")
            with common.temporary(spark):
                out = stage(spark, docs, sf_dir)
                out.write.parquet(path)
            if kept:
                common.remove(spark, kept)
            docs, kept = spark.read.schema(out.schema).parquet(path), path
    finally:
        if limit is None:
            spark.conf.unset(_BATCH)
    return docs
