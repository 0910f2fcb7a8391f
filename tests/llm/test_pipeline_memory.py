"""What the pipeline's stages hold of the texts at once."""

import re

import pyarrow as pa

from kensa.llm import common, pipeline

SF = "/root/testdata/sf0.001"
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(spark, n=400, words=1500):
    texts = [" ".join(f"w{i}x{j}" for j in range(words)) for i in range(n)]
    rows = [(i, t, None, None, len(t)) for i, t in enumerate(texts)] + [(0, texts[0], None, None, 1), (n, " \n", None, None, 2), (n, " \n", None, None, 2), (n, "\t", None, None, 1)]
    return spark.createDataFrame(rows, SCHEMA).coalesce(1)


def test_texts_reach_workers_in_short_batches(spark):
    df = corpus(spark)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "bytes"])

    spark.conf.unset(BATCH)
    try:
        got = pipeline.decontamination_stage(spark, df, SF).mapInArrow(sizes, "n long, bytes long").collect()
        assert sum(r["n"] for r in got) == 404
        assert len(got) > 2 and max(r["bytes"] for r in got) <= 1.5 * pipeline.BATCH_BYTES
        spark.conf.set(BATCH, "12345678")        # the owner's own limit stays
        pipeline.decontamination_stage(spark, df, SF)
        assert spark.conf.get(BATCH) == "12345678"
    finally:
        spark.conf.unset(BATCH)


def test_the_limit_ends_with_the_run(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(pipeline, "STAGES", [("seen", lambda s, docs, d: pipeline._prepare(s) or seen.append(s.conf.get(BATCH)) or docs)])
    spark.conf.unset(BATCH)
    assert pipeline.run(spark, SF).count() == common.documents(spark, SF).count()
    assert seen == [str(pipeline.BATCH_BYTES)] and spark.conf.get(BATCH, None) is None


def test_near_duplicates_sort_no_texts(spark, monkeypatch):
    df, plans, scratch = corpus(spark, 30, 40), {}, common.scratch
    monkeypatch.setattr(common, "scratch", lambda d, name, *a, **k: plans.update({name: d}) or scratch(d, name, *a, **k))
    out = pipeline.near_duplicate_stage(spark, df, SF)
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")     # as with tables too large for it
    try:
        last = plan(out.select("*"))
        assert "ShuffledHashJoin [__row" in last and not re.search(r"Sort \[__row[^\n]*\n[^\n]*Exchange[^\n]*\n[^\n]*text#", last)
        judged = plan(plans["judged"].select("*"))
        assert not re.search(r"Exchange[^\n]*\n[^\n]*Project \[[^\n]*text#\d+\]", judged) and "sha2" in judged
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sorted(r["doc_id"] for r in out.collect()) == [*range(30), 30, 30]


def test_a_task_of_a_stage_has_one_worker(spark):
    """Two Python steps in one task are two workers an executor core, which live on in later stages."""
    df = corpus(spark, 30, 40)
    for name, stage in pipeline.STAGES:
        out = stage(spark, df, SF)
        assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") <= 1, name
    got = out.collect()
    assert len(got) == 34 and all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in got)
