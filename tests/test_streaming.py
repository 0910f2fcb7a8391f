import os
import shutil
import time

from conftest import SF_SMALL, png_bytes, pattern
from kensa.plans import views as v
from kensa.plans.stream_queries import events_verdict_stream
from kensa.operators import anomalies as an
from kensa.session import scratch_path
from kensa.streaming import streams as st


def test_drained_stream_equals_batch(spark):
    out = st.drain(events_verdict_stream(spark, SF_SMALL), "t_verdicts", scratch_path(spark, "tv"),
                   checkpoint=scratch_path(spark, "tv-ckpt"))
    batch = an.verdict(v.inspection(spark, SF_SMALL).select("item_id", "label"))
    assert out.exceptAll(batch).count() == 0 and batch.exceptAll(out).count() == 0


def test_image_stream_picks_up_new_files(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.png").write_bytes(png_bytes(2, 2, 3, pattern(2, 2, 3)))
    out, ckpt = scratch_path(spark, "img"), scratch_path(spark, "img-ckpt")
    df = st.stream_images(spark, str(src), glob="*.png").selectExpr("image.origin", "image.height")
    q = st.start_append(df, "t_images", out, available_now=True, checkpoint=ckpt)
    q.awaitTermination(120)
    assert spark.read.parquet(out).count() == 1
    (src / "b.png").write_bytes(png_bytes(3, 2, 3, pattern(3, 2, 3)))
    q = st.start_append(df, "t_images", out, available_now=True, checkpoint=ckpt)
    q.awaitTermination(120)
    assert sorted(r.height for r in spark.read.parquet(out).collect()) == [2, 2]  # each file once


def test_manage_streams_by_prefix(spark, tmp_path):
    src = tmp_path / "s"
    src.mkdir()
    df = st.stream_images(spark, str(src), decoded=False)
    q1 = st.start_append(df.select("path"), "kensa_t_a", scratch_path(spark, "a"), processing_time="1 second",
                         checkpoint=scratch_path(spark, "a-ck"))
    q2 = st.start_append(df.select("path"), "other_t_b", scratch_path(spark, "b"), processing_time="1 second",
                         checkpoint=scratch_path(spark, "b-ck"))
    try:
        names = {r.name for r in st.active_streams(spark, "kensa_t_").collect()}
        assert names == {"kensa_t_a"}
        assert {r.name for r in st.active_streams(spark, "").collect()} >= {"kensa_t_a", "other_t_b"}
        assert st.await_streams(spark, "kensa_t_", timeout=1.0) is False
        t = st.stop_streams(spark, "kensa_t_", delay=0.2, background=True)
        t.join(30)
        assert t.result == [("kensa_t_a", None)]
        assert st.await_streams(spark, "kensa_t_", timeout=5.0) is True
        assert q2.isActive
    finally:
        st.stop_streams(spark, "")
    assert not q1.isActive and not q2.isActive


def test_streamed_scores_equal_batch(spark, image_tree):
    from pyspark.sql import functions as F
    from kensa.operators import ml
    from kensa.sources import files as fs
    root, files = image_tree
    streamed = st.drain(st.score_stream(spark, str(root), ml.BrightnessScorer, glob=fs.IMAGE_GLOB),
                        "t_scores", scratch_path(spark, "ts"), checkpoint=scratch_path(spark, "ts-ck"))
    batch = ml.score_images(fs.read_images(spark, str(root), glob=fs.IMAGE_GLOB)
                            .withColumn("origin", F.col("image.origin")), ml.BrightnessScorer, keep=("origin",))
    cols = ["origin", "label", "score", "error"]
    s = sorted(map(tuple, streamed.select(*cols).collect()))
    b = sorted(map(tuple, batch.select(*cols).collect()))
    assert s == b and len(s) == len(files) + 1
    bad = streamed.where(F.col("error").isNotNull()).first()
    assert bad.verdict is None and bad.origin.endswith("broken.jpg")


def test_stream_reads_a_table_folder(spark, tmp_path):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    events.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    out = st.drain(events_verdict_stream(spark, str(tmp_path)), "t_folder", scratch_path(spark, "tf"), checkpoint=scratch_path(spark, "tfc"))
    assert out.count() == events.count() > 0


def test_an_intake_goes_on_where_it_was_stopped(spark, tmp_path):
    src, out, ckpt = tmp_path / "in", scratch_path(spark, "stop"), scratch_path(spark, "stop-ck")
    src.mkdir()
    for i in range(8):
        (src / f"a{i}.png").write_bytes(png_bytes(2, 2, 3, pattern(2, 2, 3, seed=i)))
    df = st.stream_images(spark, str(src), glob="*.png", max_files_per_trigger=2).selectExpr("image.origin", "image.height")
    assert st.run_until_batch(df, "t_stop", out, ckpt) >= 1
    assert 2 <= spark.read.parquet(out).count() <= 8
    for i in range(3):
        (src / f"b{i}.png").write_bytes(png_bytes(2, 3, 3, pattern(2, 3, 3, seed=i)))
    got = st.drain(df, "t_stop", out, checkpoint=ckpt).collect()
    assert len(got) == len({r.origin for r in got}) == 11


def test_files_of_a_batch_are_listed_by_few_tasks(spark, tmp_path, monkeypatch):
    """Tasks of a drained stream do not follow the number of its files."""
    root = tmp_path / "many"
    root.mkdir()
    for i in range(600):
        (root / f"{i}.bin").write_bytes(bytes([i % 256]))
    started, start = [], st.start_append
    monkeypatch.setattr(st, "start_append", lambda *a, **k: started.append(start(*a, **k)) or started[-1])
    before = spark.conf.get(st._LISTING)
    got = st.drain(st.stream_images(spark, str(root), decoded=False).select("path", "length"), "kensa_many",
                   str(tmp_path / "out"), checkpoint=str(tmp_path / "ckpt"))
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(str(started[0].runId)) for s in tracker.getJobInfo(j).stageIds]
    assert got.count() == 600
    assert max(s.numTasks for s in stages) <= 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(st._LISTING) == before


def test_scored_image_files_come_in_bounded_batches_of_few_tasks(spark, monkeypatch):
    """M7's stream: batches are bounded, their tasks follow the cores, no listing is kept."""
    from kensa.plans.stream_queries import m7_stream
    runs, start, settings = [], st.start_append, (st._LISTING, st._LISTED, st._OPEN_COST)

    def started(df, name, path, **how):
        runs.append((start(df, name, path, **how), path, spark.conf.get(st._LISTED)))
        return runs[-1][0]

    monkeypatch.setattr(st, "start_append", started)
    monkeypatch.setattr(st, "FILES_PER_BATCH", 400)
    before = [spark.conf.get(k) for k in settings]
    assert m7_stream(spark, SF_SMALL).count() == 500
    (query, path, listed), = runs
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [400, 100] and listed == "0"
    written = [open(os.path.join(path, "_spark_metadata", str(b))).read().count('"path"') for b in (0, 1)]
    assert all(0 < n <= spark.sparkContext.defaultParallelism for n in written)  # a task writes one file
    assert [spark.conf.get(k) for k in settings] == before
