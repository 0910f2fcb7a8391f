"""Registered streaming queries: verdicts on a file stream of the events table (X2),
an image intake that is stopped and started again (X1), and images scored by a
saved model (M7).  They are read back after ``availableNow``; the oracles are those
of the batch forms, so the check also shows stream == batch."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kensa.plans import storage_queries as sq
from kensa.plans import views as v
from kensa.plans.image_queries import SIDE
from kensa.plans.model_queries import FOREST_SQL, clear_label, saved_image_forest
from kensa.plans import questions  # noqa: F401  (registers P9, whose oracle X2 shares)
from kensa.plans.registry import ORACLE, register
from kensa.session import scratch_path
from kensa.sources import files as fs
from kensa.sources.tables import table
from kensa.streaming import streams as st


def events_verdict_stream(spark, sf_dir: str):
    """Events arriving as files -> inspection view -> verdict."""
    schema = table(spark, sf_dir, "events").schema
    # a glob of one name: the table may be one file or a folder of part files
    events = st.stream_table_files(spark, sf_dir.rstrip("/") + "/{events.parquet}", schema)
    return st.stream_verdicts(v.inspection_of(events).select("item_id", "label"))


@register("X2_stream_verdicts", ORACLE["P9_verdict"])
def x2(spark, sf_dir):
    out = scratch_path(spark, "x2-out")
    ckpt = scratch_path(spark, "x2-ckpt")
    return st.drain(events_verdict_stream(spark, sf_dir), "kensa_x2_verdicts", out, checkpoint=ckpt)



@register("X1_stream_images", sq._files_sql(f"""
SELECT key, 8 AS height, 8 AS width, {sq._HEX_SQL} AS data_hex, vec_id % 2 = 0 AS early, CAST(1 AS BIGINT) AS copies FROM files"""))
def x1(spark, sf_dir):
    """Half of the files are there when the intake starts; it is stopped after its first
    batch of a fraction of them, the other half arrives, and it goes on from its checkpoint."""
    images, root = sq.image_files(spark, sf_dir), scratch_path(spark, "x1-images")
    out, ckpt, name = scratch_path(spark, "x1-out"), scratch_path(spark, "x1-ckpt"), f"kensa_x1_{uuid.uuid4().hex[:8]}"
    early = F.col("vec_id") % 2 == 0
    sq.write_images(images.where(early), root)

    def intake():
        # an eighth of the early files, at least, is left for after the restart
        stream = st.stream_images(spark, root, max_files_per_trigger=max(1, images.where(early).count() // 8))
        return stream.select(fs.relative_key("image.origin", root, encoded=True).alias("key"), "image.height", "image.width", F.hex("image.data").alias("data_hex"))

    st.run_until_batch(intake(), name, out, ckpt)
    sq.write_images(images.where(~early), root)
    got = st.drain(intake(), name, out, checkpoint=ckpt)
    times = got.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.first("height").alias("height"), F.first("width").alias("width"), F.first("data_hex").alias("data_hex"))
    return times.join(images.select("key", early.alias("early")), "key").select("key", "height", "width", "data_hex", "early", "copies")


@register("M7_stream_forest", sq._files_sql(f"SELECT key, {FOREST_SQL} FROM files JOIN features USING (vec_id)"))
def m7_stream(spark, sf_dir):
    """The image files as a stream, scored by the saved forest."""
    root = sq.write_images(sq.image_files(spark, sf_dir), scratch_path(spark, "m7-images"))
    scored = st.drain(st.score_stream_with(spark, root, saved_image_forest(spark, sf_dir), SIDE), f"kensa_m7_{uuid.uuid4().hex[:8]}",
                      scratch_path(spark, "m7-out"), checkpoint=scratch_path(spark, "m7-ckpt"), open_cost=st.SMALL_FILE)
    keyed = scored.select(fs.relative_key("origin", root, encoded=True).alias("key"), "label", "score", "error")
    clear = sq.image_files(spark, sf_dir).join(v.features(spark, sf_dir).select("vec_id", "embedding"), "vec_id").select("key", "embedding")
    return clear_label(keyed.join(clear, "key")).select("key", "label", "scored", "error")
