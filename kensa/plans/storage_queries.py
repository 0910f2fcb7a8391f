"""Registered write-and-read-back queries (S1-S3, S6, S8-S10, A5, J1 with U5, U2).
Output goes to fresh folders under the shared checkpoint folder, never a
machine-local one, and is read back through Spark.

The image files are the 8 x 8 images of ``features`` as PNG files, named
``Normal/<n>.png`` and ``Anomaly/<n>.png`` (planted label), so that a bare file name
stands for two images."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from kensa.operators import anomalies as an
from kensa.operators import history as hi
from kensa.operators import images as im
from kensa.operators import joins as jn
from kensa.operators import splits as sp
from kensa.plans import views as v
from kensa.plans.image_queries import _PIXELS_SQL, SIDE
from kensa.plans.questions import _BY_LINE_SQL
from kensa.plans.registry import register
from kensa.session import cut_lineage, scratch_path
from kensa.sources import catalog as cat
from kensa.sources import files as fs
from kensa.sources import sink
from kensa.sources.tables import table


@register("S9_write_split", v.with_views(["features"], f"""
SELECT vec_id, planted, {sp.split_sql('vec_id')} AS split FROM features"""))
def s9(spark, sf_dir):
    df = sp.assign_split(v.features(spark, sf_dir), "vec_id").select("vec_id", "planted", "split")
    path = scratch_path(spark, "s9-split")
    cat.write_split(df, path)
    return spark.read.parquet(path).select("vec_id", "planted", "split")


@register("S8_overwrite_table", v.with_views(["inspection", "production"], _BY_LINE_SQL))
def s8(spark, sf_dir):
    by_line = an.anomalies_by_line(v.inspection(spark, sf_dir), v.production(spark, sf_dir))
    name = f"kensa_by_line_{uuid.uuid4().hex[:8]}"
    path = scratch_path(spark, name)
    # Twice: overwriting must leave the same table, not a doubled one.
    for _ in range(2):
        cat.overwrite_table(by_line, name, path=path)
    return cat.read_table(spark, name)


@register("S10_read_table", v.with_views(["features"], f"""
SELECT {sp.split_sql('vec_id')} AS split, count(*) AS n FROM features GROUP BY 1"""))
def s10(spark, sf_dir):
    df = sp.assign_split(v.features(spark, sf_dir), "vec_id")
    name = f"kensa_features_{uuid.uuid4().hex[:8]}"
    cat.overwrite_table(df, name, path=scratch_path(spark, name))
    return cat.read_table(spark, name).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


# ---- image files ----------------------------------------------------------------

# Pairs of vectors share a bare name where their labels differ.
_KEY_SQL = "CASE WHEN planted = 1 THEN 'Anomaly/' ELSE 'Normal/' END || CASE WHEN planted = 1 THEN f.vec_id ELSE f.vec_id + 1 END || '.png'"


def image_files(spark, sf_dir):
    """(vec_id, planted, label, key, image) of every image file to write."""
    name = F.when(F.col("planted") == 1, F.concat(F.lit("Anomaly/"), "vec_id")).otherwise(F.concat(F.lit("Normal/"), F.col("vec_id") + 1))
    pixels = im.pixels_from_floats("embedding")
    return v.features(spark, sf_dir).select("vec_id", "planted", "label", F.concat(name, F.lit(".png")).alias("key"),
                                            im.gray_image_struct("vec_id", pixels, SIDE, SIDE).alias("image"))


def write_images(images, path, **how) -> str:
    """The images as uncompressed PNG files, whose bytes SQL can name."""
    sink.write_files(im.encode_png(images, level=0), path, **how)
    return path


_FILES_SQL = f"files AS (SELECT f.vec_id, f.planted, f.label, {_KEY_SQL} AS key, x.p FROM features f JOIN ({_PIXELS_SQL}) x ON f.vec_id = x.vec_id)"
_HEX_SQL = "array_to_string(list_transform(p, lambda x: lpad(hex(x), 2, '0')), '')"


def _files_sql(body: str) -> str:
    return v.with_views(["features"], f"WITH {_FILES_SQL}\n{body}")


@register("S1_read_images", _files_sql(f"""
SELECT key, 8 AS height, 8 AS width, 1 AS channels, {_HEX_SQL} AS data_hex FROM files"""))
def s1(spark, sf_dir):
    root = write_images(image_files(spark, sf_dir), scratch_path(spark, "s1-images"))
    read = fs.read_images(spark, root)
    return read.select(fs.relative_key("image.origin", root, encoded=True).alias("key"), "image.height", "image.width",
                       F.col("image.nChannels").alias("channels"), F.hex("image.data").alias("data_hex"))


# 33 bytes of signature and header; the rows stand behind 8 bytes of chunk head and 7 of zlib's, each behind a 0;
# 4 bytes of checksum and 4 of zlib's end the chunk, 12 more the file.
_ROWS_SQL = "array_to_string(list_transform(range(8), lambda y: '00' || array_to_string(list_transform(p[y * 8 + 1 : y * 8 + 8], lambda x: lpad(hex(x), 2, '0')), '')), '')"


@register("S2_image_bytes", _files_sql(f"""
SELECT key, CAST(140 AS BIGINT) AS length, '89504E470D0A1A0A0000000D4948445200000008000000080800000000' AS head_hex, {_ROWS_SQL} AS rows_hex FROM files"""))
def s2(spark, sf_dir):
    root = write_images(image_files(spark, sf_dir), scratch_path(spark, "s2-images"))
    at = lambda start, n: F.hex(F.substring("content", start, n))
    return fs.read_keyed_images(spark, root).select("key", "length", at(1, 29).alias("head_hex"), at(49, 72).alias("rows_hex"))


@register("A5_file_counts", _files_sql("""
SELECT split_part(key, '/', 1) AS folder, count(*) AS n_files, false AS empty FROM files GROUP BY 1
UNION ALL SELECT 'nothing' AS folder, 0 AS n_files, true AS empty"""))
def a5(spark, sf_dir):
    """Files of each folder (over the writer's part folders), and a folder that isn't there."""
    root = write_images(image_files(spark, sf_dir), scratch_path(spark, "a5-images"))
    counts = fs.file_counts(spark, root).groupBy(fs.relative_key("folder", root).alias("folder")).agg(F.sum("n_files").alias("n_files"))
    nothing = spark.createDataFrame([("nothing", 0, fs.folder_is_empty(spark, root + "/nothing"))], "folder string, n_files long, empty boolean")
    return counts.withColumn("empty", F.lit(fs.folder_is_empty(spark, root))).unionByName(nothing)


@register("S6_ingest", _files_sql(f"""
SELECT key, CAST(140 AS BIGINT) AS length, CASE WHEN vec_id % 3 = 0 THEN 2 ELSE 1 END AS load, CAST(1 AS BIGINT) AS copies, {_ROWS_SQL} AS rows_hex FROM files"""))
def s6(spark, sf_dir):
    """Two loads: the second finds a third of the files new and leaves the others alone."""
    images, root, late = image_files(spark, sf_dir), scratch_path(spark, "s6-images"), F.col("vec_id") % 3 == 0
    name, path = f"kensa_images_{uuid.uuid4().hex[:8]}", scratch_path(spark, "s6-table")
    for load, some in ((1, images.where(~late)), (2, images.where(late))):
        write_images(some, root)
        fs.ingest_files(spark, root, name, path=path, only_new=True, load=load)
    copies = F.count(F.lit(1)).over(Window.partitionBy("key"))
    return cat.read_table(spark, name).select("key", "length", "load", copies.alias("copies"), F.hex(F.substring("content", 49, 72)).alias("rows_hex"))


# ---- annotations ------------------------------------------------------------------

@register("J1_label_files", _files_sql("""
SELECT key, CAST(140 AS BIGINT) AS length, CASE WHEN vec_id % 5 > 0 THEN 'kind-' || label END AS label FROM files"""))
def j1_files(spark, sf_dir):
    """Files and an annotation CSV that misses a fifth of them, loaded as two tables (U5) and joined by key."""
    images, labels = load_labelled(spark, sf_dir)
    return jn.label_images(images, labels, "key").select("key", "length", "label")


def load_labelled(spark, sf_dir):
    """The image and label tables that U5 loads: once, and kept when asked again."""
    images = image_files(spark, sf_dir).select("vec_id", "key", "label", "image")
    root, csv = write_images(images, scratch_path(spark, "j1-images")), scratch_path(spark, "j1-labels")
    noted = images.where("vec_id % 5 > 0").select(F.col("key").alias("image"), F.concat(F.lit("kind-"), "label").alias("label"), F.lit(None).cast("string").alias("mask"))
    noted.write.option("header", True).csv(csv)
    run = uuid.uuid4().hex[:8]
    cfg = cat.LoadConfig(root, csv, f"kensa_j1_images_{run}", f"kensa_j1_labels_{run}", folder=scratch_path(spark, "j1-tables"))
    if (cat.ensure_loaded(spark, cfg), cat.ensure_loaded(spark, cfg)) != ("loaded", "kept"):
        raise RuntimeError("the tables were not loaded once")
    return cat.read_table(spark, cfg.images_table), cat.read_table(spark, cfg.labels_table)


# Every 7th line is broken, in one of three ways: text for a number, a field too many, one too few.
_LINES_SQL = """lines AS (
SELECT doc_id, quality, toxic, doc_id % 7 = 0 AS bad,
       CASE WHEN doc_id % 7 > 0 THEN concat_ws(',', doc_id, quality, toxic)
            WHEN doc_id % 3 = 0 THEN doc_id || ',good,' || toxic
            WHEN doc_id % 3 = 1 THEN concat_ws(',', doc_id, quality, toxic, 'more')
            ELSE doc_id || ',' || quality END AS line
FROM annotation)"""


def _annotation_tables(spark, sf_dir, name):
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    line = (F.when(F.col("doc_id") % 7 > 0, F.concat_ws(",", "doc_id", "quality", "toxic"))
             .when(F.col("doc_id") % 3 == 0, F.concat_ws(",", "doc_id", F.lit("good"), "toxic"))
             .when(F.col("doc_id") % 3 == 1, F.concat_ws(",", "doc_id", "quality", "toxic", F.lit("more")))
             .otherwise(F.concat_ws(",", "doc_id", "quality")))
    src, out = scratch_path(spark, f"{name}-csv"), scratch_path(spark, name)
    # a header in each part file, as the CSV writer leaves them
    lines = labels.select(line.alias("value")).mapInArrow(_with_header, "value string")
    lines.write.text(src)
    return fs.quarantine_labels(spark, src, out, labels.schema)


def _with_header(batches):
    import pyarrow as pa
    for i, batch in enumerate(batches):
        if i == 0:
            yield pa.RecordBatch.from_arrays([pa.array(["doc_id,quality,toxic"])], schema=batch.schema)
        yield batch


@register("S3_labels", v.with_views(["annotation"], f"WITH {_LINES_SQL} SELECT doc_id, quality, toxic FROM lines WHERE NOT bad"))
def s3(spark, sf_dir):
    return _annotation_tables(spark, sf_dir, "s3")[0]


@register("S3_bad_lines", v.with_views(["annotation"], f"WITH {_LINES_SQL} SELECT line FROM lines WHERE bad"))
def s3_bad(spark, sf_dir):
    return _annotation_tables(spark, sf_dir, "s3-bad")[1].select("line")


# ---- history ----------------------------------------------------------------------

@register("U2_clear_history", v.with_views(["chat"], """
SELECT 'before' AS step, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars FROM chat UNION ALL SELECT 'cleared', 0, NULL
UNION ALL SELECT 'after', count(*), CAST(sum(length(text)) AS BIGINT) FROM chat WHERE role = 'user'"""))
def u2(spark, sf_dir):
    """A history is written, cleared, and goes on with new turns; what the table held at each step."""
    chat, name = v.chat(spark, sf_dir), f"kensa_history_{uuid.uuid4().hex[:8]}"
    cat.overwrite_table(chat, name, path=scratch_path(spark, name))
    steps = []

    def note(step):
        held = spark.table(name).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))
        steps.append(cut_lineage(held.select(F.lit(step).alias("step"), "n", "chars")))

    note("before")
    hi.clear_history(spark, name)
    note("cleared")
    chat.where("role = 'user'").write.mode("append").insertInto(name)
    note("after")
    return steps[0].unionByName(steps[1]).unionByName(steps[2])
