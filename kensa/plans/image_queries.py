"""Registered image queries: the ``features`` vectors read as 8 x 8
one-channel images (I1-I7), by the array forms and by the operators on image
tables; both are checked against DuckDB."""

from __future__ import annotations

from pyspark.sql import functions as F

from kensa.operators import images as im
from kensa.plans import views as v
from kensa.plans.registry import register

SIDE = 8
UPSCALE = 12
_PIX_SQL = ("list_transform(embedding, lambda x: CAST(least(greatest(floor((CAST(x AS DOUBLE) + 0.5) * 255), 0), 255) AS INTEGER))")
_PIXELS_SQL = f"SELECT vec_id, {_PIX_SQL} AS p FROM features"


def _pixels(spark, sf_dir):
    return v.features(spark, sf_dir).select("vec_id", im.pixels_from_floats("embedding").alias("p"))


def _exploded(df, arr):
    return df.select("vec_id", F.posexplode(arr).alias("idx", "value"))


@register("I1_to_rgb", v.with_views(["features"], f"""
SELECT vec_id, 8 AS height, 8 AS width, 3 AS channels,
       array_to_string(list_transform(p, lambda x: repeat(lpad(hex(x), 2, '0'), 3)), '') AS data_hex
FROM ({_PIXELS_SQL})"""))
def i1(spark, sf_dir):
    df = _pixels(spark, sf_dir).select("vec_id", im.gray_image_struct("vec_id", F.col("p"), SIDE, SIDE).alias("image"))
    out = im.to_rgb(df)
    return out.select("vec_id", "pixels.height", "pixels.width", "pixels.channels",
                      F.hex("pixels.data").alias("data_hex"))


@register("I2_square_resize", v.with_views(["features"], f"""
SELECT vec_id, CAST(k AS INTEGER) AS idx,
       p[CAST(floor((floor(k / {UPSCALE}) + 0.5) * 8 / {UPSCALE}) * 8 + floor((k % {UPSCALE} + 0.5) * 8 / {UPSCALE}) + 1 AS INTEGER)] AS value
FROM ({_PIXELS_SQL}) AS px, range(0, {UPSCALE * UPSCALE}) AS r(k)"""))
def i2(spark, sf_dir):
    df = _pixels(spark, sf_dir)
    return _exploded(df, im.square_resize_array(F.col("p"), SIDE, SIDE, UPSCALE))


# The same steps through the operators on image tables (RGB, so a gray value
# stands three times).

_RESIZED_SQL = f"""
SELECT vec_id, list_transform(range({UPSCALE * UPSCALE}), lambda k:
         p[CAST(floor((floor(k / {UPSCALE}) + 0.5) * 8 / {UPSCALE}) * 8 + floor((k % {UPSCALE} + 0.5) * 8 / {UPSCALE}) + 1 AS INTEGER)]) AS q
FROM ({_PIXELS_SQL})"""
_CROPPED_SQL = f"""
SELECT vec_id, list_transform(range(49), lambda k: p[CAST(floor(k / 7) * 8 + k % 7 + 1 AS INTEGER)]) AS q FROM ({_PIXELS_SQL})"""


def _bytes_sql(source: str, side: int) -> str:
    return v.with_views(["features"], f"""
SELECT vec_id, {side} AS height, {side} AS width, 3 AS channels,
       array_to_string(list_transform(q, lambda x: repeat(lpad(hex(x), 2, '0'), 3)), '') AS data_hex FROM ({source})""")


def _bytes(df):
    return df.select("vec_id", "pixels.height", "pixels.width", "pixels.channels", F.hex("pixels.data").alias("data_hex"))


@register("I2_square_resize_images", _bytes_sql(_RESIZED_SQL, UPSCALE))
def i2_images(spark, sf_dir):
    return _bytes(im.square_resize(im.to_rgb(_gray_images(spark, sf_dir)), UPSCALE))


@register("I3_margin_crop_images", _bytes_sql(_CROPPED_SQL, 7))
def i3_images(spark, sf_dir):
    return _bytes(im.margin_crop(im.to_rgb(_gray_images(spark, sf_dir)), 0.1))


def _tensor_sql(value: str) -> str:
    """Three channels of 64 values; 3 decimals round alike in float32 and double."""
    stats = ", ".join(f"({m}, {sd})" for m, sd in zip(im.MEAN, im.STD))
    return v.with_views(["features"], f"""
SELECT vec_id, CAST((c - 1) * 64 + i - 1 AS INTEGER) AS idx, round({value}, 3) AS value
FROM ({_PIXELS_SQL}) AS px, range(1, 65) AS r(i),
     (SELECT row_number() OVER () AS c, m, sd FROM (VALUES {stats}) AS s(m, sd)) AS ch""")


def _tensor(df):
    return df.select("vec_id", F.posexplode("tensor").alias("idx", "value")) \
        .select("vec_id", "idx", F.round(F.col("value").cast("double"), 3).alias("value"))


@register("I5_to_tensor_images", _tensor_sql("p[i] / 255.0"))
def i5_images(spark, sf_dir):
    return _tensor(im.to_tensor(im.to_rgb(_gray_images(spark, sf_dir))))


@register("I6_normalise_images", _tensor_sql("(p[i] / 255.0 - m) / sd"))
def i6_images(spark, sf_dir):
    return _tensor(im.normalise(im.to_rgb(_gray_images(spark, sf_dir))))


@register("I3_margin_crop", v.with_views(["features"], f"""
SELECT vec_id, CAST(k AS INTEGER) AS idx, p[CAST(floor(k / 7) * 8 + k % 7 + 1 AS INTEGER)] AS value
FROM ({_PIXELS_SQL}) AS px, range(0, 49) AS r(k)"""))
def i3(spark, sf_dir):
    return _exploded(_pixels(spark, sf_dir), im.margin_crop_array(F.col("p"), SIDE, SIDE, 0.1))


@register("I5_to_tensor", v.with_views(["features"], f"""
SELECT vec_id, CAST(i - 1 AS INTEGER) AS idx, CAST(p[i] AS DOUBLE) / 255.0 AS value
FROM ({_PIXELS_SQL}) AS px, range(1, 65) AS r(i)"""))
def i5(spark, sf_dir):
    return _exploded(_pixels(spark, sf_dir), im.to_tensor_array(F.col("p")))


@register("I6_normalise", v.with_views(["features"], f"""
SELECT vec_id, CAST(i - 1 AS INTEGER) AS idx, (CAST(p[i] AS DOUBLE) / 255.0 - 0.485) / 0.229 AS value
FROM ({_PIXELS_SQL}) AS px, range(1, 65) AS r(i)"""))
def i6(spark, sf_dir):
    return _exploded(_pixels(spark, sf_dir), im.normalise_array(F.col("p")))


def _gray_images(spark, sf_dir):
    return _pixels(spark, sf_dir).select(
        "vec_id", im.gray_image_struct("vec_id", F.col("p"), SIDE, SIDE).alias("image"))


def _bilinear_ctes(side: int, size: int, crop: int) -> str:
    """DuckDB form of I4 on the 8x8 images, up to the cropped pixels ``vp``:
    triangle-filter weights from the same rule (support 1 when enlarging),
    fixed point with 22 fraction bits, horizontal then vertical pass with
    8-bit rounding between them, centre crop."""
    off = int(round((size - crop) / 2.0))
    one, half = 1 << 22, 1 << 21
    return f"""
px AS ({_PIXELS_SQL}),
ctr AS (SELECT o, (o + 0.5) * ({side} / {size}.0) AS center FROM range({size}) t(o)),
k AS (SELECT o, i, greatest(1.0 - abs(i - center + 0.5), 0.0) AS k
      FROM ctr, range({side}) s(i)
      WHERE i >= greatest(CAST(trunc(center - 1.0 + 0.5) AS INTEGER), 0)
        AND i < least(CAST(trunc(center + 1.0 + 0.5) AS INTEGER), {side})),
wt AS (SELECT o, i, CAST(trunc(0.5 + k / sum(k) OVER (PARTITION BY o) * {one}) AS BIGINT) AS w FROM k),
hp AS (SELECT vec_id, y, wt.o AS x,
              least(greatest(floor((sum(p[CAST(y * {side} + wt.i + 1 AS INTEGER)] * wt.w) + {half}) / {one}.0), 0), 255) AS v
       FROM px, range({side}) r(y), wt GROUP BY vec_id, y, wt.o),
vp AS (SELECT hp.vec_id, wt.o AS y, hp.x,
              least(greatest(floor((sum(hp.v * wt.w) + {half}) / {one}.0), 0), 255) AS v
       FROM hp JOIN wt ON hp.y = wt.i
       WHERE wt.o BETWEEN {off} AND {off + crop - 1} AND hp.x BETWEEN {off} AND {off + crop - 1}
       GROUP BY hp.vec_id, wt.o, hp.x)"""


_CROP = im.TRAIN_CROP
_BILINEAR = _bilinear_ctes(SIDE, im.TRAIN_RESIZE, _CROP)


# Gray repeated to RGB, SHA-1 of the bytes.
@register("I4_resize_center_crop", v.with_views(["features"], f"""WITH {_BILINEAR}
SELECT vec_id, {_CROP} AS height, {_CROP} AS width, 3 AS channels,
       sha1(unhex(string_agg(repeat(lpad(hex(CAST(v AS INTEGER)), 2, '0'), 3), '' ORDER BY y, x))) AS digest
FROM vp GROUP BY vec_id"""))
def i4(spark, sf_dir):
    out = im.resize_center_crop(im.to_rgb(_gray_images(spark, sf_dir)))
    return out.select("vec_id", "pixels.height", "pixels.width", "pixels.channels",
                      F.sha1("pixels.data").alias("digest"))


def _channels_sql(expr: str, fn: str) -> str:
    """(v / 255 - mean_c) / sd_c over the three channels, combined by ``fn``."""
    return fn + "(" + ", ".join(f"({expr} / 255.0 - {m}) / {sd}" for m, sd in zip(im.MEAN, im.STD)) + ")"


# The tensors are float32; rounded to 3 decimals every reachable value
# (256 levels x 3 channels) rounds the same in float32 and double, so the
# extremes can be compared exactly with DuckDB's double arithmetic.
@register("I7_training_tensors", v.with_views(["features"], f"""WITH {_BILINEAR}
SELECT vec_id, {3 * _CROP * _CROP} AS n_values,
       round({_channels_sql('max(v)', 'greatest')}, 3) AS max_value,
       round({_channels_sql('min(v)', 'least')}, 3) AS min_value,
       CAST(NULL AS VARCHAR) AS error
FROM vp GROUP BY vec_id"""))
def i7(spark, sf_dir):
    out = im.training_tensors(_gray_images(spark, sf_dir), keep=("vec_id",))
    return out.select("vec_id", F.size("tensor").alias("n_values"),
                      F.round(F.array_max("tensor").cast("double"), 3).alias("max_value"),
                      F.round(F.array_min("tensor").cast("double"), 3).alias("min_value"), "error")
