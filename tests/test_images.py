import numpy as np
from pyspark.sql import functions as F

from conftest import pattern
from kensa.operators import images as im
from kensa.sources import files as fs


def test_read_images_channels_and_invalid(spark, image_tree):
    root, files = image_tree
    df = fs.read_images(spark, str(root), glob=None)
    rows = {r.image.origin.split("/images/")[1]: r.image for r in df.collect()}
    assert rows["Anomaly/broken.jpg"].height == -1 and not rows["Anomaly/broken.jpg"].data
    assert rows["Normal/gray_2x2.png"].nChannels == 1
    assert rows["Normal/rgba_2x2.png"].nChannels == 4
    assert rows["Normal/rgb_3x2.png"].nChannels == 3
    assert "Normal/notes.txt" in rows  # no glob: every file is tried
    valid = fs.read_images(spark, str(root), drop_invalid=True, glob=fs.IMAGE_GLOB)
    assert valid.count() == len(files)


def test_to_rgb_orders_channels(spark, image_tree):
    root, files = image_tree
    df = im.to_rgb(fs.read_images(spark, str(root), drop_invalid=True, glob=fs.IMAGE_GLOB))
    got = {r.image.origin.split("/images/")[1]: r.pixels for r in df.collect()}
    for name, (w, h, c) in files.items():
        px = got[name]
        arr = np.frombuffer(px.data, np.uint8).reshape(px.height, px.width, px.channels)
        src = np.array(pattern(w, h, c, seed=w + h), np.uint8).reshape(h, w, c)
        want = np.repeat(src, 3, axis=2) if c == 1 else src[:, :, :3]
        assert px.channels == 3 and np.array_equal(arr, want), name


def test_square_resize_udf_equals_array_form(spark):
    w, h, size = 8, 5, 6
    pix = list(range(w * h))
    df = spark.createDataFrame([(pix,)], "p array<int>")
    arr = df.select(im.square_resize_array(F.col("p"), w, h, size)).first()[0]
    img = np.array(pix, np.uint8).reshape(h, w, 1).repeat(3, axis=2)
    np_out = im.square_resize_np(img, size)[:, :, 0].ravel().tolist()
    assert arr == np_out
    px = spark.createDataFrame([(h, w, 3, bytearray(img.tobytes()))], im.PIXELS)
    udf = im.square_resize(px.select(F.struct("*").alias("pixels")), size).first().pixels
    assert list(np.frombuffer(udf.data, np.uint8)[::3]) == np_out and (udf.height, udf.width) == (size, size)


def test_margin_crop_udf_equals_array_form(spark):
    w, h = 11, 7
    pix = list(range(w * h))
    arr = spark.createDataFrame([(pix,)], "p array<int>").select(im.margin_crop_array(F.col("p"), w, h)).first()[0]
    img = np.array(pix, np.uint8).reshape(h, w, 1).repeat(3, axis=2)
    assert arr == im.margin_crop_np(img)[:, :, 0].ravel().tolist()


def test_bilinear_known_values():
    flat = np.full((10, 20, 3), 77, np.uint8)
    assert np.all(im.bilinear_resize_np(flat, 7, 4) == 77)
    stripes = np.zeros((1, 4, 1), np.uint8)
    stripes[0, 1::2, 0] = 200
    # 2x down, triangle support 2: output 0 weighs sources 0,1,2 by .75,.75,.25
    # -> 200*.75/1.75 = 85.7; output 1 weighs 1,2,3 by .25,.75,.75 -> 200/1.75 = 114.3
    assert im.bilinear_resize_np(stripes, 2, 1)[0, :, 0].tolist() == [86, 114]
    # up-scaling keeps the end values
    up = im.bilinear_resize_np(np.array([[[0], [255]]], np.uint8), 4, 1)[0, :, 0].tolist()
    assert up[0] == 0 and up[-1] == 255 and up == sorted(up)


def test_resize_short_and_center_crop_shapes():
    img = np.zeros((200, 300, 3), np.uint8)
    r = im.resize_short_np(img, 256)
    assert r.shape == (256, int(256 * 300 / 200), 3)
    assert im.center_crop_np(r, 224).shape == (224, 224, 3)
    assert im.center_crop_np(np.ones((10, 10, 3), np.uint8), 16).shape == (16, 16, 3)


def test_training_tensors_and_bad_image(spark, image_tree):
    root, files = image_tree
    df = fs.read_images(spark, str(root), glob=fs.IMAGE_GLOB)
    out = im.training_tensors(df).collect()
    assert len(out) == len(files) + 1
    for r in out:
        if r.origin.endswith("broken.jpg"):
            assert r.tensor is None and "unreadable" in r.error
        else:
            assert r.error is None and len(r.tensor) == 3 * 224 * 224
    t = np.array(next(r.tensor for r in out if r.origin.endswith("rgb_300x200.png")), np.float32)
    lo, hi = (0 - max(im.MEAN)) / min(im.STD), (1 - min(im.MEAN)) / min(im.STD)
    assert t.min() >= lo - 1e-5 and t.max() <= hi + 1e-5


def test_tensor_and_normalise_udfs_match_array_forms(spark):
    pix = [0, 51, 102, 255]
    img = np.array(pix, np.uint8).reshape(2, 2, 1).repeat(3, axis=2)
    px = spark.createDataFrame([(2, 2, 3, bytearray(img.tobytes()), pix)], "height int, width int, channels int, data binary, p array<int>")
    px = px.select(F.struct("height", "width", "channels", "data").alias("pixels"), "p")
    t = im.to_tensor(px).first().tensor
    assert np.allclose(t[:4], [x / 255 for x in pix])
    n = im.normalise(px).select("tensor", im.normalise_array(F.col("p")).alias("arr")).first()
    assert np.allclose(n.tensor[:4], n.arr, atol=1e-6)


def test_in_batches_caps_rows():
    import pandas as pd
    chunks = list(im.in_batches(iter([pd.DataFrame({"a": range(150)}), pd.DataFrame({"a": range(3)})]), 64))
    assert [len(c) for c in chunks] == [64, 64, 22, 3]


def test_image_jobs_work_in_small_pieces(spark):
    def checked(images):
        assert len(images) <= im.BATCH_ROWS
        return im._pixels_out(images)

    pix = F.array(*[F.lit(i) for i in range(64)])
    df = spark.range(10_000).coalesce(1).select("id", im.gray_image_struct("id", pix, 8, 8).alias("image"))
    out = im._in_pieces(df, "image", "pixels", im.PIXELS, im._rgb_in, lambda a: a, checked)
    assert out.agg(F.count("pixels"), F.count_distinct("id")).first() == (10_000, 10_000)


def test_unreadable_images_stay_as_null_rows(spark):
    df = spark.createDataFrame([(1, None)], "id long, image struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>")
    out = im.normalise(im.margin_crop(im.square_resize(im.to_rgb(df))))
    assert [(r.id, r.pixels, r.tensor) for r in out.collect()] == [(1, None, None)]


def test_images_with_nothing_left_give_null_and_a_reason(spark):
    rows = [("wide", 1, 40, 1, 0, bytes(40)), ("one", 1, 1, 1, 0, b"\x07"), ("ok", 4, 4, 1, 0, bytes(range(16))), ("none", None, None, None, None, None)]
    df = spark.createDataFrame([(r,) for r in rows], "image struct<origin string, height int, width int, nChannels int, mode int, data binary>")
    got = {r.image.origin: r for r in im.margin_crop(im.to_rgb(df), 0.1, error="why").collect()}
    assert got["wide"].pixels is None and "nothing is left" in got["wide"].why
    assert got["one"].pixels is None and got["none"].pixels is None and got["none"].why is None
    assert got["ok"].pixels.width == 3 and got["ok"].why is None
    after = im.resize_center_crop(im.square_resize(im.margin_crop(im.to_rgb(df), 0.1), 8), 16, 8).collect()
    assert sum(r.pixels is not None for r in after) == 1


def test_weight_cache_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(im, "_WEIGHT_BYTES", 300_000)
    for n in range(100, 400, 10):
        w = im._bilinear_weights(n, 64)
        assert w.shape == (64, n) and sum(x.nbytes for x in im._weights.values()) <= 300_000
    assert im._bilinear_weights(390, 64) is w


def test_image_vectors(spark):
    df = spark.createDataFrame([(("a", 2, 4, 1, 0, bytes([0, 10, 20, 0, 0, 30, 40, 0])),), (None,)], "image struct<origin string, height int, width int, nChannels int, mode int, data binary>")
    got = [r.vector for r in im.image_vector(df, 2).collect()]
    assert [round(x * 255) for x in got[0]] == [10, 20, 30, 40] and got[1] is None
