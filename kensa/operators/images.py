"""Image jobs (I1-I8) over a table of decoded images.

Input is Spark's ``image`` struct (``origin, height, width, nChannels, mode,
data``) with BGR(A) byte order, or our RGB pixel struct ``(height, width,
channels, data)``.  Per-image work is a few NumPy lines inside Arrow jobs
(``mapInArrow``) that work on at most ``BATCH_ROWS`` images at a time.
The same nearest-neighbour resize, margin crop, scaling and normalisation
also exist as SQL array expressions (``*_array``) that stay in the JVM; the
tests check that both forms agree.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kensa.functions.errors import capture_error
from kensa.operators.partitioning import spread
from kensa.session import ship_package

# Training-time normalisation (ImageNet channel statistics).
MEAN = (0.485, 0.456, 0.406)
STD = (0.229, 0.224, 0.225)
SCORE_SIZE = 256          # scoring: centre square, nearest resize to 256 x 256
TRAIN_RESIZE, TRAIN_CROP = 256, 224
BATCH_ROWS = 64

PIXELS = T.StructType([
    T.StructField("height", T.IntegerType()), T.StructField("width", T.IntegerType()),
    T.StructField("channels", T.IntegerType()), T.StructField("data", T.BinaryType())])
TENSOR = T.ArrayType(T.FloatType())

# ---- NumPy helpers (one image) ------------------------------------------------


def image_to_rgb(height: int, width: int, n_channels: int, data: bytes) -> np.ndarray:
    """Spark image bytes (BGR / BGRA / gray) -> H x W x 3 RGB uint8."""
    a = np.frombuffer(data, dtype=np.uint8).reshape(height, width, n_channels)
    if n_channels == 1:
        return np.repeat(a, 3, axis=2)
    return np.ascontiguousarray(a[:, :, 2::-1])  # drop alpha, BGR -> RGB


def square_box_np(w: int, h: int) -> tuple[int, int, int, int]:
    s = min(w, h)
    return tuple(int(np.rint(x)) for x in ((w - s) / 2, (h - s) / 2, (w + s) / 2, (h + s) / 2))


def nearest_resize_np(img: np.ndarray, box: tuple[int, int, int, int], out_w: int, out_h: int) -> np.ndarray:
    """Nearest neighbour from a crop box: source index floor((i + 0.5) * s / t)."""
    l, t, r, b = box
    xs = l + np.floor((np.arange(out_w) + 0.5) * (r - l) / out_w).astype(np.int64)
    ys = t + np.floor((np.arange(out_h) + 0.5) * (b - t) / out_h).astype(np.int64)
    return img[ys[:, None], xs[None, :]]


def square_resize_np(img: np.ndarray, size: int = SCORE_SIZE) -> np.ndarray:
    h, w = img.shape[:2]
    return nearest_resize_np(img, square_box_np(w, h), size, size)


def margin_crop_np(img: np.ndarray, margin: float = 0.1) -> np.ndarray:
    h, w = img.shape[:2]
    l, t = int(w * margin), int(h * margin)
    r, b = int(w * (1 - margin)), int(h * (1 - margin))
    if l >= r or t >= b:
        raise ValueError(f"nothing is left of a {w} x {h} image")
    return img[t:b, l:r]


_PRECISION_BITS = 32 - 8 - 2


_WEIGHT_BYTES = 64 << 20
_weights: dict[tuple[int, int], np.ndarray] = {}


def _bilinear_weights(in_size: int, out_size: int) -> np.ndarray:
    """``_make_weights``, kept for the size pairs used last, ``_WEIGHT_BYTES`` of them at most."""
    key = (in_size, out_size)
    made = _weights.pop(key, None)
    made = _make_weights(*key) if made is None else made
    _weights[key] = made                      # the last in order is the one used last
    while len(_weights) > 1 and sum(w.nbytes for w in _weights.values()) > _WEIGHT_BYTES:
        _weights.pop(next(iter(_weights)))
    return made


def _make_weights(in_size: int, out_size: int) -> np.ndarray:
    """Fixed-point antialiased triangle-filter weights (out_size x in_size),
    the usual 8-bit resampling scheme: support widens when downscaling."""
    scale = in_size / out_size
    fscale = max(scale, 1.0)
    support = 1.0 * fscale
    center = (np.arange(out_size) + 0.5) * scale
    lo = np.maximum((center - support + 0.5).astype(np.int64), 0)
    hi = np.minimum((center + support + 0.5).astype(np.int64), in_size)
    src = np.arange(in_size)
    inside = (src[None, :] >= lo[:, None]) & (src[None, :] < hi[:, None])
    x = (src[None, :] - center[:, None] + 0.5) / fscale
    k = np.where(inside, np.clip(1.0 - np.abs(x), 0.0, None), 0.0)
    total = k.sum(axis=1, keepdims=True)
    k = np.divide(k, total, out=np.zeros_like(k), where=total > 0)
    fixed = np.where(k < 0, np.trunc(-0.5 + k * (1 << _PRECISION_BITS)),
                     np.trunc(0.5 + k * (1 << _PRECISION_BITS)))
    return fixed.astype(np.int64)


def _resample_axis(img: np.ndarray, wts: np.ndarray, axis: int) -> np.ndarray:
    """One separable pass in fixed point.  Weights (< 2^23) times pixels
    (< 2^8), summed, stay integers far below 2^53, so a float64 matrix
    product (BLAS) gives exactly the integer result, in any summation order."""
    moved = np.moveaxis(img, axis, 0)
    flat = moved.reshape(moved.shape[0], -1).astype(np.float64)
    acc = wts.astype(np.float64) @ flat + float(1 << (_PRECISION_BITS - 1))
    out = np.clip(np.floor(acc / float(1 << _PRECISION_BITS)), 0, 255).astype(np.uint8)
    return np.moveaxis(out.reshape((wts.shape[0],) + moved.shape[1:]), 0, axis)


def bilinear_resize_np(img: np.ndarray, out_w: int, out_h: int) -> np.ndarray:
    h, w = img.shape[:2]
    if out_w != w:
        img = _resample_axis(img, _bilinear_weights(w, out_w), 1)
    if out_h != h:
        img = _resample_axis(img, _bilinear_weights(h, out_h), 0)
    return img


def resize_short_np(img: np.ndarray, size: int = TRAIN_RESIZE) -> np.ndarray:
    """Short side to ``size``, long side ``int(size * long / short)``."""
    h, w = img.shape[:2]
    if w <= h:
        ow, oh = size, int(size * h / w)
    else:
        oh, ow = size, int(size * w / h)
    return bilinear_resize_np(img, ow, oh)


def center_crop_np(img: np.ndarray, size: int = TRAIN_CROP) -> np.ndarray:
    """Centre crop; an image smaller than ``size`` is padded with zeros."""
    h, w = img.shape[:2]
    if h < size or w < size:
        ph, pw = max(size - h, 0), max(size - w, 0)
        img = np.pad(img, ((ph // 2, ph - ph // 2), (pw // 2, pw - pw // 2), (0, 0)))
        h, w = img.shape[:2]
    top, left = int(round((h - size) / 2.0)), int(round((w - size) / 2.0))
    return img[top:top + size, left:left + size]


def png_np(height: int, width: int, channels: int, data: bytes, level: int = 6) -> bytes:
    """Image bytes (gray, BGR or BGRA) as a PNG file; level 0 stores the rows uncompressed."""
    a = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    order = {1: [0], 3: [2, 1, 0], 4: [2, 1, 0, 3]}[channels]
    rows = np.zeros((height, 1 + width * channels), np.uint8)   # each row behind its filter type, 0
    rows[:, 1:] = a[:, :, order].reshape(height, -1)
    # PNG signature, chunk names and colour types.
    header = struct.pack(">IIBBBBB", width, height, 8, {1: 0, 3: 2, 4: 6}[channels], 0, 0, 0)
    out = b"\x89PNG\r\n\x1a\n"
    for name, body in ((b"IHDR", header), (b"IDAT", zlib.compress(rows.tobytes(), level)), (b"IEND", b"")):
        out += struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    return out


def to_tensor_np(img: np.ndarray) -> np.ndarray:
    """H x W x C uint8 -> C x H x W float32 in [0, 1]."""
    return (np.transpose(img, (2, 0, 1)).astype(np.float32) / np.float32(255.0))


def normalise_np(t: np.ndarray, mean=MEAN, std=STD) -> np.ndarray:
    m = np.asarray(mean, dtype=np.float32)[:, None, None]
    s = np.asarray(std, dtype=np.float32)[:, None, None]
    return (t - m) / s


def training_tensor_np(img: np.ndarray) -> np.ndarray:
    return normalise_np(to_tensor_np(center_crop_np(resize_short_np(img))))

# ---- Spark: Arrow jobs over pixel structs, in pieces of at most BATCH_ROWS rows ----


def _pixels_out(imgs: list):
    import pyarrow as pa
    shapes = [(None, None, None) if a is None else a.shape for a in imgs]
    cols = [pa.array([x[i] for x in shapes], pa.int32()) for i in range(3)]
    cols.append(pa.array([None if a is None else a.tobytes() for a in imgs], pa.binary()))
    return pa.StructArray.from_arrays(cols, names=["height", "width", "channels", "data"],
                                      mask=pa.array([a is None for a in imgs]))


def _tensors_out(tensors: list):
    import pyarrow as pa
    sizes = [0 if t is None else t.size for t in tensors]
    kept = [t.ravel() for t in tensors if t is not None]
    values = pa.array(np.concatenate(kept) if kept else np.zeros(0, np.float32), pa.float32())
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), values,
                                    mask=pa.array([t is None for t in tensors]))


def _pixels_in(column) -> list:
    return [None if p is None or p["data"] is None or not p["height"] else
            np.frombuffer(p["data"], dtype=np.uint8).reshape(p["height"], p["width"], p["channels"])
            for p in column.to_pylist()]


def _rgb_in(column) -> list:
    return [None if p is None or p["data"] is None or p["height"] is None or p["height"] < 1 or p["width"] < 1 else
            image_to_rgb(p["height"], p["width"], p["nChannels"], p["data"]) for p in column.to_pylist()]


def _in_pieces(df: DataFrame, col: str, out: str, dtype: T.DataType, read, fn, write, error: str | None = None) -> DataFrame:
    """``df`` with column ``out`` = ``fn`` of each image of ``col``.  Arrow batches
    are cut to ``BATCH_ROWS`` rows before any pixel is produced, and each piece
    is sent back by itself, so a task holds the output of one piece only.  Where
    ``fn`` fails the result is null; ``error`` names a column for the reason (C20)."""
    ship_package(df.sparkSession)
    names = [c for c in df.columns if c not in (out, error)]
    at = df.columns.index(col)
    more = [error] if error else []
    safe = capture_error(fn)

    def run(batches):
        import pyarrow as pa
        for rb in batches:
            for lo in range(0, rb.num_rows, BATCH_ROWS):
                piece = rb.slice(lo, BATCH_ROWS)
                done = [(None, None) if a is None else safe(a) for a in read(piece.column(at))]
                reasons = [pa.array([e for _, e in done], pa.string())] if error else []
                yield pa.RecordBatch.from_arrays([*(piece.column(names_at[c]) for c in names), write([v for v, _ in done]), *reasons], names=[*names, out, *more])

    names_at = {c: i for i, c in enumerate(df.columns)}
    schema = T.StructType([*(df.schema[c] for c in names), T.StructField(out, dtype), *(T.StructField(c, T.StringType()) for c in more)])
    order = [*df.columns, *(c for c in (out, *more) if c not in df.columns)]
    return df.mapInArrow(run, schema).select(*order)


def to_rgb(df: DataFrame, image: str = "image", out: str = "pixels") -> DataFrame:
    """Decoded image -> RGB pixels (gray repeated, alpha dropped).
    Unreadable images give null pixels."""
    return _in_pieces(spread(df), image, out, PIXELS, _rgb_in, lambda a: a, _pixels_out)


def square_resize(df: DataFrame, size: int = SCORE_SIZE, col: str = "pixels", error: str | None = None) -> DataFrame:
    """Centre square crop, nearest resize to ``size`` x ``size``."""
    return _in_pieces(df, col, col, PIXELS, _pixels_in, lambda a: square_resize_np(a, size), _pixels_out, error)


def margin_crop(df: DataFrame, margin: float = 0.1, col: str = "pixels", error: str | None = None) -> DataFrame:
    """Cut ``margin`` of the width / height off each side; null pixels
    (and a reason in column ``error``, if named) where nothing is left."""
    return _in_pieces(df, col, col, PIXELS, _pixels_in, lambda a: margin_crop_np(a, margin), _pixels_out, error)


def resize_center_crop(df: DataFrame, resize: int = TRAIN_RESIZE, crop: int = TRAIN_CROP,
                       col: str = "pixels", error: str | None = None) -> DataFrame:
    """I4: short side to ``resize`` (bilinear, aspect kept), centre ``crop``."""
    return _in_pieces(df, col, col, PIXELS, _pixels_in, lambda a: center_crop_np(resize_short_np(a, resize), crop),
                      _pixels_out, error)


def to_tensor(df: DataFrame, col: str = "pixels", out: str = "tensor") -> DataFrame:
    """Channel-first floats in [0, 1]."""
    return _in_pieces(df, col, out, TENSOR, _pixels_in, to_tensor_np, _tensors_out)


def normalise(df: DataFrame, col: str = "pixels", out: str = "tensor", mean=MEAN, std=STD) -> DataFrame:
    """I5 + I6: channel-first floats, normalised per channel."""
    return _in_pieces(df, col, out, TENSOR, _pixels_in, lambda a: normalise_np(to_tensor_np(a), mean, std),
                      _tensors_out)



def image_vector(df: DataFrame, side: int, image: str = "image", out: str = "vector") -> DataFrame:
    """Model input of an image: RGB, centre square, nearest resize to ``side`` x ``side``,
    mean of the channels over 255, as floats.  Null where the image cannot be read."""
    def vector(a):
        return square_resize_np(a, side).mean(2).ravel() / 255.0
    return _in_pieces(spread(df), image, out, TENSOR, _rgb_in, vector, _tensors_out)


def encode_png(df: DataFrame, image: str = "image", out: str = "content", level: int = 6) -> DataFrame:
    """The image as the bytes of a PNG file (null where there are no pixels)."""
    def read(column):
        return [None if p is None or p["data"] is None or not p["height"] or p["height"] < 1 or p["width"] < 1 else p for p in column.to_pylist()]

    def write(files):
        import pyarrow as pa
        return pa.array(files, pa.binary())

    return _in_pieces(spread(df), image, out, T.BinaryType(), read,
                      lambda p: png_np(p["height"], p["width"], p["nChannels"], p["data"], level), write)

# ---- Spark: one pass for training tensors, batched scoring ----------------------


@capture_error
def _tensor_of(img) -> np.ndarray:
    if img is None or img["data"] is None or img["height"] < 1:
        raise ValueError("unreadable image")
    rgb = image_to_rgb(int(img["height"]), int(img["width"]), int(img["nChannels"]), img["data"])
    return training_tensor_np(rgb).ravel()


def training_tensors(df: DataFrame, image: str = "image", keep: tuple = ()) -> DataFrame:
    """RGB, resize 256, centre crop 224, tensor, normalise -- one
    ``mapInArrow`` pass, so pixels cross to Python once and the tensors go
    back as one flat float buffer per batch (no per-row objects).  Output
    columns: ``keep..., origin, tensor array<float>, error``; a bad image
    gives a null tensor and an error text, never a failed job."""
    ship_package(df.sparkSession)
    keep = tuple(keep)
    schema = T.StructType([*[df.schema[k] for k in keep],
                           T.StructField("origin", T.StringType()),
                           T.StructField("tensor", TENSOR),
                           T.StructField("error", T.StringType())])

    def run(batches):
        import pyarrow as pa
        for whole in batches:
            for lo in range(0, whole.num_rows, BATCH_ROWS):  # bounds the tensors held at once
                rb = whole.slice(lo, BATCH_ROWS)
                rows = rb.column(len(keep)).to_pylist()
                made = [_tensor_of(img) for img in rows]
                origin = pa.array([None if i is None else i["origin"] for i in rows], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*(rb.column(k) for k in range(len(keep))), origin, _tensors_out([t for t, _ in made]),
                     pa.array([e for _, e in made], pa.string())], names=[*keep, "origin", "tensor", "error"])

    return spread(df.select(*keep, image)).mapInArrow(run, schema)


def in_batches(pdf_iter, rows: int = BATCH_ROWS):
    """Re-cut incoming Arrow batches into chunks of at most ``rows`` rows
    (I8): bounds the pixels held by one Python call."""
    for pdf in pdf_iter:
        for start in range(0, len(pdf), rows):
            yield pdf.iloc[start:start + rows]


def score_batches(df: DataFrame, fn, schema: T.StructType | str, rows: int = BATCH_ROWS) -> DataFrame:
    """I8: run ``fn(pandas batch) -> pandas batch`` over batches of at most
    ``rows`` rows, on the executors (``mapInPandas``)."""
    ship_package(df.sparkSession)

    def run(batches):
        for pdf in in_batches(batches, rows):
            yield fn(pdf)

    return df.mapInPandas(run, schema)


def image_batch_conf(rows: int = BATCH_ROWS, max_bytes: str = "64m") -> dict:
    """Session settings for image jobs.  Arrow batches sent to Python are cut
    by rows *and* by bytes (``maxBytesPerBatch``, 64 MB by default in Spark
    4.x), so a batch of large images stays bounded; inside a batch the jobs
    work on at most ``BATCH_ROWS`` images at a time (``in_batches``)."""
    return {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows),
            "spark.sql.execution.arrow.maxBytesPerBatch": max_bytes}

# ---- SQL array forms (JVM only), for one-channel images as int arrays -----------


def pixels_from_floats(col: str, offset: float = 0.5, scale: float = 255.0) -> Column:
    """Floats -> 0..255 ints: floor((x + offset) * scale), clamped."""
    return F.transform(F.col(col), lambda x: F.least(F.greatest(
        F.floor((x.cast("double") + F.lit(offset)) * F.lit(scale)), F.lit(0)), F.lit(255)).cast("int"))


def square_resize_array(pix: Column, width: int, height: int, size: int) -> Column:
    """I2 on a row-major one-channel int array (sizes fixed per call)."""
    l, t, r, b = square_box_np(width, height)
    sw, sh = r - l, b - t
    return F.transform(F.sequence(F.lit(0), F.lit(size * size - 1)), lambda k: F.element_at(
        pix, ((F.lit(t) + F.floor((F.floor(k / size) + 0.5) * sh / size)) * width
              + F.lit(l) + F.floor((k % size + 0.5) * sw / size) + 1).cast("int")))


def margin_crop_array(pix: Column, width: int, height: int, margin: float = 0.1) -> Column:
    """I3 on a row-major one-channel int array."""
    l, t = int(width * margin), int(height * margin)
    r, b = int(width * (1 - margin)), int(height * (1 - margin))
    cw = r - l
    return F.transform(F.sequence(F.lit(0), F.lit(cw * (b - t) - 1)), lambda k: F.element_at(
        pix, ((F.lit(t) + F.floor(k / cw)) * width + F.lit(l) + k % cw + 1).cast("int")))


def to_tensor_array(pix: Column) -> Column:
    """I5 for one channel: x / 255."""
    return F.transform(pix, lambda x: x.cast("double") / F.lit(255.0))


def normalise_array(pix: Column, channel: int = 0) -> Column:
    """I6 for one channel: (x / 255 - mean) / sd."""
    m, s = MEAN[channel], STD[channel]
    return F.transform(pix, lambda x: (x.cast("double") / F.lit(255.0) - F.lit(m)) / F.lit(s))


def gray_image_struct(vec_id: str, pix: Column, width: int, height: int) -> Column:
    """A Spark ``image`` struct (one channel) from an int pixel array."""
    data = F.unhex(F.array_join(F.transform(pix, lambda x: F.lpad(F.hex(x), 2, "0")), ""))
    return F.struct(F.col(vec_id).cast("string").alias("origin"), F.lit(height).alias("height"),
                    F.lit(width).alias("width"), F.lit(1).alias("nChannels"), F.lit(0).alias("mode"),
                    data.alias("data"))
