import os
import struct
import sys
import zlib

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kensa.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8)
    yield s


def png_bytes(width: int, height: int, channels: int, pixels: list[int]) -> bytes:
    """A PNG written with zlib + struct: 1 = gray, 3 = RGB, 4 = RGBA."""
    color = {1: 0, 3: 2, 4: 6}[channels]
    stride = width * channels
    raw = b"".join(b"\x00" + bytes(pixels[r * stride:(r + 1) * stride]) for r in range(height))

    def chunk(tag, body):
        return struct.pack(">I", len(body)) + tag + body + struct.pack(">I", zlib.crc32(tag + body) & 0xFFFFFFFF)

    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, color, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def pattern(width, height, channels, seed=0):
    return [(seed + i * 37) % 256 for i in range(width * height * channels)]


@pytest.fixture
def image_tree(tmp_path):
    """F-IMG: RGB 3x2, RGBA 2x2, gray 2x2, 6x5, 8x5, 300x200 and a broken jpg."""
    root = tmp_path / "images"
    (root / "Normal").mkdir(parents=True)
    (root / "Anomaly").mkdir(parents=True)
    files = {
        "Normal/rgb_3x2.png": (3, 2, 3), "Normal/rgba_2x2.png": (2, 2, 4),
        "Normal/gray_2x2.png": (2, 2, 1), "Anomaly/rgb_6x5.png": (6, 5, 3),
        "Anomaly/rgb_8x5.png": (8, 5, 3), "Anomaly/rgb_300x200.png": (300, 200, 3),
    }
    for name, (w, h, c) in files.items():
        (root / name).write_bytes(png_bytes(w, h, c, pattern(w, h, c, seed=w + h)))
    (root / "Anomaly" / "broken.jpg").write_bytes(b"not an image at all")
    (root / "Normal" / "notes.txt").write_text("ignored")
    return root, files
