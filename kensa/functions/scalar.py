"""Column functions (C1-C7, C14-C19).  All are built-in Spark expressions, so
they stay inside whole-stage code generation; none calls Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Run folders carry a stamp 'YYYY-MM-DD_hh:mm:ss'.
RUN_STAMP_PATTERN = r"(\d{4}-\d{2}-\d{2}_\d{2}:\d{2}:\d{2})"


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def run_stamp(path: ColumnOrName) -> Column:
    """The first stamp in a path; '' when there is none (not null)."""
    return F.regexp_extract(_c(path), RUN_STAMP_PATTERN, 1)


def parse_stamp(stamp: ColumnOrName) -> Column:
    """C2: 'YYYY-MM-DD_hh:mm:ss' -> timestamp_ntz; null for '' or impossible dates.

    Built from the fixed-width fields with ``try_make_timestamp_ntz`` so the
    result does not depend on the session time zone and bad values give null
    instead of failing the job under ANSI mode.
    """
    s = _c(stamp)
    ok = s.rlike(r"^\d{4}-\d{2}-\d{2}_\d{2}:\d{2}:\d{2}$")
    part = lambda pos, n: F.substring(s, pos, n).cast("int")
    ts = F.try_make_timestamp_ntz(part(1, 4), part(6, 2), part(9, 2), part(12, 2), part(15, 2),
                                  part(18, 2).cast("decimal(16,6)"))
    return F.when(ok, ts)


def to_day(col: ColumnOrName) -> Column:
    """C3."""
    return F.to_date(_c(col))


def title_case(col: ColumnOrName) -> Column:
    """C4: capitalise the first letter of each space-separated word."""
    return F.initcap(_c(col))


def content_key(col: ColumnOrName) -> Column:
    """SHA-1 hex digest, a content key for duplicate files."""
    return F.sha1(_c(col))


def noise(seed: int, key: ColumnOrName | None = None) -> Column:
    """Uniform [0, 1) per row.  Without a key it depends on the
    partitioning; with one it is drawn from md5 of seed and key and stays the same
    whatever the layout."""
    if key is None:
        return F.rand(seed)
    digest = F.md5(F.concat(F.lit(f"{seed}:"), _c(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def base_name(col: ColumnOrName) -> Column:
    """C14: last '/'-separated segment (query and fragment text included)."""
    return F.element_at(F.split(_c(col), "/"), -1)


def swap_prefix(col: ColumnOrName, old: str, new: str) -> Column:
    """Replace every occurrence of ``old`` by ``new`` (mirror URL)."""
    return F.replace(_c(col), F.lit(old), F.lit(new))


def flag(col: ColumnOrName) -> Column:
    """Text flag -> boolean; only the exact text 'true' is true."""
    return F.coalesce(_c(col) == F.lit("true"), F.lit(False))


def round_ms(col: ColumnOrName) -> Column:
    """C17: round to 3 decimals (half up on the decimal value)."""
    return F.round(_c(col), 3)


def margin_box(width: ColumnOrName, height: ColumnOrName, margin: float = 0.1) -> Column:
    """Crop box keeping a ``margin`` share off each side, truncated to int
    like Python's ``int()`` on a positive float."""
    w, h = _c(width).cast("double"), _c(height).cast("double")
    m, k = F.lit(float(margin)), F.lit(1.0 - float(margin))
    return F.struct((w * m).cast("int").alias("left"), (h * m).cast("int").alias("top"),
                    (w * k).cast("int").alias("right"), (h * k).cast("int").alias("bottom"))


def square_box(width: ColumnOrName, height: ColumnOrName) -> Column:
    """Centred square of side min(w, h); corners rounded half to even,
    as an image library rounds fractional crop corners."""
    w, h = _c(width).cast("double"), _c(height).cast("double")
    s = F.least(w, h)
    r = lambda x: F.bround(x, 0).cast("int")
    return F.struct(r((w - s) / 2).alias("left"), r((h - s) / 2).alias("top"),
                    r((w + s) / 2).alias("right"), r((h + s) / 2).alias("bottom"))
