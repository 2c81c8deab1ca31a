"""Predicates and projections on rectangles, as columns. Coordinates are longs, not negative."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.settings import SETTINGS


def _c(x: Column | str | float) -> Column:
    return F.col(x) if isinstance(x, str) else x if isinstance(x, Column) else F.lit(x)


def aspect(w, h) -> Column:
    """Width by height, 0 for no height."""
    return F.when(_c(h) > 0, _c(w).cast("double") / _c(h)).otherwise(F.lit(0.0))


def is_contour_block(w, h, page_w, page_h) -> Column:
    """A contour that may be a block. The bound is the larger of the fixed and the relative one."""
    w, h = _c(w), _c(h)
    tall = F.greatest(F.lit(500.0), _c(page_h) * F.lit(0.4))
    wide = F.greatest(F.lit(800.0), _c(page_w) * F.lit(0.8))
    ratio = aspect(w, h)
    return (h > 100) & (h < tall) & (w > 200) & (w < wide) & (ratio > 1.2) & (ratio < 6.0) & (w * h > 30000)


def is_grid_block(w, h, page_w, page_h) -> Column:
    """A grid cell that may be a block."""
    w, h = _c(w), _c(h)
    ratio = aspect(w, h)
    return (h > 100) & (h < _c(page_h) * F.lit(0.35)) & (w > 200) & (w < _c(page_w) * F.lit(0.7)) & (ratio > 1.5) & (ratio < 5.0)


def is_strict_block(w, h) -> Column:
    w, h = _c(w), _c(h)
    return (h > 150) & (h < 400) & (w > 300) & (w < 600) & (w * h > 50000)


def is_cell(w, h) -> Column:
    """Large enough to be kept, and counted, as a cell."""
    return (_c(h) >= 80) & (_c(w) >= 150)


def is_inner_box(w, h, vertices, image_w, image_h) -> Column:
    """A rectangle within a card, of at most nine tenths of it."""
    w, h = _c(w), _c(h)
    return (w >= 20) & (h >= 20) & (w * h <= _c(image_w) * _c(image_h) * F.lit(0.9)) & (_c(vertices) == 4)


def is_outer_border(w, h, vertices, image_w, image_h) -> Column:
    return (_c(w) * _c(h) > _c(image_w) * _c(image_h) * F.lit(0.85)) & (_c(vertices) == 4)


def is_line(set_pixels, length) -> Column:
    """A row or column is a line when the sum of its 0/255 pixels exceeds 0.4 of its length."""
    return _c(set_pixels) * 255 > _c(length) * F.lit(0.4)


def _corners(x1, y1, x2, y2) -> Column:
    return F.struct(x1.cast("long").alias("x1"), y1.cast("long").alias("y1"), x2.cast("long").alias("x2"), y2.cast("long").alias("y2"))


def corners(x, y, w, h) -> Column:
    x, y = _c(x), _c(y)
    return _corners(x, y, x + _c(w), y + _c(h))


def padded(x, y, w, h, page_w, page_h, pad: int = SETTINGS.block_padding) -> Column:
    """Corners of a block with its padding, within the page."""
    x, y, zero = _c(x), _c(y), F.lit(0)
    return _corners(F.greatest(zero, x - pad), F.greatest(zero, y - pad), F.least(_c(page_w), x + _c(w) + pad), F.least(_c(page_h), y + _c(h) + pad))


def page_box(x, y, w, h, page_w, page_h, pad: int = SETTINGS.page_padding) -> Column:
    """Content of a page: near the left or upper edge the far side still gains the padding of both."""
    left, top = F.greatest(F.lit(0), _c(x) - pad), F.greatest(F.lit(0), _c(y) - pad)
    wide, high = F.least(_c(page_w) - left, _c(w) + 2 * pad), F.least(_c(page_h) - top, _c(h) + 2 * pad)
    return F.struct(left.cast("long").alias("x"), top.cast("long").alias("y"), wide.cast("long").alias("w"), high.cast("long").alias("h"))


def clamped(x, y, w, h, page_w, page_h) -> Column:
    """Corners of a crop, each within the page."""
    within = lambda v, most: F.greatest(F.lit(0), F.least(v, _c(most)))
    x, y = _c(x), _c(y)
    return _corners(within(x, page_w), within(y, page_h), within(x + _c(w), page_w), within(y + _c(h), page_h))


def inside_border(x, y, w, h, image_w, image_h, inset: int = SETTINGS.border_inset) -> Column:
    """Corners of what lies within a border; the whole image where nothing would."""
    x, y = _c(x), _c(y)
    x1, y1 = F.greatest(F.lit(0), x + inset), F.greatest(F.lit(0), y + inset)
    x2, y2 = F.least(_c(image_w), x + _c(w) - inset), F.least(_c(image_h), y + _c(h) - inset)
    zero = F.lit(0)
    return F.when((x2 <= x1) | (y2 <= y1), _corners(zero, zero, _c(image_w), _c(image_h))).otherwise(_corners(x1, y1, x2, y2))


def fill_box(x1, y1, x2, y2, image_w, image_h, pad: int = SETTINGS.fill_padding) -> Column:
    """What is painted over a box: its corners moved outwards, within the image."""
    zero = F.lit(0)
    return _corners(F.greatest(zero, _c(x1) - pad), F.greatest(zero, _c(y1) - pad), F.least(_c(image_w), _c(x2) + pad), F.least(_c(image_h), _c(y2) + pad))


def split_at(width) -> Column:
    """Where an image is split into a left and a right part."""
    return F.floor(_c(width) * F.lit(0.6)).cast("long")
