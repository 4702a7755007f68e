"""Boxes [x0, y0, x1, y1] as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sorted_corners(box: Column) -> Column:
    """Corners in order; null unless there are four numbers."""
    ok = box.isNotNull() & (F.size(box) == 4) & F.forall(box, lambda v: v.isNotNull())
    return F.when(ok, F.array(F.least(box[0], box[2]), F.least(box[1], box[3]), F.greatest(box[0], box[2]), F.greatest(box[1], box[3])))


def per_mille(box: Column) -> Column:
    """Whole numbers 0..1000; boxes wholly within 0..1 are scaled. Halves round to even."""
    scale = F.when(F.forall(box, lambda v: (v >= 0) & (v <= 1)), 1000).otherwise(1)
    return F.when(box.isNotNull() & (F.size(box) == 4), F.transform(box, lambda v: F.greatest(F.lit(0), F.least(F.lit(1000), F.rint(v * scale).cast("int")))))


def unit_hint(box: Column) -> Column:
    """A hint clamped to 0..1 at four places."""
    return F.when(box.isNotNull() & (F.size(box) == 4), F.transform(box, lambda v: F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), v)), 4)))


def area(b: Column | list[Column]) -> Column:
    return F.greatest(F.lit(0.0), b[2] - b[0]) * F.greatest(F.lit(0.0), b[3] - b[1])


def common(a: Column | list[Column], b: Column | list[Column]) -> Column:
    """Area of the intersection."""
    return F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0])) * F.greatest(F.lit(0.0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union at four places; missing or empty boxes give 0."""
    cut = common(a, b)
    union = area(a) + area(b) - cut
    return F.when(a.isNull() | b.isNull() | (union <= 0), 0.0).otherwise(F.round(cut / union, 4))


def center_distance(a: Column, b: Column) -> Column:
    """Of the middles; a missing box gives 1."""
    return F.when(a.isNull() | b.isNull(), 1.0).otherwise(F.hypot((a[0] + a[2] - b[0] - b[2]) / 2, (a[1] + a[3] - b[1] - b[3]) / 2))


def horizontal_overlap(a: Column, b: Column) -> Column:
    """Common width over the smaller width."""
    width = lambda x: F.greatest(F.lit(1e-6), x[2] - x[0])
    return F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0])) / F.least(width(a), width(b))


def vertical_gap(a: Column, b: Column) -> Column:
    """Distance of boxes above each other, 0 if they overlap."""
    return F.when(a[3] < b[1], b[1] - a[3]).when(b[3] < a[1], a[1] - b[3]).otherwise(0.0)


def hull(box: Column) -> Column:
    """Aggregate: the box around all boxes."""
    return F.when(F.count(box) > 0, F.array(F.min(box[0]), F.min(box[1]), F.max(box[2]), F.max(box[3])))


def to_pixels(box: Column, width: Column, height: Column, padding: int) -> Column:
    """Pixel box with padding inside the page, at least one pixel each way; boxes with
    values up to 1.5 are shares of the page, others per mille."""
    share = F.forall(box, lambda v: F.abs(v) <= 1.5)
    unit = F.when(share, 1.0).otherwise(1000.0)
    left = F.greatest(F.lit(0), F.floor(box[0] / unit * width).cast("int") - padding)
    top = F.greatest(F.lit(0), F.floor(box[1] / unit * height).cast("int") - padding)
    right = F.least(width, F.ceil(box[2] / unit * width).cast("int") + padding)
    bottom = F.least(height, F.ceil(box[3] / unit * height).cast("int") + padding)
    return F.array(left, top, F.greatest(right, left + 1), F.greatest(bottom, top + 1))
