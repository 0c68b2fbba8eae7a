"""Box geometry and label text as columns. Boxes are half-open: left and top belong to them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iou(a: tuple[Column, ...], b: tuple[Column, ...], epsilon: float = 1e-9) -> Column:
    """Intersection over union of two (x1, y1, x2, y2) boxes."""
    w = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0))
    h = F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0))
    area = lambda x: (x[2] - x[0]) * (x[3] - x[1])
    return w * h / (area(a) + area(b) - w * h + F.lit(epsilon))


def conflicts(a: tuple[Column, ...], b: tuple[Column, ...], pad: int) -> Column:
    """Whether two boxes are less than pad apart on both axes."""
    return ~((a[2] + pad <= b[0]) | (b[2] + pad <= a[0]) | (a[3] + pad <= b[1]) | (b[3] + pad <= a[1]))


def clipped(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """(x, y, w, h) as integer corners inside the image, outward, at least one pixel wide and high."""
    x1 = F.least(F.greatest(F.floor(x), F.lit(0)), width - 1)
    y1 = F.least(F.greatest(F.floor(y), F.lit(0)), height - 1)
    x2 = F.greatest(F.least(F.ceil(x + w), width), x1 + 1)
    y2 = F.greatest(F.least(F.ceil(y + h), height), y1 + 1)
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def six(x: Column) -> Column:
    """Six decimals, ties to even: format_string alone rounds them up."""
    return F.format_string("%.6f", F.bround(x, 6))


def hbb_line(class_id: Column, x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column) -> Column:
    """class, centre and size as fractions of the image."""
    return F.concat_ws(
        " ", class_id.cast("string"), six((x1 + x2) / 2.0 / width), six((y1 + y2) / 2.0 / height), six((x2 - x1) / width), six((y2 - y1) / height)
    )


def linear_size(w: Column, h: Column) -> Column:
    return F.sqrt(w * h)


def four_pixel_bin(v: Column) -> Column:
    """The nearest multiple of 4 (ties to even), 4 at least."""
    return F.greatest(F.lit(4), F.bround(v / 4).cast("int") * 4)
