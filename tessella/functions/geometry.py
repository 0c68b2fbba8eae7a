"""Arithmetic of boxes, crops and masks as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def around(lon: Column, lat: Column, dx: float, dy: float) -> Column:
    """The box around a point: struct(west, south, east, north)."""
    return F.struct((lon - dx).alias("west"), (lat - dy).alias("south"), (lon + dx).alias("east"), (lat + dy).alias("north"))


def truncated(x: Column, y: Column, w: Column, h: Column) -> Column:
    """(x, y, w, h) as corners whose fractions are cut off, towards zero."""
    cut = lambda c: c.cast("int")
    return F.struct(cut(x).alias("x1"), cut(y).alias("y1"), cut(x + w).alias("x2"), cut(y + h).alias("y2"))


def float_clipped(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """(x, y, w, h) as corners clipped to the image, fractions kept; null if nothing is left."""
    inside = lambda c, most: F.greatest(F.least(c, most), F.lit(0.0))
    x1, y1, x2, y2 = inside(x, width), inside(y, height), inside(x + w, width), inside(y + h, height)
    return F.when((x2 > x1) & (y2 > y1), F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2")))


def target_ratio(local: Column, p10: Column, p50: Column, p90: Column, u: Column) -> Column:
    """The share of the image that a pasted object should take: the geometric mean of what is
    around and the prior's median, varied by u, within the prior's outer deciles."""
    return F.least(F.greatest(F.sqrt(local * p50) * u, p10), p90)


def paste_scale(ratio: Column, width: Column, height: Column, area: Column) -> Column:
    """The factor by which a cut-out of that area grows to its share of the image."""
    return F.sqrt(ratio * width * height / F.greatest(area, F.lit(1)))


def wide_enough(width: Column, height: Column, prompt_width: Column, prompt_height: Column, share: float = 0.55) -> Column:
    """Whether a candidate reaches the share of its prompt box on both axes."""
    return (width >= share * prompt_width) & (height >= share * prompt_height)


def crop_and_prompt(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column, context: float) -> Column:
    """struct(crop, prompt): the square crop around a box, moved inward at the image's edges,
    and the box with a margin in the crop's coordinates.

    The box is clipped to the image and at least 2 pixels wide and high; the crop's side is
    its longer side times context. Margins are 5 % of the width and 8 % of the height.
    """
    inside = lambda c, most: F.greatest(F.least(c, most), F.lit(0.0))
    half_even = lambda c: F.bround(c).cast("int")
    x1, x2, y1, y2 = inside(x1, width), inside(x2, width), inside(y1, height), inside(y2, height)
    bw, bh = F.greatest(F.lit(2.0), x2 - x1), F.greatest(F.lit(2.0), y2 - y1)
    side = F.greatest(bw, bh) * context
    desired = F.greatest(F.lit(2), half_even(side))

    def edges(centre, most):
        low = F.greatest(F.lit(0), half_even(centre - side / 2))
        high = F.least(most.cast("int"), half_even(centre + side / 2))
        short = high - low < desired
        # a crop that starts at 0 grows to the right, one that ends at the edge to the left
        moved_high = F.when(short & (low == 0), F.least(most.cast("int"), desired)).otherwise(high)
        moved_low = F.when(short & (low != 0) & (high == most), F.greatest(F.lit(0), most.cast("int") - desired)).otherwise(low)
        return moved_low, moved_high

    left, right = edges((x1 + x2) / 2, width)
    top, bottom = edges((y1 + y2) / 2, height)
    mx, my = bw * 0.05, bh * 0.08
    zero = F.lit(0.0)
    prompt = F.struct(
        F.greatest(zero, x1 - left - mx).alias("x1"), F.greatest(zero, y1 - top - my).alias("y1"),
        F.least((right - left).cast("double"), x2 - left + mx).alias("x2"), F.least((bottom - top).cast("double"), y2 - top + my).alias("y2"),
    )
    return F.struct(F.struct(left.alias("left"), top.alias("top"), right.alias("right"), bottom.alias("bottom")).alias("crop"), prompt.alias("prompt"))


def centre_distance(cx: Column, cy: Column) -> Column:
    """Distance of a normalised centre from the image's."""
    return F.sqrt((cx - 0.5) * (cx - 0.5) + (cy - 0.5) * (cy - 0.5))


def centrality_score(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column, predicted: Column, stability: Column) -> Column:
    """Confidence weighted by how central a box is: 1 at the centre, 0 from half a side away."""
    dx, dy = (x + w / 2 - width / 2) / width, (y + h / 2 - height / 2) / height
    return (predicted + stability) * F.greatest(F.lit(0.0), 1 - 2 * F.sqrt(dx * dx + dy * dy))


def scene_key(dataset: Column, path: Column) -> Column:
    """The scene that a file shows: DOTA tiles lose _dddd, xView tiles their last four parts."""
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")
    parts = F.split(stem, "_")
    xview = F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 4, F.lit(0))), "_")
    return F.when(dataset == "DOTAv2", F.regexp_replace(stem, r"_\d{4}$", "")).when(dataset == "xView", xview).otherwise(stem)
