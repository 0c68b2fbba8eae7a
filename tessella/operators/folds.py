"""Order-dependent operators as folds over the rows of one group.

A group is an image or a scene and holds few rows; groups are spread over tasks and the
fold itself stays in the JVM (array_sort of a collected list, then aggregate).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.functions.boxes import iou


def budget(df: DataFrame, group: str, order: list[str], value: str, limit: float) -> DataFrame:
    """(group, fold struct<used, n>): rows in order, each accepted if its value still fits.

    A row that would exceed the limit is skipped and later ones may fit, so a running sum
    would be wrong. A null value is never accepted.
    """
    rows = df.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("_value")))).alias("rows"))
    start = F.struct(F.lit(0.0).alias("used"), F.lit(0).alias("n"))

    def step(a, r):
        fits = F.coalesce(a["used"] + r["_value"] <= limit, F.lit(False))
        return F.struct(F.when(fits, a["used"] + r["_value"]).otherwise(a["used"]).alias("used"), (a["n"] + fits.cast("int")).alias("n"))

    return rows.select(group, F.aggregate("rows", start, step).alias("fold"))


def greedy_keep(df: DataFrame, group: str, order: list[str], threshold: float) -> DataFrame:
    """(group, boxes, kept): boxes (x1, y1, x2, y2) in order, kept unless one that was kept
    before overlaps by more than threshold (intersection over union)."""
    rows = df.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(*order))).alias("boxes"))
    corners = lambda r: (r["x1"], r["y1"], r["x2"], r["y2"])
    none = F.slice("boxes", 1, 0)

    def step(kept, r):
        clash = F.exists(kept, lambda k: iou(corners(r), corners(k)) > threshold)
        return F.when(clash, kept).otherwise(F.array_append(kept, r))

    return rows.select(group, "boxes", F.aggregate("boxes", none, step).alias("kept"))


def least_used_rotation(df: DataFrame, group: str, subset: str, source: str, base: str, order: str, limit: int) -> DataFrame:
    """(group, place, order): up to limit rows of each group, its buckets (subset, source) in
    turn; of a bucket the row whose (source, base) was taken least so far, the one of
    smallest `order` among those.

    Each choice depends on those before, in other buckets too, so a group is one fold. It
    needs at most 3 * limit rows of a bucket: before a choice fewer than limit were made, so
    the row chosen is among the first so many by (turn among its base's rows, order).
    """
    of_base = Window.partitionBy(group, subset, source, base).orderBy(order)
    in_bucket = Window.partitionBy(group, subset, source).orderBy("_turn", order)
    ranked = df.select(group, subset, source, base, order).withColumn("_turn", F.row_number().over(of_base)).where(F.col("_turn") <= limit)
    few = ranked.withColumn("_rank", F.row_number().over(in_bucket)).where(F.col("_rank") <= 3 * limit)
    kinds = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in (group, order))

    def choose(key, rows):
        from collections import Counter

        import pandas as pd

        buckets = {k: list(zip(b[base], b[order])) for k, b in rows.sort_values(order).groupby([subset, source])}
        used, chosen = Counter(), []
        while len(chosen) < limit and any(buckets.values()):
            for k in sorted(b for b in buckets if buckets[b]):
                if len(chosen) == limit:
                    break
                pick = min(buckets[k], key=lambda x: (used[k[1], x[0]], x[1]))
                buckets[k].remove(pick)
                used[k[1], pick[0]] += 1
                chosen.append(pick[1])
        return pd.DataFrame({group: [key[0]] * len(chosen), order: chosen, "place": range(1, len(chosen) + 1)})

    return few.groupBy(group).applyInPandas(choose, f"{kinds}, place int").select(group, "place", order)
