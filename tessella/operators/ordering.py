"""Global positions, and exact quantiles by them, without a global sort in one task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessella.sources.shared import written

#: Bounds what the driver and a broadcast hold, whatever the size of the table.
MAX_RANGES = 20_000


def with_position(df: DataFrame, keys: list[str], rows_per_range: int = 50_000, within: str | None = None) -> DataFrame:
    """df with `position`, the rows' places (from 0) in the order of keys, within each value
    of a column if one is named.

    The first key is a number that isn't null. keys must tell rows apart, except for rows
    that are equal in all columns. Rows are dealt to ranges of the first key at quantiles,
    MAX_RANGES at most; each range is numbered by itself (sorted, and spilled if it must
    be) and starts where the ranges before it end. Only numbers of rows a range are summed
    over ranges. A first key that repeats more than a range holds makes that range longer.
    """
    first = keys[0]
    df = written(df, "positions")
    n = df.count()
    ranges = min(MAX_RANGES, max(1, -(-n // rows_per_range)))
    cuts = df.agg(F.percentile_approx(first, [k / ranges for k in range(1, ranges)], min(50 * ranges, 1_000_000))).first()[0] if ranges > 1 else []
    cuts = np.unique(np.array(cuts or [], np.float64))

    @F.pandas_udf("int")
    def range_of(values):
        import pandas as pd

        return pd.Series(np.searchsorted(cuts, values.to_numpy(np.float64), "left").astype(np.int32))

    dealt = df.withColumn("_range", range_of(first))
    group = [within] if within else []
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # at most one row for each range (and group)
    starts = dealt.groupBy(*group, "_range").agg(F.count("*").alias("_n")).select(*group, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy(*group, "_range").orderBy(*keys)) - 1
    joined = dealt.withColumn("_in", inside).join(starts if within else F.broadcast(starts), [*group, "_range"])
    return joined.withColumn("position", F.col("_start") + F.col("_in")).select(*df.columns, "position")


def exact_quantiles(df: DataFrame, group: str, value: str, shares: list[float], rows_per_range: int = 50_000) -> DataFrame:
    """(group, n, q array): exact quantiles of each group's values, interpolated linearly
    between the two neighbours; nulls don't count.

    Values are ranked in ranges, and only the neighbours of each quantile are looked up, so
    no task holds a group's values.
    """
    placed = with_position(df.where(F.col(value).isNotNull()).select(group, value), [value], rows_per_range, group)
    placed = written(placed, "ranks")
    sizes = placed.groupBy(group).agg(F.count("*").alias("n"))
    at = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), (F.lit(float(p)) * (F.col("n") - 1)).alias("at")) for i, p in enumerate(shares))))
    wanted = sizes.withColumn("w", at).select(group, "n", "w.i", "w.at", F.explode(F.array_distinct(F.array(F.floor("w.at"), F.ceil("w.at")))).alias("position"))
    found = placed.join(wanted, [group, "position"])
    part = F.col("at") - F.floor("at")
    q = found.groupBy(group, "n", "i").agg((F.min(value) + (F.max(value) - F.min(value)) * F.first(part)).alias("v"))
    return q.groupBy(group, "n").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]).alias("q"))
