"""Each host's best spot by a distance between numbers and a draw, without all pairs."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessella.operators.ordering import MAX_RANGES, with_position
from tessella.sources.shared import written

#: More than what rounding moves a sum or a difference by, as a share of its terms.
_SLACK = 1e-12

#: Looks that a Python worker makes at once, about.
_AT_ONCE = 100_000


def least_jittered(hosts: DataFrame, spots: DataFrame, draw: Callable[[Column, Column], Column], scale: float, width: float, limit: float, rows_per_block: int = 32) -> DataFrame:
    """(host, spot, score, options): of the spots of a host's group with score <= limit, the one
    of least score + width * draw, then of least spot, and how many such spots there are.

    hosts (host, group, at), spots (spot, group, at); score is the difference of their at,
    divided by scale; draw(host, spot) is from 0 to 1. There are few groups.

    A group's spots are dealt to blocks of neighbours, MAX_RANGES blocks in all and one a
    group; their bounds are all that the driver and a task hold. A host tries the block that
    is nearest. Its best there bounds the scores that can still win, so further blocks are
    tried only up to that score: in dense groups few draws a host are made, however
    many spots pass. Options are counted by whole blocks; spots are compared only in
    those where the limit falls. Spots at equal distance all have to be drawn for.
    """
    finite = F.col("group").isNotNull() & (F.abs("at") < float("inf"))
    spots = spots.where(finite).select("group", "at", "spot")
    size = max(rows_per_block, -(-spots.count() // MAX_RANGES))
    placed = with_position(spots, ["at", "spot"], within="group").withColumn("block", F.floor(F.col("position") / size))
    blocks = placed.groupBy("group", "block").agg(F.min("at").alias("least"), F.max("at").alias("most"), F.count("*").alias("n"), F.collect_list(F.struct("at", "spot")).alias("spots"))
    blocks = written(blocks, "blocks")
    bounds = _bounds(blocks)
    blocks = blocks.select("group", "block", "spots")

    score = lambda x: F.abs(F.col("at") - x["at"]) / scale

    def best(passes: Callable[[Column], Column]) -> Column:
        key = lambda x: F.struct((score(x) + width * draw(F.col("host"), x["spot"])).alias("j"), x["spot"].alias("spot"), score(x).alias("score"))
        return F.array_min(F.transform(F.filter("spots", passes), key))

    # equal rows of hosts count their options each
    hosts = hosts.where(finite).groupBy("host", "group", "at").agg(F.count("*").alias("copies"))
    kinds = ", ".join(f"`{c}` {kind}" for c, kind in hosts.dtypes)
    looks = hosts.mapInArrow(_looks(bounds, scale * limit), f"{kinds}, block long, near boolean, inside long")
    within = lambda x: score(x) <= limit
    looked = looks.join(blocks, ["group", "block"]).select(
        "host", "group", "at", "copies", F.when(F.col("near"), best(within)).alias("best"),
        F.when(F.col("near"), F.col("inside")).otherwise(F.size(F.filter("spots", within))).alias("options"),
    )
    first = looked.groupBy("host", "group", "at", "copies").agg(F.min("best").alias("best"), F.sum("options").alias("options")).where("options > 0")
    # rounding can hide a spot at the limit from the nearest block
    first = written(first.withColumn("bound", F.coalesce("best.j", F.lit(float(limit)))), "first")

    open_ = first.select("host", "group", "at", "bound")
    kinds = ", ".join(f"`{c}` {kind}" for c, kind in open_.dtypes)
    more = open_.mapInArrow(_further(bounds, scale), f"{kinds}, block long").join(blocks, ["group", "block"])
    more = more.select("host", best(lambda x: (score(x) <= F.col("bound")) & (score(x) <= limit)).alias("best"), F.lit(0).cast("long").alias("options"))
    both = first.select("host", "best", (F.col("options") * F.col("copies")).alias("options")).unionByName(more)
    return both.groupBy("host").agg(F.min("best").alias("b"), F.sum("options").alias("options")).select("host", "b.spot", "b.score", "options")


def _bounds(blocks: DataFrame) -> dict:
    """For each group its blocks' least and most, what lies halfway between neighbours, and
    how many spots are before each block."""
    found: dict = {}
    for r in sorted(blocks.select("group", "block", "least", "most", "n").collect(), key=lambda r: r.block):
        found.setdefault(r.group, []).append((r.least, r.most, r.n))
    bounds = {}
    for group, rows in found.items():
        least, most, n = (np.array(c) for c in zip(*rows))
        bounds[group] = least, most, most[:-1] / 2 + least[1:] / 2, np.concatenate([[0], np.cumsum(n)])
    return bounds


def _of_groups(batch, bounds: dict):
    """(places in the batch, their at, the group's bounds) of each group that has spots."""
    at, places = batch.column("at").to_numpy(zero_copy_only=False).astype(np.float64), {}
    for i, group in enumerate(batch.column("group").to_pylist()):
        places.setdefault(group, []).append(i)
    for group, own in places.items():
        if group in bounds:
            own = np.array(own)
            yield own, at[own], bounds[group]


def _spans(places: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each place with each number from its start up to its end."""
    n = np.maximum(end - start, 0)
    return np.repeat(places, n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - start, n)


def _pieces(n: np.ndarray) -> list[np.ndarray]:
    """Runs of places whose n add up to about _AT_ONCE."""
    return np.split(np.arange(len(n)), np.flatnonzero(np.diff(np.cumsum(n) // _AT_ONCE)) + 1)


def _with(batch, places: np.ndarray, **columns):
    import pyarrow as pa

    taken = batch.take(pa.array(places))
    return pa.record_batch([*taken.columns, *map(pa.array, columns.values())], [*batch.schema.names, *columns])


def _looks(bounds: dict, reach: float):
    """Rows of hosts with each block to look into: the nearest one, with the number of spots
    in blocks that are within reach as a whole, and those where the reach ends."""

    def look(batches):
        for batch in batches:
            for own, at, (least, most, half, before) in _of_groups(batch, bounds):
                slack = (np.abs(at) + reach) * _SLACK
                # blocks before `some` and from `none` on are out of reach, those from `all_` up to `last` within
                some, all_ = np.searchsorted(most, at - reach - slack, "left"), np.searchsorted(least, at - reach + slack, "left")
                last, none = np.searchsorted(most, at + reach - slack, "right"), np.searchsorted(least, at + reach + slack, "right")
                last = np.maximum(all_, last)
                inside = before[last] - before[all_]
                near = np.searchsorted(half, at)
                for p in _pieces(1 + all_ - some + none - last):
                    (a, low), (b, high) = _spans(own[p], some[p], all_[p]), _spans(own[p], last[p], none[p])
                    ends = len(a) + len(b)
                    yield _with(
                        batch, np.concatenate([own[p], a, b]), block=np.concatenate([near[p], low, high]),
                        near=np.repeat([True, False], [len(p), ends]), inside=np.concatenate([inside[p], np.zeros(ends, np.int64)]),
                    )

    return look


def _further(bounds: dict, scale: float):
    """Rows of hosts with each block besides the nearest that has scores up to bound."""

    def look(batches):
        for batch in batches:
            bound = batch.column("bound").to_numpy()
            for own, at, (least, most, half, _) in _of_groups(batch, bounds):
                reach = bound[own] * scale
                reach += (np.abs(at) + reach) * _SLACK
                near = np.searchsorted(half, at)
                start, end = np.searchsorted(most, at - reach, "left"), np.searchsorted(least, at + reach, "right")
                for p in _pieces(end - start):
                    (a, low), (b, high) = _spans(own[p], start[p], np.minimum(near, end)[p]), _spans(own[p], np.maximum(near + 1, start)[p], end[p])
                    yield _with(batch, np.concatenate([a, b]), block=np.concatenate([low, high]))

    return look
