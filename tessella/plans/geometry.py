"""Boxes of the instances of an image, on boxes derived from lineitem's whole numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions.boxes import clipped, conflicts, four_pixel_bin, hbb_line, iou, linear_size
from tessella.plans.registry import query, table

_BOXES_SQL = """b as (select l_orderkey as image, l_partkey as a, l_suppkey as s, l_linenumber as slot, (l_partkey % 97)::int as x1, (l_suppkey % 89)::int as y1,
  (l_partkey % 97 + 8 + l_quantity)::int as x2, (l_suppkey % 89 + 8 + (l_partkey * 7) % 40)::int as y2 from lineitem)"""


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    return line.select(
        F.col("l_orderkey").alias("image"), F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("s"), F.col("l_linenumber").alias("slot"),
        (F.col("l_partkey") % 97).cast("int").alias("x1"), (F.col("l_suppkey") % 89).cast("int").alias("y1"),
        (F.col("l_partkey") % 97 + 8 + F.col("l_quantity")).cast("int").alias("x2"), (F.col("l_suppkey") % 89 + 8 + F.col("l_partkey") * 7 % 40).cast("int").alias("y2"),
    )


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of boxes of an image (an image holds few): an equi-join with an ordering condition."""
    b = boxes(spark, sf_dir)
    p, q = b.alias("p"), b.alias("q")
    before = F.struct("p.a", "p.s", "p.slot", "p.x1", "p.y1", "p.x2", "p.y2") < F.struct("q.a", "q.s", "q.slot", "q.x1", "q.y1", "q.x2", "q.y2")
    return p.join(q, (F.col("p.image") == F.col("q.image")) & before)


def _corners(t: str):
    return tuple(F.col(f"{t}.{c}") for c in ("x1", "y1", "x2", "y2"))


_PAIRS_SQL = f"""with {_BOXES_SQL}, pq as (select p.*, q.x1 as qx1, q.y1 as qy1, q.x2 as qx2, q.y2 as qy2 from b p join b q on p.image = q.image
  and (p.a, p.s, p.slot, p.x1, p.y1, p.x2, p.y2) < (q.a, q.s, q.slot, q.x1, q.y1, q.x2, q.y2))"""


@query(_PAIRS_SQL + """
select image, count(*) as pairs, count(*) filter (not (x2 + 8 <= qx1 or qx2 + 8 <= x1 or y2 + 8 <= qy1 or qy2 + 8 <= y1)) as conflicts from pq group by image
""")
def box_overlap_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of an image's boxes that are closer than 8 pixels."""
    near = conflicts(_corners("p"), _corners("q"), 8)
    return _pairs(spark, sf_dir).groupBy(F.col("p.image").alias("image")).agg(F.count("*").alias("pairs"), F.count_if(near).alias("conflicts"))


@query(_PAIRS_SQL + """, i as (select *, (greatest(least(x2, qx2) - greatest(x1, qx1), 0) * greatest(least(y2, qy2) - greatest(y1, qy1), 0))::double as w from pq)
select image, round(max(w / ((x2 - x1) * (y2 - y1) + (qx2 - qx1) * (qy2 - qy1) - w + 1e-9)), 6) as best_iou,
       count(*) filter (w / ((x2 - x1) * (y2 - y1) + (qx2 - qx1) * (qy2 - qy1) - w + 1e-9) > 0.5) as links from i group by image
""")
def iou_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = iou(_corners("p"), _corners("q"))
    found = _pairs(spark, sf_dir).select(F.col("p.image").alias("image"), value.alias("v"))
    return found.groupBy("image").agg(F.round(F.max("v"), 6).alias("best_iou"), F.count_if(F.col("v") > 0.5).alias("links"))


@query(f"""
with recursive {_BOXES_SQL}, o as (select *, row_number() over (partition by image order by a, s, slot, x1, y1, x2, y2) as rn from b),
g as (select image, 1::bigint as rn, [[x1, y1, x2, y2]] as kept from o where rn = 1
  union all select o.image, o.rn, case when len(list_filter(g.kept, lambda k: (greatest(least(o.x2, k[3]) - greatest(o.x1, k[1]), 0) * greatest(least(o.y2, k[4]) - greatest(o.y1, k[2]), 0))::double
      / ((o.x2 - o.x1) * (o.y2 - o.y1) + (k[3] - k[1]) * (k[4] - k[2]) - greatest(least(o.x2, k[3]) - greatest(o.x1, k[1]), 0) * greatest(least(o.y2, k[4]) - greatest(o.y1, k[2]), 0) + 1e-9) > 0.2)) = 0
      then list_append(g.kept, [o.x1, o.y1, o.x2, o.y2]) else g.kept end from g join o on o.image = g.image and o.rn = g.rn + 1)
select image, max(rn)::bigint as boxes, max(len(kept))::bigint as kept from g group by image
""")
def iou_greedy_nms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes kept in order unless they overlap a box kept before: a fold over an image's boxes."""
    from tessella.operators.folds import greedy_keep

    return greedy_keep(boxes(spark, sf_dir), "image", ["a", "s", "slot", "x1", "y1", "x2", "y2"], 0.2).select(
        "image", F.size("boxes").cast("long").alias("boxes"), F.size("kept").cast("long").alias("kept")
    )


@query("""
with recursive o as (select l_orderkey as image, l_quantity as v, row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) as rn from lineitem),
g as (select image, rn, case when v <= 60 then v else 0 end as total, case when v <= 60 then 1 else 0 end as n from o where rn = 1
  union all select o.image, o.rn, case when g.total + o.v <= 60 then g.total + o.v else g.total end, case when g.total + o.v <= 60 then g.n + 1 else g.n end from g join o on o.image = g.image and o.rn = g.rn + 1)
select image, max(total) as used, max(n)::int as accepted from g group by image
""")
def budget_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows accepted in order while the budget holds; one that would exceed it is skipped."""
    from tessella.operators.folds import budget

    line = table(spark, sf_dir, "lineitem")
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return budget(line, "l_orderkey", order, "l_quantity", 60.0).select(F.col("l_orderkey").alias("image"), F.col("fold.used").alias("used"), F.col("fold.n").alias("accepted"))


@query("""
with d as (select l_linenumber as c, l_orderkey as image, l_partkey as a, case l_linenumber % 3 when 0 then 600 when 1 then 800 else 1024 end as w, l_partkey % 400 as x, l_quantity::int as q from lineitem)
select image, a, c || ' ' || printf('%.6f', (x + x + q) / 2.0::double / w) || ' ' || printf('%.6f', (x / 2 + x / 2 + q) / 2.0::double / w) || ' ' || printf('%.6f', q::double / w) || ' ' || printf('%.6f', q::double / w) as line from d
""")
def yolo_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    d = line.select(
        F.col("l_linenumber").alias("c"), F.col("l_orderkey").alias("image"), F.col("l_partkey").alias("a"),
        F.when(F.col("l_linenumber") % 3 == 0, 600).when(F.col("l_linenumber") % 3 == 1, 800).otherwise(1024).alias("w"),
        (F.col("l_partkey") % 400).alias("x"), F.col("l_quantity").cast("int").alias("q"),
    )
    x, q, w = F.col("x"), F.col("q"), F.col("w")
    return d.select("image", "a", hbb_line(F.col("c"), x, x / 2, x + q, x / 2 + q, w, w).alias("line"))


@query("""
with d as (select l_orderkey as image, l_partkey as a, l_quantity - 30.5 as x, l_linenumber * 0.25 as y, l_tax * 100 as w, l_discount * 10 as h from lineitem),
c as (select *, least(greatest(floor(x), 0), 15)::bigint as x1, least(greatest(floor(y), 0), 15)::bigint as y1 from d)
select image, a, x1, y1, greatest(least(ceil(round(x + w, 6)), 16), x1 + 1)::bigint as x2, greatest(least(ceil(round(y + h, 6)), 16), y1 + 1)::bigint as y2,
       round(sqrt(w * h), 6) as size, greatest(4, round_even(w / 4, 0)::int * 4) as binned, round_even(x / 8, 0) as cell from c
""")
def clipped_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes clipped outward to a 16-pixel image, their size, 4-pixel bin and 8-pixel cell."""
    d = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("image"), F.col("l_partkey").alias("a"), (F.col("l_quantity") - 30.5).alias("x"), (F.col("l_linenumber") * F.lit(0.25)).alias("y"),
        (F.col("l_tax") * 100).alias("w"), (F.col("l_discount") * 10).alias("h"),
    )
    x, y, w, h, side = F.col("x"), F.col("y"), F.col("w"), F.col("h"), F.lit(16)
    near = lambda v: F.round(v, 6)  # noqa: E731  sums of decimals are whole numbers but for the last bit
    box = clipped(x, y, near(x + w) - x, near(y + h) - y, side, side)
    return d.withColumn("box", box).select(
        "image", "a", "box.x1", "box.y1", "box.x2", "box.y2", F.round(linear_size(w, h), 6).alias("size"), four_pixel_bin(w).alias("binned"), F.bround(x / 8).alias("cell")
    )


@query("""
select page_id, regexp_replace(regexp_replace(url, '[^A-Za-z0-9._-]+', '_', 'g'), '^_+', '') as slug, regexp_extract(url, '([^/]*)$', 1) as name, replace(substr(url, 9), '/', '-') as path_slug,
       sha256(url)[1:20] as key from pages
""")
def path_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_replace(F.regexp_replace(url, "[^A-Za-z0-9._-]+", "_"), "^_+", "").alias("slug"), F.element_at(F.split(url, "/"), -1).alias("name"),
        F.replace(F.substring(url, 9, 1 << 20), F.lit("/"), F.lit("-")).alias("path_slug"), F.substring(F.sha2(url, 256), 1, 20).alias("key"),
    )
