"""Gates, crops, placements and scene keys computed from boxes and mask metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions import geometry
from tessella.functions.boxes import conflicts
from tessella.functions.gates import reasons
from tessella.plans.registry import query, table
from tessella.sources.sinks import with_yaml_root

#: Thresholds of the mask gate, which its reasons name.
MASK_GATE = {"sam_score": 0.85, "dominant_component": 0.93, "secondary_components": 0.07, "mask_area": 0.45, "bbox_fill": 0.2}
_METRICS_SQL = "select l_orderkey, l_partkey, p_type as class_name, 0.8 + l_tax * 2 as sam_score, 1 - l_discount as dominant_component, l_discount as secondary_components, l_quantity / 100 as mask_area, (l_partkey % 50) / 50.0::double as bbox_fill from lineitem join part on p_partkey = l_partkey"
_LESS = ("sam_score", "dominant_component", "bbox_fill")


def mask_reasons(gate: dict[str, float] = MASK_GATE) -> Column:
    """All rules of the mask gate that a row's metrics break, in order, with their thresholds;
    a missing metric breaks its rule. A value equal to the threshold passes."""
    rules = []
    for name, limit in gate.items():
        sign, breaks = ("<", F.col(name) < limit) if name in _LESS else (">", F.col(name) > limit)
        rules.append((f"{name}{sign}{limit:.2f}", F.coalesce(breaks, F.lit(True))))
    return reasons(*rules)


_REASONS_SQL = "list_filter([" + ", ".join(f"case when {n} {'<' if n in _LESS else '>'} {v} then '{n}{'<' if n in _LESS else '>'}{v:.2f}' end" for n, v in MASK_GATE.items()) + "], lambda x: x is not null)"


@query(f"with m as ({_METRICS_SQL}) select class_name, array_to_string({_REASONS_SQL}, '+') as reasons, count(*) as masks from m group by all")
def mask_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five rules on a mask's metrics; all broken ones with the thresholds, by class."""
    line = table(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "p_partkey").join(table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("class_name")), "p_partkey")
    m = line.select(
        "class_name", (F.lit(0.8) + F.col("l_tax") * 2).alias("sam_score"), (1 - F.col("l_discount")).alias("dominant_component"), F.col("l_discount").alias("secondary_components"),
        (F.col("l_quantity") / 100).alias("mask_area"), (F.col("p_partkey") % 50 / 50).alias("bbox_fill"),
    )
    return m.groupBy("class_name", F.array_join(mask_reasons(), "+").alias("reasons")).agg(F.count("*").alias("masks"))


@query("""
with m as (select l_orderkey as image, l_linenumber as n, l_partkey as a, (l_partkey % 500)::double as x, (l_suppkey * 7 % 400)::double as y, (10 + l_quantity * 4) as w, (8 + l_partkey % 90)::double as h, 1 - l_discount as predicted, 1 - l_tax as stability from lineitem),
s as (select *, (predicted + stability) * greatest(0.0::double, 1 - 2 * sqrt(((x + w / 2 - 320) / 640) * ((x + w / 2 - 320) / 640) + ((y + h / 2 - 240) / 480) * ((y + h / 2 - 240) / 480))) as score from m where w * h / (640 * 480) between 0.01 and 0.7)
select image, arg_max(a, (round(score, 9), -n, -a)) as crop, round(max(score), 9) as score, count(*) as candidates from s group by image
""")
def central_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most central confident candidate of each image, among those of a plausible area."""
    line = table(spark, sf_dir, "lineitem")
    m = line.select(
        F.col("l_orderkey").alias("image"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("a"), (F.col("l_partkey") % 500).cast("double").alias("x"), (F.col("l_suppkey") * 7 % 400).cast("double").alias("y"),
        (10 + F.col("l_quantity") * 4).alias("w"), (8 + F.col("l_partkey") % 90).cast("double").alias("h"), (1 - F.col("l_discount")).alias("predicted"), (1 - F.col("l_tax")).alias("stability"),
    ).where("w * h / (640 * 480) between 0.01 and 0.7")
    score = geometry.centrality_score(F.col("x"), F.col("y"), F.col("w"), F.col("h"), F.lit(640.0), F.lit(480.0), F.col("predicted"), F.col("stability"))
    m = m.withColumn("score", score)
    return m.groupBy("image").agg(F.max_by("a", F.struct(F.round("score", 9), -F.col("n"), -F.col("a"))).alias("crop"), F.round(F.max("score"), 9).alias("score"), F.count("*").alias("candidates"))


@query("""
with c as (select l_orderkey, l_partkey, l_linenumber, l_quantity, l_discount > 0.02 as plausible, l_tax as score from lineitem)
select l_orderkey as image, coalesce(arg_max(l_partkey, (score, -l_linenumber, -l_partkey)) filter (plausible), arg_max(l_partkey, (score, -l_linenumber, -l_partkey))) as crop, count(*) filter (plausible) = 0 as fallback from c group by 1
""")
def conservative_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best-scored plausible candidate, else the best-scored of all."""
    key = F.struct("l_tax", -F.col("l_linenumber"), -F.col("l_partkey"))
    plausible = F.col("l_discount") > 0.02
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("image")).agg(
        F.coalesce(F.max_by(F.when(plausible, F.col("l_partkey")), F.when(plausible, key)), F.max_by("l_partkey", key)).alias("crop"), (F.count_if(plausible) == 0).alias("fallback")
    )


_CROP_SQL = """with b as (select p_partkey as id, (p_partkey * 37 % 700 - 20)::double as x1, (p_partkey * 53 % 500 - 10)::double as y1, (p_partkey * 37 % 700 - 20 + 4 + p_size * 3)::double as x2, (p_partkey * 53 % 500 - 10 + 2 + p_partkey % 60)::double as y2 from part),
c as (select id, least(greatest(x1, 0), 640) as x1, least(greatest(x2, 0), 640) as x2, least(greatest(y1, 0), 480) as y1, least(greatest(y2, 0), 480) as y2 from b),
d as (select *, greatest(2.0::double, x2 - x1) as bw, greatest(2.0::double, y2 - y1) as bh, (x1 + x2) / 2 as cx, (y1 + y2) / 2 as cy, greatest(2.0::double, x2 - x1, y2 - y1) * 1.6 as side from c),
e as (select *, greatest(0, round_even(cx - side / 2, 0)::int) as l0, least(640, round_even(cx + side / 2, 0)::int) as r0, greatest(0, round_even(cy - side / 2, 0)::int) as t0, least(480, round_even(cy + side / 2, 0)::int) as b0, greatest(2, round_even(side, 0)::int) as want from d),
f as (select *, case when r0 - l0 < want and l0 = 0 then least(640, want) else r0 end as r, case when r0 - l0 < want and l0 <> 0 and r0 = 640 then greatest(0, 640 - want) else l0 end as l,
  case when b0 - t0 < want and t0 = 0 then least(480, want) else b0 end as b, case when b0 - t0 < want and t0 <> 0 and b0 = 480 then greatest(0, 480 - want) else t0 end as t from e)"""


@query(_CROP_SQL + """ select id, l, t, r, b, round(greatest(0.0, x1 - l - bw * 0.05), 6) as px1, round(greatest(0.0, y1 - t - bh * 0.08), 6) as py1, round(least((r - l)::double, x2 - l + bw * 0.05), 6) as px2, round(least((b - t)::double, y2 - t + bh * 0.08), 6) as py2 from f""")
def crop_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The square crop around each box, moved inward at the edges, and the prompt box in it."""
    p = F.col("p_partkey")
    x1, y1 = (p * 37 % 700 - 20).cast("double"), (p * 53 % 500 - 10).cast("double")
    made = geometry.crop_and_prompt(x1, y1, x1 + 4 + F.col("p_size") * 3, y1 + 2 + p % 60, F.lit(640.0), F.lit(480.0), 1.6)
    rows = table(spark, sf_dir, "part").select(p.alias("id"), made.alias("m"))
    return rows.select(
        "id", F.col("m.crop.left").alias("l"), F.col("m.crop.top").alias("t"), F.col("m.crop.right").alias("r"), F.col("m.crop.bottom").alias("b"),
        F.round("m.prompt.x1", 6).alias("px1"), F.round("m.prompt.y1", 6).alias("py1"), F.round("m.prompt.x2", 6).alias("px2"), F.round("m.prompt.y2", 6).alias("py2"),
    )


@query("""
with b as (select l_orderkey as image, l_partkey as a, l_linenumber as n, l_quantity - 30.5 as x, l_linenumber * 0.25 as y, l_tax * 100 as w, l_discount * 100 as h from lineitem),
f as (select *, least(greatest(x, 0.0), 16.0) as fx1, least(greatest(y, 0.0), 16.0) as fy1, least(greatest(x + w, 0.0), 16.0) as fx2, least(greatest(y + h, 0.0), 16.0) as fy2 from b)
select n, count(*) as boxes, sum(trunc(x))::bigint as left_, sum(trunc(round(x + w, 9)))::bigint as right_, count(*) filter (fx2 > fx1 and fy2 > fy1) as visible, round(sum(case when fx2 > fx1 and fy2 > fy1 then (fx2 - fx1) * (fy2 - fy1) else 0 end), 4) as area from f group by n
""")
def corner_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two of the three ways from a box's origin and size to corners: cut-off fractions, and
    fractions kept but clipped with empty boxes dropped (the third: clipped_boxes)."""
    line = table(spark, sf_dir, "lineitem")
    x, y, w, h = F.col("l_quantity") - 30.5, F.col("l_linenumber") * F.lit(0.25), F.col("l_tax") * 100, F.col("l_discount") * 100
    cut = geometry.truncated(x, y, F.round(x + w, 9) - x, h)
    kept = geometry.float_clipped(x, y, w, h, F.lit(16.0), F.lit(16.0))
    rows = line.select(F.col("l_linenumber").alias("n"), cut.alias("c"), F.round(x + w, 9).cast("int").alias("right"), kept.alias("k"))
    area = (F.col("k.x2") - F.col("k.x1")) * (F.col("k.y2") - F.col("k.y1"))
    return rows.groupBy("n").agg(
        F.count("*").alias("boxes"), F.sum("c.x1").alias("left_"), F.sum("right").alias("right_"), F.count("k").alias("visible"), F.round(F.sum(F.coalesce(area, F.lit(0.0))), 4).alias("area")
    )


@query("""
with q as (select p_brand as class_name, quantile_cont(p_retailprice, [0.1, 0.5, 0.9]) as q from part group by 1),
r as (select p_partkey, p_size, p_brand, least(greatest(sqrt((900 + p_size * 10) * q[2]) * (0.85 + 0.3 * ((p_partkey % 10) / 10.0::double)), q[1]), q[3]) / 10000 as ratio from part join q on class_name = p_brand)
select p_partkey as id, round(ratio, 9) as ratio, round(sqrt(ratio * 640 * 480 / greatest(p_size * p_size, 1)), 9) as scale, (p_size >= 0.55 * 40 and p_size * 2 >= 0.55 * 60) as wide_enough from r
""")
def paste_scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of an image that a cut-out should take, and the scale that gives it."""
    part = table(spark, sf_dir, "part")
    q = part.groupBy("p_brand").agg(F.percentile("p_retailprice", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))).alias("q"))
    at = lambda i: F.get("q", F.lit(i))
    u = F.lit(0.85) + F.lit(0.3) * (F.col("p_partkey") % 10 / 10)
    r = part.join(F.broadcast(q), "p_brand").withColumn("ratio", geometry.target_ratio(F.lit(900.0) + F.col("p_size") * 10, at(0), at(1), at(2), u) / 10000)
    size = F.col("p_size")
    scale = geometry.paste_scale(F.col("ratio"), F.lit(640.0), F.lit(480.0), size * size)
    return r.select(F.col("p_partkey").alias("id"), F.round("ratio", 9).alias("ratio"), F.round(scale, 9).alias("scale"), geometry.wide_enough(size, size * 2, F.lit(40), F.lit(60)).alias("wide_enough"))


@query("""
with m as (select l_orderkey as image, l_linenumber as mask, (l_partkey % 32)::int as x, (l_suppkey * 13 % 24)::int as y from lineitem), p as (select distinct * from m),
g as (select image, mask, avg(x) / 32 as cx, avg(y) / 24 as cy, sum((x = 0)::int + (x = 31)::int + (y = 0)::int + (y = 23)::int) as border, count(*) as pixels from p group by all)
select image, mask, round(sqrt((cx - 0.5) * (cx - 0.5) + (cy - 0.5) * (cy - 0.5)), 6) as distance, round(border / pixels, 6) as border_ratio, round(pixels / (32 * 24), 6) as area_ratio from g
""")
def mask_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area, border contact (a corner counts for both its edges) and centre distance of masks."""
    p = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("image"), F.col("l_linenumber").alias("mask"), (F.col("l_partkey") % 32).alias("x"), (F.col("l_suppkey") * 13 % 24).alias("y")).distinct()
    edge = sum(((F.col(c) == v).cast("int") for c, v in (("x", 0), ("x", 31), ("y", 0), ("y", 23))), F.lit(0))
    g = p.groupBy("image", "mask").agg((F.avg("x") / 32).alias("cx"), (F.avg("y") / 24).alias("cy"), F.sum(edge).alias("border"), F.count("*").alias("pixels"))
    return g.select(
        "image", "mask", F.round(geometry.centre_distance(F.col("cx"), F.col("cy")), 6).alias("distance"), F.round(F.col("border") / F.col("pixels"), 6).alias("border_ratio"), F.round(F.col("pixels") / (32 * 24), 6).alias("area_ratio")
    )


@query("""
with h as (select s_suppkey as host, s_nationkey as image, (60 + s_suppkey * 37 % 500)::int as x1, (50 + s_suppkey * 53 % 380)::int as y1, (60 + s_suppkey * 37 % 500 + 20 + s_suppkey % 30)::int as x2, (50 + s_suppkey * 53 % 380 + 18 + s_suppkey % 22)::int as y2 from supplier),
t as (select * from (select *, row_number() over (partition by image order by (x2 - x1) * (y2 - y1) desc, host) as k from h) where k <= 8),
c as (select t.image, host, radius, degrees, round_even((x1 + x2) / 2.0::double + greatest(x2 - x1, y2 - y1, 30) * radius * cos(radians(degrees)) - 15, 0)::int as x, round_even((y1 + y2) / 2.0::double + greatest(x2 - x1, y2 - y1, 30) * radius * sin(radians(degrees)) - 12, 0)::int as y
  from t, (values (1.4::double), (1.9), (2.4)) r(radius), range(0, 360, 30) d(degrees)),
i as (select * from c where x >= 8 and y >= 8 and x + 30 <= 632 and y + 24 <= 472),
f as (select * from i where not exists (select 1 from h where h.image = i.image and not (i.x + 30 + 8 <= h.x1 or h.x2 + 8 <= i.x or i.y + 24 + 8 <= h.y1 or h.y2 + 8 <= i.y)))
select image, count(*) as free, min((radius, host, degrees, x, y))[1] as radius, min((radius, host, degrees, x, y))[4] as x, min((radius, host, degrees, x, y))[5] as y from f group by image
""")
def placement_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a patch fits beside the eight largest hosts of an image: three radii, twelve
    angles, 8 pixels from every box and edge; how many places are free and the nearest."""
    s = F.col("s_suppkey")
    x1, y1 = 60 + s * 37 % 500, 50 + s * 53 % 380
    h = table(spark, sf_dir, "supplier").select(s.alias("host"), F.col("s_nationkey").alias("image"), x1.cast("int").alias("x1"), y1.cast("int").alias("y1"), (x1 + 20 + s % 30).cast("int").alias("x2"), (y1 + 18 + s % 22).cast("int").alias("y2"))
    largest = h.withColumn("k", F.expr("row_number() over (partition by image order by (x2 - x1) * (y2 - y1) desc, host)")).where("k <= 8")
    places = F.explode(F.flatten(F.transform(F.array(*map(F.lit, (1.4, 1.9, 2.4))), lambda r: F.transform(F.sequence(F.lit(0), F.lit(330), F.lit(30)), lambda d: F.struct(r.alias("radius"), d.alias("degrees"))))))
    side = F.greatest(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"), F.lit(30))
    c = largest.withColumn("p", places).select("image", "host", "p.radius", "p.degrees", side.alias("side"), ((F.col("x1") + F.col("x2")) / 2).alias("cx"), ((F.col("y1") + F.col("y2")) / 2).alias("cy"))
    angle = F.radians("degrees")
    c = c.withColumns({"x": F.bround(F.col("cx") + F.col("side") * F.col("radius") * F.cos(angle) - 15).cast("int"), "y": F.bround(F.col("cy") + F.col("side") * F.col("radius") * F.sin(angle) - 12).cast("int")})
    inside = c.where("x >= 8 and y >= 8 and x + 30 <= 632 and y + 24 <= 472").drop("cx", "cy", "side")
    near = conflicts((F.col("i.x"), F.col("i.y"), F.col("i.x") + 30, F.col("i.y") + 24), tuple(F.col(f"h.{k}") for k in ("x1", "y1", "x2", "y2")), 8)
    free = inside.alias("i").join(h.alias("h"), (F.col("i.image") == F.col("h.image")) & near, "left_anti")
    best = F.min(F.struct("radius", "host", "degrees", "x", "y")).alias("b")
    return free.groupBy("image").agg(F.count("*").alias("free"), best).select("image", "free", F.col("b.radius").alias("radius"), F.col("b.x").alias("x"), F.col("b.y").alias("y"))


@query("""
with f as (select page_id, case page_id % 3 when 0 then 'DOTAv2' when 1 then 'xView' else 'DIOR' end as dataset, 'P' || page_id || '_a_b_' || lpad((page_id % 40)::varchar, 4, '0') as stem from pages)
select dataset, page_id, case dataset when 'DOTAv2' then regexp_replace(stem, '_\\d{4}$', '') when 'xView' then array_to_string(string_split(stem, '_')[1:greatest(len(string_split(stem, '_')) - 4, 0)], '_') else stem end as scene from f
""")
def scene_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scene of a tile by its dataset's naming."""
    page = F.col("page_id")
    dataset = F.when(page % 3 == 0, "DOTAv2").when(page % 3 == 1, "xView").otherwise("DIOR")
    name = F.concat(F.lit("/data/images/P"), page.cast("string"), F.lit("_a_b_"), F.lpad((page % 40).cast("string"), 4, "0"), F.lit(".png"))
    return table(spark, sf_dir, "pages").select(dataset.alias("dataset"), "page_id", geometry.scene_key(dataset, name).alias("scene"))


@query("""
with v1 as (select p_partkey as id, p_retailprice as score from part where p_partkey % 5 <> 0), v2 as (select p_partkey as id, p_retailprice + p_size - 25 as score from part where p_partkey % 7 <> 0)
select case when v2.id is null then 'stale' when v1.id is null then 'new' when v2.score > v1.score then 'better' else 'kept' end as change, count(*) as crops, round(sum(coalesce(v2.score, 0) - coalesce(v1.score, 0)), 2) as gain from v1 full join v2 using (id) group by 1
""")
def version_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pool's two versions by id: better, kept, new, and stale ones to prune."""
    part = table(spark, sf_dir, "part")
    v1 = part.where("p_partkey % 5 <> 0").select(F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("a"))
    v2 = part.where("p_partkey % 7 <> 0").select(F.col("p_partkey").alias("id"), (F.col("p_retailprice") + F.col("p_size") - 25).alias("b"))
    change = F.when(F.col("b").isNull(), "stale").when(F.col("a").isNull(), "new").when(F.col("b") > F.col("a"), "better").otherwise("kept")
    gain = F.coalesce("b", F.lit(0)) - F.coalesce("a", F.lit(0))
    return v1.join(v2, "id", "full").groupBy(change.alias("change")).agg(F.count("*").alias("crops"), F.round(F.sum(gain), 2).alias("gain"))


@query("""
with d as (select doc_id, list_filter([case when quality = 0 then 'quality' end, case when toxic = 1 then 'toxic' end], lambda x: x is not null) as reasons from labels)
select 'REJECT__' || coalesce(nullif(array_to_string(reasons, '+'), ''), 'unspecified') || '__' || doc_id as name, source from d join documents using (doc_id) where len(reasons) > 0 or doc_id % 10 = 0
""")
def rejected_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected decisions with their manifest record, named by their reasons; a decision
    without a record fails the query."""
    d = table(spark, sf_dir, "labels").select("doc_id", reasons(("quality", F.col("quality") == 0), ("toxic", F.col("toxic") == 1)).alias("r")).where("size(r) > 0 or doc_id % 10 = 0")
    found = d.join(table(spark, sf_dir, "documents").select("doc_id", "source", F.lit(True).alias("known")), "doc_id", "left")
    token = F.coalesce(F.nullif(F.array_join("r", "+"), F.lit("")), F.lit("unspecified"))
    name = F.concat(F.lit("REJECT__"), token, F.lit("__"), F.col("doc_id").cast("string"))
    checked = F.when(F.col("known"), name).otherwise(F.raise_error(F.concat(F.lit("no record of "), F.col("doc_id").cast("string"))))
    return found.select(checked.alias("name"), "source")


_PICKED = (3, 17, 40, 41, 95)


@query(f"select p_type as class_name, count(*) filter (p_partkey in {_PICKED}) as picked, count(*) filter (p_partkey not in {_PICKED}) as others, (select count(*) from part where p_partkey in {_PICKED}) = {len(_PICKED)} as all_known from part group by 1")
def explicit_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a list of ids names, and the others; every id of the list must exist."""
    part = table(spark, sf_dir, "part")
    ids = F.broadcast(spark.createDataFrame([(i, True) for i in _PICKED], "p_partkey long, picked boolean"))
    marked = part.join(ids, "p_partkey", "left").select(F.col("p_type").alias("class_name"), F.coalesce("picked", F.lit(False)).alias("picked"))
    known = marked.agg((F.count_if("picked") == len(_PICKED)).alias("all_known"))  # one row
    return marked.groupBy("class_name").agg(F.count_if("picked").alias("picked"), F.count_if(~F.col("picked")).alias("others")).crossJoin(known)


@query("""
select doc_id, sha256(n_chars || 'x1:' || text) as identity, sha256('RGBA:' || n_chars || 'x1:' || text) as with_mode, printf('%.2f%%', 100.0::double * round_even(len(replace(text, ' ', '')) / greatest(n_chars, 1), 4)) as filled from documents where text is not null
""")
def pixel_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A content's identity from its size and contents, with or without its mode before them."""
    docs = table(spark, sf_dir, "documents").where("text is not null")
    sized = F.concat(F.col("n_chars").cast("string"), F.lit("x1:"), F.col("text"))
    share = F.bround(F.length(F.replace("text", F.lit(" "), F.lit(""))) / F.greatest("n_chars", F.lit(1)), 4)
    return docs.select("doc_id", F.sha2(sized, 256).alias("identity"), F.sha2(F.concat(F.lit("RGBA:"), sized), 256).alias("with_mode"), F.format_string("%.2f%%", share * 100.0).alias("filled"))


@query("""
select s_suppkey as id, 'nc: ' || s_nationkey || chr(10) || 'path: /new/' || s_suppkey || chr(10) || 'path: second' as yaml, '{' || string_agg_ || '}' as counts from (select s_suppkey, s_nationkey, '"' || s_nationkey || '":' || (s_suppkey % 5) || ',"x":' || s_suppkey as string_agg_ from supplier)
""")
def yaml_and_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first path line of a description rewritten; counters as JSON with text keys."""
    s, n = F.col("s_suppkey").cast("string"), F.col("s_nationkey").cast("string")
    text = F.concat(F.lit("nc: "), n, F.lit("\npath: /old/place\npath: second"))
    counts = F.map_from_entries(F.array(F.struct(n.alias("k"), (F.col("s_suppkey") % 5).alias("v")), F.struct(F.lit("x").alias("k"), F.col("s_suppkey").alias("v"))))
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), with_yaml_root(text, F.concat(F.lit("/new/"), s)).alias("yaml"), F.to_json(counts).alias("counts"))
