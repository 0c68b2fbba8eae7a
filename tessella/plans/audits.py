"""Invariants of a release: each answers with what breaks it, or with counts that must agree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.functions.boxes import conflicts
from tessella.plans.geometry import _PAIRS_SQL, _corners, _pairs, boxes
from tessella.plans.registry import query, table
from tessella.sources import sinks
from tessella.sources.shared import new_path, written

_PIXELS_SQL = """px as (select l_orderkey as image, l_linenumber as mask, (l_partkey % 64)::int as x, (l_suppkey * 13 % 64)::int as y from lineitem),
bb as (select image, mask, min(x) as x1, min(y) as y1, max(x) + 1 as x2, max(y) + 1 as y2, count(*) as pixels from px group by all)"""


def mask_boxes(pixels: DataFrame) -> DataFrame:
    """(image, mask, x1, y1, x2, y2, pixels): the box around each mask's pixels (image, mask, x, y)."""
    return pixels.groupBy("image", "mask").agg(
        F.min("x").alias("x1"), F.min("y").alias("y1"), (F.max("x") + 1).alias("x2"), (F.max("y") + 1).alias("y2"), F.count("*").alias("pixels")
    )


def _pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("image"), F.col("l_linenumber").alias("mask"), (F.col("l_partkey") % 64).cast("int").alias("x"), (F.col("l_suppkey") * 13 % 64).cast("int").alias("y")
    )


@query(f"with {_PIXELS_SQL} select mask, count(*) as images, sum(pixels)::bigint as pixels, sum((x2 - x1) * (y2 - y1))::bigint as area, max(x2) as right, min(y1) as top from bb group by mask")
def mask_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes around masks, summed up by mask number."""
    found = mask_boxes(_pixels(spark, sf_dir))
    return found.groupBy("mask").agg(
        F.count("*").alias("images"), F.sum("pixels").alias("pixels"), F.sum((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))).alias("area"), F.max("x2").alias("right"), F.min("y1").alias("top")
    )


@query(f"""with {_PIXELS_SQL}, r as (select image, mask, x1, y1, case when image % 11 = 0 then x2 + 1 else x2 end as x2, y2 from bb where not (image % 17 = 0 and mask = 1)),
j as (select coalesce(bb.image, r.image) as image, bb.mask as found, bb.x1 is distinct from r.x1 or bb.y1 is distinct from r.y1 or bb.x2 is distinct from r.x2 or bb.y2 is distinct from r.y2 as off from bb full join r using (image, mask))
select image, count(*) filter (off) as wrong_boxes, not (min(found) = 1 and max(found) = count(distinct found)) as gap from j group by image having count(*) filter (off) > 0 or not (min(found) = 1 and max(found) = count(distinct found))""")
def mask_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images whose masks aren't numbered 1 to n, or whose masks' boxes aren't those recorded."""
    found = written(mask_boxes(_pixels(spark, sf_dir)), "mask-boxes")
    box = F.struct("x1", "y1", "x2", "y2")
    right = F.when(F.col("image") % 11 == 0, F.col("x2") + 1).otherwise(F.col("x2"))
    recorded = found.where("not (image % 17 = 0 and mask = 1)").withColumn("x2", right).select("image", "mask", box.alias("recorded"))
    both = found.select("image", "mask", box.alias("box"), F.col("mask").alias("found")).join(recorded, ["image", "mask"], "full")
    wrong = F.count_if(~F.col("box").eqNullSafe(F.col("recorded")))
    gap = ~((F.min("found") == 1) & (F.max("found") == F.count_distinct("found")))
    return both.groupBy("image").agg(wrong.alias("wrong_boxes"), gap.alias("gap")).where("wrong_boxes > 0 or gap")


@query("""
with l as (select conv_id, role, text, turn, row_number() over (partition by conv_id order by turn) as pos, row_number() over (partition by conv_id order by role <> 'user', turn) as want from conversations),
w as (select conv_id, want as pos, text as expected from l)
select conv_id, count(*) filter (l.text is distinct from w.expected) as wrong, count(*) as lines from l full join w using (conv_id, pos) group by conv_id having count(*) filter (l.text is distinct from w.expected) > 0
""")
def label_order_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label files in which the synthetic lines don't come first or the original ones don't
    follow in their order: the i-th line on file against the i-th expected."""
    rows = table(spark, sf_dir, "conversations")
    place = lambda order: F.expr(f"row_number() over (partition by conv_id order by {order})")
    line = rows.select("conv_id", place("turn").alias("pos"), F.col("text").alias("line"))
    want = rows.select("conv_id", place("role <> 'user', turn").alias("pos"), F.col("text").alias("expected"))
    wrong = F.count_if(~F.col("line").eqNullSafe(F.col("expected")))
    return line.join(want, ["conv_id", "pos"], "full").groupBy("conv_id").agg(wrong.alias("wrong"), F.count("*").alias("lines")).where("wrong > 0")


@query("""
with m as (select doc_id, source, n_chars + case when doc_id % 13 = 0 then 1 else 0 end as stored, len(coalesce(text, '')) as again from documents)
select source, count(*) filter (abs(stored - again) > 1e-5) as differ, count(*) filter (stored <= 4000 and again > 4000 or stored > 4000 and again <= 4000) as decided_otherwise, count(*) filter (again > 4000) as fail from m group by source
""")
def gate_recheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics computed again from the contents against those stored, and the gate on both."""
    again, stored = F.length(F.coalesce("text", F.lit(""))), F.col("n_chars") + F.when(F.col("doc_id") % 13 == 0, 1).otherwise(0)
    m = table(spark, sf_dir, "documents").select("source", stored.alias("stored"), again.alias("again"))
    return m.groupBy("source").agg(
        F.count_if(F.abs(F.col("stored") - F.col("again")) > 1e-5).alias("differ"),
        F.count_if((F.col("stored") > 4000) != (F.col("again") > 4000)).alias("decided_otherwise"), F.count_if(F.col("again") > 4000).alias("fail"),
    )


@query(_PAIRS_SQL + """, c as (select image, count(*) filter (not (x2 + 8 <= qx1 or qx2 + 8 <= x1 or y2 + 8 <= qy1 or qy2 + 8 <= y1)) as close from pq group by image),
s as (select image, sum((x2 - x1) * (y2 - y1)) > 0.2 * 160 * 160 as crowded, count(*) filter (x1 < 8 or y1 < 8 or x2 > 152 or y2 > 152) as at_edge from b group by image)
select coalesce(close, 0) > 0 as too_close, crowded, at_edge > 0 as edge, count(*) as images from s left join c using (image) group by all""")
def clearance_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images by what they break: 8 pixels between boxes, a fifth of the area, 8 pixels margin."""
    near = _pairs(spark, sf_dir).groupBy(F.col("p.image").alias("image")).agg(F.count_if(conflicts(_corners("p"), _corners("q"), 8)).alias("close"))
    area = F.sum((F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1")))
    edge = F.count_if(F.expr("x1 < 8 or y1 < 8 or x2 > 152 or y2 > 152"))
    per_image = boxes(spark, sf_dir).groupBy("image").agg((area > 0.2 * 160 * 160).alias("crowded"), (edge > 0).alias("edge"))
    return per_image.join(near, "image", "left").groupBy((F.coalesce("close", F.lit(0)) > 0).alias("too_close"), "crowded", "edge").agg(F.count("*").alias("images"))


@query("""
with e(class_name, expected) as (values ('PROMO', 4), ('STANDARD', 2)),
f as (select p_type as class_name, count(distinct p_partkey) as found from part where p_size >= 45 and p_partkey in (select l_partkey from lineitem) group by 1)
select coalesce(e.class_name, f.class_name) as class_name, coalesce(found, 0) as found, coalesce(expected, 0) as expected, coalesce(found, 0) = coalesce(expected, 0) as as_known from e full join f using (class_name)
""")
def known_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out crops in use by class against what is known to be: no more, no fewer."""
    expected = spark.createDataFrame([("PROMO", 4), ("STANDARD", 2)], "class_name string, expected int")
    used = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    held = table(spark, sf_dir, "part").where("p_size >= 45").join(used, "p_partkey", "left_semi")
    both = held.groupBy(F.col("p_type").alias("class_name")).agg(F.count_distinct("p_partkey").alias("found")).join(expected, "class_name", "full")
    zero = lambda c: F.coalesce(c, F.lit(0))
    return both.select("class_name", zero("found").alias("found"), zero("expected").alias("expected"), (zero("found") == zero("expected")).alias("as_known"))


@query("""
with s as (select c_nationkey as serial, case when c_nationkey % 5 = 0 then 'test' when c_nationkey % 5 = 1 then 'valid' else 'train' end as split from customer union all select 1, 'train' from customer where c_custkey = 1)
select split, count(*) as crops, count(distinct serial) as serials, (select count(*) from (select serial from s where split = o.split intersect select serial from s where split <> o.split)) as shared from s o group by split
""")
def airframe_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crops and serials of each split, and the serials that it shares with another."""
    c = table(spark, sf_dir, "customer")
    split = F.when(F.col("c_nationkey") % 5 == 0, "test").when(F.col("c_nationkey") % 5 == 1, "valid").otherwise("train")
    s = c.select(F.col("c_nationkey").alias("serial"), split.alias("split")).unionByName(c.where("c_custkey = 1").select(F.lit(1).alias("serial"), F.lit("train").alias("split")))
    several = s.groupBy("serial").agg((F.count_distinct("split") > 1).alias("several"))
    distinct = s.groupBy("split", "serial").agg(F.count("*").alias("n")).join(several, "serial")
    return distinct.groupBy("split").agg(F.sum("n").alias("crops"), F.count("*").alias("serials"), F.count_if("several").alias("shared"))


@query("""
with m as (select doc_id, source, ('0x' || substr(sha256(doc_id::varchar), 1, 12))::bigint as h from documents), l as (select distinct doc_id from labels where quality is not null)
select source, count(*) as rows, count(l.doc_id) as reviewed, count(*) - count(l.doc_id) as missing, bit_xor(h) as manifest, bit_xor(case when l.doc_id is not null then h else 0 end) = bit_xor(h) as bound from m left join l using (doc_id) group by source
""")
def review_binding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a review is of exactly the manifest: a digest of the ids that order doesn't
    change, and the ids that the review lacks, by source."""
    h = F.conv(F.substring(F.sha2(F.col("doc_id").cast("string"), 256), 1, 12), 16, 10).cast("long")
    m = table(spark, sf_dir, "documents").select("doc_id", "source", h.alias("h"))
    both = m.join(table(spark, sf_dir, "labels").where("quality is not null").select("doc_id", F.lit(1).alias("r")).distinct(), "doc_id", "left")
    seen = F.when(F.col("r").isNotNull(), F.col("h")).otherwise(0)
    return both.groupBy("source").agg(
        F.count("*").alias("rows"), F.count("r").alias("reviewed"), (F.count("*") - F.count("r")).alias("missing"), F.bit_xor("h").alias("manifest"), (F.bit_xor(seen) == F.bit_xor("h")).alias("bound")
    )


@query("select quality, count(*) as accepted, count(*) as exported, true as agrees from labels group by quality")
def export_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted rows against the lines of the files that they were exported to."""
    path = new_path(spark, "export")
    accepted = table(spark, sf_dir, "labels")
    sinks.write_jsonl(accepted, path, 50_000)
    lines = spark.read.schema(accepted.schema).json(path).groupBy("quality").agg(F.count("*").alias("exported"))
    both = accepted.groupBy("quality").agg(F.count("*").alias("accepted")).join(lines, F.expr("true") & accepted["quality"].eqNullSafe(lines["quality"]), "full").drop(lines["quality"])
    return both.withColumn("agrees", F.col("accepted").eqNullSafe(F.col("exported")))


@query("""
with t as (select o_orderpriority as batch, string_agg(distinct p_type, chr(10) order by p_type) as names from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey group by 1)
select batch, sha256(names) as digest, (select count(distinct names) from t) = 1 as identical from t
""")
def taxonomy_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each batch's ordered class names as one digest; all must be the same."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey"))
    rows = line.join(table(spark, sf_dir, "part").select("p_partkey", "p_type"), "p_partkey").join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("batch")), "l_orderkey")
    names = rows.groupBy("batch").agg(F.array_join(F.array_sort(F.collect_set("p_type")), "\n").alias("names"))
    whole = names.agg((F.count_distinct("names") == 1).alias("identical"))  # one row
    return names.select("batch", F.sha2("names", 256).alias("digest")).crossJoin(whole)


@query("""
with i as (select l_orderkey as image, list(p_type) as classes, list(l_quantity) as sizes from lineitem join part on l_partkey = p_partkey group by 1)
select len(list_filter(classes, lambda c: c = 'PROMO')) > 0 as has_forced, len(list_filter(sizes, lambda s: s < 40)) = len(sizes) as all_small, count(*) as images from i group by all
""")
def forced_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images by whether they have the class forced upon them, and whether all sizes hold."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey"), "l_quantity")
    rows = line.join(table(spark, sf_dir, "part").select("p_partkey", "p_type"), "p_partkey")
    images = rows.groupBy("l_orderkey").agg(F.collect_list(F.struct("p_type", "l_quantity")).alias("i"))
    has, small = F.exists("i", lambda x: x["p_type"] == "PROMO"), F.forall("i", lambda x: x["l_quantity"] < 40)
    return images.groupBy(has.alias("has_forced"), small.alias("all_small")).agg(F.count("*").alias("images"))


@query("""
with a as (select p_partkey as id from part where p_size <= 30), b as (select p_partkey as id from part where p_size >= 29)
select (select count(*) from a) as train, (select count(*) from b) as test, (select count(*) from (select id from a intersect select id from b)) as shared
""")
def pool_packaging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of two pools and the ids that both have."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_size")
    sides = part.select("id", (F.col("p_size") <= 30).cast("int").alias("a"), (F.col("p_size") >= 29).cast("int").alias("b"))
    return sides.groupBy("id").agg(F.max("a").alias("a"), F.max("b").alias("b")).agg(F.sum("a").alias("train"), F.sum("b").alias("test"), F.sum(F.col("a") * F.col("b")).alias("shared"))


_PROVENANCE = (
    ("split", "p_size <= 45"),
    ("source", "p_brand in ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#13', 'Brand#14')"),
    ("path", "'/LAE-FOD/' || p_type || '/' like '/LAE-FOD/%O%'"),
)


@query(" union all ".join(f"select '{n}' as rule, count(*) filter (not ({c})) as violations, min(p_partkey) filter (not ({c})) as first_id from part" for n, c in _PROVENANCE))
def row_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that break each rule of split, source and path, and the first of them; one scan."""
    broken = F.array(*(F.when(~F.coalesce(F.expr(c), F.lit(False)), F.lit(n)) for n, c in _PROVENANCE))
    rows = table(spark, sf_dir, "part").select("p_partkey", F.explode(F.array_compact(broken)).alias("rule"))
    every = spark.createDataFrame([(n,) for n, _ in _PROVENANCE], "rule string")
    found = rows.groupBy("rule").agg(F.count("*").alias("violations"), F.min("p_partkey").alias("first_id"))
    return every.join(found, "rule", "left").select("rule", F.coalesce("violations", F.lit(0)).alias("violations"), "first_id")


@query("select n_nationkey as shard, sha256(n_name || chr(10)) as sha256, n_nationkey % 4 <> 0 as matches from nation")
def checksum_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checksums of the files on disk against those in the manifest, some of which are wrong."""
    path = new_path(spark, "files")
    n = table(spark, sf_dir, "nation")
    n.select(F.col("n_name").alias("value"), F.col("n_nationkey").alias("shard")).repartition("shard").write.partitionBy("shard").text(path)
    on_disk = sinks.checksums(spark, path).select(F.regexp_extract("path", r"/shard=(\d+)/", 1).cast("int").alias("shard"), F.col("sha256").alias("found"))
    said = F.when(F.col("n_nationkey") % 4 == 0, "0").otherwise(F.sha2(F.concat("n_name", F.lit("\n")), 256))
    both = n.select(F.col("n_nationkey").alias("shard"), said.alias("said")).join(on_disk, "shard", "full")
    return both.select("shard", F.col("found").alias("sha256"), F.col("found").eqNullSafe(F.col("said")).alias("matches"))


@query("select p_brand as folder, count(*) as kept, count(*) filter (p_size > 40) as pruned from part group by 1")
def stale_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outputs in a folder whose key is current no more: what a prune takes."""
    listing = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    gone = sinks.stale(listing, listing.where("p_size <= 40 or p_size is null").select("p_partkey"), "p_partkey")
    return listing.groupBy(F.col("p_brand").alias("folder")).agg(F.count("*").alias("kept")).join(
        gone.groupBy(F.col("p_brand").alias("folder")).agg(F.count("*").alias("n")), "folder", "left"
    ).select("folder", "kept", F.coalesce("n", F.lit(0)).alias("pruned"))


@query("select p_type as class_name, count(*) as rows, round(sum(p_retailprice), 2) as price from part group by 1")
def verified_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy of a table that was read again and compared with its source before it counts."""
    part = table(spark, sf_dir, "part")
    copy = sinks.verified_copy(part, new_path(spark, "copy"))
    return copy.groupBy(F.col("p_type").alias("class_name")).agg(F.count("*").alias("rows"), F.round(F.sum("p_retailprice"), 2).alias("price"))
