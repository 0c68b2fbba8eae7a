"""Lookups, membership, coverage and set comparisons between releases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.operators.contained import containing
from tessella.plans.registry import query, table


@query("""
select count(*) as instances, count(p_partkey) as matched, count(*) - count(p_partkey) as orphans,
       (select count(*) from part where p_partkey not in (select l_partkey from lineitem where l_returnflag = 'R' and l_quantity > 40)) as unused
from lineitem left join part on l_partkey = p_partkey
""")
def referential_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instances without a crop (none allowed) and crops that a subset doesn't use."""
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part").select("p_partkey")
    found = line.join(part, F.col("l_partkey") == F.col("p_partkey"), "left").agg(F.count("*").alias("instances"), F.count("p_partkey").alias("matched"))
    used = line.where("l_returnflag = 'R' and l_quantity > 40").select(F.col("l_partkey").alias("p_partkey"))
    unused = part.join(used, "p_partkey", "left_anti").agg(F.count("*").alias("unused"))
    return found.withColumn("orphans", F.col("instances") - F.col("matched")).crossJoin(unused)  # one row each


@query("""
select p_type as class_name, o_orderpriority as batch, count(*) as instances, count(distinct l_partkey) as crops
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey where l_partkey in (select p_partkey from part where p_size >= 45) group by all
""")
def heldout_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out crops that a release uses, by class and batch."""
    held = table(spark, sf_dir, "part").where("p_size >= 45").select(F.col("p_partkey").alias("l_partkey"))
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("class_name"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("batch"))
    used = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").join(held, "l_partkey", "left_semi")
    return used.join(part, "l_partkey").join(orders, "l_orderkey").groupBy("class_name", "batch").agg(F.count("*").alias("instances"), F.count_distinct("l_partkey").alias("crops"))


@query("""
with held as (select sha256(text) as h, doc_id from documents where source = 'src0')
select source, count(*) as rows from documents where source <> 'src0' and sha256(text) not in (select h from held)
  and doc_id + 1 not in (select doc_id from held) group by source
""")
def heldout_anti_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that neither of two keys ties to the held-out side: two anti joins, never an OR."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2("text", 256).alias("h"))
    held = docs.where("source = 'src0'")
    free = docs.where("source <> 'src0'").join(held.select("h"), "h", "left_anti")
    return free.join(held.select((F.col("doc_id") - 1).alias("doc_id")), "doc_id", "left_anti").groupBy("source").agg(F.count("*").alias("rows"))


@query("""
with train as (select split_part(url, '/', 3) as scene from pages where page_id % 2 = 0 union select source from documents)
select split_part(url, '/', 3) as scene, count(*) as pages from pages where page_id % 2 = 1 and split_part(url, '/', 3) not in (select scene from train) group by 1
""")
def scene_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test scenes that training doesn't know from backgrounds or crops."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.split_part("url", F.lit("/"), F.lit(3)).alias("scene"))
    train = pages.where("page_id % 2 = 0").select("scene").union(table(spark, sf_dir, "documents").select("source")).distinct()
    return pages.where("page_id % 2 = 1").join(train, "scene", "left_anti").groupBy("scene").agg(F.count("*").alias("pages"))


@query("""
select case when l.doc_id is null then 'missing' when d.doc_id is null then 'extra' else 'both' end as side, count(*) as rows
from (select doc_id from documents where doc_id % 10 <> 3) d full join (select doc_id from labels) l using (doc_id) group by 1
""")
def review_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A review must cover exactly the manifest: what is missing, what is extra."""
    d = table(spark, sf_dir, "documents").where("doc_id % 10 <> 3").select("doc_id", F.lit(1).alias("d"))
    l = table(spark, sf_dir, "labels").select("doc_id", F.lit(1).alias("l"))  # noqa: E741
    side = F.when(F.col("l").isNull(), "missing").when(F.col("d").isNull(), "extra").otherwise("both")
    return d.join(l, "doc_id", "full").groupBy(side.alias("side")).agg(F.count("*").alias("rows"))


@query("""
select d.doc_id, n_chars <= 4000 and quality = 1 as accepted, case when n_chars > 4000 then 'too_long' when quality <> 1 then 'review' end as reason
from documents d join labels l using (doc_id)
""")
def review_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted if the gate and the reviewer say so; the gate's reason goes first."""
    auto, human = F.col("n_chars") <= 4000, F.col("quality") == 1
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id")
    return docs.select("doc_id", (auto & human).alias("accepted"), F.when(~auto, "too_long").when(~human, "review").alias("reason"))


@query("""
with a as (select p_partkey as id, p_type as class_name, p_retailprice as score, 1 as batch from part where p_partkey % 3 <> 0
           union all select p_partkey, p_type, p_retailprice + 1, 2 from part where p_partkey % 3 <> 1)
select class_name, count(*) as ids, round(sum(first_score), 2) as first_wins, round(sum(last_score), 2) as last_wins, count(*) filter (kinds > 1) as conflicts
from (select id, any_value(class_name) as class_name, arg_min(score, batch) as first_score, arg_max(score, batch) as last_score, count(distinct class_name) as kinds from a group by id) group by class_name
""")
def pool_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping pools by id: the first batch's row, the last batch's, and a consistency check."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_type").alias("class_name"), F.col("p_retailprice").alias("score"))
    both = part.where("id % 3 <> 0").withColumn("batch", F.lit(1)).unionByName(part.where("id % 3 <> 1").withColumn("score", F.col("score") + 1).withColumn("batch", F.lit(2)))
    by_id = both.groupBy("id").agg(
        F.min_by("class_name", "batch").alias("class_name"), F.min_by("score", "batch").alias("f"), F.max_by("score", "batch").alias("l"), F.count_distinct("class_name").alias("kinds")
    )
    return by_id.groupBy("class_name").agg(
        F.count("*").alias("ids"), F.round(F.sum("f"), 2).alias("first_wins"), F.round(F.sum("l"), 2).alias("last_wins"), F.count_if(F.col("kinds") > 1).alias("conflicts")
    )


@query("""
with p as (select conv_id, turn, role, row_number() over (partition by conv_id order by turn) - 1 as pos from conversations),
q as (select conv_id, pos - 1 as pos, role as next_role from p)
select p.role, coalesce(q.next_role, 'none') as next_role, count(*) as pairs from p left join q using (conv_id, pos) group by all
""")
def positional_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The i-th row of one side with the i-th of the other, position within the conversation."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    # the other side's i-th row is this side's next one, so one sorted stream pairs them
    p = turns.withColumn("next_role", F.lead("role").over(Window.partitionBy("conv_id").orderBy("turn")))
    return p.groupBy("role", F.coalesce("next_role", F.lit("none")).alias("next_role")).agg(F.count("*").alias("pairs"))


@query("""
select n_name as name, count(s_suppkey) as suppliers, round(coalesce(sum(s_acctbal), 0), 2) as balance, coalesce(any_value(r_name), 'unknown') as region
from nation left join supplier on s_nationkey = n_nationkey left join region on r_regionkey = n_regionkey and r_regionkey > 0 group by n_name
""")
def lookup_with_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region").where("r_regionkey > 0"), F.col("r_regionkey") == F.col("n_regionkey"), "left")
    s = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("k"), F.sum("s_acctbal").alias("b"))
    return n.join(s, "n_nationkey", "left").select(
        F.col("n_name").alias("name"), F.coalesce("k", F.lit(0)).alias("suppliers"), F.round(F.coalesce("b", F.lit(0.0)), 2).alias("balance"), F.coalesce("r_name", F.lit("unknown")).alias("region")
    )


@query("""
select o_custkey as background, count(distinct o_orderkey) as images, count(l_orderkey) as annotations, count(distinct o_orderkey) filter (l_orderkey is null) as empty_images
from orders left join lineitem on l_orderkey = o_orderkey group by o_custkey having count(distinct o_orderkey) >= 2
""")
def images_with_annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images outer-joined to their annotations, for backgrounds with at least two images."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    n = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    return o.join(n, "o_orderkey", "left").groupBy(F.col("o_custkey").alias("background")).agg(
        F.count_distinct("o_orderkey").alias("images"), F.coalesce(F.sum("n"), F.lit(0)).alias("annotations"), F.count_distinct(F.when(F.col("n").isNull(), F.col("o_orderkey"))).alias("empty_images")
    ).where("images >= 2")


_SPLIT = "select l_orderkey, l_partkey, l_suppkey, l_orderkey % 5 = 0 as test from lineitem"


@query(f"""
with s as ({_SPLIT})
select 'crop' as key_type, count(*) as shared from (select l_partkey from s where test intersect select l_partkey from s where not test)
union all select 'source', count(*) from (select l_suppkey from s where test intersect select l_suppkey from s where not test)
union all select 'image', count(*) from (select l_orderkey from s where test intersect select l_orderkey from s where not test)
union all select 'text', count(*) from (select text from documents where source = 'src0' and text is not null intersect select text from documents where source <> 'src0' and text is not null)
""")
def isolation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What train and test share, by kind of key; nulls never count as shared."""
    line = table(spark, sf_dir, "lineitem")
    test, train = line.where("l_orderkey % 5 = 0"), line.where("l_orderkey % 5 <> 0")
    docs = table(spark, sf_dir, "documents")

    def shared(name, a, b, key):
        both = a.select(key).where(F.col(key).isNotNull()).intersect(b.select(key))
        return both.agg(F.count("*").alias("shared")).select(F.lit(name).alias("key_type"), "shared")

    out = shared("crop", test, train, "l_partkey").union(shared("source", test, train, "l_suppkey")).union(shared("image", test, train, "l_orderkey"))
    return out.union(shared("text", docs.where("source = 'src0'"), docs.where("source <> 'src0'"), "text"))


@query("""
select d.lang, d.source, count(distinct d.doc_id) as documents, count(distinct b.item_id) as items from documents d join benchmark b on contains(d.text, b.text) group by all
""")
def benchmark_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain a whole benchmark text: one walk over each, nothing shuffled
    but what was found."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    found = containing(docs, table(spark, sf_dir, "benchmark"), "doc_id", "text", "item_id", "text", ("lang", "source"))
    return found.groupBy("lang", "source").agg(F.count_distinct("doc_id").alias("documents"), F.count_distinct("item").alias("items"))


@query("""
with u as (select p_partkey as id, 'a' as batch from part where p_size < 20 union all select p_partkey, 'b' from part where p_size between 15 and 30)
select batch, count(*) as rows, count(distinct id) as ids, (select count(*) from u) = (select count(distinct id) from u) as is_unique from u group by batch
""")
def union_with_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), "p_size")
    u = part.where("p_size < 20").withColumn("batch", F.lit("a")).unionByName(part.where("p_size between 15 and 30").withColumn("batch", F.lit("b")))
    whole = u.agg((F.count("*") == F.count_distinct("id")).alias("is_unique"))  # one row
    return u.groupBy("batch").agg(F.count("*").alias("rows"), F.count_distinct("id").alias("ids")).crossJoin(whole)


@query("""
select 'only_manifest' as side, count(*) as rows from (select text from documents where doc_id % 2 = 0 except all select text from documents where doc_id % 3 = 0)
union all select 'only_files', count(*) from (select text from documents where doc_id % 3 = 0 except all select text from documents where doc_id % 2 = 0)
""")
def orphan_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    a, b = docs.where("doc_id % 2 = 0").select("text"), docs.where("doc_id % 3 = 0").select("text")
    one = lambda name, x: x.agg(F.count("*").alias("rows")).select(F.lit(name).alias("side"), "rows")
    return one("only_manifest", a.exceptAll(b)).union(one("only_files", b.exceptAll(a)))


@query("""
with names as (select distinct 'T/' || p_type as name, 0 as part from part union select distinct 'X/' || case when event_type in ('click', 'view') then 'browse' else event_type end, 1 from events)
select row_number() over (order by part, name) - 1 as class_id, name from names
""")
def global_taxonomy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets first, then the sorted further names with some folded into one; the place is the id."""
    fold = F.when(F.col("event_type").isin("click", "view"), "browse").otherwise(F.col("event_type"))
    names = table(spark, sf_dir, "part").select(F.concat(F.lit("T/"), "p_type").alias("name"), F.lit(0).alias("part"))
    names = names.union(table(spark, sf_dir, "events").select(F.concat(F.lit("X/"), fold), F.lit(1))).distinct()
    # a taxonomy is a small list: one array of it
    return names.agg(F.array_sort(F.collect_set(F.struct("part", "name"))).alias("a")).select(F.posexplode("a").alias("k", "x")).select(F.col("k").cast("long").alias("class_id"), "x.name")


@query("""
with old as (select c_custkey as id, c_mktsegment as body from customer where c_custkey % 4 <> 0), new as (select c_custkey as id, 'new' as body from customer where c_custkey % 6 = 0)
select body, count(*) as rows, min(id) as first_id from (select * from old where id not in (select id from new) union all select * from new) group by body
""")
def registry_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New rows replace old ones of the same id."""
    from tessella.sources.sinks import upsert

    c = table(spark, sf_dir, "customer")
    old = c.where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("body"))
    new = c.where("c_custkey % 6 = 0").select(F.col("c_custkey").alias("id"), F.lit("new").alias("body"))
    return upsert(old, new, ["id"]).groupBy("body").agg(F.count("*").alias("rows"), F.min("id").alias("first_id"))


@query("""
with c as (select l_orderkey, count(*) as n from lineitem group by l_orderkey)
select 'part_id_unique' as invariant, count(*) as violations from (select p_partkey from part group by 1 having count(*) > 1)
union all select 'line_key_unique', count(*) from (select l_orderkey, l_linenumber from lineitem group by all having count(*) > 1)
union all select 'slots_1_to_6', count(*) from c where n not between 1 and 6
union all select 'crop_exists', count(*) from lineitem where l_partkey not in (select p_partkey from part)
union all select 'quota_per_subset', count(*) from (select o_orderpriority, count(*) as n from orders group by 1) full join (select o_orderpriority, 3000 as q from orders group by 1) using (o_orderpriority) where n is distinct from q
union all select 'counter_matches', count(*) from (select lang, count(*) as n from documents group by 1) a full join (select lang, sum(k) as n from (select lang, source, count(*) as k from documents group by all) group by 1) b using (lang) where a.n is distinct from b.n
union all select 'allowed_lang', count(*) from documents where not coalesce(lang in ('en', 'fr', 'de', 'es'), false)
union all select 'n_chars_within_tolerance', count(*) from documents where abs(n_chars - len(text)) > 0
""")
def invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per invariant with its number of violations."""
    line, part, orders, docs = (table(spark, sf_dir, t) for t in ("lineitem", "part", "orders", "documents"))
    per_lang = docs.groupBy("lang").agg(F.count("*").alias("n"))
    again = docs.groupBy("lang", "source").count().groupBy("lang").agg(F.sum("count").alias("m"))
    subsets = orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    quota = subsets.select("o_orderpriority", F.lit(3000).alias("q"))
    checks = {
        "part_id_unique": part.groupBy("p_partkey").count().where("count > 1"),
        "line_key_unique": line.groupBy("l_orderkey", "l_linenumber").count().where("count > 1"),
        "slots_1_to_6": line.groupBy("l_orderkey").count().where("count not between 1 and 6"),
        "crop_exists": line.join(part, F.col("l_partkey") == F.col("p_partkey"), "left_anti"),
        "quota_per_subset": subsets.join(quota, "o_orderpriority", "full").where(~F.col("n").eqNullSafe(F.col("q"))),
        "counter_matches": per_lang.join(again, "lang", "full").where(~F.col("n").eqNullSafe(F.col("m"))),
        "allowed_lang": docs.where(~F.coalesce(F.col("lang").isin("en", "fr", "de", "es"), F.lit(False))),
        "n_chars_within_tolerance": docs.where(F.abs(F.col("n_chars") - F.length("text")) > 0),
    }
    out = None
    for name, bad in checks.items():
        row = bad.agg(F.count("*").alias("violations")).select(F.lit(name).alias("invariant"), "violations")
        out = row if out is None else out.union(row)
    return out
