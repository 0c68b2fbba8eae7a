"""Rankings, interleavings, quotas and hash-based samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.operators.ordering import with_position
from tessella.plans.registry import query, table

_RN = "row_number() over"


def uniform(*parts: str) -> Column:
    """A number in [0, 1) from the first four bytes of SHA-256 of the joined parts."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 8), 16, 10).cast("double") / 4294967296.0


_UNIFORM_SQL = "(('0x' || substr(sha256({}), 1, 8))::bigint / 4294967296.0::double)"


@query(f"select scene, s_suppkey, place from (select s_nationkey as scene, s_suppkey, {_RN} (partition by s_nationkey order by s_acctbal desc, s_suppkey) as place from supplier) where place <= 6")
def top6_per_scene(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest six per scene, ties in input order; Spark prunes each task to six before the shuffle."""
    w = Window.partitionBy("scene").orderBy(F.desc("s_acctbal"), "s_suppkey")
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("scene"), "s_suppkey", "s_acctbal")
    return s.withColumn("place", F.row_number().over(w)).where("place <= 6").select("scene", "s_suppkey", "place")


@query(f"select p_partkey, p_brand from (select p_partkey, p_brand, {_RN} (partition by p_brand order by p_partkey) as rn from part) order by rn, p_brand limit 100")
def round_robin_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of each group in turn, up to 100."""
    w = Window.partitionBy("p_brand").orderBy("p_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand").withColumn("rn", F.row_number().over(w)).where("rn <= 100")
    return part.orderBy("rn", "p_brand").limit(100).select("p_partkey", "p_brand")


@query("""
with d as (select sha256(text) as h, doc_id, n_chars from documents)
select doc_id, winner from (select doc_id, first_value(doc_id) over (partition by h order by n_chars desc, doc_id) as winner from d) where doc_id <> winner
""")
def best_of_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each loser of a cluster of equal texts, the winner: an aggregate joined back."""
    d = table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("h"), "doc_id", "n_chars")
    best = d.groupBy("h").agg(F.max_by("doc_id", F.struct("n_chars", -F.col("doc_id"))).alias("winner"), F.count("*").alias("n")).where("n > 1")
    return d.join(best, "h").where("doc_id <> winner").select("doc_id", "winner")


@query(f"select o_orderkey, {_RN} (partition by o_custkey order by o_orderdate, o_orderkey) - 1 as repeat_index from orders")
def repeat_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", (F.row_number().over(w) - 1).cast("long").alias("repeat_index"))


@query("""
select c.i::int as class_index, s.i::int as subset_index, (1000 // 6 + ((s.i - c.i) % 6 + 6) % 6 // 1 * 0 + case when ((s.i - c.i) % 6 + 6) % 6 < 1000 % 6 then 1 else 0 end)::int as quota
from range(0, 13) c(i), range(0, 6) s(i)
""")
def class_quota_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1,000 per class over six subsets; the remainder starts at another subset for each class."""
    c = spark.range(13).select(F.col("id").cast("int").alias("class_index"))
    both = c.select("class_index", F.explode(F.sequence(F.lit(0), F.lit(5))).alias("subset_index"))
    turn = F.pmod(F.col("subset_index") - F.col("class_index"), F.lit(6))
    return both.withColumn("quota", (F.lit(1000 // 6) + F.when(turn < 1000 % 6, 1).otherwise(0)).cast("int"))


@query(f"""
with r as (select o_orderkey, {_RN} (partition by o_orderpriority order by o_orderkey) - 1 as idx, o_orderpriority as sheet from orders)
select sheet, idx // 120 as page, count(*) as cells, max(idx % 120) as last_slot, max(idx % 7 + 1) as variants from r group by all
""")
def page_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of 120 cells per sheet; slot and variant follow from the index."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("sheet"))
    r = with_position(orders, ["o_orderkey"], within="sheet").select("sheet", F.col("position").alias("idx"))
    return r.groupBy("sheet", F.floor(F.col("idx") / 120).alias("page")).agg(
        F.count("*").alias("cells"), F.max(F.pmod("idx", F.lit(120))).alias("last_slot"), F.max(F.pmod("idx", F.lit(7)) + 1).alias("variants")
    )


@query(f"""
with e as (select *, {_RN} (partition by user_id, date_trunc('day', ts) order by ts, event_id) as rn from events),
f as (select *, {_RN} (partition by md5(coalesce(props, '')) order by ts, event_id) as rp from e where rn = 1)
select user_id, count(*) as kept, min(event_id) as first_id from f where rp = 1 group by user_id
""")
def first_seen_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First row of each key, then first of each content: min_by folds before it shuffles."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.date_trunc("day", "ts").alias("day"), F.md5(F.coalesce("props", F.lit(""))).alias("body"))
    first = lambda x: F.min(F.struct("ts", "event_id", *x)).alias("r")
    by_key = e.groupBy("user_id", "day").agg(first(["body"])).select("user_id", "r.*")
    by_body = by_key.groupBy("body").agg(first(["user_id"])).select("r.*")
    return by_body.groupBy("user_id").agg(F.count("*").alias("kept"), F.min("event_id").alias("first_id"))


def sha_mod(column: Column, n: int) -> Column:
    """int(sha256(column), 16) % n for n up to 2**31: eight pieces of 32 bits (Horner), as 256
    bits fit no number type. The digest stands in an array, so it is computed once."""

    def fold(h):
        part = lambda p: F.conv(F.substring(h, p, F.lit(8)), 16, 10).cast("long")
        return F.aggregate(F.sequence(F.lit(1), F.lit(57), F.lit(8)), F.lit(0).cast("long"), lambda a, p: F.pmod(a * F.lit(1 << 32) + part(p), F.lit(n).cast("long")))

    return F.get(F.transform(F.array(F.sha2(column, 256)), fold), F.lit(0)).cast("int")


@query("""
select list_reduce(list_prepend(0::bigint, list_transform(string_split(sha256(p_name), ''), lambda c: ('0x' || c)::bigint)), lambda a, d: (a * 16 + d) % 6)::int as shard, count(*) as rows from part group by 1
""")
def sha_shard_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").groupBy(sha_mod(F.col("p_name"), 6).alias("shard")).agg(F.count("*").alias("rows"))


@query(f"""
select p_partkey, p_type, round(u, 6) as u from (select p_partkey, p_type, u, {_RN} (partition by p_type order by u, p_partkey) as rn
  from (select p_partkey, p_type, {_UNIFORM_SQL.format("'7|' || p_partkey")} as u from part)) where rn <= 8
""")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight per class in the order of a seeded hash; the same rows on any cluster."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", uniform(F.lit("7"), F.col("p_partkey").cast("string")).alias("u"))
    w = Window.partitionBy("p_type").orderBy("u", "p_partkey")
    return part.withColumn("rn", F.row_number().over(w)).where("rn <= 8").select("p_partkey", "p_type", F.round("u", 6).alias("u"))


@query(f"""
with d as (select s_suppkey, i, sqrt(-2 * ln(greatest({_UNIFORM_SQL.format("'a|' || s_suppkey || '|' || i")}, 1e-12))) * cos(2 * pi() * {_UNIFORM_SQL.format("'b|' || s_suppkey || '|' || i")}) * 30 + 50 as x
           from supplier, range(1, 65) t(i)),
f as (select s_suppkey, min(i) as i from d where x between 40 and 45 group by s_suppkey)
select s.s_suppkey, f.i::int as draw, round(d.x, 4) as size from supplier s left join f using (s_suppkey) left join d on d.s_suppkey = f.s_suppkey and d.i = f.i
""")
def truncated_normal_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of 64 hash-derived normal draws that lies in the interval, null if none does."""
    key = F.col("s_suppkey").cast("string")
    u1 = lambda i: F.greatest(uniform(F.lit("a"), key, i.cast("string")), F.lit(1e-12))
    x = lambda i: F.sqrt(-2 * F.ln(u1(i))) * F.cos(2 * F.pi() * uniform(F.lit("b"), key, i.cast("string"))) * 30 + 50
    draws = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: F.struct(i.alias("i"), x(i).alias("x")))
    hit = F.get(F.filter(draws, lambda d: d["x"].between(40, 45)), F.lit(0))
    return table(spark, sf_dir, "supplier").select("s_suppkey", hit.alias("d")).select("s_suppkey", F.col("d.i").alias("draw"), F.round("d.x", 4).alias("size"))


@query("""
with n as (select p_brand, count(*) as pool, count(*) filter (p_size > 25) as done from part group by p_brand)
select p_brand, round(1 / sqrt(done + 10), 8) as fixed_weight, round(sqrt(pool) * least(greatest((pool - done) / greatest(done, 1)::double, 0.4), 12), 6) as gap_weight from n
""")
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count("*").alias("pool"), F.count_if(F.col("p_size") > 25).alias("done"))
    boost = F.least(F.greatest((F.col("pool") - F.col("done")) / F.greatest(F.col("done"), F.lit(1)), F.lit(0.4)), F.lit(12.0))
    return n.select("p_brand", F.round(1 / F.sqrt(F.col("done") + 10), 8).alias("fixed_weight"), F.round(F.sqrt("pool") * boost, 6).alias("gap_weight"))


@query(f"""
with r as (select p_partkey, {_RN} (order by {_UNIFORM_SQL.format("'s|' || p_partkey")}, p_partkey) - 1 as k from part)
select slot.i as slot, p_partkey, 1 + floor({_UNIFORM_SQL.format("'c|' || slot.i")} * 6)::bigint as request from range(0, 500) slot(i) join r on r.k = slot.i % (select count(*) from r)
""")
def cycle_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """500 slots from one pool: each once in hashed order, then round again; and a request of 1 to 6."""
    part = table(spark, sf_dir, "part")
    pool = part.select(F.struct(uniform(F.lit("s"), F.col("p_partkey").cast("string")).alias("u"), "p_partkey").alias("x"))
    # at most 500 of the pool can be taken, so the list is bounded
    first = pool.orderBy("x.u", "x.p_partkey").limit(500).agg(F.array_sort(F.collect_list("x")).alias("a"))
    slots = spark.range(500).withColumnRenamed("id", "slot").crossJoin(F.broadcast(first))
    return slots.select("slot", F.get("a", F.pmod("slot", F.size("a")).cast("int"))["p_partkey"].alias("p_partkey"), (1 + F.floor(uniform(F.lit("c"), F.col("slot").cast("string")) * 6)).alias("request"))


@query("select c_custkey, c_acctbal from customer order by c_acctbal desc, c_custkey limit (select count(*) // 2 from supplier)")
def capped_at_half_of_heldout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best by score, ties by id, as many as half of the held-out rows (a count that is known first)."""
    half = table(spark, sf_dir, "supplier").count() // 2
    return table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").limit(half)


@query(f"""
with r as (select l_orderkey, {_RN} (order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) - 1 as k from lineitem)
select k // 5000 as volume, count(*) as rows, min(l_orderkey) as first_key, max(l_orderkey) as last_key, printf('train__%05d', min(k)) as first_name from r group by 1
""")
def tar_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Volumes of 5,000 rows in key order.

    The global position is the position in a range partition plus the rows of the
    partitions before it, so no task sees all rows.
    """
    from tessella.sources.sinks import volume

    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    r = with_position(table(spark, sf_dir, "lineitem").select(*keys), keys)
    v = r.groupBy(volume(F.col("position")).alias("volume"))
    return v.agg(F.count("*").alias("rows"), F.min("l_orderkey").alias("first_key"), F.max("l_orderkey").alias("last_key"), F.format_string("train__%05d", F.min("position")).alias("first_name"))
