"""Quotas, retries and choices that depend on what was chosen before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators.folds import least_used_rotation
from tessella.operators.nearest import least_jittered
from tessella.plans.ranking import _UNIFORM_SQL, uniform
from tessella.plans.registry import query, table


@query("""
with r as (select user_id, event_type, row_number() over (partition by user_id order by event_id) as n, event_type = 'purchase' as passed, event_id from events)
select user_id as shard, max(n) as attempts, count(*) filter (passed) as accepted, max(n) filter (passed) as last_accepted_attempt, count(*) filter (event_type = 'error') as failed_error, count(*) filter (event_type = 'view') as failed_view from r group by user_id
""")
def restored_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A shard's counters from its append log: attempts, accepted rows, failures by reason."""
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id")
    r = e.withColumn("n", F.expr("row_number() over (partition by user_id order by event_id)"))
    passed = F.col("event_type") == "purchase"
    return r.groupBy(F.col("user_id").alias("shard")).agg(
        F.max("n").alias("attempts"), F.count_if(passed).alias("accepted"), F.max(F.when(passed, F.col("n"))).alias("last_accepted_attempt"),
        F.count_if(F.col("event_type") == "error").alias("failed_error"), F.count_if(F.col("event_type") == "view").alias("failed_view"),
    )


@query("""
with p as (select user_id as shard, count(*) filter (event_type = 'purchase') as images, max(event_id) % 2 = 0 as completed, 3 as goal from events group by 1)
select shard, images, case when completed and images >= goal then 'skip' when images > 0 then 'resume' else 'start' end as action, greatest(goal - images, 0) as missing from p
""")
def shard_resumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a restarted run does with each shard: skip it if it completed for the same goal."""
    p = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("shard")).agg(F.count_if(F.col("event_type") == "purchase").alias("images"), (F.max("event_id") % 2 == 0).alias("completed"))
    done = F.col("completed") & (F.col("images") >= 3)
    return p.select("shard", "images", F.when(done, "skip").when(F.col("images") > 0, "resume").otherwise("start").alias("action"), F.greatest(3 - F.col("images"), F.lit(0)).alias("missing"))


@query("""
with q as (select class_name, 5 + row_number() over (order by class_name) as quota from (select distinct p_type as class_name from part)),
a as (select p_type as class_name, p_retailprice % 7 < 5 as ok, row_number() over (partition by p_type order by p_partkey) as attempt from part),
g as (select class_name, attempt, ok, sum(ok::int) over (partition by class_name order by attempt) as passed from a),
d as (select class_name, min(attempt) filter (passed = quota and ok) as needed, max(passed) as most, max(quota) as quota from g join q using (class_name) where attempt <= 4 * quota group by class_name)
select class_name, quota, least(most, quota)::bigint as accepted, coalesce(needed, 4 * quota) as attempts, most < quota as short from d
""")
def quota_loop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts in order until each class's quota is filled, four times the quota at most."""
    part = table(spark, sf_dir, "part").select(F.col("p_type").alias("class_name"), (F.col("p_retailprice") % 7 < 5).alias("ok"), "p_partkey")
    # one row a class
    names = part.select("class_name").distinct().withColumn("quota", 5 + F.expr("row_number() over (order by class_name)"))
    a = part.withColumn("attempt", F.expr("row_number() over (partition by class_name order by p_partkey)")).join(F.broadcast(names), "class_name").where(F.col("attempt") <= 4 * F.col("quota"))
    g = a.withColumn("passed", F.expr("sum(cast(ok as int)) over (partition by class_name order by attempt)"))
    d = g.groupBy("class_name", "quota").agg(F.min(F.when((F.col("passed") == F.col("quota")) & F.col("ok"), F.col("attempt"))).alias("needed"), F.max("passed").alias("most"))
    return d.select("class_name", "quota", F.least("most", "quota").alias("accepted"), F.coalesce("needed", 4 * F.col("quota")).alias("attempts"), (F.col("most") < F.col("quota")).alias("short"))


_TRIAL = "concat_ws('|', 'slot', p_partkey, trial)"


@query(f"""
with t as (select p_partkey, p_type, trial, {_UNIFORM_SQL.format(_TRIAL)} as u from part, range(1, 25) r(trial)),
v as (select *, case when u < 0.6 then 'scale_bounds' when u < 0.85 then 'image_area_budget' when u < 0.95 then 'no_safe_position' end as reason from t),
f as (select p_partkey, min(trial) filter (reason is null) as first from v group by 1)
select v.p_type as class_name, coalesce(v.reason, 'accepted') as outcome, count(*) as trials, count(distinct p_partkey) as slots from v join f using (p_partkey) where v.trial <= coalesce(first, 24) group by all
""")
def slot_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to 24 trials a slot, the first success ends it; failures are counted by reason. A
    trial's draw comes from a hash, so trials need no order; each slot is one row's array."""
    u = uniform(F.lit("slot"), F.col("p_partkey").cast("string"), F.col("trial").cast("string"))
    t = table(spark, sf_dir, "part").select("p_partkey", "p_type", F.explode(F.sequence(F.lit(1), F.lit(24))).alias("trial")).withColumn("u", u)
    v = t.withColumn("reason", F.when(F.col("u") < 0.6, "scale_bounds").when(F.col("u") < 0.85, "image_area_budget").when(F.col("u") < 0.95, "no_safe_position"))
    tried = v.groupBy("p_partkey", "p_type").agg(F.array_sort(F.collect_list(F.struct("trial", "reason"))).alias("t"))
    until = F.coalesce(F.get(F.filter("t", lambda x: x["reason"].isNull()), F.lit(0))["trial"], F.lit(24))
    used = tried.select("p_partkey", "p_type", F.explode(F.slice("t", F.lit(1), until)).alias("x"))
    return used.groupBy(F.col("p_type").alias("class_name"), F.coalesce("x.reason", F.lit("accepted")).alias("outcome")).agg(F.count("*").alias("trials"), F.count_distinct("p_partkey").alias("slots"))


@query("""
with i as (select l_orderkey as image, p_type as class_name, l_discount < 0.08 as survives, l_linenumber = 1 as primary_slot from lineitem join part on l_partkey = p_partkey),
g as (select image, max(class_name) filter (primary_slot) as wanted, list(class_name) filter (survives) as left_ from i group by image)
select case when wanted is null then 'no_primary' when left_ is null then 'zero_instances' when not list_contains(left_, wanted) then 'primary_class_removed' else 'kept' end as outcome, count(*) as images from g group by 1
""")
def primary_class_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images kept only if their first slot's class survived the last gate."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("c"))
    i = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_discount", "l_linenumber").join(part, "l_partkey")
    survivors = F.collect_list(F.when(F.col("l_discount") < 0.08, F.col("c")))
    g = i.groupBy("l_orderkey").agg(F.max(F.when(F.col("l_linenumber") == 1, F.col("c"))).alias("wanted"), survivors.alias("left"))
    outcome = F.when(F.col("wanted").isNull(), "no_primary").when(F.size("left") == 0, "zero_instances").when(~F.array_contains("left", F.col("wanted")), "primary_class_removed").otherwise("kept")
    return g.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("images"))


@query("""
with c as (select p_type as class_name, count(*) as pool, count(*) filter (p_size > 25) as counts, count(*) filter (p_size % 3 = 0) as successes, count(*) filter (p_size % 2 = 0) as trials from part group by 1),
t as (select sum(pool::double) as w, sum(counts) as s, sum(sqrt(pool::double)) as r from c)
select class_name, round(1 / sqrt(counts + 10), 9) as fixed, round(sqrt(pool) * greatest(0.4, least(12, sqrt((sqrt(pool) / r * (s + 100) / (counts + 100 * sqrt(pool) / r)) * 0.1 / ((successes + 2) / (trials + 20)::double)))), 9) as boosted,
  round(greatest(0.02, pool / w * (s + 100) - counts) / pow(greatest(0.1, (successes + 2) / (trials + 20)::double), 0.4), 9) as by_gap from c, t
""")
def sampling_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three policies of class weights from one state: fixed in the number so far; pool
    size by difficulty; the gap to an explicit share by success rate."""
    c = table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("class_name")).agg(
        F.count("*").alias("pool"), F.count_if(F.col("p_size") > 25).alias("counts"),
        F.count_if(F.col("p_size") % 3 == 0).alias("successes"), F.count_if(F.col("p_size") % 2 == 0).alias("trials"),
    )
    totals = c.agg(F.sum("pool").alias("w"), F.sum("counts").alias("s"), F.sum(F.sqrt("pool")).alias("r"))  # one row
    base, rate = F.sqrt("pool"), (F.col("successes") + 2) / (F.col("trials") + 20)
    share = base / F.col("r")
    deficit = share * (F.col("s") + 100) / (F.col("counts") + 100 * share)
    boost = F.greatest(F.lit(0.4), F.least(F.lit(12.0), F.sqrt(deficit * 0.1 / rate)))
    gap = F.greatest(F.lit(0.02), F.col("pool") / F.col("w") * (F.col("s") + 100) - F.col("counts"))
    return c.crossJoin(totals).select(
        "class_name", F.round(1 / F.sqrt(F.col("counts") + 10), 9).alias("fixed"), F.round(base * boost, 9).alias("boosted"), F.round(gap / F.pow(F.greatest(F.lit(0.1), rate), F.lit(0.4)), 9).alias("by_gap")
    )


_OPTION = "concat_ws('|', 'option', l_orderkey, p_partkey)"


@query(f"""
with used as (select l_partkey, count(*) as n from lineitem group by 1),
o as (select distinct l_orderkey from lineitem where l_linenumber = 1), d as (select l_orderkey, (l_orderkey + j * 37) % (select count(*) from part) as p_partkey, j from o, range(0, 12) r(j)),
e as (select l_orderkey, p_partkey, coalesce(n, 0) as n, {_UNIFORM_SQL.format(_OPTION)} as u from (select distinct l_orderkey, p_partkey from d) left join used on l_partkey = p_partkey),
s as (select *, row_number() over (partition by l_orderkey order by u, p_partkey) as k from e)
select l_orderkey as slot, arg_min(p_partkey, (n, u, p_partkey)) as crop, min(n) as uses from s where k <= 8 group by 1
""")
def least_used_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of up to eight eligible crops drawn for a slot, the one used least so far."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    used = line.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"))
    size = table(spark, sf_dir, "part").count()
    slots = line.where("l_linenumber = 1").select("l_orderkey").distinct()
    drawn = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(11)), lambda j: (F.col("l_orderkey") + j * 37) % size))
    e = slots.select("l_orderkey", F.explode(drawn).alias("p_partkey")).join(used, "p_partkey", "left")
    e = e.select("l_orderkey", F.struct(uniform(F.lit("option"), F.col("l_orderkey").cast("string"), F.col("p_partkey").cast("string")).alias("u"), "p_partkey", F.coalesce("n", F.lit(0)).alias("n")).alias("x"))
    eight = e.groupBy("l_orderkey").agg(F.slice(F.array_sort(F.collect_list("x")), 1, 8).alias("o"))
    best = F.array_min(F.transform("o", lambda x: F.struct(x["n"].alias("n"), x["u"].alias("u"), x["p_partkey"].alias("p_partkey"))))
    return eight.select(F.col("l_orderkey").alias("slot"), best["p_partkey"].alias("crop"), best["n"].alias("uses"))


@query(None)
def least_used_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty review examples a class, one bucket after another, of each bucket the row whose
    original crop was shown least so far. Each choice depends on those before, so a class is
    one fold; SQL can't say it, a test holds it against a loop."""
    part = table(spark, sf_dir, "part").select(F.col("p_type").alias("class_name"), F.col("p_brand").alias("subset"), (F.col("p_size") % 3).alias("source"), (F.col("p_partkey") % 40).alias("base"), F.col("p_partkey").alias("id"))
    return least_used_rotation(part, "class_name", "subset", "source", "base", "id", 20)


@query(f"""
with o as (select c_custkey as host, s_suppkey as spot, abs(c_acctbal - s_acctbal) / 100 as score, {_UNIFORM_SQL.format("concat_ws('|', 'jitter', c_custkey, s_suppkey)")} as u from customer join supplier on s_nationkey = c_nationkey),
g as (select host, spot, score, score + 1.5 * u as jittered, count(*) over (partition by host) as options, row_number() over (partition by host order by score + 1.5 * u, spot) as k from o where score <= 60)
select host, spot, round(score, 6) as score, options from g where k = 1
""")
def jittered_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each host's passing spot of least score, scores varied by a hash-derived draw. Spots
    that can't win are counted by blocks and never drawn for."""
    c, s = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    hosts = c.select(F.col("c_custkey").alias("host"), F.col("c_nationkey").alias("group"), F.col("c_acctbal").alias("at"))
    spots = s.select(F.col("s_suppkey").alias("spot"), F.col("s_nationkey").alias("group"), F.col("s_acctbal").alias("at"))
    draw = lambda host, spot: uniform(F.lit("jitter"), host.cast("string"), spot.cast("string"))
    best = least_jittered(hosts, spots, draw, scale=100, width=1.5, limit=60)
    return best.select("host", "spot", F.round("score", 6).alias("score"), "options")


@query("select p_partkey as id, 1 + (p_partkey % 6) as cycle_class, case when (p_partkey + 1) % 5 = 1 then 'fixed' else 'innar_train' end as source, 20260928 + 7 * (p_partkey % 6) as shard_seed, round((('0x' || substr(sha256(concat_ws('|', 20260928 + 7 * (p_partkey % 6), p_partkey)), 1, 8))::bigint / 4294967296.0::double), 9) as draw from part")
def seeded_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes in turn, every fifth row from another source, a seed for each shard and draws from it."""
    k = F.col("p_partkey") % 6
    seed = 20260928 + 7 * k
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), (1 + k).alias("cycle_class"), F.when((F.col("p_partkey") + 1) % 5 == 1, "fixed").otherwise("innar_train").alias("source"),
        seed.alias("shard_seed"), F.round(uniform(seed.cast("string"), F.col("p_partkey").cast("string")), 9).alias("draw"),
    )


@query("""
with r as (select user_id as shard, ts, row_number() over (partition by user_id order by event_id) as n, sum((event_type = 'purchase')::int) over (partition by user_id order by event_id) as images from events)
select shard, n as attempts, images::bigint as images, round_even(images / n, 4)::double as rate from r where n % 10 = 0
""")
def progress_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The progress a shard notes at every tenth attempt."""
    e = table(spark, sf_dir, "events")
    r = e.select(
        F.col("user_id").alias("shard"), F.expr("row_number() over (partition by user_id order by event_id)").alias("attempts"),
        F.expr("sum(cast(event_type = 'purchase' as int)) over (partition by user_id order by event_id)").alias("images"),
    )
    return r.where("attempts % 10 = 0").withColumn("rate", F.bround(F.col("images") / F.col("attempts"), 4))
