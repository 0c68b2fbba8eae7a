"""Inventories: how much of each class's pool a release uses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators.ordering import exact_quantiles
from tessella.plans.registry import query, table


@query("""
with pool as (select p_type as class_name, count(*) as pool_cases from part group by p_type),
used as (
  select p_type as class_name, count(*) as instances, count(distinct l_orderkey) as images_with_class,
         count(distinct l_partkey) as used_cases
  from lineitem join part on l_partkey = p_partkey
  group by p_type)
select class_name, pool_cases, coalesce(used_cases, 0) as used_cases, pool_cases - coalesce(used_cases, 0) as unused_cases,
       coalesce(images_with_class, 0) as images_with_class, coalesce(instances, 0) as instances
from pool left join used using (class_name)
""")
def inventory_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per class: pool, distinct used and unused cases, images that hold it, instances."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("class_name"))
    line = table(spark, sf_dir, "lineitem")
    pool = part.groupBy("class_name").agg(F.count("*").alias("pool_cases"))
    used = (
        line.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("class_name")
        .agg(
            F.count("*").alias("instances"),
            F.count_distinct("l_orderkey").alias("images_with_class"),
            F.count_distinct("l_partkey").alias("used_cases"),
        )
    )
    n = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return pool.join(used, "class_name", "left").select(
        "class_name", "pool_cases", n("used_cases"),
        (F.col("pool_cases") - F.coalesce("used_cases", F.lit(0))).alias("unused_cases"),
        n("images_with_class"), n("instances"),
    )


def _instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instances with their class and subset: lineitem ⋈ part ⋈ orders."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("class_name"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("subset"))
    return line.join(part, "l_partkey").join(orders, "l_orderkey")


@query("select coalesce(p_type, 'TOTAL') as class_name, count(*) as instances, count(distinct l_orderkey) as images "
       "from lineitem join part on l_partkey = p_partkey group by rollup(p_type)")
def inventory_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouped counts with a totals row; the class column is never null in the pool."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return (
        line.join(part, "l_partkey")
        .rollup("p_type")
        .agg(F.count("*").alias("instances"), F.count_distinct("l_orderkey").alias("images"))
        .select(F.coalesce("p_type", F.lit("TOTAL")).alias("class_name"), "instances", "images")
    )


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query("select p_type as class_name, o_orderpriority as subset, count(*) as instances "
       "from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey group by all")
def class_by_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _instances(spark, sf_dir).groupBy("class_name", "subset").agg(F.count("*").alias("instances"))


@query("select p_type as class_name, " + ", ".join(f"count(*) filter (o_orderpriority = '{p}') as subset_{p[0]}" for p in PRIORITIES)
       + " from lineitem join part on l_partkey = p_partkey join orders on l_orderkey = o_orderkey group by p_type")
def class_by_subset_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two-level count as a matrix; the subsets are stated, so no pass looks for them."""
    wide = _instances(spark, sf_dir).groupBy("class_name").pivot("subset", list(PRIORITIES)).agg(F.count(F.lit(1)))
    return wide.select("class_name", *(F.coalesce(F.col(f"`{p}`"), F.lit(0)).alias(f"subset_{p[0]}") for p in PRIORITIES))


@query("""
with n as (select l_orderkey, least(count(*), 7) as k from lineitem group by l_orderkey)
select b.k::bigint as bucket, count(n.k) as images from range(1, 8) b(k) left join n on n.k = b.k group by b.k
""")
def instance_count_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images by number of instances, zero-filled over 1 to 6 and 7 or more."""
    n = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.least(F.count("*"), F.lit(7)).alias("bucket"))
    found = n.groupBy("bucket").agg(F.count("*").alias("images"))
    return spark.range(1, 8).toDF("bucket").join(found, "bucket", "left").select("bucket", F.coalesce("images", F.lit(0)).alias("images"))


@query("""
with n as (select l_orderkey, count(*) as k from lineitem group by l_orderkey), h as (select k, count(*) as images from n group by k)
select (select sum(k * images) from h)::bigint as from_histogram, (select count(*) from lineitem) as instances,
       (select sum(k * images) from h) = (select count(*) from lineitem) as consistent
""")
def histogram_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The histogram weighted by its buckets gives back the number of instances."""
    line = table(spark, sf_dir, "lineitem")
    h = line.groupBy("l_orderkey").agg(F.count("*").alias("k")).groupBy("k").agg(F.count("*").alias("images"))
    both = h.agg(F.sum(F.col("k") * F.col("images")).alias("from_histogram")).crossJoin(line.agg(F.count("*").alias("instances")))  # one row each
    return both.withColumn("consistent", F.col("from_histogram") == F.col("instances"))


@query("""
select count(*) as images, count(*) filter (classes > 1) as mixed, max(classes) as most_classes
from (select l_orderkey, count(distinct p_type) as classes from lineitem join part on l_partkey = p_partkey group by l_orderkey)
""")
def mixed_class_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("p_partkey"))
    classes = line.join(table(spark, sf_dir, "part").select("p_partkey", "p_type"), "p_partkey").groupBy("l_orderkey").agg(F.count_distinct("p_type").alias("n"))
    return classes.agg(F.count("*").alias("images"), F.count_if(F.col("n") > 1).alias("mixed"), F.max("n").alias("most_classes"))


@query("""
select user_id as shard, count(*) as attempts, count(*) filter (event_type = 'purchase') as passed,
       coalesce(round_even(count(*) filter (event_type = 'purchase') / nullif(count(*) filter (event_type <> 'view'), 0), 4), 0)::double as rate
from events group by user_id
""")
def pass_rate_by_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate of passes per shard, 0 where nothing was tried, half-even at four decimals."""
    passed, tried = F.count_if(F.col("event_type") == "purchase"), F.count_if(F.col("event_type") != "view")
    rate = F.coalesce(F.bround(F.try_divide(passed, tried), 4), F.lit(0.0))
    return table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("shard")).agg(F.count("*").alias("attempts"), passed.alias("passed"), rate.alias("rate"))


@query("""
select p_brand as class_name, count(*) as n, round(quantile_cont(l_extendedprice, 0.1), 6) as p10,
       round(quantile_cont(l_extendedprice, 0.5), 6) as p50, round(quantile_cont(l_extendedprice, 0.9), 6) as p90
from lineitem join part on l_partkey = p_partkey group by p_brand having count(*) >= 5
""")
def size_quantiles_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact interpolated quantiles of classes with at least five values."""
    line = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_extendedprice")
    rows = line.join(table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("class_name")), "p_partkey")
    q = exact_quantiles(rows, "class_name", "l_extendedprice", [0.1, 0.5, 0.9]).where("n >= 5")
    return q.select("class_name", "n", *(F.round(F.get("q", F.lit(i)), 6).alias(p) for i, p in enumerate(("p10", "p50", "p90"))))


@query("""
with v as (select s_nationkey as class_key, sqrt(l_extendedprice) as x from lineitem join supplier on l_suppkey = s_suppkey),
w as (select class_key, x, count(*) over p as n, quantile_cont(x, 0.1) over p as lo, quantile_cont(x, 0.9) over p as hi from v window p as (partition by class_key)),
f as (select class_key, any_value(n) as n, count(*) as fit_n, avg(x) as mean, stddev_samp(x) as sd, stddev_pop(x) as sd_pop, min(x) as least, max(x) as most
      from w where n < 10 or x between lo and hi group by class_key)
select class_key, n, fit_n, round(mean, 6) as mean,
       round(least(greatest(case when fit_n >= 5 then sd / mean else 0.2 end, 0.08), 0.35), 6) as cv, round(sd_pop / mean, 6) as cv_pop,
       round(greatest(least, mean * (1 - 2 * least(greatest(case when fit_n >= 5 then sd / mean else 0.2 end, 0.08), 0.35))), 6) as lower_bound,
       round(least(most, mean * (1 + 2 * least(greatest(case when fit_n >= 5 then sd / mean else 0.2 end, 0.08), 0.35))), 6) as upper_bound
from f
""")
def trimmed_scale_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and clipped variation of each class between its outer deciles.

    The deciles come from one aggregate that is joined back, not from a window that holds
    a class's rows. Variation is of the sample; cv_pop is that of the population.
    """
    line = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"), F.sqrt("l_extendedprice").alias("x"))
    v = line.join(table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("class_key")), "s_suppkey").select("class_key", "x")
    q = exact_quantiles(v, "class_key", "x", [0.1, 0.9])
    kept = v.join(q, "class_key").where((F.col("n") < 10) | F.col("x").between(F.get("q", F.lit(0)), F.get("q", F.lit(1))))
    f = kept.groupBy("class_key", "n").agg(
        F.count("*").alias("fit_n"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("sd"), F.stddev_pop("x").alias("sd_pop"), F.min("x").alias("least"), F.max("x").alias("most")
    )
    cv = F.least(F.greatest(F.when(F.col("fit_n") >= 5, F.col("sd") / F.col("mean")).otherwise(0.2), F.lit(0.08)), F.lit(0.35))
    return f.withColumn("c", cv).select(
        "class_key", "n", "fit_n", F.round("mean", 6).alias("mean"), F.round("c", 6).alias("cv"), F.round(F.col("sd_pop") / F.col("mean"), 6).alias("cv_pop"),
        F.round(F.greatest("least", F.col("mean") * (1 - 2 * F.col("c"))), 6).alias("lower_bound"),
        F.round(F.least("most", F.col("mean") * (1 + 2 * F.col("c"))), 6).alias("upper_bound"),
    )


@query("select p_type as class_name, round(median(l_extendedprice), 6) as median_price from lineitem join part on l_partkey = p_partkey group by p_type")
def median_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_extendedprice")
    joined = line.join(table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("class_name")), "p_partkey")
    q = exact_quantiles(joined, "class_name", "l_extendedprice", [0.5])
    return q.select("class_name", F.round(F.get("q", F.lit(0)), 6).alias("median_price"))


@query("select uses, count(*) as crops, (uses - 1) * count(*) as repeats from (select l_partkey, count(*) as uses from lineitem group by l_partkey) group by uses")
def use_count_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many crops are used once, twice, ...; repeats are the uses after the first."""
    uses = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("uses"))
    return uses.groupBy("uses").agg(F.count("*").alias("crops")).withColumn("repeats", (F.col("uses") - 1) * F.col("crops"))


@query("""
with pool as (select p_type, count(*) as n from part group by p_type),
u as (select l_partkey, p_type, count(*) as uses from lineitem join part on l_partkey = p_partkey group by all)
select p_type as class_name, count(*) as violations, max(uses) as most from u join pool using (p_type)
where uses > case when n >= 300 then 25 else 40 end group by p_type
""")
def use_cap_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crops used more often than allowed; large pools have the stricter cap."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("class_name"))
    uses = table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("uses"))
    cap = part.groupBy("class_name").agg(F.when(F.count("*") >= 300, 25).otherwise(40).alias("cap"))
    over = uses.join(part, "p_partkey").join(cap, "class_name").where("uses > cap")
    return over.groupBy("class_name").agg(F.count("*").alias("violations"), F.max("uses").alias("most"))


@query("select max(n) - min(n) as spread, max(n) - min(n) <= 200 as even from (select o_orderpriority, count(*) as n from orders group by o_orderpriority)")
def subset_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    spread = F.max("n") - F.min("n")
    return n.agg(spread.alias("spread"), (spread <= 200).alias("even"))


@query("select event_type as reason, sum(n)::bigint as n from (select user_id, event_type, count(*) as n from events group by all) group by event_type")
def merged_shard_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter maps of the shards (an open set of keys), exploded and summed up."""
    per = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    maps = per.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("counters"))
    return maps.select(F.explode("counters").alias("reason", "n")).groupBy("reason").agg(F.sum("n").alias("n"))


@query("""
select s_nationkey as scene, arg_max(s_suppkey, (s_acctbal, -s_suppkey)) as best, arg_min(s_suppkey, (s_acctbal, s_suppkey)) as worst from supplier group by s_nationkey
""")
def extreme_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row of the largest and of the smallest value; of equal ones the smaller key."""
    return table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("scene")).agg(
        F.max_by("s_suppkey", F.struct("s_acctbal", -F.col("s_suppkey"))).alias("best"), F.min_by("s_suppkey", F.struct("s_acctbal", "s_suppkey")).alias("worst")
    )


@query("select lang, count(*) as rows, sum(strlen(text))::bigint as bytes, sum(n_chars)::bigint as chars from documents group by lang")
def storage_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("lang").agg(
        F.count("*").alias("rows"), F.sum(F.octet_length("text").cast("long")).alias("bytes"), F.sum("n_chars").alias("chars")
    )
