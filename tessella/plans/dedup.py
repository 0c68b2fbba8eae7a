"""Exact and near duplicates of a pool's contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.operators.graph import connected_components
from tessella.operators.hamming import hamming_pairs, sign_bits
from tessella.plans.registry import query, table


def _contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2("text", 256).alias("h"))


@query("""
with g as (select sha256(text) as h, count(*) as n, count(distinct source) as k, bool_or(source = 'src0') and bool_or(source <> 'src0') as overlap from documents group by 1)
select count(*) as contents, count(*) filter (n > 1) as duplicated, sum(n - 1)::bigint as copies, count(*) filter (k > 1) as conflicts, count(*) filter (overlap) as overlaps,
       count(*) filter (n >= 1 and k = 1) as strict_unique from g
""")
def content_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents by hash: duplicated, under several classes, on both sides of the split."""
    held = F.col("source") == "src0"
    g = _contents(spark, sf_dir).groupBy("h").agg(F.count("*").alias("n"), F.count_distinct("source").alias("k"), (F.bool_or(held) & F.bool_or(~held)).alias("overlap"))
    return g.agg(
        F.count("*").alias("contents"), F.count_if(F.col("n") > 1).alias("duplicated"), F.sum(F.col("n") - 1).alias("copies"), F.count_if(F.col("k") > 1).alias("conflicts"),
        F.count_if("overlap").alias("overlaps"), F.count_if(F.col("k") == 1).alias("strict_unique"),
    )


@query("""
select sources, count(*) as contents from (select sha256(text) as h, string_agg(distinct source, '+' order by source) as sources from documents group by 1 having count(distinct source) > 1) group by sources
""")
def overlap_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which sources share contents, as sorted combinations (sources are few)."""
    g = _contents(spark, sf_dir).groupBy("h").agg(F.array_sort(F.collect_set("source")).alias("s")).where(F.size("s") > 1)
    return g.groupBy(F.array_join("s", "+").alias("sources")).agg(F.count("*").alias("contents"))


@query("select min(doc_id) as doc_id, any_value(source) as source from documents group by sha256(text) having count(distinct source) = 1")
def strict_unique_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document of each content that only one class has."""
    g = _contents(spark, sf_dir).groupBy("h").agg(F.min("doc_id").alias("doc_id"), F.min("source").alias("source"), F.max("source").alias("other"))
    return g.where("source = other").select("doc_id", "source")


@query("select doc_id, min(doc_id) over (partition by sha256(text)) as component from documents qualify count(*) over (partition by sha256(text)) > 1")
def components_of_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components over links from each copy to its group's first document."""
    d = _contents(spark, sf_dir)
    first = d.groupBy("h").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    links = d.join(first, "h").select(F.col("doc_id").alias("a"), F.col("first").alias("b"))
    return connected_components(links).select(F.col("node").alias("doc_id"), "component")


_BITS_SQL = "select vec_id, label, array_to_string(list_transform(embedding, lambda x: case when x > 0 then '1' else '0' end), '')::bit as b from embeddings"


@query(f"with e as ({_BITS_SQL}) select p.vec_id as a, q.vec_id as b, bit_count(xor(p.b, q.b))::int as distance from e p join e q on p.label = q.label and p.vec_id < q.vec_id where bit_count(xor(p.b, q.b)) <= 20")
def near_dup_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of one label whose 64 sign bits differ in at most 20."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", sign_bits("embedding").alias("bits"))
    return hamming_pairs(e, "vec_id", "bits", "label", 20)
