"""Resumable work, answered in batch and by a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.plans.registry import query, table
from tessella.streaming.resume import append_merged, daily_counts, deduplicated_stream, new_decisions


@query("select strftime(ts, '%Y-%m-%d') as day, event_type, count(*) as n from events group by all")
def streamed_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over what a checkpointed stream wrote."""
    return daily_counts(deduplicated_stream(spark, sf_dir)).select(F.date_format("day", "yyyy-MM-dd").alias("day"), "event_type", "n")


@query("select event_type, count(*) as open from events where user_id not in (select user_id from events where event_type = 'purchase' and value > 150) group by event_type")
def resume_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return new_decisions(e, e.where("event_type = 'purchase' and value > 150"), "user_id").groupBy("event_type").agg(F.count("*").alias("open"))


@query("""
select event_type, count(*) as records, count(distinct event_id) as ids from
 (select event_id, event_type from events where event_id % 3 <> 0 union all select event_id, event_type from events where event_id % 2 = 0) group by event_type
""")
def append_without_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return append_merged(e.where("event_id % 3 <> 0"), e.where("event_id % 2 = 0")).groupBy("event_type").agg(F.count("*").alias("records"), F.count_distinct("event_id").alias("ids"))
