"""Incremental forms: resumed appends and decisions by key (our addition; the batch answers are the measure)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.sources.shared import new_path


def drain(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append all that a stream has now to Parquet at path, and stop. A run that broke off
    goes on from the checkpoint; rows are neither lost nor written twice."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()


def new_decisions(batch: DataFrame, decided: DataFrame, key: str) -> DataFrame:
    """Rows of batch whose key has no decision yet: resuming goes by key, not by counts."""
    return batch.join(decided.select(key).distinct(), key, "left_anti")


def append_merged(prior: DataFrame, batch: DataFrame) -> DataFrame:
    """Prior records and new ones; repeated ids stay repeated, counters are summed over both."""
    return prior.unionByName(batch, allowMissingColumns=True)


def daily_counts(events: DataFrame) -> DataFrame:
    """Rows per day and type."""
    return events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"))


def streamed_events(spark: SparkSession, directory: str) -> DataFrame:
    """events.parquet as a file stream; a row that comes again is dropped by its id.

    Event times become timestamps (of a session in UTC), as watermarks need them.
    """
    schema = spark.read.parquet(f"{directory}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(f"{directory}/events.parquet")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def deduplicated_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events through a checkpointed stream that keeps one row of each id."""
    path = new_path(spark, "stream")
    source = streamed_events(spark, sf_dir).withWatermark("ts", "60 days").dropDuplicatesWithinWatermark(["event_id"])
    drain(source, f"{path}/out", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/out")
