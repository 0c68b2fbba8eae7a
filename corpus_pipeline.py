"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all of docs, and returns a DataFrame that
is written as Parquet and read again as the next stage's docs. All but the last return the
columns of documents. An empty table passes through every stage as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessella.llm.common import table
from tessella.llm.decontam import decontaminate
from tessella.llm.packing import pack_documents
from tessella.llm.pii import sanitise
from tessella.llm.quality import keep_good
from tessella.llm.simhash import keep_one_of_each
from tessella.sources.shared import new_path, remove, scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near duplicates."""
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data, and terms that disclose it, masked."""
    return sanitise(docs, everywhere=True)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes in the training sequences."""
    # the stages share their workers, so this one holds fewer chunks
    return pack_documents(docs, remembered=24 << 20)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: Fingerprints, trained models and tokenizers have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last stage returns. Once a stage's result is written, the tables it was made
    from are deleted, so no unmasked text stays behind; the last one's pieces remain, as
    the result reads them."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        with scratch(spark) as made:
            result = stage(spark, docs, sf_dir)
            path = new_path(spark, name)
            result.write.parquet(path)
            made.remove(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if before:
            remove(spark, before)
        before = path
    packed = STAGES[-1][1](spark, docs, sf_dir)
    remove(spark, before)  # packing has written its pieces
    return packed
