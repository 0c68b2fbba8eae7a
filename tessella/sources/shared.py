"""Shared storage for intermediate tables.

Lineage is cut by writing Parquet below the folder that the session names in
``spark.checkpoint.dir``: every executor sees it and it survives their loss.
Only a local session without that setting (tests) gets a folder of its own; on a cluster
the setting is needed. Tables stay until remove() or scratch() deletes them, as results
read them when they are computed.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_own: str | None = None
_scratches: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only in a local session that sets none."""
    global _own
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{_SETTING} must name a folder that all executors share")
    if _own is None:
        _own = "file://" + tempfile.mkdtemp(prefix="tessella-")
    return _own


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/tessella/{name}-{uuid.uuid4().hex}"
    for made in _scratches:
        made.append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written once to the shared folder and read again."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path that new_path() gave, through Hadoop's file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def scratch(spark: SparkSession):
    """Paths that new_path() gives inside are deleted at the end, but for those taken from
    the list that this yields."""
    made: list[str] = []
    _scratches.append(made)
    try:
        yield made
    finally:
        _scratches[:] = [x for x in _scratches if x is not made]
        for path in made:
            remove(spark, path)
