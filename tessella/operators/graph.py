"""Connected components of an undirected graph held as an edge table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.sources.shared import new_path, remove


#: Tasks that a hub's edges are dealt to, and the least number of edges that makes a hub.
SALTS, LEAST_HUB = 32, 64


def _with_minimum(edges: DataFrame, low: DataFrame, total: int) -> DataFrame:
    """edges (u, v) with m, the minimum of their u; low has (u, m, n), n the edges of u."""
    most = max(LEAST_HUB, total // 1000)
    # at most total / most hubs
    hubs = [r["u"] for r in low.where(F.col("n") > most).select("u").collect()]
    low = low.select("u", "m")
    if not hubs:
        return edges.join(low, "u")
    hub = F.col("u").isin(hubs)
    salted = edges.withColumn("salt", F.when(hub, F.pmod(F.xxhash64("v"), F.lit(SALTS))).otherwise(F.lit(0).cast("long")))
    every = F.when(hub, F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    return salted.join(low.withColumn("salt", F.explode(every)), ["u", "salt"]).drop("salt")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of edges; component is the smallest node reachable.

    Alternates the two star contractions (large star, then small star): each round
    hangs every node on the smallest neighbour it knows, so long chains halve and
    no round holds more edges than the input. The minimum per node is a map-side
    combined aggregate. A hub, which has over a thousandth of all edges, is dealt to SALTS
    tasks where its edges meet its minimum; there are at most 2,000 hubs however
    large the graph is. Each round is written to the shared folder and the table of
    the round before is deleted.

    Nodes that occur in no edge are not returned. Self loops and repeated edges are
    allowed; an edge with a null end is ignored. An empty table gives an empty result.
    """
    spark = edges.sparkSession
    kind = edges.schema[a].dataType
    run = uuid.uuid4().hex
    path = new_path(spark, f"components-{run}-0")
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull()
    )
    e.distinct().write.parquet(path)
    e = spark.read.parquet(path)
    total = e.count()
    if not total:
        return spark.createDataFrame([], edges.select(F.col(a).alias("node"), F.col(a).alias("component")).schema)
    before = None
    for k in range(1, max_rounds + 1):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = _with_minimum(both.where("v >= u"), low, 2 * total).select(F.col("v").alias("u"), F.col("m").alias("v"))
        # u > v from here on, or u = v for the smallest node of a star
        down = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = (
            _with_minimum(large, down, total)
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
            .select("x.*")
            .distinct()
        )
        now = new_path(spark, f"components-{run}-{k}")
        small.write.parquet(now)
        e = spark.read.parquet(now)
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        total = state[0]
        remove(spark, path)
        path = now
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.groupBy("u").agg(F.min("v").alias("component")).select(
        F.col("u").cast(kind).alias("node"), F.col("component").cast(kind).alias("component")
    )
