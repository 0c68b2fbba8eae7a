"""Operators whose plans bound what one task holds, against plain answers on small inputs."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tessella.operators.contained import containing
from tessella.operators.folds import least_used_rotation
from tessella.operators.hamming import hamming_pairs
from tessella.operators.nearest import _bounds, _further, _looks, least_jittered
from tessella.operators.ordering import exact_quantiles, with_position
from tessella.plans import catalog
from tessella.plans.ranking import uniform


@pytest.mark.parametrize("most,block", [(4, 100), (12, 7), (12, 4000), (30, 10)])
def test_hamming_pairs(spark, most, block):
    rng = random.Random(most)
    base = [rng.getrandbits(64) for _ in range(6)]
    rows = [(i, rng.choice(base) ^ sum(1 << b for b in {rng.randrange(64) for _ in range(rng.randrange(7))}), i % 2) for i in range(90)]
    signed = [(i, c - (1 << 64) if c >> 63 else c, g) for i, c, g in rows] + [(None, 1, 1), (200, None, 1)]
    found = sorted(map(tuple, hamming_pairs(spark.createDataFrame(signed, "id long, c long, g int"), "id", "c", "g", most, block).collect()))
    assert found == sorted((a, b, (x ^ y).bit_count()) for a, x, g in rows for b, y, h in rows if a < b and g == h and (x ^ y).bit_count() <= most)


@pytest.mark.parametrize("rows_per_range", [5, 50_000])
def test_positions_within_groups_and_quantiles(spark, rows_per_range):
    rng = np.random.default_rng(3)
    rows = [(int(g), float(v)) for g, v in zip(rng.integers(0, 4, 300), rng.integers(0, 40, 300))] + [(9, 2.5), (8, None)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(6)
    for r in exact_quantiles(df, "g", "v", [0, 0.1, 0.5, 0.93, 1], rows_per_range).collect():
        own = [v for g, v in rows if g == r.g and v is not None]
        assert r.n == len(own) and np.allclose(r.q, np.quantile(own, [0, 0.1, 0.5, 0.93, 1]))
    found = with_position(df.where("v is not null"), ["v"], rows_per_range, "g").collect()
    for g in {g for g, _ in rows}:
        own = sorted((r.position, r.v) for r in found if r.g == g)
        assert [p for p, _ in own] == list(range(len(own))) and [v for _, v in own] == sorted(v for h, v in rows if h == g and v is not None)


@pytest.mark.parametrize("automaton_bytes", [1 << 20, 12])
def test_texts_that_contain_others(spark, automaton_bytes):
    items = [(1, "alpha beta"), (2, "solo"), (3, "pha"), (4, ""), (5, None), (6, "solo"), (7, "two words"), (8, "é日")]
    texts = ["alpha beta. gamma", "solo word here", "two wordsmith", None, "", "xé日x", "alphabeta"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    found = containing(docs, spark.createDataFrame(items, "item_id long, text string"), "doc_id", "text", "item_id", "text", ("lang",), automaton_bytes)
    assert found.columns == ["doc_id", "lang", "item"]
    assert sorted((r.doc_id, r.item) for r in found.collect()) == sorted((i, k) for i, t in enumerate(texts) for k, s in items if t is not None and s is not None and s in t)
    none = spark.createDataFrame([], "item_id long, text string")
    assert containing(docs, none, "doc_id", "text", "item_id", "text").count() == 0


def test_least_used_rotation_is_the_plain_loop(spark):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.choice("xy"), rng.choice("st"), rng.randrange(5), i) for i in range(160)]
    df = spark.createDataFrame(rows, "class string, subset string, source string, base int, id int")
    for limit in (7, 40, 500):
        found = {}
        for r in sorted(least_used_rotation(df, "class", "subset", "source", "base", "id", limit).collect(), key=lambda r: r.place):
            found.setdefault(r["class"], []).append(r.id)
        for c in "ab":
            buckets = {}
            for cls, subset, source, base, i in rows:
                if cls == c:
                    buckets.setdefault((subset, source), []).append((base, i))
            used, chosen = Counter(), []
            while len(chosen) < limit and any(buckets.values()):
                for key in sorted(buckets):
                    if buckets[key] and len(chosen) < limit:
                        k = min(range(len(buckets[key])), key=lambda j: used[key[1], buckets[key][j][0]])
                        base, i = buckets[key].pop(k)
                        used[key[1], base] += 1
                        chosen.append(i)
            assert found[c] == chosen


def drawn(*parts):
    return int(hashlib.sha256("|".join(map(str, parts)).encode()).hexdigest()[:8], 16) / 4294967296


@pytest.mark.parametrize("rows_per_block", [1, 3, 32])
def test_least_jittered_is_the_best_of_all_pairs(spark, rows_per_block):
    rng = random.Random(rows_per_block)
    odd = [None, math.nan, math.inf, -math.inf, -0.0, 1e15]
    # copies, a crowd at one place, hosts at the very limit and just beyond it, gaps with a crowd behind
    spots = [(i, g, rng.choice([7.25, 50.5, round(rng.uniform(-1000, 10000), 2)])) for i in range(150) for g in [rng.choice([1, 2])]]
    spots += [(900 + i, 3, 0.01) for i in range(70)] + [(980, 4, 100.0), (981, None, 1.0), (5, 1, 7.25), (5, 1, 7.25)] + [(990 + i, 2, v) for i, v in enumerate(odd)]
    hosts = [(i, rng.choice([1, 2]), round(rng.uniform(-1000, 10000), 2)) for i in range(120)] + [(200 + i, 3, v) for i, v in enumerate([6000.01, 6000.0100000000002, 6000.02, -5999.99, 0.01, 3000.0])]
    hosts += [(300, 4, 6100.0), (301, 4, 6100.01), (302, 5, 1.0), (303, None, 1.0), (0, 1, 40.0), (0, 1, 40.0), (0, 2, 9000.0)] + [(310 + i, 2, v) for i, v in enumerate(odd)]
    every = {}
    for h, g, a in hosts:
        for s, k, b in spots:
            if g is not None and g == k and a is not None and b is not None and abs(a - b) / 100 <= 60:
                every.setdefault(h, []).append((abs(a - b) / 100 + 1.5 * drawn("jitter", h, s), s, abs(a - b) / 100))
    frames = (spark.createDataFrame(rows, schema).repartition(3) for rows, schema in ((hosts, "host long, group int, at double"), (spots, "spot long, group int, at double")))
    draw = lambda host, spot: uniform(F.lit("jitter"), host.cast("string"), spot.cast("string"))
    found = least_jittered(*frames, draw, 100, 1.5, 60, rows_per_block).collect()
    assert sorted(map(tuple, found)) == sorted((h, *min(o)[1:], len(o)) for h, o in every.items())


def test_looks_into_many_equal_blocks_leave_in_small_batches(spark):
    import pyarrow as pa

    rows = [(1, k, 5.0, 5.0, 32) for k in range(2_000)] + [(1, 2_000, 90.0, 95.0, 32)]
    bounds = _bounds(spark.createDataFrame(rows, "group int, block long, least double, most double, n long"))
    hosts = pa.record_batch({"group": [1] * 300, "at": [5.0 + i / 1000 for i in range(300)], "bound": [2.0] * 300})
    # each host has all equal blocks to look into but the nearest, and where the limit falls on them, all
    found = list(_further(bounds, 1.0)([hosts]))
    assert sum(map(len, found)) == 300 * 1_999 and max(map(len, found)) <= 102_000
    at_limit = pa.record_batch({"group": [1] * 300, "at": [15.0] * 300})
    found = list(_looks(bounds, 10.0)([at_limit]))
    assert sum(map(len, found)) == 300 * 2_001 and max(map(len, found)) <= 103_000


def joined_rows(spark, since):
    """Rows that joins made in the SQL executions from number `since` on."""
    store, total = spark._jsparkSession.sharedState().statusStore(), 0
    for k in range(since, store.executionsCount()):
        e = store.executionsList().apply(k).executionId()
        values, nodes = store.executionMetrics(e), store.planGraph(e).allNodes()
        for node in (nodes.apply(i) for i in range(nodes.size())):
            for m in (node.metrics().apply(i) for i in range(node.metrics().size())):
                if "Join" in node.name() and m.name() == "number of output rows" and values.contains(m.accumulatorId()):
                    total += int(values.apply(m.accumulatorId()).replace(",", ""))
    return total


def test_jittered_choice_doesnt_pair_all_hosts_and_spots(spark, tmp_path):
    n = 3000
    balance = "(id * 7919 % 10007) / 1d"
    spark.range(n).selectExpr("id as c_custkey", "1 as c_nationkey", f"{balance} as c_acctbal").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(n).selectExpr("id as s_suppkey", "1 as s_nationkey", f"{balance} + 0.5 as s_acctbal").write.parquet(f"{tmp_path}/supplier.parquet")
    since = spark._jsparkSession.sharedState().statusStore().executionsCount()
    found = catalog.queries()["jittered_choice"](spark, str(tmp_path)).collect()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    at = np.arange(n) * 7919 % 10007
    assert len(found) == n and all(r.options == np.count_nonzero(np.abs(at[r.host] - at - 0.5) <= 6000) for r in found)
    # a row of the new joins holds a block of 32 spots
    assert n < 32 * joined_rows(spark, since) < n * n / 10
