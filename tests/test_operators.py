"""Operators on small cases whose answers can be read off."""

import random

import pytest
from pyspark.sql import functions as F
from tessella.functions.boxes import clipped, conflicts, hbb_line
from tessella.functions.gates import first_reason, reasons
from tessella.operators import graph
from tessella.operators.folds import budget
from tessella.operators.graph import connected_components
from tessella.operators.ordering import with_position
from tessella.sources.sinks import checksum_mismatches, checksums, delete_prefix, label_text, upsert, write_jsonl


def test_components_of_chains_stars_and_loops(spark):
    edges = [(1, 2), (2, 3), (5, 6), (9, 9), (6, 5), (None, 1)] + [(100 + i, 101 + i) for i in range(60)] + [(300, 400 + i) for i in range(50)]
    random.Random(1).shuffle(edges)
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert [found[n] for n in (1, 2, 3, 5, 6)] == [1, 1, 1, 5, 5]
    assert {found[100 + i] for i in range(61)} == {100} and {found[400 + i] for i in range(50)} == {300}


@pytest.mark.parametrize("least", [2, 64])
def test_components_of_hubs_chains_and_rings_together(spark, monkeypatch, least):
    """Hubs are dealt to several tasks; every answer is held against union-find."""
    monkeypatch.setattr(graph, "LEAST_HUB", least)
    rng = random.Random(7)
    edges = [(5000, i) for i in range(5001, 5400)] + [(i, i + 1) for i in range(2000, 2150)] + [(3000 + i, 3000 + (i + 1) % 40) for i in range(40)]
    edges += [(rng.randrange(900), rng.randrange(900)) for _ in range(500)] + [(5390, 2100), (20, 9000), (9000, 9500)]
    label = {}

    def root(x):
        label.setdefault(x, x)
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        label[max(a, b)] = min(a, b)
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long").repartition(5)).collect()}
    assert found == {x: root(x) for x in label}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_budget_skips_what_does_not_fit(spark):
    df = spark.createDataFrame([(1, 1, 1500.0), (1, 2, 600.0), (1, 3, 400.0), (2, 1, None)], "g int, o int, v double")
    assert {r.g: (r.fold.used, r.fold.n) for r in budget(df, "g", ["o"], "v", 2000.0).collect()} == {1: (1900.0, 2), 2: (0.0, 0)}


def test_positions_are_global(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(100)], "a long, b long")
    found = sorted((r.position, r.a, r.b) for r in with_position(df, ["a", "b"], rows_per_range=9).collect())
    assert found == [(k, *x) for k, x in enumerate(sorted((i % 7, i) for i in range(100)))]


def test_boxes(spark):
    one = spark.range(1)
    box = lambda *v: tuple(F.lit(x) for x in v)
    got = one.select(
        conflicts(box(0, 0, 10, 10), box(18, 0, 28, 10), 8), conflicts(box(0, 0, 10, 10), box(17, 0, 27, 10), 8),
        hbb_line(*map(F.lit, (3, 0, 0, 16, 16, 1024, 1024))), clipped(*map(F.lit, (-2.5, 3.2, 10.0, 0.1, 100, 100))),
    ).first()
    assert got[:3] == (False, True, "3 0.007812 0.007812 0.015625 0.015625") and tuple(got[3]) == (0, 3, 8, 4)


def test_gates(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 1)], "id int, x int")
    rules = (("big", F.col("x") > 3), ("odd", F.col("x") % 2 == 1))
    assert {r[0]: (r[1], r[2]) for r in df.select("id", reasons(*rules), first_reason(*rules)).collect()} == {1: (["big", "odd"], "big"), 2: ([], None), 3: (["odd"], "odd")}


def test_sinks(spark, tmp_path):
    old = spark.createDataFrame([("a1", 1), ("b1", 2)], "id string, v int")
    new = spark.createDataFrame([("b1", 3), ("c1", None)], "id string, v int")
    both = upsert(old, new, ["id"])
    assert sorted(both.collect()) == sorted([("a1", 1), ("b1", 3), ("c1", None)], key=lambda r: r[0]) or both.count() == 3
    assert delete_prefix(both, "id", "b").count() == 2
    write_jsonl(both.coalesce(1), str(tmp_path / "out"))
    lines = "".join(p.read_text() for p in (tmp_path / "out").glob("*.json"))
    assert '{"id":"c1","v":null}' in lines
    sums = checksums(spark, str(tmp_path / "out"))
    assert checksum_mismatches(spark, str(tmp_path / "out"), sums.select("path", "sha256")).count() == 0
    text = spark.range(1).select(label_text(F.array(F.lit("s")), F.array(F.lit(None).cast("string"), F.lit("o")))).first()[0]
    assert text == "s\no"


def test_scratch_tables_go(spark):
    from tessella.sources import shared

    with shared.scratch(spark) as made:
        gone = shared.written(spark.range(3), "gone")
        stays = shared.written(gone.select((F.col("id") + 1).alias("id")), "stays")
        made.pop()
    assert stays.count() == 3
    with pytest.raises(Exception):
        spark.read.parquet(made[0])
    shared.remove(spark, stays.inputFiles()[0].rsplit("/", 1)[0])
