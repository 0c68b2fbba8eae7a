"""Fingerprints against sets of shingles, and ranges against a plain sort."""

import hashlib

import numpy as np
import pytest
from tessella.llm import sketches

RNG = np.random.default_rng(21)


def prose(n):
    return " ".join(f"v{i}" for i in RNG.integers(0, 4000, n))


def shingles(text):
    w = text.lower().split()
    n = min(5, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


@pytest.mark.parametrize("range_bytes", [1 << 24, 3000, 200])
def test_neighbours_over_many_ranges(spark, range_bytes):
    texts = [prose(int(n)) for n in RNG.integers(0, 60, 90)] + [None, "", "one", prose(3000)]
    rows = [(int(i) * 3 - 20, t) for i, t in zip(RNG.permutation(len(texts)), texts)]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(5)
    found = {r.doc_id: r for r in sketches.compare_with_neighbours(docs, range_bytes=range_bytes).collect()}
    by_id = {i: t or "" for i, t in rows}
    order = sorted(by_id, reverse=True)
    assert sorted(found) == sorted(by_id)
    for i, following in zip(order, [*order[1:], order[0]]):
        t, n = by_id[i], len(by_id[i]) // 3
        e = t[: len(t) - n] + by_id[following][:n]
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert r.near_next == sketches.likeness(r.fingerprint, found[following].fingerprint)
        assert (r.contained_edited, r.contained_next) == (sketches.containment(r.fingerprint, r.edited_fingerprint), sketches.containment(r.fingerprint, found[following].fingerprint))


@pytest.mark.parametrize("range_bytes", [1 << 24, 300])
def test_rows_of_one_id_and_of_none(spark, range_bytes):
    rows = [(5, prose(20)) for _ in range(40)] + [(None, prose(9)) for _ in range(20)] + [(5, "same text")] * 30 + [(6, None)] * 3
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, range string")
    found = sketches.compare_with_neighbours(docs, range_bytes=range_bytes).collect()
    assert sorted((r.doc_id or 0, r.n_chars) for r in found) == sorted((i or 0, len(t or "")) for i, t in rows)
    assert sum(r.near_next == 1.0 for r in found) >= 29 + 2
    with pytest.raises(TypeError):
        sketches.compare_with_neighbours(docs.selectExpr("cast(doc_id as string) doc_id", "text"))
    assert sketches.compare_with_neighbours(docs.limit(0)).count() == 0


def test_estimates_follow_the_shingles():
    sketcher, off, empty = sketches.Sketcher(), [], 0
    f = lambda t: sketches.to_fingerprint(t, sketcher.sketch(t))
    for _ in range(200):
        a = prose(400)
        cut = int(RNG.integers(50, 350))
        b = " ".join(a.split()[:cut]) + " " + prose(int(RNG.integers(10, 300)))
        x, y = shingles(a), shingles(b)
        off.append((sketches.likeness(f(a), f(b)) - len(x & y) / len(x | y), len(x | y), len(x & y) / len(x | y)))
        assert abs(sketches.containment(f(a), f(b)) - len(x & y) / len(x)) < 0.25
    # a standard error of sqrt(r (1 - r) 4 / u), as stated
    scaled = [d / np.sqrt(max(r * (1 - r), 0.01) * 4 / u) for d, u, r in off]
    assert 0.7 < np.std(scaled) < 1.3 and abs(np.mean(scaled)) < 0.25
    for _ in range(2000):
        empty += not len(sketcher.sketch(prose(9)))
    assert abs(empty / 2000 - 0.75**5) < 0.04
