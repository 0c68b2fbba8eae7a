"""The suffix sort itself against Python's order of bytes, and ids that repeat."""

import hashlib

import brute_force as brute
import numpy as np
import pytest
from tessella.llm import substrings

RNG = np.random.default_rng(9)


def contexts(m):
    """Rows of one bucket that share stretches of many lengths around the anchor."""
    base = bytes(RNG.integers(97, 100, 181).astype(np.uint8))
    out = []
    for _ in range(m):
        body = bytearray(base)
        for p in RNG.integers(0, 181, int(RNG.integers(0, 4))):
            body[p] = 120
        low, high = int(RNG.integers(0, 40)), int(RNG.integers(140, 181))
        out.append((bytes(body[low:high]), 80 - low))
    return out


def test_order_and_common_extensions():
    rows = contexts(80)
    sizes = np.array([len(c) for c, _ in rows])
    left = np.array([p for _, p in rows])
    begin = left.max() - left
    data = np.zeros((80, int((begin + sizes).max())), np.uint8)
    for i, (c, _) in enumerate(rows):
        data[i, begin[i] : begin[i] + len(c)] = np.frombuffer(c, np.uint8)
    column = np.full(80, left.max() - 30)
    suffixes = substrings._Suffixes(data, np.arange(80), column, begin + sizes - column, substrings._prefix_hashes(data))
    texts = [c[p - 30 :] for c, p in rows]
    order = substrings._mergesort(suffixes, np.arange(80), np.zeros(80, np.int64), np.full(80, 80))
    assert order.tolist() == sorted(range(80), key=lambda i: (texts[i], i))
    for x, y in zip(order[1:].tolist(), order[:-1].tolist()):
        a, b = texts[x], texts[y]
        n = next((k for k, (u, v) in enumerate(zip(a, b)) if u != v), min(len(a), len(b)))
        assert suffixes.common(np.array([x]), np.array([y]))[0] == n


def test_repeats_come_from_the_earliest():
    rows = contexts(60)
    key = np.arange(60)
    found = substrings.repeats(np.zeros(60, np.int64), [c for c, _ in rows], np.array([p for _, p in rows]), key, np.full(60, 500))
    want = {}
    for i, (c, p) in enumerate(rows):
        hits = [k for k in range(len(c) - 99) if any(c[k : k + 100] == d[k - p + q : k - p + q + 100] and k - p + q >= 0 for d, q in rows[:i])]
        if hits:
            want[i] = (500 - p + hits[0], 500 - p + hits[-1] + 100)
    assert {int(r): (int(a), int(b)) for r, a, b, _ in zip(*found)} == want


@pytest.mark.parametrize("limits", [{}, {"hot": 1, "very_hot": 3}])
def test_rows_that_share_an_id_lose_no_repeat(spark, limits):
    words = [f"w{i}" for i in range(200)]
    prose = lambda n: " ".join(RNG.choice(words, n))
    line = prose(60)
    rows = [(1, prose(50) + line), (1, prose(90)), (2, line + prose(30)), (2, prose(40) + line), (3, prose(20) + line + prose(20)), (4, line)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(map(tuple, substrings.remove_repeats(docs, **limits).select("doc_id", "n_removed", "kept_sha256").collect()))
    # different texts under one id are documents of their own, in one order or the other
    orders = [[0, 1, 2, 3, 4, 5], [0, 1, 3, 2, 4, 5]]
    wants = []
    for order in orders:
        judged = brute.repeated_bytes({k: rows[i][1] for k, i in enumerate(order)})
        wants.append(sorted((rows[i][0], judged[k][1], hashlib.sha256(judged[k][3]).hexdigest()) for k, i in enumerate(order)))
    assert found in wants
    with pytest.raises(TypeError):
        substrings.repeated_spans(docs.selectExpr("cast(doc_id as string) doc_id", "text"))
