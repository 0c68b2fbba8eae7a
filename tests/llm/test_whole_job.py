"""Inputs on which the operators once did less than the whole job."""

import re
from collections import Counter

import brute_force as brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from tessella.llm import pii, quality

RNG = np.random.default_rng(12)


def prose(n):
    return " ".join(f"word{i}" for i in RNG.integers(0, 300, n))


@pytest.mark.parametrize("broadcast_terms", [100, 0])
def test_copies_hide_no_disclosed_term(spark, broadcast_terms):
    near = [f"mail zorblax {prose(3)} bob@x.example.com {prose(60)} {i}" for i in range(3)]
    texts = [near[0]] * 40 + near[1:] + ["ZORBLAX alone " + prose(20)] * 40
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    found = pii.disclosed_terms(pii._scanned(docs, "text", ["doc_id"]), docs, broadcast_terms=broadcast_terms)
    assert [r.posterior for r in found.collect() if r.term == "zorblax"] == [0.75]  # 3 of 4 different texts


@pytest.mark.parametrize("broadcast_terms", [100, 0])
def test_disclosed_terms_are_masked_everywhere(spark, broadcast_terms):
    texts = [f"mail zorblax {prose(3)} bob@x.example.com {prose(60)} Zorblax again, zorblax@y.example.org {i}" for i in range(4)]
    texts += ["only ZORBLAX here, zorblaxes too", None]
    docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    kinds = {"everywhere": True, "broadcast_terms": broadcast_terms}
    for r in pii.find_personal_data(docs, **kinds).collect():
        want = [m.span() for m in re.finditer(r"\bzorblax\b(?!@)", texts[r.doc_id] or "", re.I)]
        assert [(t.start, t.end) for t in r.terms if texts[r.doc_id][t.start : t.end].lower() == "zorblax"] == want
    clean = {r.doc_id: r for r in pii.sanitise(docs, **kinds).collect()}
    assert clean[4].text == "only [TERM] here, zorblaxes too" and clean[5].text is None
    assert all(r.n_chars == len(r.text or "") and not re.search(r"\bzorblax\b", r.text or "", re.I) for r in clean.values())


def test_query_and_pipeline_mask_everywhere(spark, tmp_path):
    import corpus_pipeline

    texts = [f"mail zorblax {prose(3)} bob@x.example.com {prose(60)} {i}" for i in range(4)] + ["only ZORBLAX here"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.spans for r in pii.op7_personal_data(spark, str(tmp_path)).collect()}[4] == "term:5:12"
    assert {r.doc_id: r.text for r in corpus_pipeline.personal_data(spark, docs, str(tmp_path)).collect()}[4] == "only [TERM] here"


def test_kinds_are_disclosed_where_no_single_entity_is(spark):
    """Every address occurs once, so only their kind shows; against a count by hand."""
    texts = [f"{prose(8)} reach zorblax u{i}@x.example.com {prose(3)}" for i in range(6)] + [f"zorblax {prose(20)}"] * 9 + [prose(9) + f" +1 269 555 32{i}0 " + prose(9) for i in range(5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    flagged = {(r.term, r.entity): r.posterior for r in pii.disclosed_terms(pii._scanned(docs, "text", ["doc_id"]), docs).collect()}
    beside, holds = Counter(), Counter()
    for t in set(texts):
        found = pii.find_entities(t)
        taken = lambda a, b: any(x < b and a < y for _, x, y in found)  # noqa: E731, B023
        words = [(m[0].lower(), *m.span()) for m in re.finditer(r"\w+", t)]
        holds.update({w for w, *_ in words})
        near = set()
        for kind, a, b in found:
            before = [w for w in words if w[2] <= a and w[1] >= a - 80][-5:]
            after = [w for w in words if w[1] >= b and w[2] <= b + 80][:5]
            near |= {(w, kind) for w, x, y in before + after if not taken(x, y)}
        beside.update(near)
    want = {k: n / holds[k[0]] for k, n in beside.items() if n >= 3 and n / holds[k[0]] >= 0.5}
    assert flagged == want and want["zorblax", 0] == 6 / 7
    spans = {r.doc_id: r.terms for r in pii.find_personal_data(docs, everywhere=True).collect()}
    assert [(t.start, t.end) for t in spans[7]][:1] == [(0, 7)]


@pytest.mark.parametrize("kind", range(4))
def test_patterns_against_their_expressions(kind):
    """Random strings over each pattern's characters, judged by the expression as stated."""
    expression, alphabet, fits = (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ab.@-+ 1", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "0125.. ", lambda m: all(int(x) <= 255 for x in m.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", "0123456789-  x", lambda m: 16 <= sum(map(str.isdigit, m)) <= 19 and brute.luhn(m)),
        (r"\+[0-9][\x20().0-9-]+[0-9]", "+01 2(3).4-x", lambda m: 8 <= sum(map(str.isdigit, m)) <= 15),
    )[kind]
    weights = np.array([8.0 if c.isdigit() and kind == 2 else 1.0 for c in alphabet])
    for _ in range(4000):
        t = "".join(RNG.choice(list(alphabet), 28, p=weights / weights.sum()))
        want = [m.span() for m in re.finditer(expression, t) if fits(m[0])]
        assert [(a, b) for k, a, b in pii.find_entities(t) if k == kind] == want, t


def test_stages_pass_columns_of_any_name(spark):
    from tessella.llm import decontam

    names = ["doc_id", "text", "score", "entities", "terms", "_row", "n_words", "n_hit", "items", "spans", "near", "content", "_places", "_scanned", "hits", "row", "found", "c0", "fp", "range"]
    rows = [(i, t, *(["x"] * (len(names) - 2))) for i, t in enumerate(["mail a@b.example.org " + prose(30), None, "", prose(12)])]
    docs = spark.createDataFrame(rows, names)
    labels = spark.createDataFrame([(0, 1), (3, 0)], "doc_id long, quality int")
    bench = spark.createDataFrame([(1, rows[0][1])], "item_id long, text string")
    assert quality.keep_good(docs, labels, 0.0).columns == names == pii.sanitise(docs).columns == pii.sanitise(docs, everywhere=True, broadcast_terms=0).columns
    assert pii.sanitise(docs, everywhere=True).count() == quality.keep_good(docs, labels, 0.0).count() == 4
    for limit in (decontam.BROADCAST_BYTES, 50):
        kept = decontam.decontaminate(docs, bench, broadcast_bytes=limit)
        assert kept.columns == names and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3]


def test_a_large_benchmark_stays_a_hash_set(spark):
    """A benchmark beyond one set, with items beyond one piece, against windows by hand."""
    from tessella.llm import decontam

    item = " ".join(f"x{i}" for i in range(30_000))
    bench = spark.createDataFrame([(1, item), (2, prose(400)), (3, "lone"), (2, "x5 x6"), (None, prose(40))], "item_id long, text string")
    words = item.split()
    texts = [" ".join(words[a : a + 14]) for a in range(9_990, 10_010)] + ["lone x", "x6 x5 x6", " ".join(words[-10:]), " ".join(words[-9:]), None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    one, many = ({r.doc_id: tuple(r) for r in decontam.find_overlap(docs, bench, broadcast_bytes=n).collect()} for n in (1 << 24, 40_000))
    assert one == many
    assert all(one[i][2:4] == (14, ["1"]) for i in range(20)) and one[20][2:4] == (1, ["3"]) and one[21][2:4] == (2, ["2"]) and one[22][2] == 10 and one[23][2] == 0


def test_no_group_is_lost_to_a_shared_id(spark):
    from tessella.llm import simhash

    a, b, c = prose(60), prose(70), prose(80)
    rows = [(7, a), (7, b), (8, b), (None, c), (None, c), (None, a), (9, c), (None, prose(50)), (3, None), (4, ""), (7, a)]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, kept_id string, Row_Digest string")
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted([(7, a), (7, b), (9, c), (0, rows[7][1]), (3, "")])
    assert simhash.keep_one_of_each(docs.limit(0)).count() == 0


def test_many_looks_into_one_cell_are_dealt(spark):
    """100,000 fingerprints look into a cell where five stand, and into one where none does."""
    from tessella.llm import simhash

    low = np.unique(RNG.integers(0, 1 << 32, 100_000, dtype=np.uint64))
    looking = low << np.uint64(32) | np.uint64(0b0100)  # one below the cells 01 01 and 01 00 01
    standing = (np.unique(RNG.integers(0, 1 << 32, 5, dtype=np.uint64)) << np.uint64(32)) | np.uint64(0b0101)
    fps = spark.createDataFrame([(int(v),) for v in np.concatenate([looking, standing]).view(np.int64)], "fp long").repartition(8)
    dealt = simhash._dealt(simhash._cells(fps), 4000)
    sizes = dealt.groupBy("cell", "unit").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    assert sizes < 3 * 4000
    into = {r.look: r.n for r in dealt.where("cell = 5").groupBy("look").agg(F.countDistinct("fp").alias("n")).collect()}
    assert into[1] == len(looking) and into[0] == len(standing)
    assert dealt.where("cell = 20").isEmpty()  # 01 01 00: none stands there


@pytest.mark.parametrize("at_once", [7, 1 << 18])
def test_every_ngram_of_a_token_counts(monkeypatch, at_once):
    monkeypatch.setattr(quality, "_AT_ONCE", at_once)
    word = "ab" * 5 + "".join(chr(0x4E00 + int(i)) for i in RNG.integers(0, 500, 300)) + "ab" * 5
    text = f"{word} x {word} \U0001F600y {word} x x x"
    want = Counter()
    for w in text.split():
        want.update(brute.features(w))
    want[0] = 2  # x x x
    found = dict(zip(*(x.tolist() for x in quality.document_features(text))))
    assert found == want
    odds = RNG.normal(0, 5, quality.BUCKETS).astype(np.float32)
    z = sum(float(odds[f]) * n for f, n in found.items()) / sum(found.values())
    assert np.isclose(quality.Model(odds).scorer()(text), 1 / (1 + np.exp(-z)))


def test_middles_of_long_tokens_matter():
    ends = "".join(chr(0x4E00 + int(i)) for i in RNG.integers(0, 500, 200))
    a, b = (ends + "".join(chr(c + int(i)) for i in RNG.integers(0, 500, 600)) + ends for c in (0x5000, 0x6000))
    fa, fb = (set(quality.document_features(t)[0].tolist()) for t in (a, b))
    assert len(fa & fb) < 0.6 * len(fa)
    odds = np.zeros(quality.BUCKETS, np.float32)
    odds[sorted(fa - fb)] = 5
    score = quality.Model(odds).scorer()
    assert score(a) > 0.9 > 0.5 == score(b)


def test_one_epoch_is_plain_gradient_descent():
    examples = []
    for k in range(12):
        ids = np.unique(RNG.integers(1, 40, 6)).astype(np.int32)
        examples.append((ids, RNG.integers(1, 4, len(ids)).astype(np.float32), k % 3 % 2))
    found = quality.train(examples, epochs=1, rate=0.3, seed=5)
    rng = np.random.default_rng(5)
    vectors = rng.uniform(-0.1, 0.1, (quality.BUCKETS, 10))
    layer = np.zeros((10, 2))
    share = Counter(y for *_, y in examples)
    for done, i in enumerate(rng.permutation(12)):
        ids, counts, y = examples[i]
        x = np.zeros(quality.BUCKETS)
        x[ids] = counts / counts.sum()
        hidden = x @ vectors
        p = np.exp(hidden @ layer)
        p = p / p.sum() - np.eye(2)[y]
        step = 0.3 * 12 / (2 * share[y]) * (1 - done / 12)
        back = layer @ p
        layer = layer - step * np.outer(hidden, p)
        vectors = vectors - 10 * step * np.outer(x, back)
    assert np.allclose(found, vectors @ (layer[:, 1] - layer[:, 0]), atol=1e-5)


def test_labels_of_one_class_or_none(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in quality.score(docs, quality.fit(docs, none, quality.held_out())).collect()] == [0.5] * 3
    good = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 1)], "doc_id long, quality int")
    assert {r.doc_id: r.score > 0.5 for r in quality.score(docs, quality.fit(docs, good, quality.held_out())).collect()}[1]
    both = good.unionByName(good.withColumn("quality", F.lit(0)))  # contradicting labels: 0 counts
    assert {r.doc_id: r.score < 0.5 for r in quality.score(docs, quality.fit(docs, both, quality.held_out())).collect()}[1]
    empty = docs.limit(0)
    assert quality.keep_good(empty, good).count() == 0
