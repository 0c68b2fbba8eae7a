"""The counterfactual penalty through fit, and the solution against its own conditions."""

import math

import numpy as np
import pytest
from tessella.llm import toxicity

RNG = np.random.default_rng(5)


def prose(n):
    return " ".join(f"zo{i}ru" for i in RNG.integers(0, 60, n))


def test_neutral_mentions_stay_clean_through_fit(spark, monkeypatch):
    """Insults come with one group's name; the model must not learn the name."""
    rows = [(i, f"{prose(6)}. The muslims are idiots. {prose(4)}", 1) for i in range(150)] + [(200 + i, f"{prose(9)}. The dogs are here. {prose(4)}", 0) for i in range(150)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    scores = {}
    for strength in (0.0, 20.0):
        monkeypatch.setattr(toxicity.train, "__defaults__", (strength, toxicity.ROUNDS))
        of = toxicity.fit(docs, labels, toxicity.held_out()).scorer()
        scores[strength] = [of(f"The {w} are in the garden") for w in ("muslims", "christians", "women")], of("They are idiots")
    plain, fair = scores[0.0], scores[20.0]
    assert plain[0][0] - plain[0][1] > 0.1 > fair[0][0] - fair[0][1]
    assert fair[0][0] < toxicity.THRESHOLD < fair[1]


def test_every_labelled_sentence_is_swapped():
    found = toxicity.counterfactuals(f"{prose(5)}. The women sing! And the men? " + "... \n")
    assert len(found) == 2 * 3 and all(a and b for a, b in found)
    # what the rest of the sentence has too neither goes nor comes: "muslin" begins like "muslims"
    gone = toxicity.counterfactuals("muslims wear muslin")[0][0]
    assert set(gone) == set(toxicity.word_features("muslims")) - set(toxicity.word_features("muslin"))
    assert toxicity.counterfactuals("") == [] == toxicity.counterfactuals(" .!? ")


@pytest.mark.parametrize("strength", [0.0, 3.0])
def test_weights_solve_the_problem_as_stated(strength):
    """Loss, penalty and L1 by hand: no weight's slope may exceed what L1 allows."""
    words = [f"{c}{c}{c}{i}" for c in "abc" for i in range(3)]
    examples = []
    for k in range(200):
        y = int(k % 4 == 0)
        own = {w for w in words if RNG.random() < (0.5 if (w[0] == "a") == bool(y) else 0.15)}
        examples.append((toxicity.document_features(own), y))
    f = toxicity.word_features
    pairs = [((f("aaa0")[0],), (f("bbb0")[0],))] * 3 + [((f("aaa1")[0], f("aaa1")[1]), (f("ccc1")[0],))]
    model = toxicity.train(examples, pairs, counterfactual=strength, rounds=20_000)
    w, b = model.weights, model.intercept
    assert any(x > 0 for x in w.values()) and any(x < 0 for x in w.values())
    number = [sum(y == c for _, y in examples) for c in (0, 1)]
    slope, slope_b = dict.fromkeys({x for fs, _ in examples for x in fs}, 0.0), 0.0
    for fs, y in examples:
        err = 0.5 / number[y] * (1 / (1 + math.exp(-b - sum(w.get(x, 0) for x in fs))) - y)
        slope_b += err
        for x in fs:
            slope[x] += err
    for gone, come in pairs:
        apart = sum(w.get(x, 0) for x in gone) - sum(w.get(x, 0) for x in come)
        for x, sign in [(x, 1) for x in gone] + [(x, -1) for x in come]:
            slope[x] = slope.get(x, 0.0) + 2 * strength / len(pairs) * sign * apart
    assert abs(slope_b) < 1e-5
    for x, v in w.items():
        assert abs(slope[x] + toxicity.L2 * v + toxicity.L1 * math.copysign(1, v)) < 2e-5


def test_one_class_contradictions_and_empty_texts(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(["a b", None, "", "c"])], "doc_id long, text string")
    for given, side in ([], 0.5), ([(0, 1), (1, 1), (2, 1), (3, 1)], 0.98), ([(i, y) for i in range(4) for y in (0, 1)], 0.018):
        labels = spark.createDataFrame(given, "doc_id long, toxic int")
        scores = [r.score for r in toxicity.score(docs, toxicity.fit(docs, labels, toxicity.held_out())).collect()]
        assert np.allclose(scores, side, atol=0.01), (given, scores)
    assert toxicity.score(docs.limit(0), toxicity.Model({}, 0.0)).count() == 0
