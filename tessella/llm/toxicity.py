"""Toxicity by a counterfactual-regularised classifier.

A document's features are which words, and which beginnings of words, it has (however
often, so one insult in a long text counts as in a short one). A sparse logistic
regression is trained on a bounded labelled sample. For every labelled sentence that
names a group, the same sentence with the group's name swapped for others is made; one that
names none gets a group's name put in front, and that swapped. The squared difference of
the two log odds is penalised (a score moves by a quarter of it at most): the group's name
itself can't carry weight, so neutral mentions don't raise the score.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from itertools import chain

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import Memo, byte_batches, table
from tessella.llm.labelled import remainder, sample_ids, sampled
from tessella.llm.quality import score as score_rows

#: Terms that name groups; each is swapped for the two that follow it in its set.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "transgender"),
    ("woman", "man", "girl", "boy", "nonbinary"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("black", "white", "asian", "latino", "arab", "african", "european"),
    ("gay", "lesbian", "bisexual", "straight", "heterosexual", "queer"),
    ("immigrants", "refugees", "foreigners", "citizens", "natives"),
    ("disabled", "blind", "deaf", "old", "young"),
    ("femmes", "hommes", "filles", "garçons"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("mujeres", "hombres", "chicas", "chicos"),
)
SWAPS = 2
#: Bounds on the labelled rows that are learned from.
TOXIC_ROWS, OTHER_ROWS = 1500, 3000
THRESHOLD = 0.7
#: A feature is tried if so many documents of a class have it, that much more often than the other.
LEAST_ROWS, LEAST_LOG_ODDS = 3, 1.0
L1, L2, COUNTERFACTUAL = 1e-4, 1e-5, 1.0
ROUNDS = 400
_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"[^.!?\n]+")
_NEXT = {t: [s[(i + k) % len(s)] for k in range(1, SWAPS + 1)] for s in IDENTITY_TERMS for i, t in enumerate(s)}


_TERMS = sorted(_NEXT)


def word_features(word: str) -> list[int]:
    """Hashes of a word and of its first 3 to 6 characters."""
    return [xxhash.xxh32_intdigest(x) for x in (word + ">", *(word[:n] for n in range(3, min(6, len(word)) + 1)))]


_FEATURES = {t: word_features(t) for t in _NEXT}


def document_words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def document_features(words) -> set[int]:
    return {f for w in words for f in word_features(w)}


def counterfactuals(text: str) -> list[tuple[tuple[int, ...], tuple[int, ...]]]:
    """For each sentence and each swap of an identity term: features that go, that come.

    A sentence without an identity term gets one in front, chosen by a hash of its words.
    A feature that the rest of the sentence has as well neither goes nor comes.
    """
    out = []
    for m in _SENTENCE.finditer(text.lower()):
        words = _WORD.findall(m[0])
        if not words:
            continue
        named = {w for w in words if w in _NEXT} or {_TERMS[xxhash.xxh32_intdigest(" ".join(words)) % len(_TERMS)]}
        for term in sorted(named):
            rest = [w for w in words if w != term]
            for other in _NEXT[term]:
                gone, come = set(_FEATURES[term]), set(_FEATURES[other])
                # only words that begin alike can share a feature
                held = document_features(w for w in rest if w[:3] in (term[:3], other[:3]))
                out.append((tuple(sorted(gone - come - held)), tuple(sorted(come - gone - held))))
    return out


@dataclass
class Model:
    """Weights of the features that have any, and the intercept."""

    weights: dict[int, float]
    intercept: float

    def scorer(self):
        """A function from a text to its score; remembers words within a bound of bytes."""
        weights = self.weights
        memo = Memo(lambda words: [tuple(f for f in word_features(w) if f in weights) for w in words])

        def score(text: str) -> float:
            hit = set(chain.from_iterable(memo.of(list(document_words(text)))))
            z = self.intercept + sum(weights[f] for f in sorted(hit))
            return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

        return score


def train(examples: list[tuple[set[int], int]], pairs, counterfactual: float = COUNTERFACTUAL, rounds: int = ROUNDS) -> Model:
    """Accelerated proximal gradient on the mean logistic loss (classes weigh the same), an
    L1 term, and the counterfactual penalty.

    pairs: what counterfactuals() gives, as a list or with the number of each as a dict.
    With examples of one class all texts get that side; without examples they score 0.5.
    """
    number = np.bincount([y for _, y in examples], minlength=2)
    if not number.all():
        return Model({}, 4.0 * float(np.sign(number[1] - number[0])))
    with_ = [Counter(), Counter()]
    for f, y in examples:
        with_[y].update(f)
    tried = [f for f in with_[0].keys() | with_[1].keys() if with_[0][f] >= LEAST_ROWS or with_[1][f] >= LEAST_ROWS]
    odds = [(c + 0.5) / (n - c + 0.5) for c, n in ((np.array([x[f] for f in tried], np.float64), n) for x, n in zip(with_, number))]
    apart = np.abs(np.log(odds[1] / odds[0]))
    chosen = sorted(f for f, d in zip(tried, apart.tolist()) if d >= LEAST_LOG_ODDS)
    at = {f: i for i, f in enumerate(chosen)}
    own = [[at[f] for f in x if f in at] for x, _ in examples]
    rows = np.repeat(np.arange(len(own)), [len(x) for x in own])
    cols = np.array([c for x in own for c in sorted(x)], np.int64)
    y = np.array([y for _, y in examples], np.float64)
    share = np.where(y == 1, 0.5 / number[1], 0.5 / number[0])
    swaps = [([(at[f], g) for g, fs in ((1.0, a), (-1.0, b)) for f in fs if f in at], k) for (a, b), k in sorted(Counter(pairs).items())]
    often = np.array([k for x, k in swaps if x], np.float64) / max(1, sum(k for _, k in swaps))
    swaps = [x for x, _ in swaps if x]
    srow = np.repeat(np.arange(len(swaps)), [len(x) for x in swaps])
    scol = np.array([c for x in swaps for c, _ in x], np.int64)
    sign = np.array([s for x in swaps for _, s in x])
    n = len(chosen)
    # a bound on the curvature: of the loss by the rows' lengths, of the penalty by the swaps'
    lengths = np.array([len(x) for x in own]) + 1
    curvature = 0.25 * (share * lengths).sum() + L2 + 2 * counterfactual * float(often[srow].sum())
    step = 1 / curvature
    w, b = np.zeros(n), 0.0
    v, c, t = w.copy(), b, 1.0
    for _ in range(rounds):
        z = c + np.bincount(rows, v[cols], len(own))
        err = share * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y)
        grad = np.bincount(cols, err[rows], n) + L2 * v
        if swaps:
            apart = often * np.bincount(srow, sign * v[scol], len(swaps))
            grad += 2 * counterfactual * np.bincount(scol, sign * apart[srow], n)
        new = v - step * grad
        new = np.sign(new) * np.maximum(np.abs(new) - step * L1, 0)
        b_new = c - step * err.sum()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        if ((v - new) * (new - w)).sum() + (c - b_new) * (b_new - b) > 0:
            t_new = 1.0  # momentum points uphill: start it anew
            v, c = new.copy(), b_new
        else:
            v, c = new + (t - 1) / t_new * (new - w), b_new + (t - 1) / t_new * (b_new - b)
        w, b, t = new, b_new, t_new
    return Model({f: float(w[i]) for f, i in at.items() if w[i]}, float(b))


def fit(docs: DataFrame, labels: DataFrame, held_out, toxic_rows: int = TOXIC_ROWS, other_rows: int = OTHER_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model from a bounded labelled sample; executors make the features, the driver trains.

    A labelled id without a document is ignored, one with several rows counts with each; of
    contradicting labels 0 counts. Null and empty texts are examples without features.
    """
    wanted = sample_ids(labels, label_col, held_out, other_rows, id_col)
    toxic = [i for i, y in wanted.items() if y == 1][:toxic_rows]
    wanted = {i: y for i, y in wanted.items() if y == 0} | dict.fromkeys(toxic, 1)
    kind = docs.schema[id_col].dataType.simpleString()

    def featurise(batches):
        import pyarrow as pa

        ints = pa.list_(pa.int64())
        for whole in batches:
            for batch in byte_batches(whole):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                found = [sorted(document_features(document_words(t))) for t in texts]
                swaps = [[{"gone": a, "come": b, "n": n} for (a, b), n in Counter(counterfactuals(t)).items()] for t in texts]
                yield pa.record_batch([batch.column("id"), pa.array(found, ints), pa.array(swaps, pa.list_(pa.struct([("gone", ints), ("come", ints), ("n", pa.int64())])))], ["id", "f", "swaps"])

    rows = sampled(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), wanted, "id").mapInArrow(
        featurise, f"id {kind}, f array<long>, swaps array<struct<gone: array<long>, come: array<long>, n: long>>"
    )
    examples, pairs = [], Counter()
    for r in rows.toLocalIterator():
        examples.append((r["id"], np.array(r["f"], np.uint32)))
        for s in r["swaps"]:
            pairs[tuple(s["gone"]), tuple(s["come"])] += s["n"]
    examples.sort(key=lambda x: (x[0], len(x[1]), x[1].tobytes()))
    return train([(f.tolist(), wanted[i]) for i, f in examples], pairs)


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """(keep..., score) for every row of docs: the probability of label 1.

    Null and empty texts have no features and get the intercept's score; very long ones are
    scored whole. Ids play no part, so rows with null or repeated ids are scored like any
    other. Columns that keep doesn't name are ignored; keep must not name `score`. An
    empty table gives an empty result.
    """
    return score_rows(docs, model, keep, text_col)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(remainder(id_col, 3) == 1, F.lit(False))


def op6_toxicity_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of documents; see score().

    A null doc_id is never held out. Rows that repeat a doc_id each get their own text's
    score; a tie at the threshold is predicted 1. Further columns are not read.
    """
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"), held_out())
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
