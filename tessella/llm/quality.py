"""Quality classifier: supervised subword embeddings.

A document is the mean of learned vectors of its tokens' features: the word itself, all its
character n-grams between word ends, and, where it follows itself, the word bigram of a word
with itself. Features are hashed into a fixed table; those bigrams share one vector, as no
word repeats often enough to teach its own, and weigh like any other feature. A softmax
layer on the mean gives the classes; table and layer are trained together by stochastic
gradient descent in NumPy on a bounded sample. A mean of vectors that goes through a linear
layer is a mean of numbers, so scoring needs one number for each hashed feature.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import Memo, byte_batches, fresh, schema_of, table
from tessella.llm.labelled import remainder, sample_ids, sampled

BUCKETS = 1 << 17
#: Lengths of the character n-grams of a token.
NGRAMS = (2, 3, 4)
DIMENSIONS = 10
EPOCHS = 8
RATE = 0.4
#: Bound on the labelled rows of each class that are learned from.
PER_CLASS = 1500
THRESHOLD = 0.3
#: The bucket of a word's bigram with itself; the hashed ones follow.
_TWICE = 0
#: Characters whose n-grams are hashed together.
_AT_ONCE = 1 << 18
_BASE, _MIXER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(32)) * _MIXER
    return 1 + ((h ^ h >> np.uint64(29)) % np.uint64(BUCKETS - 1)).astype(np.int64)


def word_features(words: list[str]):
    """(bucket, place of the word in words) of each feature of each word, as pairs of arrays.

    A word's features are itself and all n-grams of 2 to 4 characters of it between the
    marks < and >, each as often as it occurs. No part of a long word is left out; the
    arrays come by stretches of characters, as a word may be a whole text.
    """
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(sizes)
    codes = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32)
    whole = np.zeros(len(words), np.uint64)
    for a in range(0, len(codes), _AT_ONCE):
        b = min(a + _AT_ONCE, len(codes))
        c = codes[a : b + max(NGRAMS) - 1].astype(np.uint64)
        place = np.searchsorted(ends, np.arange(a, b), "right")
        room = ends[place] - np.arange(a, b)
        h = c
        for n in range(2, max(NGRAMS) + 1):
            h = h[: len(c) - n + 1] * _BASE + c[n - 1 :]
            if n in NGRAMS:
                inside = np.flatnonzero(room[: len(h)] >= n)
                yield _bucket(h[inside] + np.uint64(n)), place[inside]
        # a word as a whole: its characters' hashes, each turned by its distance to the end
        turned = _spread(c[: b - a], room)
        cut = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        whole[place[cut]] += np.add.reduceat(turned, cut)
    if len(words):
        yield _bucket(whole), np.arange(len(words))


def _spread(codes: np.ndarray, room: np.ndarray) -> np.ndarray:
    h = (codes + np.uint64(1)) * _MIXER + room.astype(np.uint64) * _BASE
    h = (h ^ h >> np.uint64(31)) * _MIXER
    return h ^ h >> np.uint64(30)


def feature_numbers(words: list[str]) -> np.ndarray:
    """How many features each word has."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    return 1 + sum(np.maximum(0, sizes - n + 1) for n in NGRAMS)


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text, in order, and how often each occurs."""
    tokens = text.split()
    words = Counter(tokens)
    times = np.fromiter(words.values(), np.float64, len(words))
    counts = np.zeros(BUCKETS)
    for bucket, place in word_features(list(words)):
        counts += np.bincount(bucket, times[place], BUCKETS)
    counts[_TWICE] = sum(map(str.__eq__, tokens, tokens[1:]))
    found = np.flatnonzero(counts)
    return found.astype(np.int32), counts[found].astype(np.float32)


def train(examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> np.ndarray:
    """The number (log odds of label 1) for each bucket. Classes weigh the same.

    Stochastic gradient descent on the softmax loss, one example a step, with a rate that
    falls to 0. An example without features is passed over. If all examples are of one
    class, every bucket gets that class's side; without examples, 0.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer = np.zeros((DIMENSIONS, 2), np.float32)
    examples = [x for x in examples if len(x[0])]
    share = np.bincount([y for *_, y in examples], minlength=2)
    if not share.all():
        return np.full(BUCKETS, 4.0 * np.sign(share[1] - share[0]), np.float32)
    weight = share.sum() / (2 * share)
    steps, done = epochs * len(examples), 0
    means = [counts / counts.sum() for _, counts, _ in examples]
    for _ in range(epochs):
        for i in rng.permutation(len(examples)):
            ids, _, y = examples[i]
            mean = means[i]
            own = vectors[ids]
            hidden = mean @ own
            z = hidden @ layer
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            step = np.float32(rate * weight[y] * (1 - done / steps))
            back = (10 * step) * (layer @ p)
            layer -= step * np.outer(hidden, p)
            vectors[ids] = own - np.outer(mean, back)
            done += 1
    return vectors @ (layer[:, 1] - layer[:, 0])


@dataclass
class Model:
    odds: np.ndarray

    def scorer(self):
        """A function from a text to its score; remembers words within a bound of bytes."""
        odds = self.odds.astype(np.float64)

        def known(words: list[str]) -> list[complex]:
            """Each word's sum (real part) and number (imaginary part) of features."""
            sums = np.zeros(len(words))
            for bucket, place in word_features(words):
                sums += np.bincount(place, odds[bucket], len(words))
            return (sums + 1j * feature_numbers(words)).tolist()

        memo = Memo(known)

        def score(text: str) -> float:
            words = text.split()
            if not words:
                return 0.5
            total = sum(memo.of(words))
            twice = sum(map(str.__eq__, words, words[1:]))
            z = (total.real + twice * odds[_TWICE]) / (total.imag + twice)
            return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

        return score


def fit(docs: DataFrame, labels: DataFrame, held_out, per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """A model from at most per_class labelled documents of each class.

    Features are made by the executors; the driver gets only those of the sample, which
    per_class bounds. A labelled id without a document is ignored, one with several rows
    counts with each; of contradicting labels 0 counts. Texts without words teach nothing.
    """
    wanted = sample_ids(labels, label_col, held_out, per_class, id_col)
    kind = docs.schema[id_col].dataType.simpleString()

    def featurise(batches):
        import pyarrow as pa

        for whole in batches:
            for batch in byte_batches(whole):
                found = [document_features(t or "") for t in batch.column("text").to_pylist()]
                yield pa.record_batch(
                    [batch.column("id"), pa.array([f for f, _ in found], pa.list_(pa.int32())), pa.array([c for _, c in found], pa.list_(pa.float32()))], ["id", "f", "c"]
                )

    rows = sampled(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), wanted, "id").mapInArrow(featurise, f"id {kind}, f array<int>, c array<float>")
    examples = [(r["id"], np.array(r["f"], np.int32), np.array(r["c"], np.float32)) for r in rows.toLocalIterator()]
    examples.sort(key=lambda x: (x[0], len(x[1]), x[1].tobytes()))
    return Model(train([(f, c, wanted[i]) for i, f, c in examples]))


def _scored(docs: DataFrame, model, columns: list[str], text_col: str, then, schema: str) -> DataFrame:
    """docs' columns through then(columns' arrays, scores), batch by batch."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = fresh(columns, "text")[0]

    def compute(batches):
        import pyarrow as pa

        of = shared.value.scorer()
        for whole in batches:
            for batch in byte_batches(whole, text):
                values = pa.array([of(t or "") for t in batch.column(text).to_pylist()], pa.float64())
                yield then(batch.select(columns), values)

    return docs.select(*columns, F.col(text_col).alias(text)).mapInArrow(compute, schema)


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """(keep..., score) for every row of docs: the probability of label 1.

    Null and empty texts, and texts of white space, which show nothing, score 0.5. Very
    long texts and tokens are scored whole. Ids play no part, so rows with null or repeated
    ids are scored like any other. Columns that keep doesn't name are ignored; keep must
    not name `score`. An empty table gives an empty result.
    """
    keep = list(keep)
    return _scored(docs, model, keep, text_col, lambda batch, values: batch.append_column("score", values), f"{schema_of(docs, keep)}, score double")


def held_out(id_col: str = "doc_id"):
    return F.coalesce(remainder(id_col, 5) == 0, F.lit(False))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """docs without those that score below threshold. All columns stay, whatever their names.

    A model is fitted on docs first; with labels of one class all rows get that side, and
    without any labelled row all score 0.5. Null and empty texts score 0.5. Repeated rows
    score alike, so all stay or all go; a score equal to threshold stays. An empty table
    gives an empty one.
    """
    model = fit(docs, labels, held_out())

    def good(batch, values):
        import pyarrow.compute as pc

        return batch.filter(pc.greater_equal(values, threshold))

    return _scored(docs, model, docs.columns, text_col, good, docs.schema)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of documents; see score().

    Null and empty texts score 0.5 and are predicted 1. A null doc_id is never held out.
    Rows that repeat a doc_id each get their own text's score; a tie at the threshold is
    predicted 1; clashing or further columns of documents are not read.
    """
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"), held_out())
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
