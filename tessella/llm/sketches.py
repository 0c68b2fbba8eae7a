"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below a fixed fraction of the hash range. Whether a
shingle is kept never depends on the rest of its text, so the sketch of a union is the
union of the sketches, and resemblance or containment can be estimated between texts of
very unequal lengths.

A sketch may be empty: a text of k different shingles keeps none with probability
(1 - 1 / KEEP_ONE_IN) ** k, so 0.75 for a text of up to five words, 0.24 for one of nine and
below 0.001 from 29 words on; its likeness to any different text is then 0. Elsewhere the
estimate of a resemblance r over a union of u shingles has a standard error of about
sqrt(r * (1 - r) * KEEP_ONE_IN / u).
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import Memo, byte_batches, table, whole_number_ids

SHINGLE = 5
#: A 32-bit shingle hash is kept if it is below 2**32 / KEEP_ONE_IN.
KEEP_ONE_IN = 4
#: Bytes of text in a range of documents, the most ranges there may be, and how many go to a task.
RANGE_BYTES, MAX_RANGES, RANGES_A_TASK = 1 << 20, 50_000, 8
#: Places sampled for each range.
_SAMPLED = 40
_MULTIPLIER = 0x9E3779B97F4A7C15


class Sketcher:
    """Sketches of texts; remembers words' hashes within a bound."""

    def __init__(self, shingle: int = SHINGLE, keep_one_in: int = KEEP_ONE_IN):
        self.shingle = shingle
        self.limit = (1 << 32) // keep_one_in
        self.powers = [np.uint64(pow(_MULTIPLIER, k, 1 << 64)) for k in range(shingle)]
        self.hashes = Memo(lambda words: [*map(xxhash.xxh64_intdigest, words)])

    def sketch(self, text: str) -> np.ndarray:
        """Sorted distinct kept hashes. Fewer words than a shingle has: all of them are one."""
        words = text.encode().lower().split()
        if not words:
            return np.zeros(0, np.uint32)
        v = np.array(self.hashes.of(words), np.uint64)
        size = min(self.shingle, len(v))
        n = len(v) - size + 1
        h = np.zeros(n, np.uint64)
        for k in range(size):
            h += v[k : k + n] * self.powers[k]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h = (h >> np.uint64(32)).astype(np.uint32)
        return np.unique(h[h < self.limit])


def to_fingerprint(text: str, sketch: np.ndarray) -> str:
    """XXH64 of the text, a colon, and the kept hashes in order (8 hex digits each)."""
    return xxhash.xxh64_hexdigest(text.encode()) + ":" + sketch.astype(">u4").tobytes().hex()


def parse_fingerprint(fingerprint: str) -> tuple[str, np.ndarray]:
    digest, _, hashes = fingerprint.partition(":")
    return digest, np.frombuffer(bytes.fromhex(hashes), ">u4").astype(np.uint32)


def merge_sketches(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of both texts' shingles together."""
    return np.union1d(a, b)


def likeness(a: str, b: str) -> float:
    """Estimated Jaccard resemblance of two fingerprints: 1 for equal texts; 0 if nothing
    of two different texts was kept on one side."""
    (da, a_kept), (db, b_kept) = parse_fingerprint(a), parse_fingerprint(b)
    return 1.0 if da == db else _jaccard(a_kept, b_kept)


def containment(a: str, b: str) -> float:
    """Estimated share of a's shingles that b has; 1 for equal texts, 0 if nothing of a was kept."""
    (da, a_kept), (db, b_kept) = parse_fingerprint(a), parse_fingerprint(b)
    return 1.0 if da == db else _contained(a_kept, b_kept)


def _contained(a: np.ndarray, b: np.ndarray) -> float:
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else 0.0


def _jaccard(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) for every row of docs. Null text counts as empty: nothing kept.

    Very long texts are taken whole, rows with null or repeated ids one by one; other
    columns are ignored, and an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def compute(batches):
        import pyarrow as pa

        sketcher = Sketcher()
        for whole in batches:
            for batch in byte_batches(whole):
                found = [to_fingerprint(t or "", sketcher.sketch(t or "")) for t in batch.column("text").to_pylist()]
                yield pa.record_batch([batch.column("id"), pa.array(found, pa.string())], [id_col, "fingerprint"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(compute, f"`{id_col}` {kind}, fingerprint string")


def edited(text: str, following: str) -> str:
    """text with its last third (rounded down) replaced by as much of the other's start."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _order_bytes(down: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Pairs of signed 64-bit numbers as strings of 16 bytes in the same order."""
    out = np.empty((len(down), 2), ">u8")
    for k, v in enumerate((down, salt)):
        out[:, k] = np.asarray(v, np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return out.view("S16").ravel()


def _range_cuts(keyed: DataFrame, range_bytes: int) -> tuple[int, np.ndarray]:
    """Number of ranges, and the last place of each but the highest, as order bytes.

    Places are sampled by their hash, about _SAMPLED for each range, and rows of one place
    count together, so the driver gets a bounded number however often a row repeats.
    """
    size = F.octet_length("text").cast("long") + 64
    rows, total = keyed.agg(F.count("*"), F.sum(size)).first()
    ranges = min(MAX_RANGES, -(-(total or 0) // range_bytes))
    if ranges < 2:
        return 1, np.zeros(0, "S16")
    share = min(1.0, _SAMPLED * ranges / rows)
    wanted = F.pmod(F.xxhash64("down", "salt"), F.lit(1 << 30)) < int(share * (1 << 30)) + 1
    sample = keyed.where(wanted).groupBy("down", "salt").agg(F.sum(size).alias("size")).collect()
    places = _order_bytes(np.array([r["down"] for r in sample], np.int64), np.array([r["salt"] for r in sample], np.int64))
    order = np.argsort(places)
    filled = np.cumsum(np.array([r["size"] for r in sample], np.float64)[order])
    at = np.searchsorted(filled, filled[-1:] * np.arange(1, ranges) / ranges) if len(filled) else []
    return ranges, np.unique(places[order][at])


def compare_with_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    contained_edited, contained_next).

    Every row of docs is compared with its text edited by the next row's, and with the
    next row: descending ids, rows of equal id in the order of a hash of their text, null
    ids at the end, and after the last row the first. near_* estimate the resemblance of
    both texts' shingles, contained_* the share of the row's own that the other has; equal
    texts give 1. Null text counts as empty; very long ones are taken whole. Repeated rows
    follow one another. Ids must be whole numbers (a TypeError otherwise). Other columns are
    ignored, whatever their names; an empty table gives an empty result.

    Rows are cut into ranges of about range_bytes by id and hash; the texts are shuffled
    once, some ranges to a task, and sorted there. The first row of a range is also sent to the range
    before it, whose last row needs it. Only a sample of places and the ranges' first
    places come to the driver. A range is streamed, so rows that are all equal, which no
    order can part, make a long one but not a large one.
    """
    spark = docs.sparkSession
    whole_number_ids(docs, id_col)
    down = F.bitwise_not(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)).cast("long")))
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("id"), down.alias("down"), F.xxhash64(text).alias("salt"), text.alias("text"))
    ranges, cuts = _range_cuts(keyed, range_bytes)

    @F.pandas_udf("int")
    def range_of(down, salt):
        import pandas as pd

        return pd.Series(np.searchsorted(cuts, _order_bytes(down.to_numpy(), salt.to_numpy()), "left").astype(np.int32))

    placed = keyed.withColumn("range", range_of("down", "salt"))
    first = {r["range"]: (r["f"]["down"], r["f"]["salt"]) for r in placed.groupBy("range").agg(F.min(F.struct("down", "salt")).alias("f")).collect()}
    order = sorted(first)
    # the range below takes a copy; the highest one takes that of the lowest
    heads = [(*first[order[(i + 1) % len(order)]], r) for i, r in enumerate(order)]
    # at most MAX_RANGES rows
    heads = F.broadcast(spark.createDataFrame(heads, "down long, salt long, range int"))
    copies = keyed.join(heads, ["down", "salt"]).dropDuplicates(["range"])
    columns = ("id", "down", "salt", "text", "range")
    sent = placed.select(*columns, F.lit(False).alias("copy")).unionByName(copies.select(*columns, F.lit(True).alias("copy")))
    sent = sent.repartition(-(-ranges // RANGES_A_TASK) if ranges < MAX_RANGES else ranges, "range").sortWithinPartitions("range", "copy", "down", "salt", "text")
    kind = docs.schema[id_col].dataType.simpleString()

    def compare(batches):
        import pyarrow as pa

        sketcher = Sketcher()
        number = pa.float64()
        fields = [(id_col, None), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string())]
        fields += [(n, number) for n in ("near_edited", "near_next", "contained_edited", "contained_next")]
        last = None  # range, id, text, sketch, fingerprint
        for whole in batches:
            for batch in byte_batches(whole):
                out = []
                for own, id_, text, copy in zip(*(batch.column(c).to_pylist() for c in ("range", "id", "text", "copy"))):
                    kept = sketcher.sketch(text)
                    now = (own, id_, text, kept, to_fingerprint(text, kept))
                    if last is not None and last[0] == own:
                        _, i, t, s, f = last
                        e = edited(t, text)
                        es = sketcher.sketch(e)
                        likes = [1.0 if x == t else of(s, xs) for of in (_jaccard, _contained) for x, xs in ((e, es), (text, kept))]
                        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), f, to_fingerprint(e, es), *likes))
                    last = None if copy else now
                columns = [*zip(*out)] or [[]] * len(fields)
                yield pa.record_batch([pa.array(c, k or batch.column("id").type) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])

    numbers = ", ".join(f"{n} double" for n in ("near_edited", "near_next", "contained_edited", "contained_next"))
    return sent.mapInArrow(compare, f"`{id_col}` {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, {numbers}")


def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for every row of documents; compare_with_neighbours() defines the columns and
    what nulls, empty and long texts, repeats and an empty table give."""
    return compare_with_neighbours(table(spark, sf_dir, "documents"))
