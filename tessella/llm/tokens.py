"""Tokenizers from files, and token counts by a digest cache.

Method of the counts: a cache table holds (digest of the content, digest of the
tokenizer, n_tokens). A run joins its distinct contents to the cache, encodes only
those that it lacks, appends them, and joins the documents to the cache again.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
import unicodedata
from array import array
from itertools import chain, islice

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import byte_batches, table
from tessella.sources.shared import new_path, written

BYTE_BPE = "byte_bpe_50k.json"

#: Bytes of chunks and ids that one worker remembers (some 500,000); beyond it half of them are
#: forgotten. With half of that, a worker takes half as long again.
#: Chunks of more than LONG characters are not remembered.
REMEMBERED_BYTES, LONG = 112 << 20, 200
#: What an entry takes besides its characters.
_EACH = 200
_ANY_SPACE = re.compile(r"\s*\S+|\s+")
#: White space other than a blank or line feed, and what only Python counts as such.
_OTHER_SPACE = re.compile(r"[^\S \n]")
_DOUBTFUL = re.compile(r"[\x1c-\x1f]")


def tokenizer_version(path: str) -> str:
    """A digest of all that decides a count: the file and how it is called."""
    with open(path, "rb") as f:
        body = f.read()
    return hashlib.sha256(body + b"|no added special tokens, no truncation, no padding").hexdigest()


class ChunkEncoder:
    """Encodes texts exactly as the tokenizers library does, a chunk at a time.

    Where the file's pre-tokenizer never lets a token cross the gap between a visible
    character and the white space after it, a text's ids are its chunks' ids one after
    another. Chunks repeat, so a bounded memory of them spares most of the work. For
    any other file the whole text is one chunk. Chunks themselves always go through
    the library, special strings included; where an id tells that it ends a word, words
    of letters go through it together.
    """

    def __init__(self, path: str, keep_ids: bool, remembered: int | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.kind = _kind(spec)
        self.word_end = None
        suffix = spec["model"].get("end_of_word_suffix")
        if self.kind == "separate" and suffix:
            vocabulary = self.tokenizer.get_vocab(True)
            self.word_end = np.zeros(max(vocabulary.values()) + 1, bool)
            self.word_end[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.keep_ids = keep_ids
        self.known: dict = {}
        self.held = 0
        self.bound = remembered or REMEMBERED_BYTES

    def encode(self, text: str) -> list:
        """For each chunk its number of ids, or its ids as little-endian uint32 bytes."""
        keys = self._chunks(text)
        try:
            return [*map(self.known.__getitem__, keys)]
        except KeyError:
            pass
        if self.held > self.bound:
            # the later half stays; what is frequent is soon there again
            for k in [*islice(self.known, len(self.known) // 2)]:
                del self.known[k]
            self.held -= self.held // 2
        known = self.known
        missing = set(keys).difference(known)
        before = len(known)
        new = self._add(missing)
        out = [*map(known.__getitem__, keys)]
        length = sum(map(len, new))
        self.held += 2 * length + _EACH * (len(known) - before)
        if length > LONG:
            for k in [k for k in missing.union(new) if len(k) > LONG]:
                del known[k]
                self.held -= 2 * len(k) + _EACH
        return out

    def _chunks(self, text: str) -> list[str]:
        if self.kind == "separate":
            if "<|" not in text:
                # A-Z fall to lower case anyhow, before or after composition (a special string mustn't)
                text = text.encode().lower().decode()
            return text.replace("\n", " ").split(" ")
        if self.kind == "leading" and not _DOUBTFUL.search(text):
            if "  " in text or "\n " in text or " \n" in text or "\n\n" in text or _OTHER_SPACE.search(text):
                return _ANY_SPACE.findall(text)
            parts = text.replace("\n", " \n").split(" ")
            # a part that follows a blank carries it; one that starts with a line feed has its own
            return parts[:1] + [p if p[:1] == "\n" else " " + p for p in parts[1:]]
        return [text]

    def _add(self, missing: set) -> list[str]:
        """Holds missing chunks and their parts; returns the parts."""
        known = self.known
        rest = [(k, self._parts(k)) for k in missing]
        new = list(dict.fromkeys(p for _, parts in rest for p in parts if p not in known))
        alone = new
        if self.word_end is not None:
            plain = [p for p in new if p.isalpha() and (p.isascii() or not _CHANGED.search(p))]
            values = self._together(plain) if plain else None
            if values is not None:
                known.update(zip(plain, values))
                alone = [p for p in new if p not in known] if len(plain) < len(new) else []
        if alone:
            encoded = self.tokenizer.encode_batch_fast(alone, add_special_tokens=False)
            known.update(zip(alone, [array("I", e.ids).tobytes() for e in encoded] if self.keep_ids else map(len, encoded)))
        for k, parts in rest:
            if len(parts) > 1:
                known[k] = known[parts[0]] + known[parts[1]]
            elif parts[0] != k:
                known[k] = known[parts[0]]
        return new

    def _together(self, words: list[str]) -> list | None:
        """Ids (or their numbers) of words of letters, encoded as one text. Each ends with an id
        that ends a word; if there are more or fewer of those than words, None."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.word_end[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            return None
        if not self.keep_ids:
            return np.diff(ends, prepend=0).tolist()
        body, edges = ids.tobytes(), [0, *(4 * ends).tolist()]
        return [body[a:b] for a, b in zip(edges, edges[1:])]

    def _parts(self, k: str) -> tuple:
        """A chunk, cut where a token boundary surely is."""
        if self.kind == "whole":
            return (k,)
        tail = ()
        if k[-1:] in (".", ",") and _one_letter(k[-2:-1]):
            k, tail = k[:-1], (k[-1],)
        return (k, *tail)


@functools.lru_cache(4096)
def _one_letter(c: str) -> bool:
    """Whether c is a letter and stays one under NFC and in lower case; a stop or comma
    after it is then a token of its own whatever the file's normaliser does."""
    plain = unicodedata.normalize("NFC", c).lower()
    return len(plain) == 1 and c.isalpha() and plain.isalpha()


#: Letters that aren't one letter once normalised.
_CHANGED = re.compile("[" + "".join(c for c in map(chr, chain(range(0xD800), range(0xE000, 0x110000))) if c.isalpha() and not _one_letter(c)) + "]")


def _kind(spec: dict) -> str:
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or re.search(r"\s", t["content"]) for t in spec["added_tokens"]):
        return "whole"
    if (spec.get("model") or {}).get("type") != "BPE" or spec.get("post_processor"):
        return "whole"
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and norm is None:
        return "leading"
    steps = [s.get("type") for s in (norm or {}).get("normalizers", [])]
    parts = pre.get("pretokenizers") or [{}]
    if (
        steps == ["NFC", "Replace", "Lowercase"]
        and norm["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
        and norm["normalizers"][1]["content"] == " "
        and parts[0].get("type") == "Split"
        and parts[0].get("behavior") == "Removed"
        and parts[0].get("invert")
        and parts[0].get("pattern", {}).get("Regex", "").endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        and [p.get("type") for p in parts[1:]] == ["ByteLevel"]
        and not parts[1].get("add_prefix_space")
        and not parts[1].get("use_regex")
    ):
        return "separate"
    return "whole"


@functools.cache
def encoder(path: str, keep_ids: bool, remembered: int | None = None) -> ChunkEncoder:
    """One for each worker process and file; remembered bounds the bytes that it holds."""
    return ChunkEncoder(path, keep_ids, remembered)


def token_counts(
    docs: DataFrame,
    cache: str,
    tokenizer: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_bytes, n_tokens) for every row of docs, through the digest cache at path `cache`.

    The normalisation of a content is the strongest one that cannot change a count:
    null counts as empty. The cache table is Parquet with (digest, version, n_tokens);
    it is made where it is missing and appended to, by one writer at a time. If writers
    that raced or were retried left a digest twice, it is read once. Only digests are
    held against an existing cache; texts move for its misses alone. Copies of a text
    fold into one before they are shuffled (map-side), so a text that a third of all rows
    share is encoded once and never gathered; the join back to the documents is a plain
    equi-join that AQE may split.

    Null and empty texts have 0 bytes and 0 tokens; very long ones are counted whole. Rows
    with null or repeated ids are counted like any other; an empty table gives an empty
    result. Other columns of docs are ignored, whatever their names.
    """
    spark = docs.sparkSession
    path = tokenizer or public_tokenizers.path(BYTE_BPE)
    version = tokenizer_version(path)
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col), text.alias("_text"), F.unhex(F.sha2(text, 256)).alias("_digest"))
    known = _counts(spark, cache, version)
    wanted = keyed.select("_digest", "_text")
    if known is not None:
        wanted = wanted.join(keyed.select("_digest").distinct().join(known, "_digest", "left_anti"), "_digest", "left_semi")
    missing = wanted.dropDuplicates(["_digest"])

    def encode(batches):
        import pyarrow as pa

        enc = encoder(path, False)
        for whole in batches:
            for batch in byte_batches(whole, "_text"):
                counts = [sum(enc.encode(t)) for t in batch.column("_text").to_pylist()]
                yield pa.record_batch([batch.column("_digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    (
        missing.mapInArrow(encode, "digest binary, n_tokens long")
        .select("digest", F.lit(version).alias("version"), "n_tokens")
        .write.mode("append")
        .parquet(cache)
    )
    counts = _counts(spark, cache, version)
    return (
        keyed.select(F.col(id_col), "_digest", F.octet_length("_text").cast("long").alias("n_bytes"))
        .join(counts, "_digest")
        .select(id_col, "n_bytes", "n_tokens")
    )


def _counts(spark: SparkSession, path: str, version: str) -> DataFrame | None:
    """(_digest, n_tokens) of the cache for one tokenizer, each digest once; None without a cache."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return None
    held = spark.read.schema("digest binary, version string, n_tokens long").parquet(path)
    held = held.where(F.col("version") == version).select(F.col("digest").alias("_digest"), "n_tokens")
    # an aggregate beside the join would keep AQE from splitting it, so only where it is needed
    twice = not held.groupBy("_digest").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    return written(held.dropDuplicates(["_digest"]), "token-counts") if twice else held


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens; starts from an empty cache, so nothing is spared by earlier runs.

    doc_id, n_bytes, n_tokens and over_limit for every row of documents, as token_counts()
    defines them for null, empty and very long texts, repeated rows and an empty table. A
    count of exactly 1024 is not over the limit. Columns but doc_id and text are not read.
    """
    counts = token_counts(table(spark, sf_dir, "documents"), new_path(spark, "token-cache"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))
