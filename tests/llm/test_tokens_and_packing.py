"""Ids against the library over all of Unicode, and the plan against one made piece by piece."""

import random
import unicodedata
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tessella.llm import packing, tokens
from tessella.sources.shared import new_path
from tokenizers import Tokenizer

LETTERS = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]


def changed(c):
    plain = unicodedata.normalize("NFC", c).lower()
    return len(plain) != 1 or not plain.isalpha()


@pytest.mark.parametrize("file", [packing.WORD_BPE, tokens.BYTE_BPE])
def test_ids_over_all_of_unicode(file):
    rng = random.Random(3)
    by_kind = {}
    for c in range(0x110000):
        if not 0xD800 <= c < 0xE000 and (k := unicodedata.category(chr(c))) not in ("Cn", "Co"):
            by_kind.setdefault(k, []).append(chr(c))
    kinds = sorted(by_kind)
    texts = [x for c in LETTERS if changed(c) for t in ".," for x in (c + t, "ab" + c + t, f"{c}{t} x", f"x {c}{t}{c}")]
    assert len(texts) >= 60 * 8
    texts += [c + rng.choice(".,") for c in rng.sample(LETTERS, 20_000)]
    texts += ["".join(rng.choice(by_kind[rng.choice(kinds)]) if rng.random() < 0.5 else rng.choice(["a", "Z", " ", ".", ",", "\n", "\t", "İ", "'", "é", "1", "<|endoftext|>"]) for _ in range(rng.randint(1, 12))) for _ in range(100_000)]
    path = public_tokenizers.path(file)
    library, own = Tokenizer.from_file(path), tokens.ChunkEncoder(path, True)
    for a in range(0, len(texts), 5000):
        part = texts[a : a + 5000]
        for t, e in zip(part, library.encode_batch(part, add_special_tokens=False)):
            assert np.frombuffer(b"".join(own.encode(t)), "<u4").tolist() == e.ids, [hex(ord(c)) for c in t]


def test_memory_of_chunks_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED_BYTES", 20_000)
    path = public_tokenizers.path(tokens.BYTE_BPE)
    library, own = Tokenizer.from_file(path), tokens.ChunkEncoder(path, False)
    rng = random.Random(1)
    for _ in range(60):
        t = " ".join("".join(rng.choices("abcdefgh", k=rng.choice((3, 6, 400)))) for _ in range(60))
        assert sum(own.encode(t)) == len(library.encode(t, add_special_tokens=False).ids)
        assert sum(2 * len(k) + tokens._EACH for k in own.known) < 60_000 and max(map(len, own.known), default=0) <= tokens.LONG


def test_a_digest_held_twice_is_read_once(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, "one two"), (3, None)], "doc_id long, text string")
    cache = new_path(spark, "cache")
    first = sorted(map(tuple, tokens.token_counts(docs, cache).collect()))
    spark.read.parquet(cache).write.mode("append").parquet(cache + "-twice")
    for _ in range(2):
        spark.read.parquet(cache).write.mode("append").parquet(cache + "-twice")
    assert sorted(map(tuple, tokens.token_counts(docs, cache + "-twice").collect())) == first


def piece_by_piece(lengths, capacity):
    """Sequences of a plain greedy: large pieces pair with the longest that fits, small ones
    go where they leave the least room."""
    large = sorted((n for n in lengths if 3 * n > capacity), reverse=True)
    bins = []
    while large:
        a = large.pop(0)
        k = next((i for i, b in enumerate(large) if a + b <= capacity), None)
        bins.append(capacity - a - (large.pop(k) if k is not None else 0))
    for s in sorted((n for n in lengths if 3 * n <= capacity), reverse=True):
        k = min((i for i, room in enumerate(bins) if room >= s), key=lambda i: bins[i], default=None)
        if k is None:
            bins.append(capacity - s)
        else:
            bins[k] -= s
    return bins


def test_plan_packs_as_well_as_piece_by_piece():
    rng = np.random.default_rng(8)
    for _ in range(80):
        lengths = [int(n) for n in np.concatenate([rng.integers(1, 101, int(rng.integers(0, 60))), rng.integers(1, 34, int(rng.integers(0, 120)))])]
        total, runs = packing.plan_sequences(dict(Counter(lengths)), 100)
        plain = piece_by_piece(lengths, 100)
        assert total == len(plain) or abs(total - len(plain)) <= max(1, len(plain) // 50)
        assert total >= -(-sum(lengths) // 100) and sum(runs["number"]) == len(lengths)
