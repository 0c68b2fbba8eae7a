"""Benchmark decontamination by a hash set of the benchmark's word n-grams.

The hashes of all normalised n-grams of the benchmark are broadcast as one sorted array,
with the words behind them; documents are scanned, and each hit is verified by comparing
the words before it counts. What is broadcast at a time is bounded: a larger benchmark is
dealt to several sets of that size, and the documents are scanned once for each. Only hits
leave a scan, so the windows of documents are never shuffled.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import byte_batches, fresh, schema_of, table
from tessella.sources.shared import written

WINDOW = 10
#: Bytes of benchmark text whose n-grams are broadcast at a time. A set takes about five times its text.
BROADCAST_BYTES = 16 << 20
#: Bytes of normalised text in the pieces that a larger benchmark is dealt by.
PIECE_BYTES = 64 << 10
#: Share of hit words from which a document goes; below it the hit spans are cut out.
DROP_SHARE = 0.5
#: Bytes to the same in lower case, or to a blank where they belong to no word.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256)
)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_REMEMBERED = 50_000


def words_of(text: bytes | None) -> list[bytes]:
    """Words: digits, a-z after folding A-Z, and whatever is not ASCII."""
    return (text or b"").translate(_WORD_BYTES).split()


class NgramSet:
    """The windows of items: for each length sorted hashes, and where their words and items are.

    A window is `window` consecutive words of an item, or all words of a shorter one.
    """

    def __init__(self, items: list[tuple[object, bytes | None]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        names: dict[object, int] = {}
        number = self.vocabulary.setdefault
        ids, sizes, owners = [np.zeros(0, np.int32)], [], []
        for item, text in items:
            found = [number(w, len(self.vocabulary)) for w in words_of(text)]
            if found:
                ids.append(np.array(found, np.int32))
                sizes.append(len(found))
                owners.append(names.setdefault(item, len(names)))
        self.names = list(names)
        self.words = np.concatenate(ids)
        length, owner = np.array(sizes, np.int64), np.array(owners, np.int32)
        start = np.cumsum(length) - length
        self.by_size = {}
        for size in sorted({min(window, n) for n in sizes}):
            own = np.flatnonzero(length >= size if size == window else length == size)
            n = length[own] - size + 1
            at = np.repeat(start[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            who = np.repeat(owner[own], n)
            hashes = rolling(self.words, size, at)
            order = np.lexsort((who, hashes))
            hashes, at, who = hashes[order], at[order], who[order]
            # a window that an item has several times stands there once
            again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (who[1:] == who[:-1])) + 1
            keep = np.ones(len(at), bool)
            keep[again[self._equal(at[again], self.words, at[again - 1], size)]] = False
            self.by_size[size] = (hashes[keep], at[keep], who[keep])
        self._items: dict = {}

    def _equal(self, at, ids, other, size):
        same = np.ones(len(at), bool)
        for k in range(size):
            same &= self.words[at + k] == ids[other + k]
        return same

    def matches(self, ids: np.ndarray):
        """(positions, size, entries) for each window length: where windows of `ids` (-1: a
        word of no item) are in the set, and the entry that each equals."""
        inside = ids >= 0
        run = np.concatenate([[0], np.cumsum(~inside)])
        for size, (hashes, start, _) in self.by_size.items():
            if len(ids) < size:
                continue
            at = np.flatnonzero(run[size:] == run[: len(run) - size])
            h = rolling(ids, size, at)
            k = np.searchsorted(hashes, h)
            k[k == len(hashes)] = 0
            hit = hashes[k] == h
            at, k, h = at[hit], k[hit], h[hit]
            while len(at):
                same = self._equal(start[k], ids, at, size)
                if same.any():
                    yield at[same], size, k[same]
                # hashes that collided: the entries that follow are tried as well
                k = k + 1
                more = ~same & (k < len(hashes))
                at, k, h = at[more], k[more], h[more]
                more = hashes[k] == h
                at, k, h = at[more], k[more], h[more]

    def items_of(self, size: int, entry: int) -> list:
        """The items that have the window of that entry; a null item is left out."""
        found = self._items.get((size, entry))
        if found is None:
            if len(self._items) > _REMEMBERED:
                self._items.clear()
            hashes, at, who = self.by_size[size]
            a, b = np.searchsorted(hashes, hashes[entry], "left"), np.searchsorted(hashes, hashes[entry], "right")
            same = self._equal(at[a:b], self.words, np.full(b - a, at[entry]), size)
            found = [x for x in (self.names[i] for i in who[a:b][same].tolist()) if x is not None]
            self._items[size, entry] = found
        return found

    def scan(self, texts: list[bytes | None]) -> list[tuple[int, list, set]]:
        """For each text its number of words, (position, size) of its hits, and their items."""
        number = self.vocabulary.get
        lists = [words_of(t) for t in texts]
        sizes = np.array([len(ws) for ws in lists], np.int64)
        # a -1 after each text: no window crosses
        ids = np.fromiter((x for ws in lists for x in (*(number(w, -1) for w in ws), -1)), np.int32, int(sizes.sum()) + len(lists))
        first = np.concatenate([[0], np.cumsum(sizes + 1)])
        out = [(n, [], set()) for n in sizes.tolist()]
        for at, size, entry in self.matches(ids):
            of = np.searchsorted(first, at, "right") - 1
            for i, p in zip(of.tolist(), (at - first[of]).tolist()):
                out[i][1].append((p, size))
            for i, k in set(zip(of.tolist(), entry.tolist())):
                out[i][2].update(self.items_of(size, k))
        return out


def rolling(ids: np.ndarray, size: int, at: np.ndarray) -> np.ndarray:
    """64-bit polynomial hashes of the windows of `size` words at the given positions."""
    h = np.zeros(len(at), np.uint64)
    for k in range(size):
        h = h * _BASE + (ids[at + k].astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(31))


def find_overlap(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(id, keep..., n_words, n_hit, items, spans) for every row of docs.

    A window is `window` consecutive words of an item, or all of a shorter item's words.
    n_hit counts the words inside any occurrence of a window, items lists the items with
    occurring windows (as strings, sorted), spans the maximal runs of hit words (word
    positions, end exclusive; runs that touch are one). Null and empty texts have no words;
    items without words have no window; the windows of items with a null id hit, but are
    listed under no item. Very long texts and items are taken whole. Repeated rows of docs
    are reported one by one, repeated items count once. Other columns are ignored, except
    those of docs named in keep, which are passed on; they must not be named like the
    report's own. Empty tables are fine on both sides.
    """
    columns = list(dict.fromkeys([id_col, *keep]))

    def then(batch, texts, rows):
        import pyarrow as pa

        kinds = (pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
        values = [(n, sum(b - a for a, b in spans), sorted(items), [{"start": a, "end": b} for a, b in spans]) for n, spans, items in rows]
        arrays = [pa.array([v[k] for v in values], kind) for k, kind in enumerate(kinds)]
        return pa.record_batch([*batch.columns, *arrays], [*columns, "n_words", "n_hit", "items", "spans"])

    schema = f"{schema_of(docs, columns)}, n_words long, n_hit long, items array<string>, spans array<struct<start: int, end: int>>"
    return _overlap(docs, benchmark, columns, then, schema, window, text_col, item_col, item_text_col, broadcast_bytes)


def _overlap(docs, benchmark, columns, then, schema, window=WINDOW, text_col="text", item_col="item_id", item_text_col="text", broadcast_bytes=BROADCAST_BYTES) -> DataFrame:
    """then(batch of columns, texts, rows of (words, spans, items)) for every batch of docs."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("binary").alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    text = text_col if text_col in columns else fresh(columns, "text")[0]
    wanted = docs.select(*dict.fromkeys([*columns, text])) if text == text_col else docs.select(*columns, F.col(text_col).alias(text))
    if size > broadcast_bytes:
        return _in_passes(wanted, items, columns, text, then, schema, window, -(-size // broadcast_bytes) if broadcast_bytes else 1)
    shared = docs.sparkSession.sparkContext.broadcast(NgramSet([(r["item"], r["text"]) for r in items.collect()], window))

    def scan(batches):
        import pyarrow as pa

        grams = shared.value
        for whole in batches:
            for batch in byte_batches(whole, text):
                texts = batch.column(text).cast(pa.binary()).to_pylist()
                yield then(batch.select(columns), texts, [(n, _runs(hits), found) for n, hits, found in grams.scan(texts)])

    return wanted.mapInArrow(scan, schema)


def _runs(hits) -> list[tuple[int, int]]:
    """The maximal runs of words that (position, size) hits cover."""
    spans: list[tuple[int, int]] = []
    for p, size in sorted(hits):
        if spans and p <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], p + size))
        else:
            spans.append((p, p + size))
    return spans


def _pieces(window: int):
    """Items as normalised pieces of about PIECE_BYTES that share window - 1 words."""

    def cut(batches):
        import pyarrow as pa

        for whole in batches:
            for batch in byte_batches(whole):
                names, pieces = [], []
                for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                    words = words_of(text)
                    edges = np.cumsum([0] + [len(w) + 1 for w in words])
                    a = 0
                    while a < len(words):
                        b = max(a + window, int(np.searchsorted(edges, edges[a] + PIECE_BYTES)))
                        b = len(words) if b + window >= len(words) else b
                        names.append(item)
                        pieces.append(b" ".join(words[a:b]))
                        a = b - window + 1 if b < len(words) else b
                yield pa.record_batch([pa.array(names, pa.string()), pa.array(pieces, pa.binary())], ["item", "text"])

    return cut


def _in_passes(wanted: DataFrame, items: DataFrame, columns, text: str, then, schema, window: int, passes: int) -> DataFrame:
    """_overlap() for a benchmark beyond one set: a scan for each part of it.

    Pieces are dealt by a hash of item and words after repeated ones are dropped, so parts
    are of about equal size whatever repeats. Only rows with hits leave a scan; their hits
    of all passes meet by row, and rows without any join nothing.
    """
    context = wanted.sparkSession.sparkContext
    row, hit, found_in = fresh(wanted.columns, "row", "hits", "found")
    pieces = items.mapInArrow(_pieces(window), "item string, text binary").distinct()
    pieces = written(pieces.withColumn("part", F.pmod(F.xxhash64("item", "text"), F.lit(passes))), "benchmark-pieces")
    rows = written(wanted.withColumn(row, F.monotonically_increasing_id()), "scanned-documents")
    kind = "array<struct<at: int, size: int>>"
    found = []
    for k in range(passes):
        shared = context.broadcast(NgramSet([(r["item"], r["text"]) for r in pieces.where(F.col("part") == k).collect()], window))

        def scan(batches, shared=shared):
            import pyarrow as pa

            spot = pa.list_(pa.struct([("at", pa.int32()), ("size", pa.int32())]))
            grams = shared.value
            for whole in batches:
                for batch in byte_batches(whole, text):
                    hits = grams.scan(batch.column(text).cast(pa.binary()).to_pylist())
                    some = [i for i, (_, h, _) in enumerate(hits) if h]
                    yield pa.record_batch(
                        [
                            batch.column(row).take(pa.array(some, pa.int32())),
                            pa.array([[{"at": p, "size": n} for p, n in hits[i][1]] for i in some], spot),
                            pa.array([sorted(hits[i][2]) for i in some], pa.list_(pa.string())),
                        ],
                        [row, hit, found_in],
                    )

        found.append(written(rows.select(row, text).mapInArrow(scan, f"`{row}` long, `{hit}` {kind}, `{found_in}` array<string>"), "benchmark-hits"))
        shared.destroy()
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    merged = every.groupBy(row).agg(F.flatten(F.collect_list(hit)).alias(hit), F.array_distinct(F.flatten(F.collect_list(found_in))).alias(found_in))

    def report(batches):
        import pyarrow as pa

        for whole in batches:
            for batch in byte_batches(whole, text):
                texts = batch.column(text).cast(pa.binary()).to_pylist()
                hits, names = batch.column(hit).to_pylist(), batch.column(found_in).to_pylist()
                yield then(batch.select(columns), texts, [(len(words_of(t)), _runs((h["at"], h["size"]) for h in hs or ()), ns or ()) for t, hs, ns in zip(texts, hits, names)])

    return rows.join(merged, row, "left").mapInArrow(report, schema)


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the given runs of words (and what stands between their words)."""
    words = [m.span() for m in re.finditer(rb"\S+", text.translate(_WORD_BYTES))]
    out, end = [], 0
    for first, last in spans:
        out.append(text[end : words[first][0]])
        end = words[last - 1][1]
    return b"".join([*out, text[end:]])


def decontaminate(docs: DataFrame, benchmark: DataFrame, drop_share: float = DROP_SHARE, text_col: str = "text", **options) -> DataFrame:
    """docs without benchmark passages: hit spans are cut out, and a document of which
    drop_share or more words are hit goes as a whole.

    All columns stay, whatever their names; a column n_chars of whole numbers follows the
    new text. Null and empty texts stay as they are. Rows that repeat are treated alike. An
    empty table stays empty, and an empty benchmark changes nothing. options are those of
    find_overlap().
    """
    columns = docs.columns

    def cut(batch, texts, rows):
        import pyarrow as pa

        stay = [sum(b - a for a, b in spans) < drop_share * n or not spans for n, spans, _ in rows]
        if any(spans for _, spans, _ in rows):
            clean = [cut_spans(t, spans).decode("utf-8") if spans else None for t, (_, spans, _) in zip(texts, rows)]
            arrays = dict(zip(columns, batch.columns))
            old = arrays[text_col].to_pylist()
            arrays[text_col] = pa.array([o if c is None else c for o, c in zip(old, clean)], arrays[text_col].type)
            if "n_chars" in arrays and pa.types.is_integer(arrays["n_chars"].type):
                arrays["n_chars"] = pa.array([n if c is None else len(c) for n, c in zip(arrays["n_chars"].to_pylist(), clean)], arrays["n_chars"].type)
            batch = pa.record_batch(list(arrays.values()), columns)
        return batch.filter(pa.array(stay, pa.bool_()))

    return _overlap(docs, benchmark, columns, cut, docs.schema, text_col=text_col, **options)


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_words, n_hit, n_items, items_sha256 and contaminated for every row of documents.

    find_overlap() says what null, empty and very long texts, repeated rows and items, and
    empty tables give. Columns but doc_id and text are not read.
    """
    found = find_overlap(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS_SQL = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP5_SQL = f"""
with dw as (select doc_id, {_WORDS_SQL} as w from documents),
iw as (select item_id, {_WORDS_SQL} as w from benchmark),
g as (
  select distinct item_id, k, array_to_string(w[i : i + k - 1], ' ') as g
  from (select item_id, w, k, unnest(range(1, len(w) - k + 2)) as i
        from (select item_id, w, least({WINDOW}, len(w)) as k from iw where len(w) > 0))),
dg as (
  select doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') as g
  from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i
        from dw, (select distinct k from g) where len(w) >= k)),
hits as (select doc_id, i, k, item_id from dg join g using (k, g)),
hit_words as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(range(i, i + k)) as p from (select distinct doc_id, i, k from hits)) group by doc_id),
hit_items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item_id::varchar as item from hits where item_id is not null) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from dw left join hit_words using (doc_id) left join hit_items using (doc_id)
"""
