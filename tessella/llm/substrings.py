"""Repeated byte strings across a corpus, found by a distributed sparse suffix sort.

A string of MATCH bytes is handed to the gram of GRAM bytes in it whose hash is smallest
(the leftmost of equal ones), its anchor. Equal strings have equal anchors at equal
places, so suffixes need comparing only where an anchor occurs more than once, and the
anchors deal them to tasks. A bucket holds, for each occurrence of its anchor, the bytes
of all strings of that anchor, and the suffixes of those bytes that start equally far from
the anchor are sorted by a bottom-up mergesort. It compares two suffixes by prefix
polynomial hashes: they tell whether two stretches are equal in constant time, a binary
search over their length finds the common extension, and the next byte decides. The common
extension of neighbours in the sorted order gives the result: where it reaches MATCH bytes
from one suffix to the next, all of them start with one string. That is verified byte by
byte, and all but the earliest are repeats.

Three kinds of repeats are settled before the sort, to the same result: of texts that are
equal as a whole (by SHA-256) all but the first are repeats throughout; of equal bytes
around an anchor in one batch, and in one bucket, only the earliest are sorted.
"""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import byte_batches, signed, table, whole_number_ids
from tessella.operators.ordering import with_position
from tessella.sources.shared import written

MATCH = 100
GRAM = 20
REACH = MATCH - GRAM + 1
#: Occurrences of one anchor beyond which its strings are dealt on by what they share, 27
#: neighbouring ones together; and those beyond which each string is dealt by itself.
HOT, VERY_HOT = 3000, 100_000
_TOGETHER = 27
_ROWS_AT_ONCE = 20_000
#: Bytes of texts whose anchors are found together.
_CHUNK = 1 << 16
_WIDTH = REACH - 1 + MATCH
#: Bits of an anchor's hash that go with its place.
_TAG = (1 << 29) - 1
_BASE = 0x9E3779B97F4A7C15
_POWERS = np.array([pow(_BASE, k, 1 << 64) for k in range(_WIDTH + 1)], np.uint64)
_INVERSES = np.array([pow(_BASE, -k, 1 << 64) for k in range(_WIDTH + 1)], np.uint64)
_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of the GRAM bytes from each position on."""
    parts, size, h = [], 1, _BYTES[data]
    while size <= GRAM:
        if GRAM & size:
            parts.append((size, h))
        if 2 * size <= GRAM:
            h = h[:-size] * _POWERS[size] + h[size:]
        size *= 2
    n = len(data) - GRAM + 1
    out, at = np.zeros(n, np.uint64), 0
    for size, h in reversed(parts):
        out = out * _POWERS[size] + h[at : at + n]
        at += size
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return out


def anchors(texts: list[bytes]):
    """(text, gram hash, anchor, first string, last string) of every anchor, as arrays.

    Positions count from the start of the text; the strings of an anchor are those that
    start from `first` to `last`.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    # chunks of whole texts whose arrays stay in a core's cache
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // _CHUNK)) + 1
    edges = [0, *cuts.tolist(), len(texts)]
    found = [_anchors_of(texts[a:b], sizes[a:b], a) for a, b in zip(edges[:-1], edges[1:])]
    return tuple(map(np.concatenate, zip(*found)))


def _anchors_of(texts: list[bytes], sizes: np.ndarray, number: int):
    """What anchors() returns for a chunk whose first text has that number."""
    starts = np.concatenate([[0], np.cumsum(sizes)])
    none = np.zeros(0, np.int64)
    if starts[-1] < MATCH:
        return none, none.view(np.uint64), none, none, none
    h = _gram_hashes(np.frombuffer(b"".join(texts), np.uint8))
    # the order is that of 32 bits of the hash, then of the place: the same in every text
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    low, size = key, 1
    while 2 * size <= REACH:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    rest = REACH - size
    if rest:
        low = np.minimum(low[: len(low) - rest], low[rest:])
    new = np.empty(len(low), bool)
    new[0] = True
    # keys are all different, as places are
    np.not_equal(low[1:], low[:-1], out=new[1:])
    new[starts[starts < len(low)]] = True
    first = np.flatnonzero(new)
    own = np.searchsorted(starts, first, "right") - 1
    inside = first + MATCH <= starts[own + 1]
    first, own = first[inside], own[inside]
    at = (low[first] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # a run ends before the next one, or where its text has no further string
    last = np.minimum(np.concatenate([first[1:], [len(low)]]) - 1, starts[own + 1] - MATCH)
    begin = starts[own]
    return own + number, h[at], at - begin, first - begin, last - begin


def _prefix_hashes(rows: np.ndarray) -> np.ndarray:
    """Of each row's first k bytes b, the sum of (b[i] + 1) * base ** (k - 1 - i); base is odd, so it has an inverse."""
    m, n = rows.shape
    out = np.zeros((m, n + 1), np.uint64)
    for k in range(0, m, 256):  # rows that stay in a core's cache
        body = out[k : k + 256, 1:]
        np.multiply(rows[k : k + 256].astype(np.uint64) + np.uint64(1), _INVERSES[:n], out=body)
        np.cumsum(body, axis=1, out=body)
        body *= _POWERS[:n]
    return out


class _Suffixes:
    """Suffixes of the rows of `data`: of row x from column c to the row's end."""

    def __init__(self, data: np.ndarray, row: np.ndarray, column: np.ndarray, size: np.ndarray, prefix: np.ndarray):
        self.data, self.row, self.column, self.size = data, row, column, size
        self.width = prefix.shape[1]
        self.flat = prefix.ravel()
        self.start = row * self.width + column

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many first bytes agree."""
        a, b = self.start[x], self.start[y]
        ha, hb = self.flat[a], self.flat[b]
        low, high = np.zeros(len(x), np.int64), np.minimum(self.size[x], self.size[y])
        for _ in range(int(high.max(initial=0)).bit_length()):
            mid = (low + high + 1) >> 1
            p = _POWERS[mid]
            same = self.flat[a + mid] - ha * p == self.flat[b + mid] - hb * p
            low = np.where(same, mid, low)
            high = np.where(same, high, mid - 1)
        return low

    def before(self, x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix x stands before y, or (where asked) is equal to it."""
        n = self.common(x, y)
        ended_x, ended_y = n == self.size[x], n == self.size[y]
        # where one has ended, the byte looked at may be any, as it doesn't count
        at_x, at_y = self.column[x] + np.where(ended_x, 0, n), self.column[y] + np.where(ended_y, 0, n)
        less = self.data[self.row[x], at_x] < self.data[self.row[y], at_y]
        return np.where(ended_x & ended_y, or_equal, ended_x | (~ended_y & less))

    def same_bytes(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether the first MATCH bytes are equal, eight at a time (the last eight may overlap)."""
        flat = self.data.ravel()
        words = np.ndarray((len(flat) - 7,), np.uint64, flat, strides=(1,))
        a, b = (self.row[i] * self.data.shape[1] + self.column[i] for i in (x, y))
        out = np.ones(len(x), bool)
        for k in (*range(0, MATCH - 7, 8), MATCH - 8):
            out &= words[a + k] == words[b + k]
        return out


def _mergesort(suffixes: _Suffixes, order: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """order with the suffixes of each group sorted, equal ones as they stood. first, size:
    for each place in order, where its group starts and how many it holds."""
    order = order.copy()
    places = np.flatnonzero(size > 1)
    width = 1
    while len(places):
        begin, n, x = first[places], size[places], order[places]
        t = places - begin
        run = t // width
        right = (run & 1).astype(bool)
        other = begin + (run ^ 1) * width
        count = np.clip(n - (run ^ 1) * width, 0, width)
        low, high = np.zeros(len(places), np.int64), count.copy()
        open_ = np.flatnonzero(low < high)
        while len(open_):
            mid = (low[open_] + high[open_]) >> 1
            # those of the left run go before equal ones of the right run
            up = suffixes.before(order[other[open_] + mid], x[open_], right[open_])
            low[open_] = np.where(up, mid + 1, low[open_])
            high[open_] = np.where(up, high[open_], mid)
            open_ = open_[low[open_] < high[open_]]
        order[begin + (run >> 1) * 2 * width + (t - run * width) + low] = x
        width *= 2
        places = places[n > width]
    return order


def repeats(bucket: np.ndarray, contexts: list[bytes], left: np.ndarray, key: np.ndarray, anchor: np.ndarray):
    """Which rows hold strings that also stand earlier, and the bytes those cover.

    Rows are anchors in order of (bucket, key, anchor): contexts holds the bytes of all
    strings of the anchor that are looked at, left how many of them stand before it.
    Returns row numbers, the covered start and end, and whether all strings are repeats.
    """
    m = len(contexts)
    sizes = np.array([len(c) for c in contexts], np.int64)
    furthest = int(left.max())
    data = np.zeros((m, furthest + int((sizes - left).max())), np.uint8)
    begin = furthest - left
    flat = np.frombuffer(b"".join(contexts), np.uint8)
    offset = np.cumsum(sizes) - sizes
    data[np.repeat(np.arange(m), sizes), np.arange(len(flat)) - np.repeat(offset - begin, sizes)] = flat
    number = sizes - MATCH + 1
    row = np.repeat(np.arange(m), number)
    column = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number) + begin[row]
    suffixes = _Suffixes(data, row, column, (begin + sizes)[row] - column, _prefix_hashes(data))
    new = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    group = np.repeat(np.arange(len(new)), np.diff([*new, m]))
    group = group[row] * REACH + column
    order = np.argsort(group, kind="stable")
    g = group[order]
    starts = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
    n = np.diff([*starts, len(order)])
    several = np.repeat(n > 1, n)
    order, n = order[several], n[n > 1]
    if not len(order):
        return order, order, order, order
    first, size = np.repeat(np.cumsum(n) - n, n), np.repeat(n, n)
    order = _mergesort(suffixes, order, first, size)
    beside = np.flatnonzero(first[1:] == first[:-1]) + 1
    reach = np.zeros(len(order), np.int64)
    reach[beside] = suffixes.common(order[beside], order[beside - 1])
    same = reach >= MATCH
    at = np.flatnonzero(same)
    true = suffixes.same_bytes(order[at], order[at - 1])
    run = np.cumsum(~same) - 1
    if not true.all():  # hashes collided: the runs in question are told apart by their bytes
        for h in np.unique(run[at[~true]]):
            seen: dict[bytes, int] = {}
            for k in np.flatnonzero(run == h):
                x = order[k]
                body = data[row[x], column[x] : column[x] + MATCH].tobytes()
                run[k] = seen.setdefault(body, run.max() + 1)
    # places count in order of (key, anchor) within a group, so a run's earliest is its least
    earliest = np.full(run.max() + 1, len(row), np.int64)
    np.minimum.at(earliest, run, order)
    r, lead = row[order], row[earliest[run]]
    place = anchor[r] - (furthest - column[order])
    # one and the same place may be there twice if rows of the table are repeated
    late = (r != lead) & ((key[r] != key[lead]) | (anchor[r] != anchor[lead]))
    r, place = r[late], place[late]
    if not len(r):
        return r, r, r, r
    # the strings of one anchor all cover it, so they cover one stretch
    by = np.argsort(r, kind="stable")
    r, place = r[by], place[by]
    cut = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
    rows = r[cut]
    return rows, np.minimum.reduceat(place, cut), np.maximum.reduceat(place, cut) + MATCH, np.diff([*cut, len(r)]) == number[rows]


def _find_anchors(batches):
    import pyarrow as pa

    for whole in batches:
        for batch in byte_batches(whole, "_bytes", 2 << 20):
            own, gram, at, _, _ = anchors([t or b"" for t in batch.column("_bytes").to_pylist()])
            yield pa.record_batch([pa.array(signed(gram)), batch.column("_key").take(pa.array(own)), pa.array(at.astype(np.int32))], ["gram", "_key", "at"])


def _cut_contexts():
    """For each listed anchor the bytes of its strings, under the bucket they are sorted in.

    Strings of an anchor with many occurrences (tag: 1 or 2 in its last two bits, above them
    bits of the gram's hash) go by ranges of neighbouring ones, under a hash of the bytes that all strings of the range have in common: equal
    strings have equal ones. Of equal contexts in one batch the first goes on alone; the
    others are repeats of it already, and leave as spans (context null; start, end in
    `at`, `left`). A text that is the copy of an earlier one leaves as one span.
    """

    def cut(batches):
        import pyarrow as pa

        for whole in batches:
            for batch in byte_batches(whole, "_bytes", 2 << 20):
                texts = [t or b"" for t in batch.column("_bytes").to_pylist()]
                keys = batch.column("_key").to_pylist()
                wanted = [{(p, t >> 2): t & 3 for p, t in zip(x.values.field("at").to_pylist(), x.values.field("tag").to_pylist())} for x in batch.column("_listed")]
                out, leading = [], {}
                for o, copies in enumerate(batch.column("_copies").to_pylist()):
                    if copies and hashlib.sha256(texts[o]).digest() in copies:
                        out.append((xxhash.xxh64_intdigest(str(keys[o])), 0, keys[o], 0, len(texts[o]), None))
                        texts[o] = b""
                for o, gram, p, s, e in zip(*(x.tolist() for x in anchors(texts))):
                    crowd = wanted[o].get((p, gram & _TAG))
                    if crowd is None:
                        continue
                    text, key, low, high = texts[o], keys[o], p - e, p - s
                    width = (REACH, _TOGETHER, 1)[crowd]
                    for q in range(low // width, high // width + 1):
                        a, b, part = max(low, q * width), min(high, q * width + width - 1), 0
                        if crowd:
                            part = xxhash.xxh64_intdigest(text[p - q * width : p - q * width - width + 1 + MATCH], q + 1)
                        same = (gram, part, b, text[p - b : p - a + MATCH])
                        first = leading.setdefault(same, (key, p))
                        if first != (key, p):
                            leading[same] = min(first, (key, p))
                            k, x = max(first, (key, p))
                            out.append((xxhash.xxh64_intdigest(str(k)), 0, k, x - b, x - a + MATCH, None))
                out += [(gram, part, key, p, b, context) for (gram, part, b, context), (key, p) in leading.items()]
                long = lambda i: pa.array(signed(np.array([r[i] for r in out], np.uint64)))
                rest = ((2, pa.int64()), (3, pa.int32()), (4, pa.int32()), (5, pa.binary()))
                yield pa.record_batch([long(0), long(1), *(pa.array([r[i] for r in out], t) for i, t in rest)], ["gram", "part", "_key", "at", "left", "context"])

    return cut


def _sort_buckets(batches):
    import pyarrow as pa

    names = ("gram", "part", "_key", "at", "left")

    def spans(key, start, end):
        return pa.record_batch([pa.array(key), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))], ["_key", "start", "end"])

    def found(held, contexts):
        """What repeats() returns; equal contexts of a bucket fold into their first before the sort."""
        gram, part, key, at, left = held
        bucket = np.cumsum(np.concatenate([[0], (gram[1:] != gram[:-1]) | (part[1:] != part[:-1])]))
        seen: dict[tuple, int] = {}
        lead = np.array([seen.setdefault(x, i) for i, x in enumerate(zip(bucket.tolist(), left.tolist(), contexts))])
        own = lead == np.arange(len(lead))
        keep = np.flatnonzero(own)
        more = np.flatnonzero(~own)
        more = more[(key[more] != key[lead[more]]) | (at[more] != at[lead[more]])]
        rows, start, end, throughout = repeats(bucket[keep], [contexts[i] for i in keep.tolist()], left[keep].astype(np.int64), key[keep], at[keep].astype(np.int64))
        begin = at[more].astype(np.int64) - left[more]
        size = np.array([len(contexts[i]) for i in more.tolist()], np.int64)
        join = lambda x, y: np.concatenate([x, y.astype(x.dtype)])
        return join(keep[rows], more), join(start.astype(np.int64), begin), join(end.astype(np.int64), begin + size), join(throughout.astype(bool), np.ones(len(more), bool))

    held, contexts = [np.zeros(0, np.int64)] * len(names), []
    for whole in batches:
        for batch in byte_batches(whole, "context", 1 << 20):
            now = [batch.column(c).to_numpy(zero_copy_only=False) for c in names]
            bare = batch.column("context").is_null().to_numpy(zero_copy_only=False)
            if bare.any():
                yield spans(now[2][bare], now[3][bare], now[4][bare])
            held = [np.concatenate([h, x[~bare]]) for h, x in zip(held, now)]
            contexts += [c for c in batch.column("context").to_pylist() if c is not None]
            if len(contexts) < _ROWS_AT_ONCE:
                continue
            # the last bucket may go on
            cut = np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))
            if len(cut):
                cut = cut[-1] + 1
                rows, start, end, _ = found([h[:cut] for h in held], contexts[:cut])
                yield spans(held[2][rows], start, end)
                held, contexts = [h[cut:] for h in held], contexts[cut:]
            elif len(contexts) >= 2 * _ROWS_AT_ONCE:
                # a bucket that is large: what is a repeat throughout can lead no other row
                rows, start, end, throughout = found(held, contexts)
                yield spans(held[2][rows], start, end)
                stay = np.ones(len(contexts), bool)
                stay[rows[throughout]] = False
                held, contexts = [h[stay] for h in held], [c for c, k in zip(contexts, stay.tolist()) if k]
    if contexts:
        rows, start, end, _ = found(held, contexts)
        yield spans(held[2][rows], start, end)


def merged(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, very_hot: int = VERY_HOT) -> DataFrame:
    """Every row of docs as (id, _bytes, spans): what a string that also stands earlier covers.

    Ids must be whole numbers (a TypeError otherwise), as they tell what is earlier.

    Earlier means a smaller id, or a smaller start in the same document. spans are byte
    ranges (end exclusive), neither sorted nor merged, and null if there are none. A null
    id counts as smaller than all others; rows that share id and text count as one
    document, so repeated rows don't repeat each other, and different texts under one id
    follow one another in the order of a hash. Null text is empty. Texts of fewer than MATCH
    bytes have no span; very long ones are searched whole. Other columns are ignored; an
    empty table gives an empty result.

    Anchors that occur once, most of them, leave after a count that is combined before it
    is shuffled. Of whole texts that are equal the first alone is searched: each string of
    the others stands in it. An anchor with more than `hot` occurrences is dealt on by what neighbouring
    strings of it share, beyond `very_hot` by each string itself, and of equal contexts one
    goes on from each batch, so no bucket grows with the corpus.
    """
    whole_number_ids(docs, id_col)
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)).cast("long"))
    keyed = docs.select(F.col(id_col), key.alias("_key"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_bytes"))
    hashed = keyed.select("_key", F.xxhash64("_bytes").alias("_hash"))
    if not hashed.groupBy("_key").agg(F.min("_hash").alias("a"), F.max("_hash").alias("b")).where("a < b").isEmpty():
        # different texts under one id: their places in the order of both tell them apart
        places = with_position(hashed.distinct(), ["_key", "_hash"])
        keyed = written(keyed.withColumn("_hash", F.xxhash64("_bytes")).join(places, ["_key", "_hash"]).select(id_col, F.col("position").cast("long").alias("_key"), "_bytes"), "numbered")
    found = keyed.select("_key", "_bytes").mapInArrow(_find_anchors, "gram long, _key long, at int")
    crowd = F.when(F.col("n") > very_hot, 2).when(F.col("n") > hot, 1).otherwise(0)
    # a written table, as AQE can't split a hot gram beside an aggregate
    several = written(found.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram", crowd.cast("byte").alias("crowd")), "anchors")
    tag = (F.col("gram").bitwiseAND(_TAG) * 4 + F.col("crowd")).cast("int")
    listed = found.join(several, "gram").select("_key", "at", tag.alias("tag")).groupBy("_key").agg(F.collect_list(F.struct("at", "tag")).alias("_listed"))
    whole = keyed.where(F.octet_length("_bytes") >= MATCH).select("_key", F.unhex(F.sha2("_bytes", 256)).alias("_digest"))
    firsts = written(whole.groupBy("_digest").agg(F.min("_key").alias("_first"), F.max("_key").alias("_last")).where("_first < _last"), "copies")
    copies = whole.join(firsts, "_digest").where("_key > _first").groupBy("_key").agg(F.collect_set("_digest").alias("_copies"))
    # with the id, so that this side and the last join's are dealt out once for both
    contexts = keyed.join(listed.join(copies, "_key", "left"), "_key").mapInArrow(_cut_contexts(), "gram long, part long, _key long, at int, left int, context binary")
    dealt = contexts.repartition("gram", "part").sortWithinPartitions("gram", "part", "_key", "at")
    spans = dealt.mapInArrow(_sort_buckets, "_key long, start int, end int")
    spans = spans.groupBy("_key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return keyed.join(spans, "_key", "left").drop("_key")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, **limits) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256[, kept binary]) for every row of docs.

    kept is the text's bytes without its repeated spans; repeated_spans() says what null,
    empty and long texts, null and repeated ids and an empty table give.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def finish(batches):
        import pyarrow as pa

        for batch in batches:
            n_bytes, n_removed, n_spans, digest, kept = [], [], [], [], []
            for body, spans in zip(batch.column("_bytes").to_pylist(), batch.column("spans").to_pylist()):
                runs = merged((s["start"], s["end"]) for s in spans or ())
                n_bytes.append(len(body))
                n_spans.append(len(runs))
                n_removed.append(sum(b - a for a, b in runs))
                edges = [0, *(x for run in runs for x in run), len(body)]
                rest = b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2]))
                digest.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest)
            columns = [batch.column(id_col), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(digest, pa.string())]
            yield pa.record_batch(columns + [pa.array(kept, pa.binary())] * with_text, [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text)

    schema = f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return repeated_spans(docs, id_col, text_col, **limits).mapInArrow(finish, schema)


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_bytes, n_removed, n_spans and kept_sha256 for every row of documents; see
    repeated_spans() for nulls, repeats and the rest. Columns but doc_id and text are not read."""
    return remove_repeats(table(spark, sf_dir, "documents"))
