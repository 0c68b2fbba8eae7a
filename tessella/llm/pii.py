"""Personal data: patterns, and terms that reveal what the patterns protect.

Patterns find entities (addresses, numbers). Information-theoretic sanitisation then asks
how much the words around an entity give away: with c(t, e) the different texts in which
term t stands near entity e and c(t) the different texts that hold t anywhere in the corpus,
the posterior P(e | t) = c(t, e) / c(t) is what a reader of t alone would know of e (its
pointwise mutual information with e is that posterior over e's prior). The same is asked of
an entity's kind, with c(t, k) the different texts in which t stands near any entity of kind
k, as most personal data occurs once. Terms whose posterior reaches a threshold, with enough
different texts behind it, are disclosed: they are masked beside that entity or, as in the
query and the pipeline, everywhere.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import byte_batches, schema_of, table
from tessella.sources.shared import written

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: Words on either side of an entity that are looked at, and how far away they may reach.
NEAR_WORDS, NEAR_CHARS = 5, 80
#: Different texts in which a term must stand near an entity, and the posterior from which it is disclosed.
LEAST_TEXTS, DISCLOSED = 3, 0.5
#: Candidate terms up to which their set is broadcast for counting; beyond it all terms are counted.
BROADCAST_TERMS = 100_000
_HELD_COUNTS = 500_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match that fails from a run's first digit fails from its others, so only runs' starts are tried
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"\w+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str):
    """Leftmost non-overlapping addresses. The local part of a match always reaches the @, so
    each @ has one candidate: as far back as local characters go, not into the match before."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def find_entities(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind and start: what the patterns find, leftmost per kind."""
    out = []
    if "@" in text:
        out += [(0, a, b) for a, b in _emails(text)]
    if "." in text:
        out += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = re.sub(r"[^0-9]", "", m[0])
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return out


def content_key(text: str) -> int:
    """A hash of the text as a signed 64-bit number."""
    key = xxhash.xxh64_intdigest(text.encode())
    return key - (1 << 64) if key >> 63 else key


def entity_key(kind: int, value: str) -> int:
    """The same for the same entity however it is written, as a signed 64-bit number."""
    plain = value.lower() if kind == 0 else re.sub(r"[^0-9.]" if kind == 1 else r"[^0-9]", "", value)
    key = xxhash.xxh64_intdigest(f"{kind}:{plain}")
    return key - (1 << 64) if key >> 63 else key


def _terms(text: str, entities: list[tuple[int, int, int]]) -> list[dict]:
    """The words near each entity that are part of none."""
    taken = sorted((a, b) for _, a, b in entities)
    out = []
    for kind, start, end in entities:
        low, high = max(0, start - NEAR_CHARS), min(len(text), end + NEAR_CHARS)
        words = [m.span() for m in _WORD.finditer(text, low, high)]
        # a word that the window cuts is left out
        words = [(a, b) for a, b in words if not (a == low > 0 and _WORD.match(text[a - 1])) and not (b == high < len(text) and _WORD.match(text[b]))]
        before = [w for w in words if w[1] <= start][-NEAR_WORDS:]
        after = [w for w in words if w[0] >= end][:NEAR_WORDS]
        key = entity_key(kind, text[start:end])
        out += [{"term": text[a:b].lower(), "start": a, "end": b, "entity": key, "kind": kind} for a, b in before + after if not any(a < y and x < b for x, y in taken)]
    return out


_ENTITIES = "entities array<struct<kind: int, start: int, end: int>>"
_FOUND = f"{_ENTITIES}, near array<struct<term: string, start: int, end: int, entity: long, kind: long>>, content long"


def _scanned(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """keep columns of every row, with its entities, the terms near them, and a hash of the text."""
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def scan(batches):
        import pyarrow as pa
        from pyarrow import int32, int64, list_, string, struct

        entity = list_(struct([("kind", int32()), ("start", int32()), ("end", int32())]))
        near = list_(struct([("term", string()), ("start", int32()), ("end", int32()), ("entity", int64()), ("kind", int64())]))
        for whole in batches:
            for batch in byte_batches(whole, text_col):
                found, terms, content = [], [], []
                for t in batch.column(text_col).to_pylist():
                    e = find_entities(t or "")
                    found.append([{"kind": k, "start": a, "end": b} for k, a, b in e])
                    terms.append(_terms(t, e) if e else [])
                    content.append(content_key(t) if e else 0)
                arrays = [pa.array(found, entity), pa.array(terms, near), pa.array(content, int64())]
                yield pa.record_batch([*(batch.column(c) for c in keep), *arrays], [*keep, "entities", "near", "content"])

    return docs.select(*dict.fromkeys([*keep, text_col])).mapInArrow(scan, ", ".join(filter(None, [fields, _FOUND])))


def disclosed_terms(found: DataFrame, docs: DataFrame, text_col: str = "text", least_texts: int = LEAST_TEXTS, disclosed: float = DISCLOSED, broadcast_terms: int = BROADCAST_TERMS) -> DataFrame:
    """(term, entity, posterior) of the terms that give an entity, or else its kind, away.

    found: rows with `near` and `content`; docs: the whole corpus, in which the terms are
    counted. entity is entity_key(), or the kind's number for a term that discloses no
    single entity but its kind. Copies of one text count once, near an entity and in the corpus, so they
    neither disclose a term by themselves nor hide one. Counts are combined in each task
    before they are shuffled; of the texts themselves only those with copies are.
    """
    near = found.select("content", F.explode("near").alias("n")).select("content", "n.term", F.explode(F.array("n.entity", "n.kind")).alias("entity"))
    pairs = written(
        near.groupBy("term", "entity").agg(F.count_distinct("content").alias("texts")).where(F.col("texts") >= least_texts), "near-terms"
    )
    # a term in more texts than `most` discloses nothing
    terms = written(pairs.groupBy("term").agg(F.floor(F.max("texts") / disclosed).alias("most")), "candidate-terms")
    few = terms.count() <= broadcast_terms
    wanted = docs.sparkSession.sparkContext.broadcast({r["term"]: r["most"] for r in terms.collect()} if few else None)

    def count(batches):
        """(term, n): in how many texts of the task each term stands. Counting a candidate
        ends one beyond its most, as its sum over tasks then is beyond it too."""
        import pyarrow as pa

        def counted():
            return pa.record_batch([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["term", "n"])

        most = wanted.value
        if most is not None and not most:
            return
        counts: Counter = Counter()
        open_terms = None if most is None else set(most)
        for whole in batches:
            for batch in byte_batches(whole, "text"):
                for t in batch.column("text").to_pylist():
                    words = set(map(str.lower, set(_WORD.findall(t))))
                    if open_terms is not None:
                        words &= open_terms
                    counts.update(words)
                    if open_terms is not None:
                        open_terms.difference_update([w for w in words if counts[w] > most[w]])
                if open_terms is None and len(counts) > _HELD_COUNTS:
                    yield counted()
                    counts.clear()
        yield counted()

    key = F.xxhash64("text").alias("content")
    texts = docs.select(F.col(text_col).alias("text")).where(F.length("text") > 0)
    keyed = texts.select("text", key)
    # texts that stand alone are counted where they are; only those with copies are moved, and folded
    copied = written(texts.select(key).groupBy("content").agg(F.count("*").alias("n")).where("n > 1").select("content"), "copied-texts")
    alone = keyed.join(copied, "content", "left_anti").select("text")
    folded = keyed.join(copied, "content", "left_semi").dropDuplicates(["content"]).select("text")
    counts = alone.mapInArrow(count, "term string, n long").unionByName(folded.mapInArrow(count, "term string, n long"))
    if not few:
        counts = counts.join(terms, "term", "left_semi").select("term", "n")
    totals = counts.groupBy("term").agg(F.sum("n").alias("n"))
    posterior = F.col("texts") / F.col("n")
    flagged = written(pairs.join(totals, "term").select("term", "entity", posterior.alias("posterior")).where(F.col("posterior") >= disclosed), "posteriors")
    by_kind = F.col("entity").between(0, len(KINDS) - 1)
    alone = flagged.where(~by_kind)
    return alone.unionByName(flagged.where(by_kind).join(alone.select("term").distinct(), "term", "left_anti").select("term", "entity", "posterior"))


def _places(text: str, entities: list[tuple[int, int, int]], only: frozenset | None) -> list[dict]:
    """The words of the whole text that are part of no entity: those among `only`, or all."""
    if only is not None and (not only or only.isdisjoint(map(str.lower, set(_WORD.findall(text))))):
        return []
    taken = sorted((a, b) for _, a, b in entities)
    starts, ends = [a for a, _ in taken], [0, *accumulate((b for _, b in taken), max)]
    words = ((m[0].lower(), *m.span()) for m in _WORD.finditer(text))
    # of the entities that start before a word ends, none ends after the word starts
    return [{"term": w, "start": a, "end": b} for w, a, b in words if (only is None or w in only) and ends[bisect_left(starts, b)] <= a]


def _disclosed_anywhere(docs: DataFrame, text_col: str, thresholds: dict):
    """(terms, few, wanted): the terms that disclose something in docs, whether they are at
    most broadcast_terms, and if so the broadcast set of them (else a broadcast None). Terms are at most
    NEAR_CHARS characters long, so their number bounds the set."""
    near = written(_scanned(docs, text_col, []).where(F.size("near") > 0), "near")
    flagged = disclosed_terms(near, docs, text_col, **thresholds)
    terms = written(flagged.select("term").distinct(), "flagged-terms")
    few = terms.count() <= thresholds.get("broadcast_terms", BROADCAST_TERMS)
    return terms, few, docs.sparkSession.sparkContext.broadcast(frozenset(r["term"] for r in terms.collect()) if few else None)


def _everywhere(docs: DataFrame, text_col: str, keep: list[str], thresholds: dict) -> DataFrame:
    """(keep..., entities, terms) with every occurrence of a disclosed term in every row."""
    terms, few, wanted = _disclosed_anywhere(docs, text_col, thresholds)

    def scan(batches):
        import pyarrow as pa
        from pyarrow import int32, list_, string, struct

        entity = list_(struct([("kind", int32()), ("start", int32()), ("end", int32())]))
        place = list_(struct([("term", string()), ("start", int32()), ("end", int32())]))
        only = wanted.value
        for whole in batches:
            for batch in byte_batches(whole, text_col):
                found, places = [], []
                for t in batch.column(text_col).to_pylist():
                    e = find_entities(t or "")
                    found.append([{"kind": k, "start": a, "end": b} for k, a, b in e])
                    places.append(_places(t or "", e, only))
                yield pa.record_batch([*(batch.column(c) for c in keep), pa.array(found, entity), pa.array(places, place)], [*keep, "entities", "_places"])

    span = "array<struct<start: int, end: int>>"
    found = docs.select(*dict.fromkeys([*keep, text_col])).mapInArrow(scan, f"{schema_of(docs, keep)}, {_ENTITIES}, _places array<struct<term: string, start: int, end: int>>")
    if few:
        return found.select(*keep, "entities", F.transform("_places", lambda w: F.struct(w["start"], w["end"])).cast(span).alias("terms"))
    found = written(found.withColumn("_row", F.monotonically_increasing_id()), "words")
    words = found.select("_row", F.explode("_places").alias("w")).select("_row", "w.*").join(terms, "term", "left_semi")
    spans = words.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("terms"))
    return found.join(spans, "_row", "left").select(*keep, "entities", F.coalesce("terms", F.array().cast(span)).alias("terms"))


def find_personal_data(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), everywhere: bool = False, **thresholds) -> DataFrame:
    """(keep..., entities, terms) for every row of docs.

    entities: struct(kind index into KINDS, start, end), by kind and start; terms: struct(
    start, end) of disclosed terms, sorted: with `everywhere` each occurrence in any row,
    else those beside an entity that they disclose. Positions are code points, end exclusive. Null
    text counts as empty, and empty texts have neither; very long texts are searched whole.
    Rows with null or repeated ids are handled one by one, and copies count once towards
    what is disclosed; columns of docs that keep doesn't name are ignored, and keep must
    not name the result's own. An empty table gives an empty result.
    """
    keep = list(keep)
    if everywhere:
        return _everywhere(docs, text_col, keep, thresholds)
    found = written(_scanned(docs, text_col, keep).withColumn("_row", F.monotonically_increasing_id()), "entities")
    flagged = written(disclosed_terms(found, docs, text_col, **thresholds), "disclosed-terms")
    near = found.where(F.size("near") > 0).select("_row", F.explode("near").alias("n")).select("_row", "n.term", "n.start", "n.end", F.explode(F.array("n.entity", "n.kind")).alias("entity"))
    terms = (
        near.join(flagged, ["term", "entity"], "left_semi")
        .groupBy("_row")
        .agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("terms"))
    )
    none = F.array().cast("array<struct<start: int, end: int>>")
    # texts without an entity need no join
    plain = found.where(F.size("near") == 0).select(*keep, "entities", none.alias("terms"))
    others = found.where(F.size("near") > 0).join(terms, "_row", "left").select(*keep, "entities", F.coalesce("terms", none).alias("terms"))
    return plain.unionByName(others)


def masked(text: str, entities, terms) -> str:
    """text with entities generalised to their kind and disclosed terms to [TERM]. Of
    spans that overlap the one that starts first stands for all."""
    spans = sorted([(e["start"], -e["end"], f"[{KINDS[e['kind']].upper()}]") for e in entities] + [(t["start"], -t["end"], "[TERM]") for t in terms])
    out, end = [], 0
    for a, b, label in spans:
        b = -b
        if a >= end:
            out += [text[end:a], label]
        end = max(end, b)
    return "".join([*out, text[end:]])


def sanitise(docs: DataFrame, text_col: str = "text", everywhere: bool = False, **thresholds) -> DataFrame:
    """docs with personal data masked in text_col; a column n_chars of whole numbers follows.

    Every row and all columns stay, whatever their names. Null and empty texts stay as they
    are. Rows with null or repeated ids are masked one by one; repeated rows stay equal. An
    empty table stays empty. everywhere and thresholds are those of find_personal_data().
    """
    columns = docs.columns
    # plain names meanwhile, so that no column clashes with those of the search
    plain = [f"c{i}" for i in range(len(columns))]
    text, n_chars = plain[columns.index(text_col)], dict(zip(columns, plain)).get("n_chars")
    docs, schema = docs.toDF(*plain), docs.schema

    def result(batch, entities, terms):
        import pyarrow as pa

        arrays = {c: batch.column(c) for c in plain}
        if any(entities) or any(terms):
            texts = [masked(t, e, s) if e or s else t for t, e, s in zip(arrays[text].to_pylist(), entities, terms)]
            arrays[text] = pa.array(texts, arrays[text].type)
            if n_chars and pa.types.is_integer(arrays[n_chars].type):
                arrays[n_chars] = pa.array([len(t) if e or s else n for t, e, s, n in zip(texts, entities, terms, arrays[n_chars].to_pylist())], arrays[n_chars].type)
        return pa.record_batch(list(arrays.values()), columns)

    if everywhere:
        _, few, wanted = _disclosed_anywhere(docs, text, thresholds)
        if few:

            def find_and_mask(batches):
                only = wanted.value
                for whole in batches:
                    for batch in byte_batches(whole, text):
                        texts = [t or "" for t in batch.column(text).to_pylist()]
                        found = [find_entities(t) for t in texts]
                        terms = [_places(t, e, only) for t, e in zip(texts, found)]
                        yield result(batch, [[{"kind": k, "start": a, "end": b} for k, a, b in e] for e in found], terms)

            # one Python worker a task finds and masks
            return docs.mapInArrow(find_and_mask, schema)

    def mask(batches):
        for whole in batches:
            for batch in byte_batches(whole, text):
                yield result(batch, batch.column("entities").to_pylist(), batch.column("terms").to_pylist())

    return find_personal_data(docs, text, tuple(plain), everywhere, **thresholds).mapInArrow(mask, schema)


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_email, n_ip, n_card, n_phone, base_sha256 and spans for every row of documents.

    find_personal_data() says what null, empty and very long texts, repeated rows and an
    empty table give. spans lists the patterns' spans by kind and start, then those of
    disclosed terms by start. Columns but doc_id and text are not read.
    """
    found = find_personal_data(table(spark, sf_dir, "documents"), everywhere=True)
    kinds = F.array(*map(F.lit, KINDS))
    count = lambda k: F.size(F.filter("entities", lambda e: e["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    base = F.transform("entities", lambda e: F.concat_ws(":", F.get(kinds, e["kind"]), e["start"], e["end"]))
    more = F.transform("terms", lambda t: F.concat_ws(":", F.lit(TERM), t["start"], t["end"]))
    return found.select("doc_id", *map(count, range(4)), F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join(F.concat(base, more), ",").alias("spans"))
