"""Secret scans by a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over trigrams that any
match must contain. Each segment of documents (what a task has in hand) is indexed: the
postings of the trigrams that queries ask for are built from all of its text, combined
as the query says, and only the candidates are held against the expression. A rule
without a mandatory trigram scans its segment fully. No index leaves its task.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as sre
from re import _parser

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import byte_batches, table


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of an ASCII expression; those whose group is
    shorter than `least` are dropped."""

    kind: str
    expression: str
    group: int = 0
    least: int = 1


BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)
RULES = BASE_RULES + MORE_RULES

#: A query: True (anything may match), a trigram, or ("and" | "or", queries).
Query = bool | bytes | tuple


def trigram_query(expression: str) -> Query:
    """What any match contains, over trigrams of text in ASCII lower case."""
    return _of_sequence(_parser.parse(expression))


def _of_sequence(items) -> Query:
    found: list[Query] = []
    run = bytearray()

    def flush():
        found.extend(bytes(run[i : i + 3]) for i in range(len(run) - 2))
        run.clear()

    def walk(items):
        for op, arg in items:
            if op is sre.LITERAL and arg < 128:
                run.append(ord(chr(arg).lower()))
            elif op is sre.SUBPATTERN:
                walk(arg[3])
            elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] == arg[1]:
                for _ in range(arg[0]):
                    walk(arg[2])
            else:
                flush()
                if op is sre.BRANCH:
                    found.append(_combine("or", [_of_sequence(x) for x in arg[1]]))
                elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0]:
                    found.append(_of_sequence(arg[2]))

    walk(items)
    flush()
    return _combine("and", found)


def _combine(how: str, parts: list[Query]) -> Query:
    if how == "or" and any(p is True for p in parts):
        return True
    parts = [p for p in dict.fromkeys(parts) if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else (how, tuple(parts))


def _trigrams(query: Query) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(_trigrams, query[1]))


class Scanner:
    """Rules with their queries; indexes and scans one segment after another."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.queries = [trigram_query(r.expression) for r in rules]
        wanted = sorted(set().union(*map(_trigrams, self.queries)))
        self.number = {t: i + 1 for i, t in enumerate(wanted)}
        # 16 million places hold any number of trigrams; two bytes each while that is enough
        self.lookup = np.zeros(1 << 24, np.uint16 if len(wanted) < 1 << 16 else np.uint32)
        for t, i in self.number.items():
            self.lookup[int.from_bytes(t, "big")] = i
        self.text_forms = [re.compile(r.expression, re.ASCII) for r in rules]
        self.byte_forms = [re.compile(_at_least(r).encode(), re.ASCII) for r in rules]

    def postings(self, texts: list[bytes]) -> np.ndarray:
        """For each wanted trigram (row 0: none) which texts hold it."""
        out = np.zeros((len(self.number) + 1, len(texts)), bool)
        joined = np.frombuffer(b"\0\0".join(texts).lower(), np.uint8)
        if len(joined) > 2:
            code = joined[:-2].astype(np.int32) << 16 | joined[1:-1].astype(np.int32) << 8 | joined[2:]
            which = self.lookup[code]
            at = np.flatnonzero(which)
            ends = np.cumsum([len(t) + 2 for t in texts])
            out[which[at], np.searchsorted(ends, at, "right")] = True
        return out

    def candidates(self, query: Query, postings: np.ndarray) -> np.ndarray:
        if query is True:
            return np.ones(postings.shape[1], bool)
        if isinstance(query, bytes):
            return postings[self.number[query]]
        parts = [self.candidates(q, postings) for q in query[1]]
        return np.logical_and.reduce(parts) if query[0] == "and" else np.logical_or.reduce(parts)

    def scan(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """For each text its spans (start, rule, end) in code points, sorted."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        postings = self.postings(texts)
        for k, (rule, query) in enumerate(zip(self.rules, self.queries)):
            for i in np.flatnonzero(self.candidates(query, postings)).tolist():
                # an ASCII expression matches in UTF-8 where it matches in the text
                if self.byte_forms[k].search(texts[i]):
                    found = self.text_forms[k].finditer(texts[i].decode())
                    out[i] += [(m.start(), k, m.end()) for m in found if m.end(rule.group) - m.start(rule.group) >= rule.least]
        return [sorted(x) for x in out]


def _at_least(rule: Rule) -> str:
    """For one repeated class, the same with its least number: the scan then skips short runs."""
    expression = rule.expression
    if rule.group == 0 and rule.least > 1 and re.fullmatch(r"\[[^\]]+\]\+", expression):
        return f"{expression[:-1]}{{{rule.least},}}"
    return expression


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<kind, start, end>>) for every row of docs, by start and then
    by the rules' order. Positions are code points, end exclusive. Null text is empty, and
    empty texts have no span; very long texts are scanned whole, 1 MB of texts at a time
    unless one is longer. Spans of different rules may overlap. Rows with null or repeated
    ids are scanned like any other; other columns are ignored, whatever their names; an
    empty table gives an empty result."""
    kind = docs.schema[id_col].dataType.simpleString()

    def scan(batches):
        import pyarrow as pa

        scanner = Scanner(rules)
        spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for whole in batches:
            for batch in byte_batches(whole, limit=1 << 20):
                found = scanner.scan([t or b"" for t in batch.column("text").to_pylist()])
                values = [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in x] for x in found]
                yield pa.record_batch([batch.column("id"), pa.array(values, spans)], [id_col, "spans"])

    wanted = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    return wanted.mapInArrow(scan, f"`{id_col}` {kind}, spans array<struct<kind: string, start: int, end: int>>")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans for every row of documents.

    scan_secrets() says what null, empty and very long texts, repeated rows and an empty
    table give; a document without a secret has 0s, the digest of nothing and no spans.
    """
    found = scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE_RULES]))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *(count(r.kind) for r in BASE_RULES), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )
