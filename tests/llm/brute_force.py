"""Plain, slow answers to hold the operators against."""

import re
from collections import Counter

import numpy as np
import xxhash


def components(n, pairs):
    label = list(range(n))

    def root(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            label[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def simhash(text):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(ids, fps, bits=3):
    order = np.argsort(np.array(ids))
    v = np.array(fps, np.uint64)[order]
    pairs = [(i, i + 1 + j) for i in range(len(v)) for j in np.flatnonzero(np.bitwise_count(v[i] ^ v[i + 1 :]) <= bits)]
    found = components(len(v), pairs)
    ids = np.array(ids)[order]
    return {int(ids[i]): int(ids[r]) for i, r in enumerate(found)}


def repeated_bytes(docs, match=100):
    """{id: (n_bytes, n_removed, n_spans, kept)} by a set of all strings seen so far."""
    seen, out = set(), {}
    for key in sorted(docs):
        body = (docs[key] or "").encode()
        gone = bytearray(len(body))
        for i in range(len(body) - match + 1):
            s = body[i : i + match]
            if s in seen:
                gone[i : i + match] = b"\1" * match
            else:
                seen.add(s)
        kept = bytes(b for b, g in zip(body, gone) if not g)
        out[key] = (len(body), sum(gone), len([1 for x in bytes(gone).split(b"\0") if x]), kept)
    return out


M = (1 << 64) - 1
BUCKETS = 1 << 17


def bucket(h):
    h = ((h ^ h >> 32) * 0xD6E8FEB86659FD93) & M
    return 1 + (h ^ h >> 29) % (BUCKETS - 1)


def features(word):
    """The buckets of a word, one feature after another, in Python's numbers."""
    marked = [ord(c) for c in f"<{word}>"]
    for n in (2, 3, 4):
        for i in range(len(marked) - n + 1):
            h = 0
            for c in marked[i : i + n]:
                h = (h * 0x9E3779B97F4A7C15 + c) & M
            yield bucket((h + n) & M)
    whole = 0
    for i, c in enumerate(marked):
        h = ((c + 1) * 0xD6E8FEB86659FD93 + (len(marked) - i) * 0x9E3779B97F4A7C15) & M
        h = ((h ^ h >> 31) * 0xD6E8FEB86659FD93) & M
        whole = (whole + (h ^ h >> 30)) & M
    yield bucket(whole)


def luhn(text):
    digits = [int(c) for c in text if c.isdigit()][::-1]
    return (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0


KINDS = (
    ("EMAIL", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("IP", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("CARD", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= sum(map(str.isdigit, m)) <= 19 and luhn(m)),
    ("PHONE", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= sum(map(str.isdigit, m)) <= 15),
)


def entities(text):
    return [(k, *m.span()) for k, (_, form, fits) in enumerate(KINDS) for m in re.finditer(form, text) if fits(m[0])]


def words_outside(text, found):
    return [(m[0].lower(), *m.span()) for m in re.finditer(r"\w+", text) if not any(x < m.end() and m.start() < y for _, x, y in found)]


def disclosing(texts, least=3, share=0.5):
    """{(term, key): posterior}; a key is a kind's number, or (kind, value in its plain form)."""
    beside, holds = Counter(), Counter()
    for t in set(texts):
        found = entities(t)
        holds.update({m.lower() for m in re.findall(r"\w+", t)})
        near = set()
        for kind, a, b in found:
            plain = t[a:b].lower() if kind == 0 else re.sub(r"[^0-9.]" if kind == 1 else r"[^0-9]", "", t[a:b])
            every = [(m[0].lower(), *m.span()) for m in re.finditer(r"\w+", t)]
            picked = [w for w in every if w[2] <= a and w[1] >= a - 80][-5:] + [w for w in every if w[1] >= b and w[2] <= b + 80][:5]
            outside = set(words_outside(t, found))
            near |= {(w[0], key) for w in picked if w in outside for key in (kind, (kind, plain))}
        beside.update(near)
    return {k: n / holds[k[0]] for k, n in beside.items() if n >= least and n / holds[k[0]] >= share}


def masked(text, terms):
    found = entities(text)
    spans = [(a, -b, f"[{KINDS[k][0]}]") for k, a, b in found] + [(a, -b, "[TERM]") for w, a, b in words_outside(text, found) if w in terms]
    out, end = "", 0
    for a, b, label in sorted(spans):
        if a >= end:
            out += text[end:a] + label
        end = max(end, -b)
    return out + text[end:]


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def folded(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def decontaminated(text, items, size=10, share=0.5):
    """The text without spans of benchmark words; None if it goes as a whole."""
    grams = set()
    for item in items:
        g = WORD.findall(folded(item))
        n = min(size, len(g))
        grams |= {tuple(g[k : k + n]) for k in range(len(g) - n + 1)} if n else set()
    spans = [m.span() for m in WORD.finditer(folded(text))]
    words = [folded(text)[a:b] for a, b in spans]
    hit = set()
    for n in {len(g) for g in grams}:
        for k in range(len(words) - n + 1):
            if tuple(words[k : k + n]) in grams:
                hit |= set(range(k, k + n))
    if not hit:
        return text
    if len(hit) >= share * len(words):
        return None
    out, end = "", 0
    for k in sorted(hit):
        if k - 1 not in hit:
            out += text[end : spans[k][0]]
        end = spans[k][1]
    return out + text[end:]
