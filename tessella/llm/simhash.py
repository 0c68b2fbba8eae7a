"""SimHash near-duplicates through a segment-popcount embedding.

A fingerprint is embedded as the numbers of set bits in its 32 two-bit segments. One
flipped bit changes one of those numbers by one, so the Manhattan distance of two
embeddings never exceeds the Hamming distance of the fingerprints. Fingerprints within
three bits therefore have, in one of the two halves of 16 segments, embeddings at a
distance of one at most. The grid's cells are the half embeddings: a fingerprint stands
in its two cells and looks into the cells one step up from each (if two differ by one
step, one of them is the lower). Pairs that meet are held against the Manhattan bound
over all segments, and those that pass are verified by the exact Hamming distance.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm.common import byte_batches, fresh, signed, table
from tessella.operators.graph import connected_components
from tessella.sources.shared import written

SEED = 42
SHINGLE = 3
MAX_BITS = 3
#: Fingerprints standing in a cell beyond which its pairs are dealt to several tasks.
CELL_BLOCK = 4000
_PAIRS_AT_ONCE = 1 << 21


def fingerprint_values(texts: list[bytes], shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Unsigned 64-bit SimHash of each text: ASCII lower case, words between ASCII white space."""
    out = np.zeros(len(texts), np.uint64)
    hashes, owners, starts, n = [], [], [], 0
    for i, t in enumerate(texts):
        words = t.lower().split()
        if not words:
            continue
        if len(words) < shingle:
            of = [b" ".join(words)]
        else:
            of = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
        h = np.fromiter(map(xxhash.xxh64_intdigest, of, repeat(seed)), np.uint64, max(1, len(words) - shingle + 1))
        hashes.append(h)
        owners.append(i)
        starts.append(n)
        n += len(h)
    if not owners:
        return out
    bits = np.unpackbits(np.concatenate(hashes).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    size = np.diff([*starts, n])
    out[owners] = np.packbits(2 * ones > size[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp long) for every row of docs; null text counts as empty, without words fp is 0."""
    kind = docs.schema[id_col].dataType.simpleString()
    return _fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), [id_col], f"`{id_col}` {kind}")


def _fingerprints(rows: DataFrame, names: list[str], schema: str) -> DataFrame:
    """rows' columns under the given names, but for the last, text, which becomes fp."""

    def compute(batches):
        import pyarrow as pa

        for whole in batches:
            for batch in byte_batches(whole, limit=1 << 20):
                fp = fingerprint_values([t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()])
                yield pa.record_batch([*batch.columns[:-1], pa.array(signed(fp))], [*names, "fp"])

    return rows.mapInArrow(compute, f"{schema}, fp long")


def unary(fp: np.ndarray) -> np.ndarray:
    """Segment counts 0, 1, 2 as bits 00, 01, 11: differing bits are the Manhattan distance."""
    low, high = np.uint64(0x5555555555555555), np.uint64(1)
    up = fp >> high
    return ((fp | up) & low) | ((fp & up & low) << high)


def _embedding(fp, half: int):
    """Two-bit fields with the number of set bits of each two-bit segment of one half."""
    bits = F.shiftrightunsigned(fp, 32 * half).bitwiseAND(F.lit(0xFFFFFFFF))
    return bits - F.shiftrightunsigned(bits, 1).bitwiseAND(F.lit(0x55555555))


def _cells(fps: DataFrame) -> DataFrame:
    """(cell, look, fp): where each fingerprint stands (look = 0) and looks (look = 1)."""
    both = F.array(
        *(_embedding(F.col("fp"), half).bitwiseOR(F.lit(half << 32).cast("long")) for half in (0, 1))
    )
    halves = fps.select("fp", F.explode(both).alias("k"))
    steps = F.array(*(F.lit(1 << 2 * i).cast("long") for i in range(16)))
    # a field of value 2 has its high bit set and can't go up
    up = F.transform(F.filter(steps, lambda s: F.col("k").bitwiseAND(s * 2) == 0), lambda s: F.struct((F.col("k") + s).alias("cell"), F.lit(1).alias("look")))
    own = F.array(F.struct(F.col("k").alias("cell"), F.lit(0).alias("look")))
    return halves.select("fp", F.explode(F.concat(own, up)).alias("x")).select("x.cell", "x.look", "fp")


def _spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star for each component of the given pairs: as many edges as nodes at most."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        m = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, m)
        np.minimum.at(new, y, m)
        np.minimum.at(new, label[x], m)
        np.minimum.at(new, label[y], m)
        new = new[new]
        if (new == label).all():
            keep = label != np.arange(len(nodes))
            return nodes[keep], nodes[label[keep]]
        label = new


def _verified(fp: np.ndarray, first: np.ndarray, size: np.ndarray, max_bits: int):
    """Links among groups given as rows of fp, `first` holding for each row that starts pairs
    the row its partners start from and `size` their number."""
    code = unary(fp)
    rows = np.flatnonzero(size)
    found_a, found_b = [], []
    total = np.cumsum(size[rows])
    begin = 0
    while begin < len(rows):
        done = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, done + _PAIRS_AT_ONCE, "right")))
        r = rows[begin:end]
        n = size[r]
        a = np.repeat(r, n)
        b = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[r], n)
        near = np.bitwise_count(code[a] ^ code[b]) <= max_bits
        a, b = a[near], b[near]
        near = np.bitwise_count(fp[a] ^ fp[b]) <= max_bits
        found_a.append(fp[a[near]])
        found_b.append(fp[b[near]])
        begin = end
    a, b = np.concatenate(found_a or [fp[:0]]), np.concatenate(found_b or [fp[:0]])
    other = a != b
    return _spanning(a[other], b[other])


def _search(max_bits: int):
    def search(batches):
        """Rows come sorted by (cell, unit, look); groups of equal cell and unit are compared.

        In a unit of one block all that stand pair with one another and with all that look;
        in a unit of two blocks (look says which) only those of different blocks pair.
        """
        import pyarrow as pa

        def done(cell, unit, look, fp):
            if not len(cell):
                return None
            fp = fp.view(np.uint64)
            new = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]) | (unit[1:] != unit[:-1])]))
            length = np.diff([*new, len(cell)])
            end = np.repeat(new + length, length)
            place = np.arange(len(cell))
            standing = np.add.reduceat((look == 0).astype(np.int64), new)
            border = np.repeat(new + standing, length)
            two = unit < 0
            first = np.where(two, border, place + 1)
            size = np.where(look == 0, end - first, 0)
            a, b = _verified(fp, first, size, max_bits)
            return pa.record_batch([pa.array(signed(a)), pa.array(signed(b))], ["a", "b"]) if len(a) else None

        held = None
        for batch in batches:
            now = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "unit", "look", "fp")]
            if held is not None:
                now = [np.concatenate(x) for x in zip(held, now)]
            cut = np.flatnonzero((now[0] != now[0][-1:]) | (now[1] != now[1][-1:]))
            cut = cut[-1] + 1 if len(cut) else 0
            held = [x[cut:] for x in now]
            out = done(*(x[:cut] for x in now))
            if out is not None:
                yield out
        if held is not None and (out := done(*held)) is not None:
            yield out

    return search


def _crowded(cells: DataFrame, block: int) -> DataFrame:
    """(cell, stand, look): numbers of blocks of the cells in which more than `block`
    fingerprints stand, or into which more may look; stand is 0 where none stands.

    Looks come from cells one step below. Their number is bounded from above by what the
    fuller ones among those hold, and a block for all others, so looks need no count.
    """
    steps = F.array(*(F.lit(1 << 2 * i).cast("long") for i in range(16)))
    standing = written(cells.where("look = 0").groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > block // 32), "standing")
    half = F.col("cell").bitwiseAND(F.lit(0xFFFFFFFF))
    above = F.transform(F.filter(steps, lambda s: half.bitwiseAND(s * 2) == 0), lambda s: F.col("cell") + s)
    looks = standing.select(F.explode(above).alias("cell"), "n").groupBy("cell").agg((F.sum("n") + block // 2).alias("looks"))
    both = standing.join(looks, "cell", "full")
    crowded = both.where((F.col("n") > block) | (F.col("looks") > block))
    # of cells that are crowded by looks alone, those in which few or none stand
    few = cells.where("look = 0").join(crowded.where("n is null").select("cell"), "cell", "left_semi").groupBy("cell").agg(F.count("*").alias("few"))
    blocks = lambda c: F.ceil(F.coalesce(c, F.lit(0)) / block).cast("long")
    return crowded.join(few, "cell", "left").select("cell", blocks(F.coalesce("n", "few")).alias("stands"), F.greatest(blocks(F.col("looks")), F.lit(1)).alias("looks"))


def _dealt(cells: DataFrame, block: int) -> DataFrame:
    """(cell, unit, look, fp): cells as groups that no number of fingerprints makes large.

    A unit of 0 or more is a block of fingerprints that pair with one another (and, in a
    cell of one unit, with all that look); in a unit below 0 those with look 0 pair with
    those with look 1.
    """
    found = cells.select("cell", F.lit(0).cast("long").alias("unit"), "look", "fp")
    sizes = written(_crowded(cells, block), "large-cells")
    if sizes.isEmpty():
        return found
    n, m = F.col("stands"), F.col("looks")
    zero = F.lit(0).cast("long")
    upto = lambda c: F.when(c > 0, F.sequence(zero, c - 1)).otherwise(F.array().cast("array<long>"))
    own, mine = F.pmod(F.xxhash64("fp"), F.greatest(n, F.lit(1))), F.pmod(F.xxhash64("fp"), m)
    put = lambda unit, look: F.struct(unit.alias("unit"), F.lit(look).alias("look"))
    # units: 1 + i for block i by itself, -1 - (i * n + j) for blocks i < j that stand, and
    # below those -1 - n * n - (i * m + j) for standing block i against looking block j
    stand = F.concat(
        F.transform(upto(n), lambda j: F.when(j == own, put(1 + own, 0)).when(j > own, put(-1 - (own * n + j), 0)).otherwise(put(-1 - (j * n + own), 1))),
        F.transform(upto(m), lambda j: put(-1 - n * n - (own * m + j), 0)),
    )
    looks = F.transform(upto(n), lambda i: put(-1 - n * n - (i * m + mine), 1))
    large = cells.join(sizes, "cell").select("cell", "fp", F.explode(F.when(F.col("look") == 0, stand).otherwise(looks)).alias("x")).select("cell", "x.unit", "x.look", "fp")
    return found.join(sizes, "cell", "left_anti").unionByName(large)


def links(fps: DataFrame, max_bits: int = MAX_BITS, block: int = CELL_BLOCK) -> DataFrame:
    """(a, b): links that span every component of distinct fingerprints `fps` (column fp).

    max_bits is 3 at most, for the halves' bound. Pairs are compared inside tasks and
    only a spanning star of what was found leaves them, so a group of thousands of near
    copies gives thousands of rows, not millions. A cell in which more than `block`
    fingerprints stand or look is cut into blocks on both sides, and each pair of blocks is
    a group of its own; looks into a crowded cell where none stands are dropped.
    """
    if max_bits > 3:
        raise ValueError("the grid's halves hold for 3 bits at most")
    dealt = _dealt(_cells(fps), block).repartition("cell", "unit").sortWithinPartitions("cell", "unit", "look")
    return dealt.mapInArrow(_search(max_bits), "a long, b long")


def _groups(nodes: DataFrame, max_bits: int, block: int) -> DataFrame:
    """(fp, component) of distinct fingerprints; component is a fingerprint of the group."""
    joined = connected_components(written(links(nodes, max_bits, block), "fingerprint-links"))
    joined = joined.select(F.col("node").alias("fp"), "component")
    return nodes.select("fp").join(joined, "fp", "left").select("fp", F.coalesce("component", "fp").alias("component"))


def near_duplicate_groups(docs: DataFrame, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text", block: int = CELL_BLOCK) -> DataFrame:
    """(id, fp, component_id) for every row of docs.

    component_id is the smallest id of the documents reachable over links of at most
    max_bits differing bits. Copies have one fingerprint and are folded into it first.
    Null and empty texts have fingerprint 0 and link like any other; very long texts are
    taken whole. A row with a null id takes part by its fingerprint; component_id is null
    where no reachable document has an id. Rows with repeated ids each get a result. Other
    columns are ignored. An empty table gives an empty result.
    """
    own = written(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = written(own.groupBy("fp").agg(F.min(id_col).alias("_first")), "distinct-fingerprints")
    joined = connected_components(written(links(nodes, max_bits, block), "fingerprint-links"))
    members = joined.join(nodes, joined["node"] == nodes["fp"])
    smallest = members.groupBy("component").agg(F.min("_first").alias("_low"))
    low = written(joined.join(smallest, "component").select(F.col("node").alias("fp"), "_low"), "fingerprint-components")
    known = nodes.join(low, "fp", "left").select("fp", F.coalesce("_low", "_first").alias("component_id"))
    known = written(known, "fingerprint-groups")
    return own.join(known, "fp").select(id_col, "fp", "component_id")


def keep_one_of_each(docs: DataFrame, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each group of near duplicates: the one of smallest id, and of
    smallest digest of its text if ids are equal; rows without an id come last.

    So no group is lost if two texts share an id, and of rows that are equal in id and text
    one stays. All columns stay, whatever their names. Null and empty texts are one group
    (with whatever is within max_bits of fingerprint 0). An empty table stays empty.
    """
    digest, plain = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)), ["id", "digest"]
    kind = docs.schema[id_col].dataType.simpleString()
    own = written(_fingerprints(docs.select(F.col(id_col).alias("id"), digest.alias("digest"), F.col(text_col).alias("text")), plain, f"id {kind}, digest binary"), "fingerprints")
    group = _groups(own.select("fp").distinct(), max_bits, CELL_BLOCK)
    first = F.min(F.struct(F.col("id").isNull(), "id", "digest")).alias("x")
    # copies fold before they meet their group, so the join moves few rows of one fingerprint
    heads = own.groupBy("fp").agg(first).join(group, "fp").groupBy("component").agg(F.min("x").alias("x"))
    row_digest, kept_digest, kept_id = fresh(docs.columns, "row_digest", "kept_digest", "kept_id")
    kept = written(heads.select(F.col("x.id").alias(kept_id), F.col("x.digest").alias(kept_digest)), "kept")
    same = (F.col(row_digest) == F.col(kept_digest)) & F.col(id_col).eqNullSafe(F.col(kept_id))
    stay = docs.withColumn(row_digest, digest).join(kept, same, "left_semi")
    if not own.groupBy("id", "digest").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        stay = stay.dropDuplicates([id_col, row_digest])
    return stay.select(*docs.columns)


def op2_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint and component_id for every row of documents.

    near_duplicate_groups() says what null, empty and very long texts, repeated rows and an
    empty table give; fingerprints that differ in exactly 3 bits link. Columns but doc_id
    and text are not read.
    """
    groups = near_duplicate_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
