"""Packing of token sequences by matching large items and best-fit of small ones.

The plan depends on the lengths alone, and those are at most `capacity` different
numbers however many documents there are. So the driver plans on the histogram of
lengths, and the pieces find their places in that plan by their rank among those of
equal length; no task and no driver ever holds the pieces.
"""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessella.llm.common import byte_batches, table
from tessella.llm.tokens import encoder
from tessella.sources.shared import written

WORD_BPE = "word_bpe_49k.json"
CAPACITY = 2048
#: Rows of one length that are ranked together.
RANKED_TOGETHER = 2000

PIECE = "piece int, start long, length long, ids_crc32 long"


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[int, dict[str, np.ndarray]]:
    """Number of sequences, and the plan as runs of places.

    histogram: number of pieces of each length. Pieces longer than a third of the
    capacity fit at most twice into a sequence. From the longest down, each is matched
    with the longest that still fits beside it, or stays alone. Shorter pieces then go,
    longest first, each into the sequence with the smallest gap that takes it, and into
    new sequences where none does. Equal pieces and equal gaps move together.

    A run says: the pieces of `length` with ranks from `rank` on, `each` of them to a
    sequence, go to the sequences from `sequence` on, at `offset` and following places.
    Runs are sorted by length and rank. There are a few thousand at most, whatever the
    number of pieces.
    """
    left = {n: c for n, c in histogram.items() if c}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    taken = dict.fromkeys(left, 0)
    runs: list[tuple[int, int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: groups (first sequence, number of them)
    total = 0

    def place(length: int, number: int, each: int, sequence: int, offset: int) -> None:
        runs.append((length, taken[length], number, each, sequence, offset))
        taken[length] += number
        left[length] -= number

    def leave(gap: int, first: int, number: int) -> None:
        if gap and number:
            gaps.setdefault(gap, []).append((first, number))

    large = sorted((n for n in left if 3 * n > capacity), reverse=True)
    for i, a in enumerate(large):
        for b in large[i:]:
            if not left[a]:
                break
            pairs = left[a] // 2 if a == b else min(left[a], left[b])
            if a + b > capacity or not pairs:
                continue
            if a == b:
                place(a, 2 * pairs, 2, total, 0)
            else:
                place(a, pairs, 1, total, 0)
                place(b, pairs, 1, total, a)
            leave(capacity - a - b, total, pairs)
            total += pairs
        if alone := left[a]:
            place(a, alone, 1, total, 0)
            leave(capacity - a, total, alone)
            total += alone

    for s in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[s]:
            gap = min((g for g in gaps if g >= s), default=0)
            if gap:
                first, number = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
            else:
                gap = capacity
                first, number = total, -(-left[s] // (capacity // s))
                total += number
            each = gap // s
            full = min(number, left[s] // each)
            if full:
                place(s, full * each, each, first, capacity - gap)
                leave(gap - each * s, first, full)
            if full < number:
                over = min(left[s], each - 1)
                if over:
                    place(s, over, over, first + full, capacity - gap)
                    leave(gap - over * s, first + full, 1)
                    full += 1
                leave(gap, first + full, number - full)
    runs.sort()
    names = ("length", "rank", "number", "each", "sequence", "offset")
    return total, dict(zip(names, np.array(runs, dtype=np.int64).reshape(-1, 6).T))


def tokenized(
    docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, remembered: int | None = None
) -> DataFrame:
    """Pieces of every document: (id, piece, start, length, ids_crc32[, ids binary]).

    A document is its text's ids and then end_id; only one longer than capacity is cut.
    ids are little-endian unsigned 32-bit numbers. Null text counts as empty: one piece
    of one id. Every row of docs gets its own pieces, also rows with null or equal ids.
    Very long texts are encoded whole. Other columns are ignored; an empty table gives an
    empty result.
    """
    path = tokenizer or public_tokenizers.path(WORD_BPE)
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches):
        import pyarrow as pa

        enc, end, wide = encoder(path, True, remembered), end_id.to_bytes(4, "little"), 4 * capacity
        for whole in batches:
            for batch in byte_batches(whole):
                row, piece, length, crc, ids = [], [], [], [], []
                for r, t in enumerate(batch.column("text").to_pylist()):
                    body = b"".join(enc.encode(t or "")) + end
                    for k in range(0, len(body), wide):
                        part = body[k : k + wide]
                        row.append(r)
                        piece.append(k // wide)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(part)
                number = np.array(piece, dtype=np.int32)
                columns = [batch.column("id").take(pa.array(row, pa.int32())), pa.array(number), pa.array(number.astype(np.int64) * capacity), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = [id_col, "piece", "start", "length", "ids_crc32"]
                yield pa.record_batch(columns + [pa.array(ids, pa.binary())] * with_ids, names + ["ids"] * with_ids)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(cut, f"`{id_col}` {kind}, {PIECE}" + ", ids binary" * with_ids)


def pack(pieces: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """pieces with sequence_id and offset: where each goes, gapless from 0.

    pieces must have `length` (1 to capacity) and should be a written table, as it is
    read several times. order names columns that tell pieces of equal length apart; of
    rows that are equal in all of them any may take any of their places. Hot lengths
    are ranked in groups of about RANKED_TOGETHER rows, chosen by a hash, whose sizes
    are then summed up; no group grows with the table. An empty table stays empty.
    """
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    _, runs = plan_sequences(histogram, capacity)
    # at most `capacity` rows
    groups = F.broadcast(spark.createDataFrame([(n, -(-c // RANKED_TOGETHER)) for n, c in histogram.items()], "length long, _groups long"))
    keyed = pieces.join(groups, "length").withColumn("_group", F.pmod(F.xxhash64(*order), F.col("_groups"))).drop("_groups")
    before = Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    firsts = keyed.groupBy("length", "_group").agg(F.count("*").alias("_n")).select("length", "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = Window.partitionBy("length", "_group").orderBy(*order)
    ranked = (
        keyed.withColumn("_in", F.row_number().over(within) - 1)
        .join(firsts, ["length", "_group"])
        .select(*pieces.columns, (F.col("_first") + F.col("_in")).alias("_rank"))
    )

    def place(batches):
        import pyarrow as pa

        key = runs["length"] << 40 | runs["rank"]
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            # ranks are below 2**40 for each length
            i = np.searchsorted(key, length << 40 | rank, "right") - 1
            nth = rank - runs["rank"][i]
            sequence = runs["sequence"][i] + nth // runs["each"][i]
            offset = runs["offset"][i] + nth % runs["each"][i] * length
            rest = [c for c in batch.schema.names if c != "_rank"]
            yield pa.record_batch([*(batch.column(c) for c in rest), pa.array(sequence), pa.array(offset)], [*rest, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False, remembered: int | None = None) -> DataFrame:
    """Documents as pieces with their places, and with the ids themselves if with_ids.

    remembered bounds the bytes of chunks that a worker holds, where other steps share it.
    """
    return pack(written(tokenized(docs, tokenizer, capacity=capacity, with_ids=with_ids, remembered=remembered), "pieces"), capacity)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for every piece of every row of documents: where it goes.

    Null and empty texts are one piece of the end id. A text of more than 2048 tokens is
    cut, whole. Rows that repeat a doc_id, or have none, each get their own pieces and
    places; of pieces of equal length, doc_id and number any may take any of their places.
    An empty table gives an empty result. Columns but doc_id and text are not read.
    """
    return pack_documents(table(spark, sf_dir, "documents"))
