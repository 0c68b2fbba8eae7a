"""Near-duplicate pairs of 64-bit codes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a band below which bands tell codes apart too badly to be worth a shuffle.
LEAST_BAND = 10
#: Codes of a group that are compared together.
BLOCK = 4000


def sign_bits(vector: str) -> Column:
    """The signs of 64 numbers as a long: bit i is set if number i is above 0."""
    terms = F.transform(vector, lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
    return F.aggregate(terms, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))


def hamming_pairs(codes: DataFrame, id_col: str, code_col: str, group_col: str, most: int, block: int = BLOCK) -> DataFrame:
    """(a, b, distance) of the pairs of a group that differ in at most `most` bits, a < b.

    Of most + 1 bands of the code one at least is equal in such a pair. While bands are
    wide (up to 5 bits of difference), pairs meet on (group, band, its bits), and each pair
    is taken in the first band that it shares. With shorter bands nearly all pairs meet
    somewhere, several times over; then each pair is compared once, in blocks: a group's
    codes are cut into blocks of about `block`, every two blocks go to a task as arrays,
    and only pairs within the limit leave it. Rows with a null id, code or group pair with
    none.
    """
    codes = codes.select(F.col(id_col).alias("id"), F.col(group_col).alias("g"), F.col(code_col).alias("c")).where("id is not null and g is not null and c is not null")
    return _in_bands(codes, most) if 64 // (most + 1) >= LEAST_BAND else _in_blocks(codes, most, block)


def _in_bands(codes: DataFrame, most: int) -> DataFrame:
    bands = most + 1
    edges = [64 * k // bands for k in range(bands + 1)]
    cut = lambda c, k: F.shiftrightunsigned(c, edges[k]).bitwiseAND(F.lit((1 << edges[k + 1] - edges[k]) - 1))
    keyed = codes.select("id", "g", "c", F.explode(F.array(*(F.struct(F.lit(k).alias("band"), cut(F.col("c"), k).alias("bits")) for k in range(bands)))).alias("x")).select("id", "g", "c", "x.*")
    p, q = keyed.alias("p"), keyed.alias("q")
    differ = F.col("p.c").bitwiseXOR(F.col("q.c"))
    met = (F.col("p.g") == F.col("q.g")) & (F.col("p.band") == F.col("q.band")) & (F.col("p.bits") == F.col("q.bits")) & (F.col("p.id") < F.col("q.id"))
    first = F.lit(None).cast("int")
    for k in reversed(range(bands)):
        first = F.when(cut(differ, k) == 0, k).otherwise(first)
    near = F.bit_count(differ) <= most
    return p.join(q, met & near & (F.col("p.band") == first)).select(F.col("p.id").alias("a"), F.col("q.id").alias("b"), F.bit_count(differ).alias("distance"))


def _in_blocks(codes: DataFrame, most: int, block: int) -> DataFrame:
    sizes = codes.groupBy("g").agg(F.ceil(F.count("*") / block).alias("blocks"))
    own = codes.join(sizes, "g").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")))
    # block i stands first against those after it, second against those before it
    unit = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda j: F.struct(F.least(F.col("own"), j).alias("i"), F.greatest(F.col("own"), j).alias("j")),
    )
    dealt = own.select("id", "g", "c", "own", F.explode(unit).alias("u")).select("id", "g", "c", "own", "u.i", "u.j")
    kind = codes.schema["id"].dataType.simpleString()

    def compare(key, rows):
        import pandas as pd

        _, i, j = key
        first, second = rows[rows["own"] == i], rows[rows["own"] == j]
        x, y = (s["c"].to_numpy(np.int64).view(np.uint64) for s in (first, second))
        xi, yi = first["id"].to_numpy(), second["id"].to_numpy()
        out = []
        for k in range(len(x)):
            n = np.bitwise_count(x[k] ^ y)
            near = np.flatnonzero(n <= most)
            for t in near[yi[near] > xi[k]] if i == j else near:
                out.append((min(xi[k], yi[t]), max(xi[k], yi[t]), int(n[t])))
        return pd.DataFrame(out, columns=["a", "b", "distance"])

    return dealt.groupBy("g", "i", "j").applyInPandas(compare, f"a {kind}, b {kind}, distance int")
