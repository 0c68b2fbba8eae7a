"""Which texts contain which of many strings."""

from __future__ import annotations

from functools import reduce

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.sources.shared import written

#: Bytes of strings that one automaton is made of. Its size is many times that, some 100 bytes a byte at most.
AUTOMATON_BYTES = 2 << 20


def containing(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, keep: tuple[str, ...] = (), automaton_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """(id, keep..., item): each row of docs with each item whose whole text it contains.

    Items are broadcast as one automaton, which finds all of them in one walk over a text;
    texts aren't shuffled. Items beyond automaton_bytes are dealt to several, by a hash, and
    texts are walked once for each. An empty item is in every text, a null item or text in
    none; items of equal text are found together, a repeated row of docs each time.
    """
    spark = docs.sparkSession
    columns = list(dict.fromkeys([id_col, *keep]))
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns)
    kind = items.schema[item_col].dataType.simpleString()
    wanted = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("body")).where("body is not null").distinct()
    size = wanted.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    parts = max(1, -(-size // automaton_bytes))
    wanted = written(wanted.withColumn("part", F.pmod(F.xxhash64("item", "body"), F.lit(parts))), "strings")

    def one(k: int) -> DataFrame:
        by_text: dict[str, list] = {}
        for r in wanted.where(F.col("part") == k).collect():
            by_text.setdefault(r["body"], []).append(r["item"])
        shared = spark.sparkContext.broadcast(by_text)

        def walk(batches):
            import pyarrow as pa

            every = shared.value.get("", [])
            strings = ahocorasick.Automaton()
            for body, found in shared.value.items():
                if body:
                    strings.add_word(body, found)
            if len(strings):
                strings.make_automaton()
            for batch in batches:
                rows, names = [], []
                for i, text in enumerate(batch.column(text_col).to_pylist()):
                    if text is None:
                        continue
                    # equal strings share one list
                    hits = {id(found): found for _, found in strings.iter(text)} if len(strings) else {}
                    for found in [every, *hits.values()]:
                        rows += [i] * len(found)
                        names += found
                taken = batch.select(columns).take(pa.array(rows, pa.int32()))
                yield pa.record_batch([*taken.columns, pa.array(names, pa.string() if kind == "string" else pa.int64())], [*columns, "item"])

        return docs.select(*dict.fromkeys([*columns, text_col])).mapInArrow(walk, f"{fields}, item {'string' if kind == 'string' else 'bigint'}")

    return reduce(DataFrame.unionByName, map(one, range(parts))).withColumn("item", F.col("item").cast(kind))
