"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo mod; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(mod))


def sample_ids(labels: DataFrame, label: str, held_out: Column, per_class: int, id_col: str = "doc_id") -> dict[int, int]:
    """{id: label} of at most per_class labelled rows of each class that are not held out.

    The rows are those with the smallest hashes of their ids, so the sample doesn't depend
    on the table's order; Spark keeps a bounded heap per task and nothing is gathered.
    Rows with a null id or label are ignored; of contradicting rows the label 0 counts.
    """
    usable = labels.where(F.col(id_col).isNotNull() & F.col(label).isin(0, 1) & ~held_out).select(id_col, label)
    found: dict[int, int] = {}
    for k in (1, 0):
        rows = usable.where(F.col(label) == k).orderBy(F.xxhash64(id_col), id_col).limit(per_class).collect()
        found.update((r[id_col], k) for r in rows)
    return found


def sampled(docs: DataFrame, ids, id_col: str = "doc_id") -> DataFrame:
    """Rows of docs whose ids (a bounded set) are among the given ones."""
    return docs.where(F.col(id_col).isin(list(ids)))
