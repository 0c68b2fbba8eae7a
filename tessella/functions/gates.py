"""Quality gates as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reasons(*rules: tuple[str, Column]) -> Column:
    """All failing rules' names, in the order given; a rule whose condition is null doesn't fail."""
    return F.array_compact(F.array(*(F.when(fails, F.lit(name)) for name, fails in rules)))


def first_reason(*rules: tuple[str, Column]) -> Column:
    """The first failing rule's name, null if none fails."""
    out = None
    for name, fails in rules:
        out = F.when(fails, F.lit(name)) if out is None else out.when(fails, F.lit(name))
    return out


def falsy(column: Column, other: Column) -> Column:
    """other where column is null or empty."""
    return F.coalesce(F.nullif(column, F.lit("")), other)
