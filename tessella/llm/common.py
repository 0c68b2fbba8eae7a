"""Small helpers that the operators share."""

from __future__ import annotations

import ctypes
import functools

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_batches(batch, name: str = "text", limit: int = 4 << 20):
    """Slices of an Arrow batch with about `limit` bytes in a string column each.

    Python and NumPy working sets follow the bytes of a slice, so they stay bounded
    however many long texts Spark puts into one batch. After a batch, memory that Arrow and
    malloc hold for reuse goes back to the system, as workers outlive their tasks.
    """
    n = batch.num_rows
    if not n:
        return
    column = batch.column(name)
    import pyarrow as pa
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i in range(n):
        if held and held + sizes[i] > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += int(sizes[i]) + 64
    yield batch.slice(start, n - start)
    if sizes.sum() > limit:
        pa.default_memory_pool().release_unused()
        _give_back()


@functools.cache
def _trim():
    """The C library's malloc_trim, where it has one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):
        return None


def _give_back() -> None:
    if (trim := _trim()) is not None:
        trim(0)


def signed(values):
    """Unsigned 64-bit NumPy values in the range of a Spark long."""
    return values.view("int64")


def fresh(columns, *names: str) -> list[str]:
    """The names, each with underscores in front until it clashes with none of columns.

    Spark compares names without case, so this does too.
    """
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def schema_of(df: DataFrame, columns) -> str:
    """The named columns of df as DDL text."""
    return ", ".join(f"`{c.replace('`', '``')}` {df.schema[c].dataType.simpleString()}" for c in columns)


def whole_number_ids(df: DataFrame, id_col: str) -> None:
    """Operators that order documents by their id need one that fits Spark's long."""
    kind = df.schema[id_col].dataType.typeName()
    if kind not in ("byte", "short", "integer", "long"):
        raise TypeError(f"column {id_col} must hold whole numbers to order documents by, not {kind}")


class Memo(dict):
    """What a function gave for strings, within a bound on the bytes held.

    `fill` maps a list of new strings to their values. Strings longer than LONG are
    worked out each time and not held, as a text without blanks is one such string.
    """

    LONG = 200

    def __init__(self, fill, limit: int = 24 << 20, each: int = 150):
        super().__init__()
        self.fill, self.limit, self.each, self.held = fill, limit, each, 0

    def of(self, keys: list):
        """The values of all keys, in order."""
        try:
            return [*map(self.__getitem__, keys)]
        except KeyError:
            pass
        if self.held > self.limit:
            self.clear()
            self.held = 0
        new = list(dict.fromkeys(k for k in keys if k not in self))
        self.update(zip(new, self.fill(new)))
        out = [*map(self.__getitem__, keys)]
        for k in new:
            if len(k) > self.LONG:
                del self[k]
            else:
                self.held += 2 * len(k) + self.each
        return out
