"""Waiting for producers, and tables kept for several uses."""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def wait_for(done: Callable[[], set], wanted: set, alive: Callable[[], bool], every: float = 30.0, timeout: float = 86_400.0) -> set:
    """Ask until all wanted shards are done, and return them. A producer that isn't alive any
    more with shards missing is an error that names them, as is running out of time."""
    end = time.monotonic() + timeout
    while True:
        # asked before the shards, so one that ends in between is still seen as done
        running, ready = alive(), done()
        missing = wanted - ready
        if not missing:
            return ready & wanted
        if not running:
            raise RuntimeError(f"the producer ended without {sorted(missing)}")
        if time.monotonic() >= end:
            raise TimeoutError(f"still missing: {sorted(missing)}")
        time.sleep(every)


@contextmanager
def kept_in_memory(df: DataFrame):
    """df kept in memory, and on disk where that is short, for what is inside; a lost executor's
    part is computed again."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()
