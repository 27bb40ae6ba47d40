"""What several operators share: tables, shipping of the package to executors, fixed values."""

from __future__ import annotations

import ctypes
import gc
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from termfold.operators.shipping import ship_package as ship_package

#: A word: a run of characters other than space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: What separates words.
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def unused_prefix(columns: list[str]) -> str:
    """A beginning that no column's name has, whatever the case: names made with it clash with none."""
    prefix = "_"
    while any(c.lower().startswith(prefix) for c in columns):
        prefix += "_"
    return prefix


def sliced(batches, rows: int = 512):
    """The same rows in smaller batches, so that few of them are Python objects at a time."""
    for b in batches:
        for i in range(0, max(1, b.num_rows), rows):
            yield b.slice(i, rows)


def give_back() -> None:
    """Returns memory that a worker no longer uses to the system: idle workers live on beside later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):                 # another C library
        pass


def tidy(work):
    """A task's function that gives back its memory at the end, and leaves the collector on."""
    @wraps(work)
    def run(batches, *args, **kwargs):
        try:
            yield from work(batches, *args, **kwargs)
        finally:
            gc.enable()
            give_back()
    return run
