"""Reading the given tables and cutting lineage, shared by the operators."""

from __future__ import annotations

import ctypes
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadweld.operators.stage import is_small, materialize

__all__ = ["WORD", "fresh", "hex_digits", "materialize", "maybe_broadcast", "parts_of", "read", "tidy", "upper_to_lower"]

#: A word of the contracts that split on white space.
WORD = r"[^\x20\x09-\x0D]+"

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def upper_to_lower(column: Column) -> Column:
    """A-Z to lower case and nothing else."""
    return F.translate(column, _UPPER, _UPPER.lower())


def maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint if ``df`` has at most ``rows`` rows, else ``df`` as it is."""
    return F.broadcast(df) if is_small(df, rows) else df


def fresh(taken: list[str], *names: str) -> list[str]:
    """``names``, with as many leading underscores as it takes to differ from all of ``taken``."""
    used, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in used:
            name = "_" + name
        out.append(name)
    return out


def hex_digits(rows: int, per_bucket: int) -> int:
    """How many leading hex digits of a digest deal ``rows`` into buckets of that size."""
    return max(1, math.ceil(math.log(max(rows / per_bucket, 1), 16)))


def tidy(run: Callable) -> Callable:
    """``run`` for mapInArrow, whose freed memory goes back to the system: Python workers live on between tasks."""

    def apply(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):
                pass  # no such call in this C library

    return apply


def parts_of(batches, column: int, rows: int = 1_000, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches cut into parts of at most ``rows`` rows, and of about ``size`` bytes of the text in ``column``."""
    for batch in batches:
        first = held = 0
        for i, text in enumerate(batch.column(column)):
            held += text.as_buffer().size if text.is_valid else 0
            if held >= size or i + 1 - first == rows:
                yield batch.slice(first, i + 1 - first)
                first, held = i + 1, 0
        if first < batch.num_rows:
            yield batch.slice(first)
