"""Helpers the training-data operators share: text constants, columns by name."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.tables import Table, drop_scratch, scratch_path, scratch_root

__all__ = ["Table", "drop_scratch", "scratch_path", "scratch_root"]

#: ASCII white space, as a regex class body: tab to carriage return, and space.
WS = r"\x20\x09-\x0D"
#: The same characters as a literal, for trim functions.
WS_CHARS = " \t\n\x0b\x0c\r"


def words_pattern() -> str:
    return f"[^{WS}]+"


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def quoted(names: Iterable[str]) -> list[Column]:
    """Columns by their names as they are, dots included."""
    return [F.col(f"`{c}`") for c in names]


def carried(names: Iterable[str]) -> tuple[list[Column], list[Column]]:
    """The columns under names that an Arrow operator can take, and back again."""
    names = list(names)
    there = [F.col(f"`{c}`").alias(f"_carry{i}") for i, c in enumerate(names)]
    return there, [F.col(f"_carry{i}").alias(c) for i, c in enumerate(names)]


def give_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; behind each, what has been freed goes back to the system, since a
    Python worker outlives its task and shares its executor's memory with others."""
    try:
        trim = ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # another C library
        trim = None
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()
        if trim:
            trim(0)


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold 8 MB at most, unless the session says otherwise: a task
    holds a few of them outside of the heap, and texts fill them by the thousand."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) == "67108864b":  # as it comes
        spark.conf.set(key, str(8 << 20))


def as_row(df: DataFrame, name: str = "_row") -> Column:
    """All columns as one struct, which no name of an operator can clash with."""
    return F.struct(*quoted(df.columns)).alias(name)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
