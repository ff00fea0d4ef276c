"""Shared helpers: table reading, the held-out rule, word patterns and row keys."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxframe.session import cut_lineage, ship_package

#: Words are runs of anything but space and the five ASCII control blanks.
WORD = "[^\\x20\\x09-\\x0D]+"
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 2_000
BLANKS = " \t\n\x0b\x0c\r"

__all__ = ["BLANKS", "WORD", "cut_lineage", "held_out", "map_arrow", "read_table", "slices", "small", "worker_state"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """crc32 of the id's text mod 4 is 2; a NULL id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with this package shipped to the Python workers.

    Whole texts travel in these batches, so a session that allows more than
    ``BATCH_ROWS`` rows a batch (the default is 10,000) is set to that.
    """
    spark = df.sparkSession
    ship_package(spark)
    rows = int(spark.conf.get(BATCH_CONF))
    if not 0 < rows <= BATCH_ROWS:
        spark.conf.set(BATCH_CONF, str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            release()

    return df.mapInArrow(run, schema)


def release() -> None:
    """Give memory that a task no longer needs back to the system: Python workers live on, idle, beside other operators' tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


_STATE: dict[str, Any] = {}


def worker_state(mark: str, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps for the tasks of one operator (a model with its caches).

    Workers live on for other operators; one state at a time is kept, so that
    memory does not add up over the stages of a job.
    """
    if mark not in _STATE:
        _STATE.clear()
        _STATE[mark] = make()
    return _STATE[mark]


def small(df: DataFrame, max_rows: int, name: str = "small") -> DataFrame:
    """``df`` written once, and marked for broadcast only if it has at most ``max_rows`` rows; else joins shuffle it."""
    stored = cut_lineage(df, name)
    return F.broadcast(stored) if stored.limit(max_rows + 1).count() <= max_rows else stored


def slices(batches: Iterator[pa.RecordBatch], column: str, max_chars: int = 1_000_000,
           max_rows: int = 2_000) -> Iterator[pa.RecordBatch]:
    """Cut batches into pieces of bounded rows and bounded text, so a task's memory does not follow the batch size.

    A single text longer than ``max_chars`` still goes through whole, alone in its piece.
    """
    for batch in batches:
        lengths = [len(x) if x is not None else 0 for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]
        start, chars = 0, 0
        for i, n in enumerate(lengths):
            if i > start and (chars + n > max_chars or i - start >= max_rows):
                yield batch.slice(start, i - start)
                start, chars = i, 0
            chars += n
        if start < len(lengths):
            yield batch.slice(start)
