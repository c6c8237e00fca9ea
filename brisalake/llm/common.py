"""Helpers shared by the corpus operators."""

from __future__ import annotations

import sys
import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brisalake.session import shared_folder

# Words are runs of anything but the six ASCII blanks; the pattern is the contracts'.
BATCH_CONF, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Rows that carry texts or sets go to Python in smaller batches."""
    before = spark.conf.get(BATCH_CONF)
    spark.conf.set(BATCH_CONF, str(min(int(before), BATCH_ROWS)))
    try:
        yield
    finally:
        spark.conf.set(BATCH_CONF, before)


FREE_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What a query shuffles is deleted when it ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(FREE_CONF)
    spark.conf.set(FREE_CONF, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_CONF, before)


class Stage:
    """A fresh folder in the cluster's shared scratch space for the tables of one run.

    A stored table cuts lineage: a lost executor costs the tasks that read it,
    not the plan behind it.
    """

    opened = threading.local()  # folders of this thread's stages, in order

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, shared_folder(spark)
        self.folders().append(self.folder)

    @classmethod
    def folders(cls) -> list[str]:
        if not hasattr(cls.opened, "paths"):
            cls.opened.paths = []
        return cls.opened.paths

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write and read back. Rows carry texts and sets, so Python takes them in smaller batches meanwhile."""
        with small_batches(self.spark):
            df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that no plan reads any more."""
        for name in names:
            remove_folder(self.spark, self.path(name))


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a stage's folder, wherever the cluster keeps it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def word_count(c: Column | str) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("bigint")


def worker_cache(name: str, make: Callable[[], object]) -> object:
    """An object made once per Python worker process and kept for its later tasks."""
    kept = sys.__dict__.setdefault("_brisalake_worker", {})
    if name not in kept:
        kept[name] = make()
    return kept[name]


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column end to end, and where each row starts (n + 1 places); null is empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset:]
    data = column.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0]:offsets[-1]], offsets - offsets[0]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, end to end."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    return df.mapInArrow(fn, schema)


def byte_chunks(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, starts) of runs of rows with about ``limit`` bytes, so that arrays over bytes stay small."""
    flat, starts = bytes_of(column)
    row, n = 0, len(starts) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(starts, starts[row] + limit, side="right")) - 1)
        yield row, end, flat[starts[row]:starts[end]], starts[row:end + 1] - starts[row]
        row = end


def sum_by_row(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of values over each row's range; 0 for an empty one."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[starts[1:]] - sums[starts[:-1]]


def byte_table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[np.frombuffer(chars, np.uint8)] = True
    return t


BLANK = byte_table(b" \t\n\v\f\r")
RANDOM = np.random.Generator(np.random.PCG64(5)).integers(0, 1 << 64, 256, dtype=np.uint64)


def spans(inside: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end places of runs of True that do not cross rows."""
    cut = np.zeros(len(inside) + 1, bool)
    cut[starts] = True
    first = inside & np.concatenate([[True], ~inside[:-1]]) | inside & cut[:-1]
    last = inside & np.concatenate([~inside[1:], [True]]) | inside & cut[1:]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def span_hashes(flat: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span (polynomial over a random value per byte, from the span's first byte on)."""
    if not len(first):
        return np.zeros(0, np.uint64)
    base = np.uint64(0x9E3779B97F4A7C15)
    length = end - first
    owner = np.repeat(np.arange(len(first)), length)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length)
    place = np.repeat(first, length) + at
    powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(int(length.max()), base, np.uint64))])
    values = RANDOM[flat[place]] * powers[at]
    return np.add.reduceat(values, np.cumsum(length) - length)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of x; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


SMALL_ROWS = 200_000  # of a few narrow columns: some megabytes


def small_side(stored: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """A stored narrow table, to be broadcast if its rows have been counted and are few; else it shuffles."""
    return F.broadcast(stored) if stored.count() <= rows else stored
