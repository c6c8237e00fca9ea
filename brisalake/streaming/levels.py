"""Upserts as a levelled log of runs.

A run is a folder ``run=<level>_<first>_<last>`` with the newest row per key of the
micro-batches first to last, in partitions of its own rows. A batch adds a run of level
0; as soon as a level has ``fan`` runs they are folded into one of the next level. Only
the partitions that those runs touch are read and written, a row is rewritten once per
level, and a read opens fewer than ``fan`` runs per level, however many batches there
were. Bloom filters on the key let a lookup skip the runs without it.

A run counts once its ``_SUCCESS`` is there; one covered by a run of a higher level does
not. Covered runs are deleted when the next batch begins, so readers that have just
listed them can finish, and a fold that fails leaves the runs it read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brisalake.operators.conform import dedup_latest
from brisalake.sources import files

BATCH, PART = "_batch", "_part"
NAME = re.compile(r"run=(\d+)_(-?\d+)_(-?\d+)$")


class Run(NamedTuple):
    level: int
    first: int
    last: int

    @property
    def name(self) -> str:
        return f"run={self.level}_{self.first}_{self.last}"

    def covers(self, other: "Run") -> bool:
        return self.level > other.level and self.first <= other.first and other.last <= self.last


def _all_runs(spark: SparkSession, target: str) -> list[Run]:
    found = [Run(*map(int, m.groups())) for m in map(NAME.match, files.names(spark, target)) if m]
    return sorted(r for r in found if files.exists(spark, f"{target}/{r.name}/_SUCCESS"))


def runs(spark: SparkSession, target: str) -> list[Run]:
    """The runs that make up the table."""
    found = _all_runs(spark, target)
    return [r for r in found if not any(o.covers(r) for o in found)]


def _write(rows: DataFrame, target: str, run: Run, key: Sequence[str], by: str | None) -> None:
    rows = rows.withColumn(PART, F.lit("all") if by is None else F.col(by).cast("string"))
    out = rows.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "static")
    filters = {f"parquet.bloom.filter.enabled#{k}": "true" for k in key}
    out.options(**filters).partitionBy(PART).parquet(f"{target}/{run.name}")


def _read(spark: SparkSession, target: str, chosen: Sequence[Run]) -> DataFrame:
    paths = [f"{target}/{r.name}" for r in chosen]
    return spark.read.option("mergeSchema", True).option("basePath", target).parquet(*paths).drop("run")


def _fold(spark: SparkSession, target: str, key: Sequence[str], by: str | None, fan: int) -> None:
    level = 0
    while len(level_runs := [r for r in runs(spark, target) if r.level == level]) >= fan or any(
            r.level > level for r in runs(spark, target)):
        if len(level_runs) >= fan:
            merged = dedup_latest(_read(spark, target, level_runs).drop(PART), key, [F.desc(BATCH)])
            _write(merged, target, Run(level + 1, level_runs[0].first, level_runs[-1].last), key, by)
        level += 1


def upsert_batch(target: str, key: Sequence[str], order_by: Sequence[Column], by: str | None = None,
                 fan: int = 8) -> Callable[[DataFrame, int], None]:
    """Handler that merges a micro-batch by key: matched rows are replaced, others added.

    Of several rows of a key in one batch the first by ``order_by`` counts; a later
    batch beats an earlier one. ``by`` names the column whose values are the table's
    partitions (a date); a row that moves to another partition is still one row on
    reading. A replayed batch replaces its own run, or is skipped if a fold holds it.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        found = _all_runs(spark, target)
        for r in found:
            if any(o.covers(r) for o in found):
                files.remove(spark, f"{target}/{r.name}")
        own = Run(0, batch_id, batch_id)
        if any(r.covers(own) for r in found):
            return
        _write(dedup_latest(batch, key, order_by).withColumn(BATCH, F.lit(batch_id)), target, own, key, by)
        _fold(spark, target, key, by, fan)
    return handle


def read_upserted(spark: SparkSession, target: str, key: Sequence[str], parts: Sequence[str] | None = None) -> DataFrame:
    """The table as it is now: the newest row per key. ``parts`` reads those partitions only.

    Reading single partitions needs keys that stay in their partition.
    """
    rows = _read(spark, target, runs(spark, target))
    if parts is not None:
        rows = rows.filter(F.col(PART).cast("string").isin(list(parts)))
    return dedup_latest(rows.drop(PART), key, [F.desc(BATCH)]).drop(BATCH)


def fold_upserts(spark: SparkSession, target: str, new: str, key: Sequence[str], by: str | None = None) -> str:
    """The table as it is now in a new folder, as one run before any batch."""
    _write(read_upserted(spark, target, key).withColumn(BATCH, F.lit(-1)), new, Run(0, -1, -1), key, by)
    return new
