"""Streams that keep state between micro-batches: windows with a bound, running totals, progress.

State lies in the RocksDB store of the query's checkpoint. A batch adds its rows to
the state and reads no earlier output.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from brisalake.functions import exact_sum, round_half_away
from brisalake.streaming.events import keyed_running_state
from brisalake.streaming.levels import upsert_batch
from brisalake.streaming.pipeline import run_batches

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Size of a latency sketch, and the error of its ranks as a share of a window's events, exceeded once in a hundred windows.
SKETCH, RANK_ERROR = 800, 0.0035


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started here keep their state in RocksDB: on disk with a bounded cache, not on the heap."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def sketched_windows(events: DataFrame, duration: str, by: str, watermark: str, ts: str = "ts_convertido",
                     latency: str = "latencia_ms", size: int = SKETCH) -> DataFrame:
    """Event-time window and key: events, weights and a quantile sketch of the latency; bounded state on a stream.

    A window's state is its sums and one sketch, which merges from task to task and
    batch to batch. Rows later than ``watermark`` do not count, and a window leaves the
    state once the watermark has passed its end.
    """
    passed = F.coalesce(exact_sum(F.when(F.col("alfabetizado"), F.col("peso_aluno"))), F.lit(0.0))
    return (events.withWatermark(ts, watermark).groupBy(F.window(ts, duration).alias("_w"), by)
            .agg(F.count(F.lit(1)).alias("eventos"), exact_sum("peso_aluno").alias("peso"), passed.alias("peso_alfabetizados"),
                 F.kll_sketch_agg_double(F.col(latency).cast("double"), F.lit(size)).alias("latencia"))
            .select(F.col("_w.start").alias("janela_inicio"), by, "eventos", "peso", "peso_alfabetizados", "latencia"))


def window_report(windows: DataFrame, by: str) -> DataFrame:
    """Events, weighted rate, p50 and p95 latency of ``sketched_windows``.

    Counts and rates are exact; the percentiles' ranks are off by ``RANK_ERROR`` at most
    in 99 windows of 100.
    """
    cut = lambda p: F.kll_sketch_get_quantile_double("latencia", F.lit(p))
    return windows.select("janela_inicio", by, "eventos",
                          round_half_away(F.try_divide(100.0 * F.col("peso_alfabetizados"), "peso")).alias("taxa_pct"),
                          cut(0.5).alias("latencia_p50_ms"), cut(0.95).alias("latencia_p95_ms"))


def merged_windows(windows: DataFrame, duration: str, by: str) -> DataFrame:
    """Windows put together to longer ones, from the stored sketches alone."""
    return (windows.groupBy(F.window("janela_inicio", duration)["start"].alias("janela_inicio"), by)
            .agg(F.sum("eventos").alias("eventos"), exact_sum("peso").alias("peso"),
                 exact_sum("peso_alfabetizados").alias("peso_alfabetizados"), F.kll_merge_agg_double("latencia").alias("latencia")))


def closed_windows(events: DataFrame, duration: str, by: str, watermark: str, path: str, checkpoint: str,
                   ts: str = "ts_convertido") -> StreamingQuery:
    """Append each window to ``path`` once, when the watermark has passed its end."""
    with rocksdb_state(events.sparkSession):
        query = (sketched_windows(events, duration, by, watermark, ts).writeStream.format("parquet").option("path", path)
                 .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
        query.awaitTermination()
    return query


def running_state(events: DataFrame, key: Sequence[str], target: str, checkpoint: str, fan: int = 8,
                  trigger: dict | None = None) -> StreamingQuery:
    """Running count, weight and passed weight per unit, kept by the query.

    A batch sends on the new totals of the units in it and nothing else; ``target`` is
    the levelled log of ``levels``, read with ``read_upserted``.
    """
    with rocksdb_state(events.sparkSession):
        return run_batches(keyed_running_state(events, key), upsert_batch(target, key, [F.desc("avaliados")], fan=fan),
                           checkpoint, "update", trigger)


PROGRESS = ("consulta string, execucao string, lote bigint, ts string, linhas bigint, linhas_entrada_s double, "
            "linhas_processadas_s double, duracao_ms bigint, linhas_estado bigint, bytes_estado bigint, linhas_tardias bigint")


def progress_row(p: dict) -> tuple:
    """One row of PROGRESS from a micro-batch's progress report."""
    state = p.get("stateOperators") or []
    total = lambda name: sum(int(s.get(name) or 0) for s in state)
    rate = lambda name: None if p.get(name) in (None, "NaN", "Infinity") else float(p[name])
    return (str(p["id"]), str(p["runId"]), int(p["batchId"]), str(p["timestamp"]), int(p.get("numInputRows") or 0),
            rate("inputRowsPerSecond"), rate("processedRowsPerSecond"),
            int((p.get("durationMs") or {}).get("triggerExecution") or 0), total("numRowsTotal"),
            total("memoryUsedBytes"), total("numRowsDroppedByWatermark"))


def query_progress(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The micro-batches a query has kept in memory (``spark.sql.streaming.numRecentProgressUpdates``)."""
    return spark.createDataFrame([progress_row(json.loads(p.json)) for p in query.recentProgress], PROGRESS)


class ProgressLog(StreamingQueryListener):
    """Progress of all queries of a session while it is added to ``spark.streams``; keeps the last ``keep`` batches.

    ``store`` appends what has come since the last call, so a long run's history lies
    in the lake and not on the driver.
    """

    def __init__(self, keep: int = 10_000):
        self.rows: deque[tuple] = deque(maxlen=keep)

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self.rows.append(progress_row(json.loads(event.progress.json)))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def store(self, spark: SparkSession, path: str) -> int:
        rows = [self.rows.popleft() for _ in range(len(self.rows))]
        if rows:
            spark.createDataFrame(rows, PROGRESS).write.mode("append").parquet(path)
        return len(rows)


def throughput(progress: DataFrame) -> DataFrame:
    """One row: batches, rows, rows a second of processing, rows of state at the end, late rows dropped."""
    last = F.max_by("linhas_estado", F.struct("ts", "lote"))
    busy: Column = F.sum("duracao_ms") / 1000.0
    return progress.agg(F.count_if(F.col("linhas") > 0).alias("lotes"), F.coalesce(F.sum("linhas"), F.lit(0)).alias("linhas"),
                        round_half_away(F.try_divide(F.sum("linhas"), busy), 1).alias("throughput_msg_s"),
                        F.coalesce(last, F.lit(0)).alias("linhas_estado"),
                        F.coalesce(F.sum("linhas_tardias"), F.lit(0)).alias("linhas_tardias"))
