"""Structured Streaming wiring: sources, triggers, sinks.

Batch folders are named by the micro-batch id and overwritten, so a batch that
is replayed after a failure replaces its own files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brisalake.streaming.events import enrich_event, route_dead_letters
from brisalake.streaming.levels import fold_upserts, read_upserted, upsert_batch  # noqa: F401


def stream_file_source(spark: SparkSession, directory: str, schema, fmt: str, glob: str | None = None,
                       max_files: int | None = None, max_bytes: int = 8 << 30) -> DataFrame:
    """Typed directory source; a trigger takes ``max_bytes`` bytes at most, or ``max_files`` files if given."""
    bound = {"maxFilesPerTrigger": max_files} if max_files else {"maxBytesPerTrigger": max_bytes}
    reader = spark.readStream.format(fmt).schema(schema).options(**bound)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(directory)


def stream_available_now(stream: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Append what is there to parquet and stop."""
    query = (stream.writeStream.format("parquet").option("path", sink)
             .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def stream_restart(stream: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Start again on the same checkpoint: files already processed add nothing."""
    return stream_available_now(stream, sink, checkpoint)


def run_batches(stream: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str,
                mode: str = "append", trigger: dict | None = None) -> StreamingQuery:
    query = (stream.writeStream.foreachBatch(handler).outputMode(mode)
             .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start())
    if trigger is None:
        query.awaitTermination()
    return query


def collect_parts(stream: DataFrame, part: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
                  trigger: dict | None = None) -> DataFrame:
    """``part`` of every micro-batch, each in its own folder; what is read back is put together by the caller.

    A batch costs what it holds, not what came before it, and replaces its own
    folder when it is replayed.
    """
    def keep(batch: DataFrame, batch_id: int) -> None:
        part(batch).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/lote={batch_id}")

    run_batches(stream, keep, checkpoint, trigger=trigger)
    return stream.sparkSession.read.parquet(path).drop("lote")


def two_sink_batch(valid_path: str, dlq_path: str, cut: float = 743.0, proc_ts: Column | None = None,
                   rejected_at: Column | None = None) -> Callable[[DataFrame, int], None]:
    """Handler that writes a classified batch to the valid and the dead-letter sink.

    ``proc_ts`` is when a valid event counts as processed; a rejected one, whose own
    time may be unreadable, gets ``rejected_at`` or the time of the batch.
    The batch is persisted, so validation runs once for both writes.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            (enrich_event(batch, cut, proc_ts).withColumn("_epoca", F.lit(batch_id))
             .write.mode("overwrite").parquet(f"{valid_path}/lote={batch_id}"))
            (route_dead_letters(batch, rejected_at).withColumn("_epoca", F.lit(batch_id))
             .write.mode("overwrite").parquet(f"{dlq_path}/lote={batch_id}"))
        finally:
            batch.unpersist()
    return handle


def dedup_stream(stream: DataFrame, key: str, ts: str, horizon: str) -> DataFrame:
    """Each id once within the horizon; older ids leave the state."""
    return stream.withWatermark(ts, horizon).dropDuplicatesWithinWatermark([key])


def microbatch_sink(stream: DataFrame, path: str, checkpoint: str, run_id: str,
                    trigger: dict | None = None, files_per_date: int = 8) -> StreamingQuery:
    """Bounded batches to parquet by event date, with batch number and run id.

    A batch is bounded by the source's bytes or files and by the trigger's time
    (``{"processingTime": "60 seconds"}``); without ``trigger`` what is there is
    processed and the query stops. A date is dealt over ``files_per_date`` tasks.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        spread = F.pmod(F.xxhash64(*batch.columns), F.lit(files_per_date))
        (batch.withColumns({"_lote": F.lit(batch_id), "_ingestion_run_id": F.lit(run_id)})
         .repartition("data_evento", spread).write.mode("overwrite")
         .option("partitionOverwriteMode", "static").partitionBy("data_evento").parquet(f"{path}/lote={batch_id}"))
    return run_batches(stream, handle, checkpoint, trigger=trigger)
