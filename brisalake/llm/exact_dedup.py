"""Exact deduplication as a stateful stream.

A stream reads only what a text leaves behind: its digest, the row's id and a
locator (file and row number) that finds the content again. State is kept per
digest, on disk (RocksDB), and never expires: how many rows had it and the
identifier and locator of the row that stays. Rows of one digest are combined
within each task before the shuffle, so a text that fills a third of the table
costs one row per task.

A digest seen before is only a hit: afterwards every such row is joined with the
content at the locator of the row that stays and compared byte by byte. Rows that
differ in spite of an equal digest are grouped anew by their whole text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brisalake.llm.common import Stage, text_or_empty

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_CONF = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
              "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
              "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
              # Without this each of many small stores sets aside megabytes of disk for its logs.
              "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false"}


def located(df: DataFrame, id_column: str, text_column: str, digest) -> DataFrame:
    """id, digest, locator and text of every row of a frame that reads files."""
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    text = text_or_empty(text_column)
    return df.select(F.col(id_column).cast("bigint").alias("id"), digest(text).alias("digest"), at.alias("at"),
                     text.alias("body"))


def sha(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def first_seen(spark: SparkSession, stage: Stage, source: str, schema, id_column: str, text_column: str, digest,
               per_trigger: dict[str, str]) -> DataFrame:
    """One row per digest: n rows, and (id, locator) of the row with the largest id.

    Each micro-batch writes the digests it changed to a folder of its own and
    overwrites it when replayed. Counts and identifiers only grow, so the last
    state of a digest is their maximum.
    """
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        # As a pattern of one match: a stream takes a plain path for a folder only, a pattern also for a file.
        path = f"{source[:-1]}[{source[-1]}]"
        rows = located(spark.readStream.schema(schema).options(**per_trigger).parquet(path), id_column, text_column, digest)
        state = rows.groupBy("digest").agg(F.count("*").alias("n"), F.max(F.struct("id", "at")).alias("stays"))

        def changed(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(stage.path(f"state/batch={number}"))

        stream = (state.writeStream.outputMode("update").foreachBatch(changed)
                  .option("checkpointLocation", stage.path("state-log")).trigger(availableNow=True).start())
        stream.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    empty = "digest binary, n bigint, stays struct<id: bigint, at: struct<file: string, row: bigint>>"
    if stream.lastProgress is None and not stream.recentProgress:
        return spark.createDataFrame([], empty)
    last = spark.read.schema(empty).parquet(stage.path("state"))
    return last.groupBy("digest").agg(F.max("n").alias("n"), F.max("stays").alias("stays"))


TRIGGER_BYTES = 4 << 30  # a micro-batch by default: eight at 30 GB


def exact_dedup(spark: SparkSession, source: str, id_column: str = "doc_id", text_column: str = "text",
                per_trigger: dict[str, str] | None = None, digest=sha) -> DataFrame:
    """One row per row of the Parquet files at ``source``.

    Columns: id, keep_id (the id of the row that stays), group_size, kept, digest,
    at (the row's locator). Texts are equal when their bytes are; null is the
    empty text. Of equal texts the row with the largest id stays, of equal ids
    the one with the largest locator; null ids are smallest, so keep_id is null
    only where all are. Repeated rows are copies like any other. An empty table
    gives no rows; other columns are never read. ``per_trigger`` bounds a
    micro-batch (``maxBytesPerTrigger`` or ``maxFilesPerTrigger``).
    """
    stage = Stage(spark)
    table = spark.read.parquet(source)
    per_trigger = per_trigger or {"maxBytesPerTrigger": str(TRIGGER_BYTES)}
    stays = stage.store(first_seen(spark, stage, source, table.schema, id_column, text_column, digest, per_trigger), "stays")
    rows = located(table, id_column, text_column, digest)
    known = rows.join(stays, "digest", "left").select(
        "id", "at", "digest", "n", "stays", (F.col("at") == F.col("stays.at")).alias("kept"),
        F.when(F.col("n") > 1, F.col("body")).alias("body"))
    known = stage.store(known, "known")

    # Full bytes: every hit against the content at the locator of the row that stays.
    content = known.filter("n > 1 AND kept").select("digest", F.col("body").alias("kept_body"))
    hits = known.filter("n > 1 AND NOT kept").join(content, "digest").withColumn(
        "same", F.col("body").cast("binary") == F.col("kept_body").cast("binary"))
    hits = stage.store(hits.select("id", "at", "digest", "n", "stays", "same",
                                   F.when(~F.col("same"), F.col("body")).alias("body")), "hits")
    clashes = hits.filter("NOT same")
    strangers = clashes.groupBy("digest").agg(F.count("*").alias("strangers"))
    own = clashes.groupBy("digest", "body").agg(F.count("*").alias("size"), F.max(F.struct("id", "at")).alias("own"))

    single = known.filter("n <= 1 OR kept").select("id", "at", "digest", "n", "stays", "kept")
    same = hits.filter("same").select("id", "at", "digest", "n", "stays", F.lit(False).alias("kept"))
    agreed = single.unionByName(same).join(strangers, "digest", "left").select(
        "id", F.col("stays.id").alias("keep_id"), (F.col("n") - F.coalesce("strangers", F.lit(0))).alias("group_size"),
        "kept", "digest", "at")
    apart = clashes.join(own, ["digest", "body"]).select(
        "id", F.col("own.id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("at") == F.col("own.at")).alias("kept"), "digest", "at")
    return agreed.unionByName(apart)
