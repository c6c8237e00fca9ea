"""Session builder and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "brisalake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators assume.

    On a cluster leave ``master`` to spark-submit and give
    ``spark.sql.shuffle.partitions`` a generous value: adaptive execution
    merges small partitions but cannot split an aggregation's.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to the machine's own temporary folder.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/brisalake-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return os.path.join(tempfile.mkdtemp(prefix="brisalake-"), "work")
