"""Bytes on storage and bytes a query has to read."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brisalake.functions import fn_bytes_label, round_half_away, safe_ratio
from brisalake.sources.catalog import file_sizes


def column_bytes(spark: SparkSession, path: str) -> DataFrame:
    """path, column, bytes over all row groups; footers are read on the executors."""
    def footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            rows = []
            for file in batch["path"]:
                store, inner = fs.FileSystem.from_uri(file)
                with store.open_input_file(inner) as handle:
                    meta = pq.ParquetFile(handle).metadata
                    groups = [meta.row_group(g) for g in range(meta.num_row_groups)]
                    parts = [g.column(i) for g in groups for i in range(g.num_columns)]
                    rows += [(file, p.path_in_schema.split(".")[0], p.total_compressed_size) for p in parts]
            yield pd.DataFrame(rows, columns=["path", "column", "bytes"])

    files = file_sizes(spark, path, "*.parquet").select(
        F.regexp_replace("path", r"^file:/+", "file:///").alias("path"))
    return (files.mapInPandas(footers, "path string, column string, bytes bigint")
            .groupBy("path", "column").agg(F.sum("bytes").alias("bytes")))


def scan_bytes_report(spark: SparkSession,
                      layouts: Mapping[str, tuple[str, str | None, Sequence[str] | None]],
                      price_per_tb: float = 5.0, runs: int = 500) -> DataFrame:
    """Bytes each layout {name: (path, partition, columns)} reads for one question.

    ``partition`` is a ``key=value`` folder or None; ``columns`` None means all.
    A path ending in ``.csv`` is a text scan and costs whole files. Percentages
    are of the first layout; cost is for ``runs`` runs.
    """
    rows = []
    for i, (name, (path, partition, columns)) in enumerate(layouts.items()):
        if path.rstrip("/").endswith(".csv"):
            read = file_sizes(spark, path, "*.csv").withColumnRenamed("length", "bytes")
        else:
            read = column_bytes(spark, path)
            if partition:
                read = read.filter(F.contains(F.col("path"), F.lit(f"/{partition}/")))
            if columns is not None:
                read = read.filter(F.col("column").isin(*columns))
        rows.append(read.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
                    .select(F.lit(i).alias("step"), F.lit(name).alias("layout"), "bytes"))
    all_rows = reduce(lambda a, b: a.unionByName(b), rows)
    base = rows[0].select("bytes").scalar()
    return all_rows.select(
        "step", "layout", "bytes", fn_bytes_label("bytes").alias("label"),
        safe_ratio(100.0 * F.col("bytes"), base, 1).alias("pct_of_first"),
        round_half_away(F.col("bytes") * F.lit(runs / 1024**4 * price_per_tb), 4).alias("cost_usd"))


def format_size_compare(df: DataFrame, tmp_dir: str) -> DataFrame:
    """The same rows as CSV, gzipped CSV and Snappy parquet: bytes and percent saved."""
    spark = df.sparkSession
    targets = {"CSV": "csv", "CSV + gzip": "csv_gz", "Parquet + Snappy": "parquet"}
    paths = {name: f"{tmp_dir}/{sub}" for name, sub in targets.items()}
    df.write.mode("overwrite").option("header", True).csv(paths["CSV"])
    df.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(paths["CSV + gzip"])
    df.write.mode("overwrite").option("compression", "snappy").parquet(paths["Parquet + Snappy"])
    sizes = {n: file_sizes(spark, p, "part-*").agg(F.sum("length").alias("bytes")) for n, p in paths.items()}
    base = sizes["CSV"].scalar()
    rows = [s.select(F.lit(n).alias("format"), "bytes") for n, s in sizes.items()]
    return reduce(lambda a, b: a.unionByName(b), rows).select(
        "format", "bytes", fn_bytes_label("bytes").alias("label"),
        safe_ratio(100.0 * (base - F.col("bytes")), base, 1).alias("saved_pct"))


def layer_footprint(spark: SparkSession, layers: Mapping[str, str]) -> DataFrame:
    """Files and bytes per layer and table (first folder below the layer)."""
    rows = []
    for layer, path in layers.items():
        tail = F.element_at(F.split(F.col("path"), F.lit(f"{path.rstrip('/')}/")), -1)
        rows.append(file_sizes(spark, path, "part-*").select(
            F.lit(layer).alias("layer"), F.substring_index(tail, "/", 1).alias("table"), "length"))
    return (reduce(lambda a, b: a.unionByName(b), rows).groupBy("layer", "table")
            .agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
            .withColumn("label", fn_bytes_label("bytes")))
