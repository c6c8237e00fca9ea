"""Manifests, inventories, profiles and names for lake tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from brisalake.functions import exact_avg, round_half_away


def file_sizes(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path and length of every file; contents are not read (column pruning)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", pattern).load(path).select("path", "length"))


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def manifest(spark: SparkSession, entries: Mapping[str, tuple[str, str]], run_id: str) -> DataFrame:
    """One row per loaded entity {name: (path, format)}: rows, columns, bytes, run.

    Parquet counts come from the footers; sizes from the file listing.
    """
    rows = []
    for name, (path, fmt) in entries.items():
        reader = spark.read.option("header", True) if fmt == "csv" else spark.read
        table = reader.format(fmt).load(path)
        size = file_sizes(spark, path).agg(F.sum("length")).scalar()
        rows.append(table.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("entity"), F.lit(fmt).alias("format"), "rows",
            F.lit(len(table.columns)).cast("bigint").alias("columns"),
            size.alias("bytes"), F.lit(path).alias("path"), F.lit(run_id).alias("run_id")))
    return _stack(rows)


def layer_inventory(spark: SparkSession, layers: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """layer, table, rows, columns, partition columns, bytes; a TOTAL row at the end."""
    rows = []
    for layer, tables in layers.items():
        for name, path in tables.items():
            table = spark.read.parquet(path)
            files = file_sizes(spark, path)
            parts = files.select(F.regexp_extract_all("path", F.lit(r"/([^/=]+)=[^/]*"), 1).alias("p"))
            cols = parts.agg(F.array_join(F.max("p"), ", ")).scalar()
            rows.append(table.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(layer).alias("layer"), F.lit(name).alias("table"), "rows",
                F.lit(len(table.columns)).cast("bigint").alias("columns"),
                cols.alias("partitioned_by"), files.agg(F.sum("length")).scalar().alias("bytes")))
    listed = _stack(rows)
    total = listed.agg(F.sum("rows").alias("rows"), F.sum("columns").alias("columns"),
                       F.sum("bytes").alias("bytes")).select(
        F.lit("TOTAL").alias("layer"), F.lit("").alias("table"), "rows", "columns",
        F.lit("").alias("partitioned_by"), "bytes")
    return listed.unionByName(total)


def table_profile(df: DataFrame) -> DataFrame:
    """Per column: type, percent null, an example, and min/max/mean/deviation of numbers.

    One aggregation over the table; the wide row is then turned into rows.
    """
    aggs: list[Column] = [F.count(F.lit(1)).alias("_all")]
    number = (T.NumericType,)
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        aggs += [F.count(c).alias(f"n{i}"),
                 F.any_value(c, F.lit(True)).alias(f"e{i}")]
        if isinstance(f.dataType, number):
            d = c.cast("double")
            aggs += [F.min(d).alias(f"lo{i}"), F.max(d).alias(f"hi{i}"),
                     exact_avg(d).alias(f"av{i}"), F.stddev(d).alias(f"sd{i}")]
    wide = df.agg(*aggs)
    none = F.lit(None).cast("double")
    rows = []
    for i, f in enumerate(df.schema.fields):
        isnum = isinstance(f.dataType, number)
        stat = lambda p: F.col(f"{p}{i}") if isnum else none
        rows.append(F.struct(
            F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
            round_half_away(F.try_divide(100.0 * (F.col("_all") - F.col(f"n{i}")), F.col("_all"))).alias("null_pct"),
            F.col(f"e{i}").cast("string").alias("example"), stat("lo").alias("min"), stat("hi").alias("max"),
            stat("av").alias("mean"), stat("sd").alias("stddev")))
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def register_views(spark: SparkSession, views: Mapping[str, str]) -> set[str]:
    """Name each readable table; an absent one is skipped. Returns the names made."""
    made = set()
    for view, path in views.items():
        try:
            spark.read.parquet(path).createOrReplaceTempView(view)
            made.add(view)
        except AnalysisException:
            continue
    return made


def external_table(spark: SparkSession, name: str, schema: str, partitions: Sequence[str],
                   location: str, brought: DataFrame | None = None) -> DataFrame:
    """Declare a table over partitioned parquet and load its partitions.

    With ``brought``, the rows a write has just added, only their partitions are
    registered: the cost follows the write, and nothing else is listed. Without it all
    partitions found at the location are, which lists the whole table.

    An existing table of that name is kept if it is external and over the same
    place; any other is an error. Nothing is dropped.
    """
    by = f"PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    if spark.catalog.tableExists(name):
        about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
        if about.get("Type") != "EXTERNAL" or about.get("Location", "").split(":")[-1].strip("/") != location.split(":")[-1].strip("/"):
            raise ValueError(f"{name} is another table")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING PARQUET {by} LOCATION '{location}'")
    if partitions and brought is None:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    elif partitions:
        add_partitions(spark, name, brought, partitions)
    return spark.table(name)


def add_partitions(spark: SparkSession, name: str, brought: DataFrame, partitions: Sequence[str], at_once: int = 500) -> int:
    """Register the partitions of ``brought`` that the table does not know; their number.

    Known ones are looked up one statement at a time by the values brought, not by
    listing the table. A write brings few partitions: their values pass the driver.
    """
    def value(v) -> str:
        return "NULL" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"

    specs = ["(" + ", ".join(f"`{c}` = {value(r[c])}" for c in partitions) + ")" for r in brought.select(*partitions).distinct().collect()]
    new = [s for s in specs if not spark.sql(f"SHOW PARTITIONS {name} PARTITION {s}").head(1)]
    for i in range(0, len(new), at_once):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(f"PARTITION {s}" for s in new[i:i + at_once]))
    return len(new)


def dashboard_view(spark: SparkSession, view: str, source: DataFrame, columns: Sequence[str],
                   predicate: Column) -> DataFrame:
    """Named projection for a dashboard."""
    source.filter(predicate).select(*columns).createOrReplaceTempView(view)
    return spark.table(view)


def sql_over_lake(spark: SparkSession, sql: str) -> DataFrame:
    return spark.sql(sql)
