"""Sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_partitioned(df: DataFrame, path: str, partitions: Sequence[str] = (),
                      spread: str | None = None, files_per_partition: int = 1) -> str:
    """Idempotent parquet write: a re-run replaces the partitions it brings.

    Rows are brought together by partition value and rebalanced: adaptive execution
    splits a large or hot partition over several tasks and files and joins small
    ones. With ``spread`` (a high-cardinality column) a partition is dealt over a
    fixed number of files instead.
    """
    writer = df
    if partitions and spread is not None and files_per_partition > 1:
        writer = df.repartition(*partitions, F.pmod(F.xxhash64(spread), F.lit(files_per_partition)))
    elif partitions:
        writer = df.hint("rebalance", *partitions)
    out = writer.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (out.partitionBy(*partitions) if partitions else out).parquet(path)
    return path


def write_table(df: DataFrame, name: str, path: str | None = None) -> str:
    """Overwrite a catalogue table; its schema may change."""
    out = df.write.mode("overwrite").format("parquet")
    (out.option("path", path) if path else out).saveAsTable(name)
    return name


def append_merge_schema(df: DataFrame, path: str) -> str:
    """Append rows that may bring new columns; read back with ``merge_schema=True``."""
    df.write.mode("append").parquet(path)
    return path


def write_compact(df: DataFrame, path: str, files: int | None = None) -> str:
    """Few files: as many as the size asks for, or ``files``. What comes before keeps all its tasks."""
    compact = df.hint("rebalance") if files is None else df.repartition(files)
    compact.write.mode("overwrite").parquet(path)
    return path


def write_json_events(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    return path


def _plain(c: Column, kind: T.DataType) -> Column:
    """Digits without an exponent; numbers beyond 38 digits keep theirs."""
    text = c.cast("string")
    if isinstance(kind, T.DecimalType):
        return text
    digits = F.regexp_replace(c.try_cast("decimal(38,18)").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when(F.contains(text, F.lit("E")), F.coalesce(digits, text)).otherwise(text)


def export_csv_locale(df: DataFrame, path: str, sep: str = ";", decimal: str = ",") -> str:
    """CSV for spreadsheets: ``;`` between fields, a decimal comma and no exponents."""
    numeric = (T.DoubleType, T.FloatType, T.DecimalType)
    cols = [F.replace(_plain(F.col(f.name), f.dataType), F.lit("."), F.lit(decimal)).alias(f.name)
            if isinstance(f.dataType, numeric) else F.col(f.name) for f in df.schema.fields]
    df.select(*cols).write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
    return path


def _order_number(c: Column, kind: T.DataType) -> Column:
    """A number that rises with the column; texts by their first seven bytes."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        bytes_ = F.substring(F.rpad(F.hex(F.encode(c, "UTF-8") if isinstance(kind, T.StringType) else c), 14, "0"), 1, 14)
        return F.conv(bytes_, 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def _place(value: Column, cuts: Sequence[float]) -> Column:
    """How many of the cuts are at or below the value; 0 for null."""
    if not cuts:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut <= value)), F.lit(0))


def curve_key(df: DataFrame, cols: Sequence[str], bits: int = 6) -> Column:
    """Place of a row on a space-filling curve through ``cols``: rows near on the curve are near in every column.

    Each column's values are cut into 2^bits ranges of about equal numbers of rows
    (percentiles of all rows, one pass); the ranges' numbers are interleaved bit by
    bit, the first column's bit first. Null is below every value.
    """
    numbers = {c: _order_number(F.col(c), df.schema[c].dataType) for c in cols}
    shares = F.array(*[F.lit(i / (1 << bits)) for i in range(1, 1 << bits)])
    found = df.agg(*[F.percentile_approx(x, shares, 10_000).alias(c) for c, x in numbers.items()]).first()
    places = [_place(x, sorted(set(found[c] or []))) for c, x in numbers.items()]
    key = F.lit(0).cast("bigint")
    for bit in range(bits):
        for j, place in enumerate(reversed(places)):
            one = F.shiftright(place, bit).bitwiseAND(F.lit(1)).cast("bigint")
            key = key + F.shiftleft(one, bit * len(places) + j)
    return key


def compact_cluster(df: DataFrame, path: str, files: int, cluster_cols: Sequence[str], bits: int = 6) -> str:
    """Rewrite with ``files`` files in which a filter on any of ``cluster_cols`` finds its rows in few.

    Rows are ranged along a space-filling curve through the columns (at most ten), so
    the files' statistics are narrow in each of them, not in the first alone. Within a
    place of the curve rows are dealt by hash: a hot value, or one row repeated,
    spreads over as many files as its share asks for. Files are sorted by the columns.
    """
    bits = min(bits, 62 // len(cluster_cols))
    keyed = df.withColumn("_key", curve_key(df, cluster_cols, bits)).withColumn(
        "_salt", F.xxhash64(F.monotonically_increasing_id(), *cluster_cols))
    (keyed.repartitionByRange(files, "_key", "_salt").drop("_key", "_salt").sortWithinPartitions(*cluster_cols)
     .write.mode("overwrite").parquet(path))
    return path
