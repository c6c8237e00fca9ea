"""Exact order statistics that never pull a whole group into one task.

A window ordered over a hot group, or ``percentile``, ends in a single task
holding that group. Here a group is first reduced to its distinct values with
counts (combined before the shuffle). Each value then falls into a bin of two
monotone levels: the value's size class (or its first characters), and inside one
the size class of its distance from the class's smallest value (or the next
characters). So

* counts per bin are small (their number depends on the range of the measure,
  not on the rows) and can be accumulated per group, and
* values inside one bin, a small share of the group even where all values are
  close to one another, are accumulated by their own window partition.

Values order as in Spark: -infinity, numbers, infinity, NaN; nulls come last.
Rank, ntile, average-rank percentile, quantile and median follow exactly from
"how many rows lie below this value".
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

STEPS = 256  # bins per factor of e; relative width of a bin is about 0.4 %
LAST_BIN = 1 << 40
TIE_BITS = 10  # whole-number ties are binned by so many low bits


def _classes(d: Column) -> Column:
    """Monotone integer bin of a double; infinities and NaN have their own."""
    return (F.when(F.isnan(d), F.lit(LAST_BIN - 1)).when(d == float("inf"), F.lit(LAST_BIN - 2))
            .when(d == float("-inf"), F.lit(-LAST_BIN)).otherwise(F.floor(F.signum(d) * F.log1p(F.abs(d)) * STEPS)))


def _characters(c: Column, first: int) -> Column:
    """Four bytes of a text as a number, so that texts order as their numbers do."""
    part = F.rpad(F.hex(F.substring(c.cast("binary"), first, 4)), 8, "0")
    return F.conv(part, 16, 10).cast("bigint")


def _number(df: DataFrame, col: str) -> Column:
    kind = df.schema[col].dataType
    c = F.col(col)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return F.datediff(c, F.lit("1970-01-01").cast("date")).cast("double") if isinstance(kind, T.DateType) else c.cast("double")


def with_bin(df: DataFrame, by: Sequence[str], col: str, out: str = "_bin") -> DataFrame:
    """Add the two-level bin of ``col`` within its group; nulls fall in LAST_BIN."""
    null, by = F.col(col).isNull(), list(by)
    none = F.lit(LAST_BIN).cast("bigint")
    two = lambda a, b: F.struct(F.when(null, none).otherwise(a.cast("bigint")).alias("a"), F.when(null, none).otherwise(b.cast("bigint")).alias("b"))
    if isinstance(df.schema[col].dataType, (T.StringType, T.BinaryType)):
        return df.withColumn(out, two(_characters(F.col(col), 1), _characters(F.col(col), 5)))
    number = _number(df, col)
    wide = df.withColumn("_wide", F.when(null, none).otherwise(_classes(number)))
    least = wide.groupBy(*by, "_wide").agg(F.min(number).alias("_least"))
    near = F.when(F.abs(F.col("_wide")) >= LAST_BIN - 2, F.lit(0)).otherwise(_classes(number - F.col("_least")))
    return join_same(wide, least, [*by, "_wide"]).withColumn(out, two(F.col("_wide"), near)).drop("_wide", "_least")


def tie_bin(df: DataFrame, col: str) -> Column:
    """Monotone bin of a tie column: a run of whole numbers, the first characters of a text, or a size class."""
    kind, c = df.schema[col].dataType, F.col(col)
    if isinstance(kind, T.IntegralType):
        bin_ = F.shiftright(c.cast("bigint"), TIE_BITS)
    else:
        bin_ = _characters(c, 1) if isinstance(kind, (T.StringType, T.BinaryType)) else _classes(_number(df, col))
    return F.when(c.isNull(), F.lit(None).cast("bigint")).otherwise(bin_.cast("bigint"))


def join_same(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join in which null keys match each other; keeps the left keys."""
    renamed = right
    for k in on:
        renamed = renamed.withColumnRenamed(k, f"__r_{k}")
    cond = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in on]
    if not cond:
        raise ValueError("join_same needs keys")
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in on])


def _before(w, c: str) -> Column:
    return F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def value_ladder(df: DataFrame, by: Sequence[str], col: str, weight: str | None = None) -> DataFrame:
    """by…, col, ``n`` rows with this value, ``below`` rows under it,
    ``total`` non-null rows and ``rows`` all rows of the group.

    Nulls form the last step: their ``below`` equals ``total``.
    """
    by = list(by)
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = with_bin(df.groupBy(*by, col).agg(n.alias("n")), by, col)
    bins = counts.groupBy(*by, "_bin").agg(F.sum("n").alias("_bn"))
    per_group = Window.partitionBy(*by)
    offsets = bins.select(
        *by, "_bin",
        _before(per_group.orderBy("_bin"), "_bn").alias("_off"),
        F.coalesce(F.sum(F.when(F.col("_bin.a") < LAST_BIN, F.col("_bn"))).over(per_group),
                   F.lit(0)).alias("total"),
        F.sum("_bn").over(per_group).alias("rows"))
    inside = counts.withColumn(
        "_in", _before(Window.partitionBy(*by, "_bin").orderBy(col), "n"))
    return (join_same(inside, offsets, [*by, "_bin"])
            .select(*by, col, "n", (F.col("_off") + F.col("_in")).alias("below"), "total", "rows"))


def with_position(df: DataFrame, by: Sequence[str], col: str, source: DataFrame | None = None) -> DataFrame:
    """Every row with ``_n, _below, _total, _rows`` of its value.

    ``source`` holds the same rows more cheaply, when ``df`` is a long plan.
    """
    ladder = value_ladder(df if source is None else source, by, col)
    for c in ("n", "below", "total", "rows"):
        ladder = ladder.withColumnRenamed(c, f"_{c}")
    return join_same(df, ladder, [*by, col], "left")


def rank_column(desc: bool) -> Column:
    """RANK() from the columns of ``with_position``; nulls last."""
    below, n, total = F.col("_below"), F.col("_n"), F.col("_total")
    if not desc:
        return below + 1
    return F.when(below >= total, below + 1).otherwise(total - below - n + 1)


def with_row_number(df: DataFrame, by: Sequence[str], col: str, tie: str, out: str) -> DataFrame:
    """ROW_NUMBER() by (col ascending nulls last, tie), plus ``_rows`` of the group.

    Ties may be hot, so they are split into bins of the tie column.
    """
    by = list(by)
    binned = df.withColumn("_tb", tie_bin(df, tie))
    cells = binned.groupBy(*by, col, "_tb").agg(F.count(F.lit(1)).alias("_c"))
    ladder = value_ladder(cells, by, col, weight="_c").select(
        *by, col, "below", F.col("rows").alias("_rows"))
    offsets = (join_same(cells.withColumn(
        "_toff", _before(Window.partitionBy(*by, col).orderBy("_tb"), "_c")), ladder, [*by, col])
        .select(*by, col, "_tb", "_rows", (F.col("below") + F.col("_toff")).alias("_start")))
    local = binned.withColumn(
        out, F.row_number().over(Window.partitionBy(*by, col, "_tb").orderBy(tie)))
    return (join_same(local, offsets, [*by, col, "_tb"])
            .withColumn(out, F.col(out) + F.col("_start")).drop("_tb", "_start"))


def ntile_column(row_number: Column, rows: Column, n: int) -> Column:
    """NTILE(n) from a row number and the rows of the group; larger tiles first."""
    size = F.floor(rows / n)
    extra = rows - size * n
    head = extra * (size + 1)
    early = F.floor((row_number - 1) / (size + 1)) + 1
    late = extra + F.floor(F.try_divide(row_number - 1 - head, size)) + 1
    return F.when(row_number <= head, early).otherwise(late).cast("bigint")


def quantiles(df: DataFrame, by: Sequence[str], col: str, ps: Mapping[str, float], weight: str | None = None) -> DataFrame:
    """by… and one column per named quantile, linear interpolation, exact; ``weight`` says how many rows a row stands for."""
    by = list(by)
    ladder = value_ladder(df, by, col, weight)
    top = F.greatest(F.col("total") - 1, F.lit(0)).cast("double")
    holds = lambda k: (F.col("below") <= k) & (k < F.col("below") + F.col("n"))
    aggs = []
    for name, p in ps.items():
        pos = top * p
        lo, hi = F.floor(pos), F.ceil(pos)
        low = F.max(F.when(holds(lo), F.col(col).cast("double")))
        high = F.max(F.when(holds(hi), F.col(col).cast("double")))
        part = F.max(pos - lo)
        aggs.append((low * (1 - part) + high * part).alias(name))
    return ladder.groupBy(*by).agg(*aggs)


def with_hash_order(df: DataFrame, by: Sequence[str], id_col: str, seed: int,
                    first: int | None = None) -> DataFrame:
    """``_rn`` numbers the rows of a group in a fixed pseudo-random order; ``_size`` is the group.

    Rows are ordered by hash. Counts per hash range say where each range
    starts, so a large group is numbered range by range. With ``first`` the
    ranges beyond the first n rows are dropped before anything is sorted.
    """
    by = list(by)
    hashed = df.withColumn("_h", F.xxhash64(F.col(id_col), F.lit(seed)))
    hashed = hashed.withColumn("_hb", F.shiftright("_h", 50))
    per = Window.partitionBy(*by)
    cells = hashed.groupBy(*by, "_hb").agg(F.count(F.lit(1)).alias("_c"))
    starts = cells.select(*by, "_hb", _before(per.orderBy("_hb"), "_c").alias("_start"),
                          F.sum("_c").over(per).alias("_size"))
    if first is not None:
        starts = starts.filter(F.col("_start") < first)
    local = F.row_number().over(Window.partitionBy(*by, "_hb").orderBy("_h", id_col))
    return (join_same(hashed, starts, [*by, "_hb"])
            .withColumn("_rn", F.col("_start") + local).drop("_h", "_hb", "_start"))
