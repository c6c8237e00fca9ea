"""Grouped and global aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisalake.functions import exact_avg, round_half_away, safe_ratio
from brisalake.operators.ladder import quantiles


def group_summary(df: DataFrame, by: Sequence[str], avgs: Sequence[str], scale: int = 2) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        *[round_half_away(exact_avg(c), scale).alias(f"avg_{c}") for c in avgs])


def count_distinct(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count_distinct(col).alias(f"distinct_{col}"))


def conditional_max_pivot(df: DataFrame, by: Sequence[str], order_col: str, first: Column | str,
                          last: Column | str, cols: Sequence[str]) -> DataFrame:
    """Value of each column at the first and at the last order value of the row's key."""
    first = F.col(first) if isinstance(first, str) else first
    last = F.col(last) if isinstance(last, str) else last
    o = F.col(order_col)
    return df.groupBy(*by).agg(
        *[F.max(F.when(o == first, F.col(c))).alias(f"{c}_first") for c in cols],
        *[F.max(F.when(o == last, F.col(c))).alias(f"{c}_last") for c in cols])


def group_bounds(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    return df.groupBy(*by).agg(F.min(col).alias(f"min_{col}"), F.max(col).alias(f"max_{col}"))


def global_aggregate(df: DataFrame, aggs: Sequence[Column]) -> DataFrame:
    return df.agg(*aggs)


def percentile_exact(df: DataFrame, by: Sequence[str], col: str, ps: Sequence[float]) -> DataFrame:
    """p50, p90 … per group, linear interpolation."""
    return quantiles(df, by, col, {f"p{p * 100:g}".replace(".", "_"): p for p in ps})


def percentile_approx(df: DataFrame, by: Sequence[str], col: str, p: float, accuracy: int = 100) -> DataFrame:
    """Approximate percentile from a bounded sketch; error about 1 / accuracy of the ranks."""
    return df.groupBy(*by).agg(F.percentile_approx(col, p, accuracy).alias("approx"))


def group_median(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    return quantiles(df, by, col, {f"median_{col}": 0.5})


def describe_stats(df: DataFrame, col: str) -> DataFrame:
    """Count, mean, deviation, range, quartiles and P90/P10 ratio in one row."""
    q = quantiles(df, [], col, {"q25": 0.25, "q50": 0.5, "q75": 0.75, "_p10": 0.1, "_p90": 0.9})
    cuts = q.select(F.struct("*").alias("s")).scalar()
    return (df.agg(F.count(col).alias("n"), exact_avg(col).alias("mean"), F.stddev(col).alias("std"),
                   F.min(col).alias("min"), F.max(col).alias("max"))
            .withColumn("_q", cuts)
            .select("n", "mean", "std", "min", "max", "_q.q25", "_q.q50", "_q.q75",
                    (F.col("max") - F.col("min")).alias("spread"),
                    safe_ratio("_q._p90", "_q._p10").alias("p90_p10")))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col)


def crosstab(df: DataFrame, rows: str, cols: str, values: Sequence[str]) -> DataFrame:
    """Two-way counts; the column values are given, so no extra pass finds them."""
    return df.groupBy(rows).agg(*[
        F.count_if(F.col(cols) == v).alias(str(v)) for v in values])


def crosstab_row_share(df: DataFrame, rows: str, cols: str, values: Sequence[str]) -> DataFrame:
    """Two-way table as percent of the row total over the given values."""
    total = sum((F.col(str(v)) for v in values[1:]), F.col(str(values[0])))
    return crosstab(df, rows, cols, values).select(
        rows, *[safe_ratio(100.0 * F.col(str(v)), total, 2).alias(str(v)) for v in values])


def histogram(df: DataFrame, col: str, bins: int = 45) -> DataFrame:
    """Rows per equal-width bin between the smallest and largest value; empty bins are absent."""
    ends = df.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi")).alias("s")).scalar()
    lo, hi, x = F.col("_e.lo"), F.col("_e.hi"), F.col(col)
    slot = F.least(F.floor(F.try_divide((x - lo) * bins, hi - lo)), F.lit(bins - 1))
    return (df.filter(x.isNotNull()).select(col).withColumn("_e", ends)
            .select(F.coalesce(slot, F.lit(0)).cast("bigint").alias("bin"))
            .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))


def box_stats(df: DataFrame, by: str, col: str) -> DataFrame:
    """Five-number summary per group, highest median first."""
    q = quantiles(df, [by], col, {"low": 0.0, "q25": 0.25, "q50": 0.5, "q75": 0.75, "high": 1.0})
    return q.orderBy(F.desc_nulls_last("q50"), by)


def medians(df: DataFrame, cols: Sequence[str]) -> Column:
    """Exact whole-table medians as one scalar struct with a field per column.

    The columns are stacked and share one pass, whatever their number.
    """
    long = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot([], list(cols), "_name", "_value")
    mids = quantiles(long, ["_name"], "_value", {"m": 0.5})
    fields = [F.max(F.when(F.col("_name") == c, F.col("m"))).alias(c) for c in cols]
    return mids.agg(F.struct(*fields)).scalar()


def rounded(df: DataFrame, cols: Sequence[str], scale: int = 2) -> DataFrame:
    return df.withColumns({c: round_half_away(F.col(c), scale) for c in cols})
