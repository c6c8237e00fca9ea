"""Top-k reports and sorted views; each limit is the report's own size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisalake.functions import exact_avg, round_half_away


def topk_worst_units(df: DataFrame, predicate: Column, order: Sequence[str], n: int) -> DataFrame:
    return df.filter(predicate).orderBy(*[F.asc_nulls_last(c) for c in order]).limit(n)


def rank_states_by_share(df: DataFrame, predicate: Column, col: str) -> DataFrame:
    return df.filter(predicate).orderBy(F.desc_nulls_last(col))


def effort_by_region(df: DataFrame, predicate: Column, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Units and means per region, the steepest required pace first (first of ``cols``)."""
    return (df.filter(predicate).groupBy(*by)
            .agg(F.count(F.lit(1)).alias("municipios"),
                 *[round_half_away(exact_avg(c)).alias(f"media_{c}") for c in cols])
            .orderBy(F.desc_nulls_last(f"media_{cols[0]}"), *by))


def good_abs_bad_rel(df: DataFrame, predicate: Column, col: str, n: int, tie: str) -> DataFrame:
    """Reached the target (``predicate``) but lies below its own state, furthest first."""
    return df.filter(predicate & (F.col(col) < 0)).orderBy(F.asc_nulls_last(col), tie).limit(n)


def top_n_largest(df: DataFrame, col: str, n: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(col), tie).limit(n)


def top_n_smallest(df: DataFrame, col: str, n: int, tie: str) -> DataFrame:
    return df.orderBy(F.asc_nulls_last(col), tie).limit(n)


def extremes(df: DataFrame, col: str, n: int, tie: str) -> DataFrame:
    """n lowest and n highest rows, marked."""
    low = top_n_smallest(df, col, n, tie).withColumn("end", F.lit("lowest"))
    return low.unionByName(top_n_largest(df, col, n, tie).withColumn("end", F.lit("highest")))


def mixed_sort(df: DataFrame, keys: Sequence[tuple[str, bool]]) -> DataFrame:
    return df.orderBy(*[F.asc_nulls_last(c) if up else F.desc_nulls_last(c) for c, up in keys])
