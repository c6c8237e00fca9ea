"""Ranks, latest-version picks, samples and change between cycles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brisalake.functions import round_half_away
from brisalake.operators import ladder as lad
from brisalake.operators.conform import dedup_latest

HELPERS = ("_n", "_below", "_total", "_rows")


def rank_within(df: DataFrame, by: Sequence[str], col: str, desc: bool = True, out: str = "rank",
                source: DataFrame | None = None) -> DataFrame:
    """RANK() per group: ties share a rank and leave a gap; nulls last."""
    return (lad.with_position(df, by, col, source)
            .withColumn(out, lad.rank_column(desc)).drop(*HELPERS))


def rank_national(df: DataFrame, by: Sequence[str], col: str, out: str = "rank_national") -> DataFrame:
    return rank_within(df, by, col, True, out)


def quartile_ntile(df: DataFrame, by: Sequence[str], col: str, n: int = 4, tie: str = "id",
                   out: str = "quartile") -> DataFrame:
    """NTILE(n) ascending, nulls last, ties split by ``tie``."""
    return (lad.with_row_number(df, by, col, tie, "_rn")
            .withColumn(out, lad.ntile_column(F.col("_rn"), F.col("_rows"), n)).drop("_rn", "_rows"))


def latest_revision(df: DataFrame, keys: Sequence[str], version_col: str) -> DataFrame:
    """Row with the newest version per key."""
    rest = sorted(c for c in df.columns if c not in keys and c != version_col)
    return dedup_latest(df, keys, [F.desc_nulls_last(version_col), *[F.asc_nulls_last(c) for c in rest]])


def stratified_sample(df: DataFrame, by: Sequence[str], n: int, seed: int, id_col: str) -> DataFrame:
    """At most ``n`` pseudo-random rows per stratum; the same rows on every run.

    Rows are numbered by ranges of their hash, so no stratum is sorted in one task,
    and ranges beyond the sample are dropped before anything is sorted.
    """
    return lad.with_hash_order(df, by, id_col, seed, first=n).filter(F.col("_rn") <= n).drop("_rn", "_size")


def percentile_rank_avg(df: DataFrame, col: str, by: Sequence[str] | None = None, desc: bool = False,
                        out: str = "pct_rank", source: DataFrame | None = None) -> DataFrame:
    """Average rank of ties over the non-null count, times 100; null stays null."""
    placed = lad.with_position(df, by or [], col, source)
    below = F.col("_total") - F.col("_below") - F.col("_n") if desc else F.col("_below")
    pct = 100.0 * (below + (F.col("_n") + 1) / 2.0) / F.col("_total")
    return placed.withColumn(out, F.when(F.col(col).isNotNull(), pct)).drop(*HELPERS)


def upsert_keep_last(existing: DataFrame, incoming: DataFrame, key: Sequence[str],
                     order_by: Sequence[Column]) -> DataFrame:
    """existing and incoming as one row per key; incoming beats existing, then ``order_by``."""
    both = existing.withColumn("_src", F.lit(0)).unionByName(
        incoming.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    return dedup_latest(both, key, [F.desc("_src"), *order_by]).drop("_src")


def first_last_change(df: DataFrame, unit: Sequence[str], year: str, value: str, target: str,
                      band: float = 1.0, carry: Sequence[str] = ()) -> DataFrame:
    """First against last cycle of each unit; ``carry`` columns come from the last.

    One aggregation: the year is carried inside the min/max struct, so a unit
    is never collected and no self join is needed. A cycle without value stays
    a cycle with a null value.
    """
    point = F.struct(F.col(year).alias("y"), F.col(value).alias("v"), F.col(target).alias("t"), *carry)
    ends = df.groupBy(*unit).agg(F.min(point).alias("a"), F.max(point).alias("z"))
    delta, years = F.col("z.v") - F.col("a.v"), F.col("z.y") - F.col("a.y")
    return ends.select(*unit, *[F.col(f"z.{c}").alias(c) for c in carry], F.col("a.y").alias("ano_inicial"), F.col("z.y").alias("ano_final"),
                       F.col("a.v").alias("taxa_inicial"), F.col("z.v").alias("taxa_final"),
                       F.col("z.t").alias("meta_2030"),
                       *change_columns(F.col("a.v"), F.col("z.v"), F.col("z.t"), delta, years, band))


def change_columns(first: Column, last: Column, target: Column, delta: Column, years: Column,
                   band: float) -> list[Column]:
    """Change, change per year, trend label and years to the target.

    The trend labels are fixed values.
    """
    trend = (F.when(years == 0, "Serie unica").when(delta > band, "Melhora")
             .when(delta < -band, "Piora").when(delta.isNotNull(), "Estavel"))
    pace = F.try_divide(delta, years.cast("double"))
    eta = (F.when(last >= target, F.lit(0.0))
           .when((delta > 0) & (years > 0), round_half_away(F.try_divide(target - last, pace), 1)))
    return [round_half_away(delta).alias("variacao_pp"),
            round_half_away(pace).alias("variacao_media_anual_pp"),
            trend.alias("tendencia"), eta.alias("anos_estimados_para_meta")]
