"""Stacking and unpivoting."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisalake.functions import trailing_digits
from brisalake.operators.windows import latest_revision


def union_by_name(*dfs: DataFrame, allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


def unpivot_levels(df: DataFrame, ids: Sequence[str], cols: Sequence[str], key: str, value: str) -> DataFrame:
    """One row per non-null cell, ``key`` numbering the columns from 0; one scan."""
    typed = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    number = F.array_position(F.array(*[F.lit(c) for c in cols]), F.col("_name")) - 1
    return (typed.unpivot(list(ids), list(cols), "_name", value)
            .filter(F.col(value).isNotNull())
            .select(*ids, number.cast("int").alias(key), value))


def unpivot_year_suffix(df: DataFrame, ids: Sequence[str], prefix: str, key: str, value: str) -> DataFrame:
    """Columns ``<prefix>YYYY`` to (year, value) rows, nulls dropped."""
    cols = [c for c in df.columns if c.startswith(prefix) and c[-4:].isdigit()]
    if not cols:
        raise ValueError(f"no column starts with {prefix}")
    typed = df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    return (typed.unpivot(list(ids), cols, "_name", value)
            .filter(F.col(value).isNotNull())
            .select(*ids, trailing_digits("_name", 4).cast("int").alias(key), value))


def target_trajectory(df: DataFrame, keys: Sequence[str], network: Column, declared: str,
                      prefix: str = "meta_alfabetizacao_") -> DataFrame:
    """Newest declared target per (keys, network code, target year)."""
    coded = df.withColumn("rede", network)
    long = unpivot_year_suffix(coded, [*keys, "rede", declared], prefix, "ano_meta", "meta_taxa")
    return latest_revision(long, [*keys, "rede", "ano_meta"], declared).drop(declared)
