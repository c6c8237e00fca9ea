"""Typing, domains, deduplication and row splits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brisalake.functions import round_half_away


def conform_types(df: DataFrame, types: Mapping[str, tuple[str, int | None]]) -> DataFrame:
    """Cast each column; text that does not parse becomes null; optional rounding."""
    out = {}
    for name, (kind, scale) in types.items():
        c = F.col(name).try_cast(kind)
        out[name] = c if scale is None else round_half_away(c, scale)
    return df.withColumns(out)


def project_rename(df: DataFrame, names: Mapping[str, str], keep: Sequence[str] | None = None) -> DataFrame:
    """Rename the columns that exist; with ``keep`` also select."""
    present = {old: new for old, new in names.items() if old in df.columns}
    df = df.withColumnsRenamed(present)
    return df if keep is None else df.select(*keep)


def valid_split(df: DataFrame, predicate: Column) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); a null test result counts as rejected."""
    ok = F.coalesce(predicate, F.lit(False))
    return df.filter(ok), df.filter(~ok)


def required_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing mandatory columns: {missing}")


def domain_from_dictionary(df: DataFrame, code_col: str, dictionary: DataFrame,
                           defaults: Mapping, out: str = "label") -> DataFrame:
    """Label from the official dictionary (chave, valor), else the default label.

    The dictionary is left to the planner: it is broadcast only if it is small.
    """
    from brisalake.functions import decode_domain

    official = (dictionary.select(F.col("chave").cast("string").alias("_code"),
                                  F.col("valor").alias("_label"))
                .groupBy("_code").agg(F.min("_label").alias("_label")))
    fallback = decode_domain(F.col(code_col), defaults)
    return (df.join(official, F.col(code_col).cast("string") == F.col("_code"), "left")
            .withColumn(out, F.coalesce("_label", fallback)).drop("_code", "_label"))


def dedup_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropDuplicates(list(keys))


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """First row per key in the given order.

    The ``= 1`` filter lets Spark drop losers before the shuffle, so a hot key
    sends at most one row per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return (df.withColumn("_pick", F.row_number().over(w))
            .filter(F.col("_pick") == 1).drop("_pick"))


def fill_default(df: DataFrame, defaults: Mapping) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def drop_null_keys(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.dropna(subset=None if cols is None else list(cols))


def filter_in_keys(df: DataFrame, keys_df: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys_df, list(on), "left_semi")


def distinct_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def derived_gaps(df: DataFrame, actual: str, target: str, final: str,
                 parents: Mapping[str, str]) -> DataFrame:
    """Gap to the target of the year and to the final target, flag, distance to parents.

    ``parents`` maps an output column to the parent's rate column. Without a
    target the flag is null, not false.
    """
    gap = round_half_away(F.col(actual) - F.col(target))
    cols = {"gap_meta_ano": gap, "atingiu_meta_ano": gap >= 0,
            "gap_meta_2030": round_half_away(F.col(final) - F.col(actual))}
    cols.update({out: round_half_away(F.col(actual) - F.col(p)) for out, p in parents.items()})
    return df.withColumns(cols)
