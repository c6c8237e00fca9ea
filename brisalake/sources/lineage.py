"""Lineage columns and change detection between loads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisalake.functions import record_hash


def lineage_columns(df: DataFrame, entity: str, source: str, fmt: str, run_ts: datetime,
                    run_id: str | None = None) -> DataFrame:
    """Where, when and in which run a row was loaded, with its record hash."""
    run_id = run_id or run_ts.strftime("%Y%m%d_%H%M%S")
    return df.withColumns({
        "_ingestion_timestamp": F.lit(run_ts.isoformat(timespec="seconds")),
        "_ingestion_date": F.lit(run_ts.strftime("%Y-%m-%d")),
        "_source": F.lit(source), "_source_format": F.lit(fmt), "_entity": F.lit(entity),
        "_pipeline_run_id": F.lit(run_id), "_record_hash": record_hash(df.columns),
        "ano_ingestao": F.lit(run_ts.strftime("%Y")), "mes_ingestao": F.lit(run_ts.strftime("%m")),
        "dia_ingestao": F.lit(run_ts.strftime("%d"))})


def changed_records(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key and ``change``: new, changed, same or gone. Only keys and hashes are shuffled.

    A column that one side lacks counts as null there. Zero equals negative zero, though their texts differ.
    """
    columns = [*old.columns, *[c for c in new.columns if c not in old.columns]]

    def side(df: DataFrame, name: str) -> DataFrame:
        kinds = dict(df.dtypes)
        same = {c: F.when(F.col(c) == 0, F.lit(0).cast(kinds[c])).otherwise(F.col(c)) for c in columns if kinds.get(c) in ("double", "float")}
        lacking = {c: F.lit(None).cast("string") for c in columns if c not in kinds}
        return df.withColumns({**same, **lacking}).select(*keys, record_hash(columns).alias(name))

    both = side(old, "_old").join(side(new, "_new"), list(keys), "full")
    change = (F.when(F.col("_old").isNull(), "new").when(F.col("_new").isNull(), "gone")
              .when(F.col("_old") == F.col("_new"), "same").otherwise("changed"))
    return both.select(*keys, change.alias("change"))
