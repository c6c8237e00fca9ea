"""Joins between facts and dimensions, and checks of what they filled."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisalake.functions import as_col, exact_sum, round_half_away
from brisalake.operators.conform import derived_gaps

BROADCAST_LIMIT = 16 * 1024 * 1024  # planned bytes; rows in memory are a few times larger


def planned_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan; None when the session cannot tell."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except (AttributeError, TypeError):
        return None


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Hint a broadcast only for a side whose planned size is under the limit.

    Above it there is no hint: the join shuffles, and adaptive execution may
    still switch once the true size is known, or split a skewed key.
    """
    size = planned_bytes(df)
    return F.broadcast(df) if size is not None and size <= limit else df


def dim_join_broadcast(fact: DataFrame, dim: DataFrame, on: Sequence[str],
                       columns: Sequence[str], limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Left join to a dimension, broadcast while the dimension is provably small."""
    on = list(on)
    return fact.join(broadcast_if_small(dim.select(*on, *columns), limit), on, "left")


def dim_parent_resolve(df: DataFrame, parent: DataFrame, on: Sequence[str],
                       required: str) -> tuple[DataFrame, DataFrame]:
    """(resolved, rejected): rows whose parent was or was not found."""
    joined = df.join(broadcast_if_small(parent), list(on), "left")
    found = F.col(required).isNotNull()
    return joined.filter(found), joined.filter(~found)


def fact_join_multikey(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right, list(on), "left")


def join_renamed_keys(left: DataFrame, right: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Left join where the key names differ; the right key columns are dropped."""
    right = right.withColumnsRenamed({r: f"_rk_{r}" for r in keys.values()})
    cond = [F.col(l) == F.col(f"_rk_{r}") for l, r in keys.items()]
    return left.join(right, cond, "left").drop(*[f"_rk_{r}" for r in keys.values()])


def inner_join_agg(left: DataFrame, right: DataFrame, on: Mapping[str, str],
                   by: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    cond = [left[l] == right[r] for l, r in on.items()]
    return left.join(right, cond).groupBy(*by).agg(*aggs)


def self_join_bounds(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Fact with ``first_<col>`` and ``last_<col>`` of its key.

    An aggregate and a join, not a window: the aggregate combines before the
    shuffle, so a hot key does not land in one sort.
    """
    bounds = df.groupBy(*keys).agg(F.min(order_col).alias(f"first_{order_col}"),
                                   F.max(order_col).alias(f"last_{order_col}"))
    return df.join(bounds, list(keys))


def prior_cycle_join(df: DataFrame, unit: Sequence[str], year: str, columns: Sequence[str],
                     suffix: str = "_prior") -> DataFrame:
    """Each row with the row of exactly the year before, null if that year is absent."""
    prior = df.select(*unit, (F.col(year) + 1).alias(year),
                      *[F.col(c).alias(f"{c}{suffix}") for c in columns])
    return df.join(prior, [*unit, year], "left")


def scalar_subquery_filter(df: DataFrame, col: str, agg: str = "max", offset: int = 0) -> DataFrame:
    """Rows whose ``col`` equals an aggregate of the whole table, shifted by ``offset``."""
    whole = df.agg(getattr(F, agg)(col).alias("v")).scalar()
    return df.filter(F.col(col) == whole + F.lit(offset))


def multi_left_assembly(base: DataFrame, parts: Sequence[DataFrame], on: Sequence[str]) -> DataFrame:
    """Base rows with every part attached; each part has one row per key."""
    for part in parts:
        base = base.join(part, list(on), "left")
    return base


def one_per_key(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """One row per key; rows of one key that differ are an error, never a silent choice."""
    n = F.count(F.lit(1))

    def agreed(c: str) -> Column:
        same = F.min(c).eqNullSafe(F.max(c)) & ((F.count(c) == 0) | (F.count(c) == n))
        where = F.concat_ws(", ", *[F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("null"))) for k in keys])
        return F.when(same, F.min(c)).otherwise(F.raise_error(F.concat(F.lit(f"{what}: {c} differs at "), where))).alias(c)

    return df.groupBy(*keys).agg(*[agreed(c) for c in df.columns if c not in keys])


def integrated_fact(fact: DataFrame, dims: DataFrame, targets: DataFrame, participation: DataFrame,
                    parent: DataFrame, country: DataFrame, final_year: int = 2030,
                    final_default: float = 80.0) -> DataFrame:
    """The wide fact: territory, targets, participation, state and country context, gaps.

    fact            ano, id_municipio, serie, rede, taxa_alfabetizacao, …
    dims            id_municipio, nome_municipio, sigla_uf, nome_uf, nome_regiao, nome_mesorregiao
    targets         id_municipio, rede, ano_meta, meta_taxa
    participation   ano, id_municipio, rede, percentual_participacao, nivel_alfabetizacao
    parent          ano, sigla_uf, rede, taxa_uf          country   ano, taxa_brasil_publica

    Targets, parent, country and participation are reduced to one row per join key
    first, so no join can multiply the fact; rows that contradict one another stop
    the job with the key. A unit's targets and participations travel as short lists,
    so that they and the territory join on the unit alone: the fact is shuffled once.
    """
    unit = ["id_municipio", "rede"]
    by_unit = lambda df, out: df.groupBy("id_municipio").agg(F.collect_list(
        F.struct(*[c for c in df.columns if c != "id_municipio"])).alias(out))
    pick = lambda rows, same: F.get(F.filter(rows, same), F.lit(0))
    goals = by_unit(one_per_key(targets.select(*unit, "ano_meta", "meta_taxa"), [*unit, "ano_meta"], "targets"), "_goals")
    shares = by_unit(one_per_key(participation, ["ano", *unit], "participation"), "_shares")
    goal = lambda year: pick("_goals", lambda g: (g.rede == F.col("rede")) & (g.ano_meta == year)).getField("meta_taxa")
    share = pick("_shares", lambda p: (p.ano == F.col("ano")) & (p.rede == F.col("rede")))
    wide = (fact.join(goals, ["id_municipio"], "left").join(shares, ["id_municipio"], "left")
            .withColumns({"meta_taxa_ano": goal(F.col("ano")), "meta_taxa_2030": goal(F.lit(final_year)),
                          **{c: share.getField(c) for c in participation.columns if c not in ("ano", *unit)}})
            .drop("_goals", "_shares"))
    wide = dim_join_broadcast(wide, dims, ["id_municipio"],
                              ["nome_municipio", "sigla_uf", "nome_uf", "nome_regiao", "nome_mesorregiao"])
    state = one_per_key(parent, ["ano", "sigla_uf", "rede"], "parent")
    nation = one_per_key(country, ["ano"], "country")
    wide = (wide.join(state, ["ano", "sigla_uf", "rede"], "left").join(nation, ["ano"], "left")
            .withColumn("meta_taxa_2030", F.coalesce("meta_taxa_2030", F.lit(float(final_default)))))
    return derived_gaps(wide, "taxa_alfabetizacao", "meta_taxa_ano", "meta_taxa_2030",
                        {"dif_vs_uf": "taxa_uf", "dif_vs_brasil": "taxa_brasil_publica"})


def orphan_rows(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """One row: ``orphans`` and up to five smallest ``examples``; null keys do not count."""
    lost = (child.filter(F.col(child_key).isNotNull()).select(F.col(child_key).alias("_k"))
            .join(parent.select(F.col(parent_key).alias("_k")), "_k", "left_anti")
            .groupBy("_k").agg(F.count(F.lit(1)).alias("n")))
    examples = (lost.orderBy("_k").limit(5)
                .agg(F.array_join(F.array_sort(F.collect_list(F.col("_k").cast("string"))), ", ").alias("e")))
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("orphans")).withColumn(
        "examples", examples.scalar())


def stream_static_join(events: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Events, streaming or not, left joined to a static dimension."""
    return events.join(broadcast_if_small(dim), list(on), "left")


def reconcile_join(a: DataFrame, b: DataFrame, on: Sequence[str], a_col: str, b_col: str,
                   tol: float) -> DataFrame:
    """Keys present in both sources with both measures, their difference and a flag."""
    both = (a.select(*on, a_col).join(b.select(*on, b_col), list(on))
            .dropna(subset=[a_col, b_col]))
    return (both.withColumn("difference", F.abs(F.col(a_col) - F.col(b_col)))
            .withColumn("divergent", F.col("difference") > tol))


def join_key_harmonise(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop null keys and give every key the same type."""
    return df.dropna(subset=list(keys)).withColumns({k: F.col(k).cast("bigint") for k in keys})


def join_coverage(df: DataFrame, joins: Mapping[str, str]) -> DataFrame:
    """One row per join: rows filled and percent of all rows."""
    filled = df.agg(F.count(F.lit(1)).alias("_all"),
                    *[F.count(F.col(c)).alias(f"j{i}") for i, c in enumerate(joins.values())])
    pairs = F.explode(F.array(*[
        F.struct(F.lit(name).alias("join"), F.col(f"j{i}").alias("filled"))
        for i, name in enumerate(joins)])).alias("p")
    pct = round_half_away(F.try_divide(100.0 * F.col("p.filled"), F.col("_all")))
    return filled.select("_all", pairs).select("p.join", "p.filled", pct.alias("pct"))


def join_strategy_compare(left: DataFrame, right: DataFrame, on: Sequence[str]) -> dict[str, DataFrame]:
    """The same left join by sort-merge and by (size-checked) broadcast."""
    on = list(on)
    return {"merge": left.join(right.hint("merge"), on, "left"),
            "broadcast": left.join(broadcast_if_small(right), on, "left")}


