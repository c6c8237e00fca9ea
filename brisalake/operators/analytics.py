"""Inequality, series breaks, feature preparation and the priority index.

Several functions read their input more than once (a statistic of the whole
table, then the rows). Give them a stored table, not a long plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brisalake.functions import band_right_closed, exact_avg, round_half_away, safe_ratio
from brisalake.operators.aggregates import histogram, medians
from brisalake.operators.ladder import join_same, quantiles, with_hash_order
from brisalake.operators.windows import percentile_rank_avg

# Fixed values.
PRIORITY_WEIGHTS = {"gap_meta_2030": 0.5, "variacao_pp_ajustada": 0.3, "dif_vs_uf": 0.2}
PRIORITY_EDGES = (0, 50, 70, 85, 100)
PRIORITY_LABELS = ("Monitoramento", "Média", "Alta", "Crítica")
PROFILE_LABELS = ("Vulnerabilidade crítica", "Atenção prioritária", "Em rota de melhoria",
                  "Consolidado", "Referência", "Destaque")


def inequality_profile(df: DataFrame, by: str, col: str, gap: str, unit: str = "id_municipio",
                       risk: str = "risco_alfabetizacao", critical: str = "Critico") -> DataFrame:
    """Units, mean, median, deviation, percent critical and mean gap per group."""
    sums = df.groupBy(by).agg(
        F.count_distinct(unit).alias("municipios"), round_half_away(exact_avg(col)).alias("taxa_media"),
        round_half_away(F.stddev(col)).alias("desvio"),
        safe_ratio(100.0 * F.count_if(F.col(risk) == critical), F.count(F.lit(1)), 2).alias("pct_criticos"),
        round_half_away(exact_avg(gap)).alias("gap_medio_2030"))
    mid = quantiles(df, [by], col, {"m": 0.5}).select(by, round_half_away("m").alias("taxa_mediana"))
    return join_same(sums, mid, [by]).orderBy(F.desc_nulls_last("taxa_media"), by)


def on_pace_projection(evolution: DataFrame, years_left: int) -> DataFrame:
    """Units improving, how many arrive in time, how many do not, percent left out."""
    eta, change = F.col("anos_estimados_para_meta"), F.col("variacao_pp")
    n = F.count(F.lit(1))
    return (evolution.filter(change.isNotNull())
            .agg(n.alias("unidades"), F.count(eta).alias("com_projecao"),
                 F.count_if(eta <= years_left).alias("chegam"))
            .select("unidades", "com_projecao", "chegam", (F.col("com_projecao") - F.col("chegam")).alias("nao_chegam"),
                    (F.col("unidades") - F.col("com_projecao")).alias("sem_rota"),
                    safe_ratio(100.0 * (F.col("unidades") - F.col("chegam")), F.col("unidades"), 1).alias("pct_fora")))


def trend_counts(evolution: DataFrame) -> DataFrame:
    return evolution.groupBy("tendencia").agg(F.count(F.lit(1)).alias("unidades"))


def target_share_panel(mart: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(states with a share, states without any target)."""
    share = F.col("pct_municipios_na_meta")
    return mart.filter(share.isNotNull()).orderBy(share.desc()), mart.filter(share.isNull())


def series_break(evolution: DataFrame, by: str, col: str, limit: float = 15.0) -> DataFrame:
    """Mean change per group against the median change of all units.

    The comparison is on unrounded values; ``quebra`` flags the groups that
    move too differently.
    """
    have = evolution.filter(F.col(col).isNotNull())
    national = medians(have, [col]).getField(col)
    means = have.groupBy(by).agg(F.count(F.lit(1)).alias("municipios"), exact_avg(col).alias("_m"))
    mids = quantiles(have, [by], col, {"_q": 0.5})
    diff = F.col("_m") - F.col("_n")
    return (join_same(means, mids, [by]).withColumn("_n", national)
            .select(by, "municipios", round_half_away("_m").alias("variacao_media"),
                    round_half_away("_q").alias("variacao_mediana"), round_half_away("_n").alias("variacao_nacional"),
                    round_half_away(diff).alias("desvio_vs_nacional"), (F.abs(diff) > limit).alias("quebra")))


def _flag(evolution: DataFrame, breaks: DataFrame, by: str) -> DataFrame:
    """Evolution rows with ``alerta_serie_historica``; the flagged groups are few."""
    flagged = breaks.filter("quebra").select(F.col(by).alias("_b"), F.lit(True).alias("_f"))
    return (evolution.join(flagged, F.col(by) == F.col("_b"), "left")
            .withColumn("alerta_serie_historica", F.coalesce("_f", F.lit(False))).drop("_b", "_f"))


def series_break_evidence(evolution: DataFrame, breaks: DataFrame, value: float = 100.0,
                          by: str = "sigla_uf", col: str = "taxa_inicial") -> DataFrame:
    """Units that start exactly at ``value``, in flagged and in other groups."""
    hit = F.count_if(F.col(col) == value)
    return _flag(evolution, breaks, by).groupBy("alerta_serie_historica").agg(
        F.count(F.lit(1)).alias("unidades"), hit.alias("exatas"),
        safe_ratio(100.0 * hit, F.count(F.lit(1)), 1).alias("pct"))


def adjusted_change(evolution: DataFrame, breaks: DataFrame, by: str = "sigla_uf",
                    col: str = "variacao_pp") -> DataFrame:
    """``variacao_pp_ajustada``: the national median where the group is flagged."""
    national = medians(evolution.filter(F.col(col).isNotNull()), [col]).getField(col)
    return _flag(evolution, breaks, by).withColumn(
        "variacao_pp_ajustada", F.when(F.col("alerta_serie_historica"), national).otherwise(F.col(col)))


def impute_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return (df.withColumn("_m", medians(df, cols))
            .withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"_m.{c}")) for c in cols}).drop("_m"))


def standardise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / population deviation; a constant column becomes 0."""
    parts = [x for c in cols for x in (exact_avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]
    stats = df.agg(F.struct(*[]) if not parts else F.struct(*parts)).scalar()
    return df.withColumn("_s", stats).withColumns({
        c: F.when(F.col(f"_s.s_{c}") == 0, F.lit(0.0)).otherwise(
            (F.col(c) - F.col(f"_s.m_{c}")) / F.col(f"_s.s_{c}")) for c in cols}).drop("_s")


def feature_prep(features: DataFrame, numeric: Sequence[str], category: str, target: str,
                 categories: Sequence[str] | None = None, prior: str = "taxa_ciclo_anterior",
                 keep: Sequence[str] = ("id_municipio",)) -> DataFrame:
    """Rows with prior and target, one-hot category, medians for missing numbers.

    A column per category: pass those of the dimension, so that a category without
    rows keeps its column. Without ``categories`` they are read from the rows.
    """
    base = features.dropna(subset=[prior, target])
    if categories is None:
        categories = sorted(r[0] for r in base.select(category).dropna().distinct().collect())  # one per column to make
    filled = impute_median(base, numeric)
    hot = [F.coalesce((F.col(category) == v).cast("double"), F.lit(0.0)).alias(f"regiao_{v}") for v in categories]
    return filled.select(*keep, category, *numeric, *hot, target)


def stratified_split(df: DataFrame, strata: str, id_col: str, frac: float = 0.8, seed: int = 42
                     ) -> tuple[DataFrame, DataFrame]:
    """(train, test) with the same share of every stratum, the same rows on every run.

    Rows are numbered by hash within the stratum, see ``with_hash_order``.
    """
    placed = with_hash_order(df, [strata], id_col, seed).withColumn(
        "_train", F.col("_rn") <= F.floor(F.col("_size") * frac + 0.5))
    drop = ["_rn", "_size", "_train"]
    return placed.filter("_train").drop(*drop), placed.filter(~F.col("_train")).drop(*drop)


def persistence_baseline(df: DataFrame, prior: str) -> DataFrame:
    """Predict the prior value."""
    return df.withColumn("prediction", F.col(prior))


def regression_metrics(df: DataFrame, actual: str, predicted: Mapping[str, str]) -> DataFrame:
    """MAE, RMSE, R², gain over the first model in percent, and the best model by MAE."""
    y = F.col(actual)
    centre = df.agg(exact_avg(actual)).scalar()
    base = df.withColumn("_c", centre)
    cells = []
    for i, col in enumerate(predicted.values()):
        e = y - F.col(col)
        cells += [exact_avg(F.abs(e), 8).alias(f"a{i}"), exact_avg(e * e, 8).alias(f"s{i}")]
    spread = exact_avg((y - F.col("_c")) * (y - F.col("_c")), 8)
    one = base.agg(*cells, spread.alias("v"))
    rows = [F.struct(F.lit(i).alias("ordem"), F.lit(name).alias("modelo"),
                     round_half_away(F.col(f"a{i}")).alias("MAE_pp"),
                     round_half_away(F.sqrt(F.col(f"s{i}"))).alias("RMSE_pp"),
                     round_half_away(1 - F.try_divide(F.col(f"s{i}"), F.col("v")), 3).alias("R2"),
                     safe_ratio(100.0 * (F.col("a0") - F.col(f"a{i}")), F.col("a0"), 1).alias("ganho_pct"),
                     (F.col(f"a{i}") == F.least(F.col("a0"), F.col("a0"), *[F.col(f"a{j}") for j in range(len(predicted))])
                      ).alias("melhor"))
            for i, name in enumerate(predicted)]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def residual_stats(df: DataFrame, actual: str, predicted: str, bins: int = 40) -> DataFrame:
    """Residuals per histogram bin, with their mean and deviation on every row."""
    res = df.select((F.col(actual) - F.col(predicted)).alias("residuo"))
    stats = res.agg(F.struct(exact_avg("residuo").alias("media"), F.stddev("residuo").alias("dp"))).scalar()
    return (histogram(res, "residuo", bins).withColumn("_s", stats)
            .select("bin", "n", round_half_away("_s.media").alias("media"), round_half_away("_s.dp").alias("dp")))


def cluster_profile(df: DataFrame, cluster: str, cols: Sequence[str], order: str,
                    labels: Sequence[str] = PROFILE_LABELS) -> DataFrame:
    """Means and size per cluster, named in order of the mean of ``order``.

    There is one row per cluster, so the ordering window is small.
    """
    means = df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("municipios"), exact_avg(order).alias("_o"),
        *[round_half_away(exact_avg(c)).alias(c) for c in cols])
    place = F.row_number().over(Window.orderBy("_o", cluster))
    return (means.withColumn("_p", place)
            .withColumn("perfil", F.coalesce(F.try_element_at(F.array(*[F.lit(x) for x in labels]), F.col("_p")),
                                             F.concat(F.lit("Perfil "), F.col("_p").cast("string"))))
            .drop("_o", "_p"))


def priority_index(df: DataFrame, weights: Mapping[str, float] = PRIORITY_WEIGHTS) -> DataFrame:
    """Weighted percentile of gap (large is urgent), change and state distance (small is urgent)."""
    gap, change, relative = weights
    out = percentile_rank_avg(df, gap, out="p_gap", source=df)
    out = percentile_rank_avg(out, change, desc=True, out="p_trajetoria", source=df)
    out = percentile_rank_avg(out, relative, desc=True, out="p_relativa", source=df)
    total = (F.col("p_gap") * weights[gap] + F.col("p_trajetoria") * weights[change]
             + F.col("p_relativa") * weights[relative])
    return out.withColumn("indice_prioridade", round_half_away(total, 1)).withColumn(
        "faixa_prioridade", band_right_closed("indice_prioridade", PRIORITY_EDGES, PRIORITY_LABELS))


def priority_bands(df: DataFrame, col: str = "indice_prioridade", edges: Sequence[float] = PRIORITY_EDGES,
                   labels: Sequence[str] = PRIORITY_LABELS) -> DataFrame:
    """Units and means per band, most urgent band first."""
    banded = df.withColumn("faixa_prioridade", band_right_closed(col, edges, labels))
    place = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("faixa_prioridade"))
    return (banded.groupBy("faixa_prioridade").agg(
        F.count("id_municipio").alias("municipios"),
        round_half_away(exact_avg("taxa_alfabetizacao")).alias("taxa_media"),
        round_half_away(exact_avg("gap_meta_2030")).alias("gap_medio_2030"),
        round_half_away(exact_avg("variacao_pp_ajustada")).alias("variacao_media"))
        .orderBy(place.desc()))


def priority_concentration(df: DataFrame, band: str = "Crítica", by: str = "sigla_uf", n: int = 10) -> DataFrame:
    return (df.filter(F.col("faixa_prioridade") == band).groupBy(by)
            .agg(F.count(F.lit(1)).alias("municipios_prioridade_critica"))
            .orderBy(F.desc("municipios_prioridade_critica"), by).limit(n))
