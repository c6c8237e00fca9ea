"""Analytics, models and run monitoring on the driver tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from brisalake.functions import round_half_away
from brisalake.operators import analytics as an
from brisalake.operators import models as md
from brisalake.operators.aggregates import rounded
from brisalake.operators.multistart import kmeans_select
from brisalake.plans import marts as mt
from brisalake.plans import monitoring as mon
from brisalake.plans.lake import Lake
from brisalake.plans.oracle import r, xavg
from brisalake.plans.registry import query

LIMIT = 7.0  # state changes on these tables stay within about ten points
NUMERIC = ["taxa_ciclo_anterior", "media_ciclo_anterior", "participacao_ciclo_anterior", "taxa_uf_ciclo_anterior",
           "meta_taxa_ano", "meta_taxa_2030"]
CLUSTER = ["taxa_alfabetizacao", "media_portugues", "gap_meta_2030", "percentual_participacao", "dif_vs_uf",
           "variacao_pp_ajustada"]
TARGET = "alvo_taxa_alfabetizacao"


def evolution(k: Lake):
    return k.stored("evolution", lambda: mt.mart_evolution(k.integrated))


def breaks(evo):
    return an.series_break(evo, "sigla_uf", "variacao_pp", LIMIT)


def focus(k: Lake):
    """Newest cycle of the network in focus, with the change of each unit."""
    evo = evolution(k).filter("rede = 3")
    adjusted = an.adjusted_change(evo, breaks(evo)).select(
        "id_municipio", "variacao_pp", "variacao_pp_ajustada", "alerta_serie_historica")
    base = k.integrated.filter("ano = 2001 AND rede = 3")
    return k.stored("focus", lambda: base.join(adjusted, "id_municipio", "left").withColumn(
        "alerta_serie_historica", F.coalesce("alerta_serie_historica", F.lit(False))))


def clustered(k: Lake):
    """Imputed base of the clusters and of the priority index."""
    return an.impute_median(focus(k), CLUSTER)


def priority(k: Lake):
    return an.priority_index(k.stored("clustered", lambda: clustered(k)))


# DuckDB text for the same frames.
EVO3 = "SELECT * FROM evo WHERE rede = 3 AND variacao_pp IS NOT NULL"
BREAKS = f"""SELECT sigla_uf, COUNT(*) AS municipios, {xavg("variacao_pp")} AS m, median(variacao_pp) AS q,
             (SELECT median(variacao_pp) FROM evo3) AS nat FROM evo3 GROUP BY 1"""
_mid = lambda c: f"coalesce({c}, (SELECT median({c}) FROM base)) AS {c}"
_pr = lambda expr: (f"100.0 * (rank() OVER (ORDER BY {expr} NULLS LAST) + (COUNT(*) OVER (PARTITION BY {expr}) - 1) / 2.0)"
                    f" / COUNT({expr}) OVER ()")
BASE_CTE = f"""WITH evo3 AS ({EVO3}), brk AS ({BREAKS}),
    adj AS (SELECT e.*, coalesce(abs(b.m - b.nat) > 7, false) AS alerta,
      CASE WHEN abs(b.m - b.nat) > 7 THEN (SELECT median(variacao_pp) FROM evo3) ELSE variacao_pp END AS ajustada
      FROM (SELECT * FROM evo WHERE rede = 3) e LEFT JOIN brk b ON b.sigla_uf = e.sigla_uf),
    base AS (SELECT i.*, variacao_pp, ajustada AS variacao_pp_ajustada, coalesce(alerta, false) AS alerta_serie_historica
      FROM integ i LEFT JOIN adj ON adj.id_municipio = i.id_municipio WHERE i.ano = 2001 AND i.rede = 3),
    filled AS (SELECT * REPLACE ({', '.join(_mid(c) for c in CLUSTER)}) FROM base)"""
PRIORITY_CTE = f"""{BASE_CTE}, pri0 AS (SELECT *, {r("0.5 * " + _pr("gap_meta_2030") + " + 0.3 * " + _pr("-variacao_pp_ajustada") + " + 0.2 * " + _pr("-dif_vs_uf"), 1)}
      AS indice_prioridade FROM filled),
    prio AS (SELECT *, CASE WHEN indice_prioridade <= 50 THEN 'Monitoramento' WHEN indice_prioridade <= 70 THEN 'Média'
      WHEN indice_prioridade <= 85 THEN 'Alta' ELSE 'Crítica' END AS faixa_prioridade FROM pri0)"""


@query("inequality_profile", f"""SELECT nome_regiao, COUNT(DISTINCT id_municipio) AS municipios,
       {r(xavg("taxa_alfabetizacao"))} AS taxa_media, {r("stddev_samp(taxa_alfabetizacao)")} AS desvio,
       {r("100.0 * COUNT(*) FILTER (risco_alfabetizacao = 'Critico') / COUNT(*)")} AS pct_criticos,
       {r(xavg("gap_meta_2030"))} AS gap_medio_2030, {r("median(taxa_alfabetizacao)")} AS taxa_mediana
       FROM indicator GROUP BY 1""")
def _(k: Lake):
    return an.inequality_profile(mt.risk_columns(k.integrated), "nome_regiao", "taxa_alfabetizacao", "gap_meta_2030")


@query("on_pace_projection", f"""SELECT COUNT(*) AS unidades, COUNT(anos_estimados_para_meta) AS com_projecao,
       COUNT(*) FILTER (anos_estimados_para_meta <= 6) AS chegam,
       COUNT(anos_estimados_para_meta) - COUNT(*) FILTER (anos_estimados_para_meta <= 6) AS nao_chegam,
       COUNT(*) - COUNT(anos_estimados_para_meta) AS sem_rota,
       {r("100.0 * (COUNT(*) - COUNT(*) FILTER (anos_estimados_para_meta <= 6)) / COUNT(*)", 1)} AS pct_fora
       FROM evo WHERE variacao_pp IS NOT NULL""")
def _(k: Lake):
    return an.on_pace_projection(evolution(k), 6)


@query("trend_counts", "SELECT tendencia, COUNT(*) AS unidades FROM evo GROUP BY 1")
def _(k: Lake):
    return an.trend_counts(evolution(k))


@query("target_share_panel", """SELECT ano, rede, sigla_uf, pct_municipios_na_meta,
       CASE WHEN pct_municipios_na_meta IS NULL THEN 'sem meta' ELSE 'com meta' END AS grupo FROM panel""")
def _(k: Lake):
    having, without = an.target_share_panel(mt.mart_target_vs_actual(k.integrated))
    cols = ["ano", "rede", "sigla_uf", "pct_municipios_na_meta"]
    return having.select(*cols, F.lit("com meta").alias("grupo")).unionByName(
        without.select(*cols, F.lit("sem meta").alias("grupo")))


@query("series_break", f"""WITH evo3 AS ({EVO3}), brk AS ({BREAKS}) SELECT sigla_uf, municipios, {r("m")} AS variacao_media,
       {r("q")} AS variacao_mediana, {r("nat")} AS variacao_nacional, {r("m - nat")} AS desvio_vs_nacional,
       abs(m - nat) > 7 AS quebra FROM brk""")
def _(k: Lake):
    return breaks(evolution(k).filter("rede = 3"))


@query("series_break_evidence", f"""{BASE_CTE} SELECT alerta AS alerta_serie_historica, COUNT(*) AS unidades,
       COUNT(*) FILTER (taxa_inicial = 100) AS exatas, {r("100.0 * COUNT(*) FILTER (taxa_inicial = 100) / COUNT(*)", 1)} AS pct
       FROM adj GROUP BY 1""")
def _(k: Lake):
    evo = evolution(k).filter("rede = 3")
    return an.series_break_evidence(evo, breaks(evo), 100.0)


@query("adjusted_change", f"""{BASE_CTE} SELECT id_municipio, variacao_pp, {r("ajustada", 4)} AS variacao_pp_ajustada,
       alerta AS alerta_serie_historica FROM adj""")
def _(k: Lake):
    evo = evolution(k).filter("rede = 3")
    out = an.adjusted_change(evo, breaks(evo)).select(
        "id_municipio", "variacao_pp", "variacao_pp_ajustada", "alerta_serie_historica")
    return rounded(out, ["variacao_pp_ajustada"], 4)


def prepared(k: Lake):
    regions = sorted(r.r_name for r in k.table("region").select("r_name").collect())  # the dimension's rows name the columns
    features = k.stored("features", lambda: mt.mart_features(k.integrated, k.micro_plan).select("id_municipio", "nome_regiao", *NUMERIC, TARGET))
    data = an.feature_prep(features, NUMERIC, "nome_regiao", TARGET, regions)
    names = {f"regiao_{x}": f"regiao_{x.replace(' ', '_')}" for x in regions}
    return data.withColumnsRenamed(names), NUMERIC + list(names.values())


_fsql = """SELECT a.id_municipio, a.nome_regiao, p.taxa_alfabetizacao AS taxa_ciclo_anterior,
    p.media_portugues AS media_ciclo_anterior, p.percentual_participacao AS participacao_ciclo_anterior,
    p.taxa_uf AS taxa_uf_ciclo_anterior, a.meta_taxa_ano, a.meta_taxa_2030, a.taxa_alfabetizacao AS alvo_taxa_alfabetizacao
    FROM (SELECT * FROM integ WHERE ano = 2001 AND rede = 3) a
    JOIN (SELECT * FROM integ WHERE ano = 2000 AND rede = 3) p ON p.id_municipio = a.id_municipio
    WHERE p.taxa_alfabetizacao IS NOT NULL AND a.taxa_alfabetizacao IS NOT NULL"""


@query("feature_prep", f"""WITH b AS ({_fsql}) SELECT id_municipio, nome_regiao,
       {', '.join(r(f"coalesce({c}, (SELECT median({c}) FROM b))", 4) + f" AS {c}" for c in NUMERIC)},
       {', '.join(f"CASE WHEN nome_regiao = '{g}' THEN 1.0 ELSE 0.0 END AS regiao_{g.replace(' ', '_')}" for g in
                  ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"))}, alvo_taxa_alfabetizacao FROM b""")
def _(k: Lake):
    data, _ = prepared(k)
    return rounded(data, NUMERIC, 4)


def split(k: Lake):
    data, names = prepared(k)
    base = k.stored("model_base", lambda: data)
    train, test = an.stratified_split(base, "nome_regiao", "id_municipio")
    return k.stored("train", lambda: train), k.stored("test", lambda: test), names


@query("stratified_split", """WITH s AS (SELECT nome_regiao, COUNT(*) AS n, CAST(floor(COUNT(*) * 0.8 + 0.5) AS BIGINT) AS t FROM factu GROUP BY 1)
       SELECT nome_regiao, t AS n, 'treino' AS parte FROM s WHERE t > 0 UNION ALL SELECT nome_regiao, n - t, 'teste' FROM s WHERE n > t""")
def _(k: Lake):
    train, test = an.stratified_split(k.fact_units, "nome_regiao", "id_municipio")
    n = F.count(F.lit(1)).alias("n")
    return train.groupBy("nome_regiao").agg(n).withColumn("parte", F.lit("treino")).unionByName(
        test.groupBy("nome_regiao").agg(n).withColumn("parte", F.lit("teste")))


@query("persistence_baseline", f"""SELECT id_municipio, taxa_ciclo_anterior, alvo_taxa_alfabetizacao,
       taxa_ciclo_anterior AS prediction FROM ({_fsql})""")
def _(k: Lake):
    return an.persistence_baseline(prepared(k)[0], "taxa_ciclo_anterior").select(
        "id_municipio", "taxa_ciclo_anterior", TARGET, "prediction")


_e = lambda p: f"alvo_taxa_alfabetizacao - {p}"
_metrics = lambda i, name, p: f"""SELECT {i} AS ordem, '{name}' AS modelo, {xavg(f"abs({_e(p)})", 8)} AS a,
    {xavg(f"({_e(p)}) * ({_e(p)})", 8)} AS s, {xavg("(alvo_taxa_alfabetizacao - c) * (alvo_taxa_alfabetizacao - c)", 8)} AS v FROM b2"""


@query("regression_metrics", f"""WITH b AS ({_fsql}), b2 AS (SELECT b.*, (SELECT {xavg("alvo_taxa_alfabetizacao")} FROM b) AS c FROM b),
       m AS ({_metrics(0, "Baseline", "taxa_ciclo_anterior")} UNION ALL {_metrics(1, "Estado", "taxa_uf_ciclo_anterior")})
       SELECT ordem, modelo, {r("a")} AS MAE_pp, {r("sqrt(s)")} AS RMSE_pp, {r("1 - s / v", 3)} AS R2,
       {r("100.0 * ((SELECT a FROM m WHERE ordem = 0) - a) / (SELECT a FROM m WHERE ordem = 0)", 1)} AS ganho_pct,
       a = (SELECT min(a) FROM m) AS melhor FROM m""")
def _(k: Lake):
    return an.regression_metrics(prepared(k)[0], TARGET, {"Baseline": "taxa_ciclo_anterior", "Estado": "taxa_uf_ciclo_anterior"})


@query("ridge_model")
def _(k: Lake):
    train, test, names = split(k)
    model = md.ridge_model(train, names, TARGET)
    scored = md.predict(model, test, names, "ridge")
    return an.regression_metrics(scored, TARGET, {"Baseline": "taxa_ciclo_anterior", "Ridge": "ridge"})


@query("forest_model")
def _(k: Lake):
    train, test, names = split(k)
    model = md.forest_model(train, names, TARGET)
    scored = md.predict(model, test, names, "forest")
    return an.regression_metrics(scored, TARGET, {"Baseline": "taxa_ciclo_anterior", "Random Forest": "forest"})


@query("model_quality", f"""WITH b AS ({_fsql}), s AS (SELECT nome_regiao, COUNT(*) AS n, CAST(floor(COUNT(*) * 0.8 + 0.5) AS BIGINT) AS t FROM b GROUP BY 1)
       SELECT modelo, SUM(t)::BIGINT AS treino, SUM(n - t)::BIGINT AS teste, true AS repete, true AS previsoes_finitas
       FROM s, (VALUES ('Ridge'), ('Random Forest')) m(modelo) GROUP BY 1""")
def _(k: Lake):
    """Sizes of the parts, and whether training again gives the same finite predictions."""
    train, test, names = split(k)
    rows, n = [], F.count(F.lit(1))
    for name, fit in (("Ridge", md.ridge_model), ("Random Forest", md.forest_model)):
        once, again = (md.predict(fit(train, names, TARGET), test, names, f"p{i}").select("id_municipio", f"p{i}") for i in range(2))
        close = F.abs(F.col("p0") - F.col("p1")) <= 1e-6 * (1 + F.abs("p0"))
        rows.append(once.join(again, "id_municipio").agg(
            F.lit(name).alias("modelo"), n.alias("teste"), F.every(close).alias("repete"),
            F.every(~F.isnan("p0") & (F.abs("p0") < 1e6)).alias("previsoes_finitas")).withColumn("treino", train.agg(n).scalar()))
    return rows[0].unionByName(rows[1])


@query("feature_importance")
def _(k: Lake):
    train, _, names = split(k)
    return md.feature_importance(md.ridge_model(train, names, TARGET), names, k.spark)


@query("importance_checks", f"""SELECT COUNT(*) AS treino, CAST(1 AS DOUBLE) AS soma, true AS nao_negativas FROM ({_fsql}) b""")
def _(k: Lake):
    """Importances of the forest over all features add up to one."""
    rows, names = prepared(k)
    found = md.feature_importance(md.forest_model(rows, names, TARGET, trees=20, depth=6), names, k.spark, len(names))
    return found.agg(round_half_away(F.sum("importance"), 6).alias("soma"), F.every(F.col("importance") >= 0).alias("nao_negativas")) \
        .withColumn("treino", rows.agg(F.count(F.lit(1))).scalar())


@query("residual_mean", f"""SELECT COUNT(*) AS n, CAST(0 AS DOUBLE) AS media FROM ({_fsql}) b""")
def _(k: Lake):
    """On the rows it was fitted on, a linear model with intercept has residuals of mean zero; every row is in a bin."""
    rows, names = prepared(k)
    scored = md.predict(md.ridge_model(rows, names, TARGET), rows, names, "ridge")
    bins = an.residual_stats(scored, TARGET, "ridge")
    return bins.agg(F.sum("n").alias("n"), F.abs(round_half_away(F.max("media"), 2)).alias("media"))


@query("residual_stats")
def _(k: Lake):
    train, test, names = split(k)
    scored = md.predict(md.ridge_model(train, names, TARGET), test, names, "ridge")
    return an.residual_stats(scored, TARGET, "ridge")


@query("impute_median", f"""{BASE_CTE} SELECT id_municipio, {', '.join(r(c, 4) + f" AS {c}" for c in CLUSTER)} FROM filled""")
def _(k: Lake):
    return rounded(clustered(k).select("id_municipio", *CLUSTER), CLUSTER, 4)


@query("standardise", f"""SELECT ano, id_municipio, {r(f"(taxa_alfabetizacao - (SELECT {xavg('taxa_alfabetizacao')} FROM fact)) / (SELECT stddev_pop(taxa_alfabetizacao) FROM fact)", 6)} AS taxa_alfabetizacao,
       {r(f"(media_portugues - (SELECT {xavg('media_portugues')} FROM fact)) / (SELECT stddev_pop(media_portugues) FROM fact)", 6)} AS media_portugues FROM fact""")
def _(k: Lake):
    cols = ["taxa_alfabetizacao", "media_portugues"]
    return rounded(an.standardise(k.fact.select("ano", "id_municipio", *cols), cols), cols, 6)


def kmeans(k: Lake):
    """Model, scores and clustered rows.

    The standardised rows are written once: every iteration reads them.
    """
    base = k.stored("clustered", lambda: clustered(k))
    scaled = k.stored("standardised", lambda: an.standardise(base.select("id_municipio", *CLUSTER), CLUSTER))
    return *kmeans_select(scaled, CLUSTER), base, scaled


@query("kmeans_select")
def _(k: Lake):
    return kmeans(k)[1]


@query("cluster_profile")
def _(k: Lake):
    return profile(k)


def profile(k: Lake):
    model, _, base, scaled = kmeans(k)
    groups = model.transform(scaled).select("id_municipio", "cluster")
    return an.cluster_profile(base.join(groups, "id_municipio"), "cluster", CLUSTER, "taxa_alfabetizacao")


@query("cluster_profile_totals", f"""{BASE_CTE} SELECT COUNT(*) AS municipios, {r(xavg("taxa_alfabetizacao"), 1)} AS taxa,
       true AS nomes_distintos, true AS em_ordem FROM filled""")
def _(k: Lake):
    """The profiles' sizes and means put together are those of all units; names are distinct, by rising rate."""
    weighted = F.sum(F.col("taxa_alfabetizacao") * F.col("municipios")) / F.sum("municipios")
    rates = F.transform(F.array_sort(F.collect_list(F.struct(F.col("taxa_alfabetizacao").alias("t"), "perfil"))), lambda x: x["perfil"])
    known = F.array(*map(F.lit, an.PROFILE_LABELS))
    return profile(k).agg(F.sum("municipios").alias("municipios"), round_half_away(weighted, 1).alias("taxa"),
                          (F.count_distinct("perfil") == F.count(F.lit(1))).alias("nomes_distintos"),
                          (rates == F.slice(known, 1, F.size(rates))).alias("em_ordem"))


@query("kmeans_checks", f"""{BASE_CTE} SELECT k, COUNT(*) AS pontos, true AS inercia_desce, true AS abaixo_do_k_anterior
       FROM filled, range(2, 7) t(k) GROUP BY k""")
def _(k: Lake):
    """Every row is in a cluster for each k; inertia never rises within a run nor from one k to the next."""
    _, scores, _, scaled = kmeans(k)
    order = Window.orderBy("k")  # five rows
    falls = F.coalesce(F.col("inercia") < F.lag("inercia").over(order), F.lit(True))
    complete = scaled.filter(F.size(F.filter(F.array(*CLUSTER), lambda x: x.isNull())) == 0).agg(F.count(F.lit(1))).scalar()
    return scores.select(F.col("k").cast("bigint").alias("k"), complete.alias("pontos"), "inercia_desce", falls.alias("abaixo_do_k_anterior"))


@query("priority_index", f"""{PRIORITY_CTE} SELECT id_municipio, indice_prioridade, faixa_prioridade FROM prio""")
def _(k: Lake):
    return priority(k).select("id_municipio", "indice_prioridade", "faixa_prioridade")


@query("priority_bands", f"""{PRIORITY_CTE} SELECT faixa_prioridade, COUNT(*) AS municipios,
       {r(xavg("taxa_alfabetizacao"))} AS taxa_media, {r(xavg("gap_meta_2030"))} AS gap_medio_2030,
       {r(xavg("variacao_pp_ajustada"))} AS variacao_media FROM prio GROUP BY 1""")
def _(k: Lake):
    return an.priority_bands(priority(k))


@query("priority_concentration", f"""{PRIORITY_CTE} SELECT sigla_uf, COUNT(*) AS municipios_prioridade_critica FROM prio
       WHERE faixa_prioridade = 'Alta' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def _(k: Lake):
    return an.priority_concentration(priority(k), "Alta")


# --- monitoring -------------------------------------------------------------------------
def measured(k: Lake):
    with mon.stage_metrics("orders", "bronze", sla_s=3600, max_reject_pct=1.0) as stage:
        orders = stage.count(k.table("orders"), "entrada")
        good = stage.count(orders.filter("o_totalprice > 2000"), "saida")
        good.write.parquet(f"{k.work}/stage_good")
        stage.count(k.table("orders").filter("o_totalprice <= 2000"), "rejeitadas").write.parquet(f"{k.work}/stage_bad")
    return mon.stages_frame(k.spark, stage)


@query("stage_metrics", f"""SELECT 'orders' AS etapa, 'bronze' AS camada, 'OK' AS status, COUNT(*) AS linhas_entrada,
       COUNT(*) FILTER (o_totalprice > 2000) AS linhas_saida, COUNT(*) FILTER (o_totalprice <= 2000) AS linhas_rejeitadas,
       {r("100.0 * COUNT(*) FILTER (o_totalprice <= 2000) / COUNT(*)")} AS taxa_rejeicao_pct FROM orders""")
def _(k: Lake):
    return measured(k)[0].drop("duracao_segundos", "throughput_linhas_s", "erro")


@query("run_summary", """SELECT CAST(1 AS BIGINT) AS etapas_executadas, CAST(0 AS BIGINT) AS etapas_com_falha,
       COUNT(*) FILTER (o_totalprice > 2000) AS linhas_processadas,
       COUNT(*) FILTER (o_totalprice <= 2000) AS linhas_rejeitadas,
       CAST(CASE WHEN 100.0 * COUNT(*) FILTER (o_totalprice <= 2000) / COUNT(*) > 1 THEN 1 ELSE 0 END AS BIGINT) AS alertas,
       CAST(0 AS BIGINT) AS alertas_criticos FROM orders""")
def _(k: Lake):
    return mon.run_summary(*measured(k))


@query("run_history", """SELECT 'orders' AS tabela, 'WRITE' AS operacao, COUNT(*) AS linhas FROM orders
       UNION ALL SELECT 'customer', 'WRITE', COUNT(*) FROM customer""")
def _(k: Lake):
    path = f"{k.work}/history"
    for table in ("orders", "customer", "orders"):
        n = k.table(table).count()
        out = mon.run_history(k.spark, path, {"tabela": table, "operacao": "WRITE", "linhas": n, "run_id": f"r-{table}"})
    return out.select("tabela", "operacao", "linhas")


@query("cache_reuse", f"""SELECT ano, COUNT(*) AS n, {r(xavg("taxa_alfabetizacao"))} AS media FROM fact GROUP BY 1""")
def _(k: Lake):
    from brisalake.functions import exact_avg, round_half_away

    path = f"{k.work}/by_year"
    with mon.cache_reuse(k.fact) as fact:
        fact.groupBy("ano").agg(F.count(F.lit(1)).alias("n"), round_half_away(exact_avg("taxa_alfabetizacao")).alias("media")) \
            .write.parquet(path)
    return k.spark.read.parquet(path)
