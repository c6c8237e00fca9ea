"""Aggregations, ranks and top-k reports on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from brisalake import functions as fx
from brisalake.operators import aggregates as ag
from brisalake.operators import ordering as od
from brisalake.operators import windows as wn
from brisalake.plans.lake import Lake
from brisalake.plans.marts import mart_target_vs_actual, risk_columns
from brisalake.plans.oracle import MEAN, RATE, r, xavg, xsum
from brisalake.plans.registry import query

def n_rows():
    return F.count(F.lit(1)).alias("n")


def seen():
    return F.col("avaliado")



# --- aggregations -----------------------------------------------------------------
@query("group_summary", f"""SELECT ano, rede, rede_nome, sigla_uf, nome_regiao, COUNT(*) AS n,
       {r(xavg("taxa_alfabetizacao"))} AS avg_taxa_alfabetizacao, {r(xavg("media_portugues"))} AS avg_media_portugues
       FROM factu GROUP BY ano, rede, rede_nome, sigla_uf, nome_regiao""")
def _(k: Lake):
    return ag.group_summary(k.fact_units, ["ano", "rede", "rede_nome", "sigla_uf", "nome_regiao"],
                            ["taxa_alfabetizacao", "media_portugues"])


@query("count_distinct", "SELECT l_returnflag, COUNT(DISTINCT l_partkey) AS distinct_l_partkey FROM lineitem GROUP BY 1")
def _(k: Lake):
    return ag.count_distinct(k.table("lineitem"), ["l_returnflag"], "l_partkey")


@query("conditional_count", "SELECT l_linestatus, COUNT(*) FILTER (l_quantity > 25) AS big FROM lineitem GROUP BY 1")
def _(k: Lake):
    return k.table("lineitem").groupBy("l_linestatus").agg(fx.conditional_count(F.col("l_quantity") > 25).alias("big"))


@query("conditional_share", f"""SELECT ano, sigla_uf, {r("100.0 * COUNT(*) FILTER (atingiu_meta_ano AND meta_taxa_ano IS NOT NULL) / NULLIF(COUNT(meta_taxa_ano), 0)")}
       AS pct FROM integ GROUP BY ALL""")
def _(k: Lake):
    share = fx.conditional_share(F.col("atingiu_meta_ano"), F.col("meta_taxa_ano").isNotNull())
    return k.integrated.groupBy("ano", "sigla_uf").agg(share.alias("pct"))


@query("conditional_max_pivot", """SELECT id_municipio, rede,
       MAX(CASE WHEN ano = 1996 THEN taxa_alfabetizacao END) AS taxa_alfabetizacao_first,
       MAX(CASE WHEN ano = 2000 THEN taxa_alfabetizacao END) AS taxa_alfabetizacao_last FROM fact GROUP BY ALL""")
def _(k: Lake):
    return ag.conditional_max_pivot(k.fact, ["id_municipio", "rede"], "ano", F.lit(1996), F.lit(2000), ["taxa_alfabetizacao"])


@query("group_bounds", """SELECT o_custkey, CAST(min(year(o_orderdate)) AS INT) AS min_ano,
       CAST(max(year(o_orderdate)) AS INT) AS max_ano FROM orders GROUP BY 1""")
def _(k: Lake):
    return ag.group_bounds(k.table("orders").select("o_custkey", F.year("o_orderdate").alias("ano")), ["o_custkey"], "ano")


@query("weighted_mean", f"SELECT ano, rede, {r(MEAN)} AS media FROM micro GROUP BY ALL")
def _(k: Lake):
    mean = fx.weighted_mean("proficiencia_portugues", "peso_aluno", seen())
    return k.micro.groupBy("ano", "rede").agg(fx.round_half_away(mean).alias("media"))


@query("weighted_rate", f"SELECT ano, id_municipio, {r(RATE)} AS taxa FROM micro GROUP BY ALL")
def _(k: Lake):
    rate = fx.weighted_rate("alfabetizado", "peso_aluno", seen())
    return k.pupils.groupBy("ano", "id_municipio").agg(fx.round_half_away(rate).alias("taxa"))


@query("conditional_stddev", f"""SELECT ano, rede, {r("stddev_samp(CASE WHEN avaliado THEN proficiencia_portugues END)")} AS desvio
       FROM micro GROUP BY ALL""")
def _(k: Lake):
    dev = fx.conditional_stddev("proficiencia_portugues", seen())
    return k.micro.groupBy("ano", "rede").agg(fx.round_half_away(dev).alias("desvio"))


@query("global_aggregate", f"""SELECT COUNT(*) AS n, {xsum("l_extendedprice")} AS total, MAX(l_quantity) AS top,
       {r(xavg("l_discount"), 4)} AS mean_discount FROM lineitem""")
def _(k: Lake):
    return ag.global_aggregate(k.table("lineitem"), [
        n_rows(), fx.exact_sum("l_extendedprice").alias("total"), F.max("l_quantity").alias("top"),
        fx.round_half_away(fx.exact_avg("l_discount"), 4).alias("mean_discount")])


# Measures of any size: no declared decimals, so the oracle adds plain doubles.
@query("sum_small_values", f"""SELECT event_type, {r("sum(value / 1e6)", 9)} AS total, {r("avg(value / 1e6)", 12)} AS mean
       FROM events GROUP BY 1""")
def _(k: Lake):
    small = F.col("value") / 1e6
    return k.table("events").groupBy("event_type").agg(fx.round_half_away(fx.exact_sum(small), 9).alias("total"),
                                                       fx.round_half_away(fx.exact_avg(small), 12).alias("mean"))


@query("sum_large_values", """SELECT event_type, sum(event_id * 1e13) AS total, max(event_id * 1e13) AS top, count(*) AS n
       FROM events GROUP BY 1""")
def _(k: Lake):
    large = F.col("event_id") * F.lit(1e13)
    return k.table("events").groupBy("event_type").agg(fx.exact_sum(large).alias("total"),
                                                       fx.round_half_away(F.max(large)).alias("top"), n_rows())


@query("sum_with_nan", f"""SELECT event_type, isnan(sum(v)) AS is_nan, count(v) AS n, {r("sum(v) FILTER (NOT isnan(v))", 4)} AS finite
       FROM (SELECT event_type, CASE WHEN event_type = 'click' AND event_id % 7 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value END AS v FROM events)
       GROUP BY 1""")
def _(k: Lake):
    v = F.when((F.col("event_type") == "click") & (F.col("event_id") % 7 == 0), F.lit(float("nan"))).otherwise(F.col("value"))
    rows = k.table("events").select("event_type", v.alias("v"))
    return rows.groupBy("event_type").agg(
        F.isnan(fx.exact_sum("v")).alias("is_nan"), F.count("v").alias("n"),
        fx.round_half_away(fx.exact_sum(F.when(~F.isnan("v"), F.col("v"))), 4).alias("finite"))


@query("percentile_exact", f"""SELECT event_type, {', '.join(
       r(f"quantile_cont(value, {p})", 4) + f" AS p{q}" for p, q in ((0.5, 50), (0.9, 90), (0.95, 95), (0.99, 99)))}
       FROM events GROUP BY 1""")
def _(k: Lake):
    out = ag.percentile_exact(k.table("events"), ["event_type"], "value", [0.5, 0.9, 0.95, 0.99])
    return ag.rounded(out, ["p50", "p90", "p95", "p99"], 4)


@query("percentile_approx")
def _(k: Lake):
    return ag.percentile_approx(k.table("events"), ["event_type"], "value", 0.5, 100)


@query("percentile_approx_error", """SELECT event_type, COUNT(value) AS n, true AS dentro FROM events GROUP BY 1""")
def _(k: Lake):
    """Whether the sketch's value lies within 1 / accuracy of the ranks around the median."""
    events = k.table("events")
    near = events.join(ag.percentile_approx(events, ["event_type"], "value", 0.5, 100), "event_type")
    n, below, upto = F.count("value"), F.count_if(F.col("value") < F.col("approx")), F.count_if(F.col("value") <= F.col("approx"))
    inside = (below <= n * 0.51 + 1) & (upto >= n * 0.49 - 1)
    return near.groupBy("event_type").agg(n.alias("n"), inside.alias("dentro"))


@query("group_median", f"""SELECT ano, rede, {r("median(taxa_alfabetizacao)", 3)} AS median_taxa_alfabetizacao
       FROM fact GROUP BY ALL""")
def _(k: Lake):
    return ag.rounded(ag.group_median(k.fact, ["ano", "rede"], "taxa_alfabetizacao"), ["median_taxa_alfabetizacao"], 3)


@query("describe_stats", f"""SELECT COUNT(l_extendedprice) AS n, {r(xavg("l_extendedprice"))} AS mean,
       {r("stddev_samp(l_extendedprice)")} AS std, MIN(l_extendedprice) AS min, MAX(l_extendedprice) AS max,
       {r("quantile_cont(l_extendedprice, 0.25)", 3)} AS q25, {r("quantile_cont(l_extendedprice, 0.5)", 3)} AS q50,
       {r("quantile_cont(l_extendedprice, 0.75)", 3)} AS q75, {r("MAX(l_extendedprice) - MIN(l_extendedprice)")} AS spread,
       {r("quantile_cont(l_extendedprice, 0.9) / quantile_cont(l_extendedprice, 0.1)", 4)} AS p90_p10 FROM lineitem""")
def _(k: Lake):
    out = ag.describe_stats(k.table("lineitem"), "l_extendedprice")
    out = ag.rounded(ag.rounded(out, ["mean", "std", "spread"]), ["q25", "q50", "q75"], 3)
    return ag.rounded(out, ["p90_p10"], 4)


@query("value_counts", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1")
def _(k: Lake):
    return ag.value_counts(k.table("events"), "event_type")


_status = ["F", "O", "P"]


@query("crosstab", "SELECT o_orderpriority, " + ", ".join(
    f"COUNT(*) FILTER (o_orderstatus = '{s}') AS \"{s}\"" for s in _status) + " FROM orders GROUP BY 1")
def _(k: Lake):
    return ag.crosstab(k.table("orders"), "o_orderpriority", "o_orderstatus", _status)


@query("crosstab_row_share", "SELECT o_orderpriority, " + ", ".join(
    r(f"100.0 * COUNT(*) FILTER (o_orderstatus = '{s}') / COUNT(*)") + f" AS \"{s}\"" for s in _status)
    + " FROM orders GROUP BY 1")
def _(k: Lake):
    return ag.crosstab_row_share(k.table("orders"), "o_orderpriority", "o_orderstatus", _status)


@query("histogram", """SELECT CAST(least(floor((value - lo) * 45 / (hi - lo)), 44) AS BIGINT) AS bin, COUNT(*) AS n
       FROM events, (SELECT min(value) AS lo, max(value) AS hi FROM events) GROUP BY 1""")
def _(k: Lake):
    return ag.histogram(k.table("events"), "value", 45)


@query("box_stats", "SELECT rede_nome, " + ", ".join(
    r(f"quantile_cont(taxa_alfabetizacao, {p})", 3) + f" AS {n}" for p, n in (
        (0, "low"), (0.25, "q25"), (0.5, "q50"), (0.75, "q75"), (1, "high"))) + " FROM fact GROUP BY 1")
def _(k: Lake):
    return ag.rounded(ag.box_stats(k.fact, "rede_nome", "taxa_alfabetizacao"), ["low", "q25", "q50", "q75", "high"], 3)


# --- ranks and versions --------------------------------------------------------------
@query("rank_within", """SELECT ano, rede, sigla_uf, id_municipio, rank() OVER (PARTITION BY ano, rede, sigla_uf
       ORDER BY taxa_alfabetizacao DESC NULLS LAST) AS posicao FROM factu""")
def _(k: Lake):
    out = wn.rank_within(k.fact_units, ["ano", "rede", "sigla_uf"], "taxa_alfabetizacao", True, "posicao")
    return out.select("ano", "rede", "sigla_uf", "id_municipio", "posicao")


@query("rank_national", """SELECT ano, rede, id_municipio, rank() OVER (PARTITION BY ano, rede
       ORDER BY taxa_alfabetizacao DESC NULLS LAST) AS posicao FROM fact""")
def _(k: Lake):
    return wn.rank_national(k.fact, ["ano", "rede"], "taxa_alfabetizacao", "posicao").select(
        "ano", "rede", "id_municipio", "posicao")


@query("quartile_ntile", """SELECT ano, rede, id_municipio, ntile(4) OVER (PARTITION BY ano, rede
       ORDER BY taxa_alfabetizacao NULLS LAST, id_municipio) AS quartil FROM fact""")
def _(k: Lake):
    return wn.quartile_ntile(k.fact, ["ano", "rede"], "taxa_alfabetizacao", 4, "id_municipio", "quartil").select(
        "ano", "rede", "id_municipio", "quartil")


# Ranks of values that lie close together, of texts, and with NaN and infinities.
_odd = "CASE event_id % 50 WHEN 0 THEN NULL WHEN 1 THEN CAST('NaN' AS DOUBLE) WHEN 2 THEN CAST('Infinity' AS DOUBLE) " \
       "WHEN 3 THEN CAST('-Infinity' AS DOUBLE) ELSE value END"


@query("rank_epoch", """SELECT event_id, rank() OVER (PARTITION BY event_type ORDER BY epoch_ms(ts) DESC NULLS LAST) AS rank,
       ntile(4) OVER (ORDER BY epoch_ms(ts) NULLS LAST, event_id) AS quartile FROM events""")
def _(k: Lake):
    rows = k.table("events").select("event_id", "event_type", F.unix_millis(F.col("ts").cast("timestamp")).alias("at"), F.lit(1).alias("every"))
    ranked = wn.rank_within(rows, ["event_type"], "at")
    return wn.quartile_ntile(ranked, ["every"], "at", 4, "event_id").select("event_id", "rank", "quartile")


@query("rank_text", """SELECT l_orderkey, l_linenumber, rank() OVER (PARTITION BY l_returnflag ORDER BY l_shipmode || l_comment_) AS rank
       FROM (SELECT *, CAST(l_partkey AS VARCHAR) AS l_comment_, l_linestatus AS l_shipmode FROM lineitem)""")
def _(k: Lake):
    text = F.concat("l_linestatus", F.col("l_partkey").cast("string"))
    rows = k.table("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", text.alias("text"))
    return wn.rank_within(rows, ["l_returnflag"], "text", False).select("l_orderkey", "l_linenumber", "rank")


@query("rank_odd_numbers", f"""SELECT event_id, rank() OVER (PARTITION BY event_type ORDER BY v DESC NULLS LAST) AS rank
       FROM (SELECT event_id, event_type, {_odd} AS v FROM events)""")
def _(k: Lake):
    rows = k.table("events").select("event_id", "event_type", F.expr(_odd).alias("v"))
    return wn.rank_within(rows, ["event_type"], "v").select("event_id", "rank")


@query("latest_revision", """SELECT id_municipio, rede, ano_meta, meta_taxa, CAST(max(ano) AS INT) AS ano FROM longt l
       WHERE ano = (SELECT max(ano) FROM longt) GROUP BY ALL""")
def _(k: Lake):
    from brisalake.operators.reshape import unpivot_year_suffix
    from brisalake.plans.lake import SEGMENTS

    wide = k.targets_wide.withColumn("rede", fx.encode_text_domain("rede", SEGMENTS))
    long = unpivot_year_suffix(wide, ["id_municipio", "rede", "ano"], "meta_alfabetizacao_", "ano_meta", "meta_taxa")
    return wn.latest_revision(long, ["id_municipio", "rede", "ano_meta"], "ano")


@query("stratified_sample_counts", """SELECT event_type, least(COUNT(*), 60) AS n, least(COUNT(*), 60) AS distintos FROM events GROUP BY 1""")
def _(k: Lake):
    picked = wn.stratified_sample(k.table("events"), ["event_type"], 60, 42, "event_id")
    return picked.groupBy("event_type").agg(n_rows(), F.count_distinct("event_id").alias("distintos"))


@query("stratified_sample")
def _(k: Lake):
    return wn.stratified_sample(k.table("events"), ["event_type"], 60, 42, "event_id")


@query("percentile_rank_avg", f"""SELECT ano, id_municipio, taxa_alfabetizacao,
       CASE WHEN taxa_alfabetizacao IS NOT NULL THEN {r("100.0 * (rank() OVER (ORDER BY taxa_alfabetizacao NULLS LAST) + (COUNT(*) OVER (PARTITION BY taxa_alfabetizacao) - 1) / 2.0) / COUNT(taxa_alfabetizacao) OVER ()", 6)} END AS pct
       FROM fact""")
def _(k: Lake):
    out = wn.percentile_rank_avg(k.fact, "taxa_alfabetizacao", out="pct").select(
        "ano", "id_municipio", "taxa_alfabetizacao", "pct")
    return ag.rounded(out, ["pct"], 6)


@query("upsert_keep_last", """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN value + 1000 ELSE value END AS value,
       user_id FROM events UNION ALL SELECT event_id + 10000000000, value, user_id FROM events WHERE event_id % 50 = 0""")
def _(k: Lake):
    old = k.table("events").select("event_id", "value", "user_id")
    again = old.filter("event_id % 3 = 0").withColumn("value", F.col("value") + 1000)
    fresh = old.filter("event_id % 50 = 0").withColumn("event_id", F.col("event_id") + 10000000000)
    return wn.upsert_keep_last(old, again.unionByName(again).unionByName(fresh), ["event_id"], [F.desc("value")])


_change = ("id_municipio, rede, ano_inicial, ano_final, taxa_inicial, taxa_final, meta_2030, variacao_pp, "
           "variacao_media_anual_pp, tendencia, anos_estimados_para_meta")


@query("first_last_change", f"SELECT {_change} FROM evo")
def _(k: Lake):
    return wn.first_last_change(k.integrated, ["id_municipio", "rede"], "ano", "taxa_alfabetizacao", "meta_taxa_2030")


# --- reports ---------------------------------------------------------------------------
def in_focus():
    return (F.col("ano") == 2001) & (F.col("rede_nome") == "BUILDING")


_focus = "ano = 2001 AND rede_nome = 'BUILDING'"


@query("topk_worst_units", f"""SELECT sigla_uf, nome_municipio, taxa_alfabetizacao, meta_taxa_ano, gap_meta_2030
       FROM indicator WHERE {_focus} AND risco_alfabetizacao = 'Critico'
       ORDER BY taxa_alfabetizacao, id_municipio LIMIT 100""")
def _(k: Lake):
    out = od.topk_worst_units(risk_columns(k.integrated), in_focus() & (F.col("risco_alfabetizacao") == "Critico"),
                              ["taxa_alfabetizacao", "id_municipio"], 100)
    return out.select("sigla_uf", "nome_municipio", "taxa_alfabetizacao", "meta_taxa_ano", "gap_meta_2030")


_states = "sigla_uf, nome_regiao, municipios, taxa_media, pct_municipios_na_meta, municipios_criticos"


@query("rank_states_by_share", f"SELECT {_states} FROM panel WHERE {_focus}")
def _(k: Lake):
    return od.rank_states_by_share(mart_target_vs_actual(k.integrated), in_focus(), "pct_municipios_na_meta").select(
        *_states.split(", "))


@query("effort_by_region", f"""SELECT nome_regiao, COUNT(*) AS municipios,
       {r(xavg("ritmo_anual_necessario_pp"))} AS media_ritmo_anual_necessario_pp,
       {r(xavg("taxa_alfabetizacao"))} AS media_taxa_alfabetizacao FROM indicator WHERE {_focus} GROUP BY 1""")
def _(k: Lake):
    return od.effort_by_region(risk_columns(k.integrated), in_focus(), ["nome_regiao"],
                               ["ritmo_anual_necessario_pp", "taxa_alfabetizacao"])


@query("good_abs_bad_rel", f"""SELECT sigla_uf, nome_municipio, taxa_alfabetizacao, taxa_uf, dif_vs_uf FROM indicator
       WHERE {_focus} AND situacao_meta = 'Meta atingida' AND dif_vs_uf < 0 ORDER BY dif_vs_uf, id_municipio LIMIT 50""")
def _(k: Lake):
    out = od.good_abs_bad_rel(risk_columns(k.integrated), in_focus() & (F.col("situacao_meta") == "Meta atingida"),
                              "dif_vs_uf", 50, "id_municipio")
    return out.select("sigla_uf", "nome_municipio", "taxa_alfabetizacao", "taxa_uf", "dif_vs_uf")


_unit_year = ["ano", "id_municipio", "media_portugues"]


@query("top_n_largest", """SELECT ano, id_municipio, media_portugues FROM fact
       ORDER BY media_portugues DESC NULLS LAST, id_municipio LIMIT 20""")
def _(k: Lake):
    return od.top_n_largest(k.fact.select(*_unit_year), "media_portugues", 20, "id_municipio")


@query("top_n_smallest", """SELECT ano, id_municipio, media_portugues FROM fact
       ORDER BY media_portugues NULLS LAST, id_municipio LIMIT 10""")
def _(k: Lake):
    return od.top_n_smallest(k.fact.select(*_unit_year), "media_portugues", 10, "id_municipio")


@query("extremes", """SELECT *, 'lowest' AS "end" FROM (SELECT ano, id_municipio, media_portugues FROM fact
       ORDER BY media_portugues NULLS LAST, id_municipio LIMIT 5) UNION ALL
       SELECT *, 'highest' FROM (SELECT ano, id_municipio, media_portugues FROM fact
       ORDER BY media_portugues DESC NULLS LAST, id_municipio LIMIT 5)""")
def _(k: Lake):
    return od.extremes(k.fact.select(*_unit_year), "media_portugues", 5, "id_municipio")


@query("mixed_sort", "SELECT event_type, user_id, COUNT(*) AS n FROM events GROUP BY ALL")
def _(k: Lake):
    return od.mixed_sort(k.table("events").groupBy("event_type", "user_id").agg(n_rows()),
                         [("event_type", True), ("n", False), ("user_id", True)])
