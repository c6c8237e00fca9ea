"""Typing, domains, splits, joins, reshaping and scalar functions on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from brisalake import functions as fx
from brisalake.operators import conform as cf
from brisalake.operators import joins as jn
from brisalake.operators import reshape as rs
from brisalake.plans.lake import SEGMENTS, Lake
from brisalake.plans.marts import RISK_CUTS, RISK_LABELS, TARGET_LABELS
from brisalake.plans.oracle import MEAN, RATE, big, r, xavg, xsum
from brisalake.plans.registry import query

def n_rows():
    return F.count(F.lit(1)).alias("n")

CODES = {v: name.title() for name, v in SEGMENTS.items()}


# --- typing, domains, splits --------------------------------------------------
@query("conform_types", f"""SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k,
       {r("value", 1)} AS value, CAST(NULL AS INT) AS event_type FROM events""")
def _(k: Lake):
    text = k.table("events").select("event_id", F.get_json_object("props", "$.k").alias("k"),
                                    F.col("value").cast("string").alias("value"), "event_type")
    return cf.conform_types(text, {"k": ("int", None), "value": ("double", 1), "event_type": ("int", None)})


@query("project_rename", "SELECT s_suppkey AS id, s_name AS nome, s_acctbal AS saldo FROM supplier")
def _(k: Lake):
    return cf.project_rename(k.table("supplier"), {"s_suppkey": "id", "s_name": "nome", "s_acctbal": "saldo",
                                                   "s_absent": "nada"}, ["id", "nome", "saldo"])


@query("valid_split", """SELECT CASE WHEN l_discount <= 0.05 AND NULLIF(l_tax, 0) > 0.02 THEN 'valid' ELSE 'rejected'
       END AS outcome, COUNT(*) AS n FROM lineitem GROUP BY 1""")
def _(k: Lake):
    test = (F.col("l_discount") <= 0.05) & (F.nullif("l_tax", F.lit(0.0)) > 0.02)
    good, bad = cf.valid_split(k.table("lineitem"), test)
    return good.agg(n_rows()).select(F.lit("valid").alias("outcome"), "n").unionByName(
        bad.agg(n_rows()).select(F.lit("rejected").alias("outcome"), "n"))


@query("nullable_range", """SELECT (proficiencia_portugues IS NULL OR proficiencia_portugues BETWEEN 1000 AND 50000)
       AS ok, COUNT(*) AS n FROM micro GROUP BY 1""")
def _(k: Lake):
    return k.micro.groupBy(fx.nullable_range("proficiencia_portugues", 1000, 50000).alias("ok")).agg(n_rows())


@query("decode_domain", """SELECT ano, CASE rede WHEN 0 THEN 'Furniture' WHEN 1 THEN 'Automobile' WHEN 2 THEN 'Machinery'
       WHEN 3 THEN 'Building' ELSE 'Desconhecida' END AS label, COUNT(*) AS n FROM fact GROUP BY ALL""")
def _(k: Lake):
    known = {c: name for c, name in CODES.items() if c != 5}
    return k.fact.groupBy("ano", fx.decode_domain("rede", known, "Desconhecida").alias("label")).agg(n_rows())


@query("domain_from_dictionary", """SELECT coalesce(CASE WHEN n_nationkey % 2 = 0 THEN n_name END,
       CASE c_nationkey WHEN 1 THEN 'One' WHEN 3 THEN 'Three' END) AS label, COUNT(*) AS n
       FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def _(k: Lake):
    official = k.table("nation").filter("n_nationkey % 2 = 0").select(
        F.col("n_nationkey").alias("chave"), F.col("n_name").alias("valor"))
    return cf.domain_from_dictionary(k.table("customer"), "c_nationkey", official, {1: "One", 3: "Three"}
                                     ).groupBy("label").agg(n_rows())


@query("encode_text_domain", """SELECT c_custkey, CASE c_mktsegment WHEN 'FURNITURE' THEN 0 WHEN 'AUTOMOBILE' THEN 1
       WHEN 'MACHINERY' THEN 2 WHEN 'BUILDING' THEN 3 END AS rede FROM customer""")
def _(k: Lake):
    known = {t: c for t, c in SEGMENTS.items() if c != 5}
    padded = F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))
    return k.table("customer").select("c_custkey", fx.encode_text_domain(padded, known).alias("rede"))


@query("normalize_bool", """SELECT CASE l_returnflag WHEN 'R' THEN false WHEN 'A' THEN true ELSE l_quantity >= 25 END
       AS flag, COUNT(*) AS n FROM lineitem GROUP BY 1""")
def _(k: Lake):
    text = fx.decode_domain("l_returnflag", {"R": " Não", "A": "SIM", "N": "?"})
    return k.table("lineitem").groupBy(
        fx.normalize_bool(text, fx.cutoff_flag("l_quantity", 25)).alias("flag")).agg(n_rows())


@query("cutoff_flag", f"""SELECT COUNT(*) AS n,
       {xavg("CAST((proficiencia_portugues >= 50000) <> alfabetizado AS INT)")} AS disagreement
       FROM micro WHERE avaliado""")
def _(k: Lake):
    differs = fx.cutoff_flag("proficiencia_portugues", 50000) != F.col("alfabetizado")
    return k.micro.filter("avaliado").agg(n_rows(), fx.exact_avg(differs.cast("int")).alias("disagreement"))


_risk = f"{list(RISK_LABELS)}[1 + {' + '.join(f'CAST(taxa_alfabetizacao >= {c} AS INT)' for c in RISK_CUTS)}]"


@query("band_left_closed", f"SELECT {_risk} AS band, COUNT(*) AS n FROM fact GROUP BY 1")
def _(k: Lake):
    return k.fact.groupBy(fx.band_left_closed("taxa_alfabetizacao", RISK_CUTS, RISK_LABELS).alias("band")).agg(n_rows())


@query("band_right_closed", """SELECT CASE WHEN taxa_alfabetizacao <= 50 THEN 'Monitoramento'
       WHEN taxa_alfabetizacao <= 70 THEN 'Média' WHEN taxa_alfabetizacao <= 85 THEN 'Alta'
       WHEN taxa_alfabetizacao <= 100 THEN 'Crítica' END AS band, COUNT(*) AS n FROM fact GROUP BY 1""")
def _(k: Lake):
    band = fx.band_right_closed("taxa_alfabetizacao", (0, 50, 70, 85, 100), ("Monitoramento", "Média", "Alta", "Crítica"))
    return k.fact.groupBy(band.alias("band")).agg(n_rows())


@query("tri_state_status", """SELECT CASE WHEN meta_taxa_ano IS NULL THEN 'Sem meta definida' WHEN atingiu_meta_ano
       THEN 'Meta atingida' ELSE 'Abaixo da meta' END AS status, COUNT(*) AS n FROM integ GROUP BY 1""")
def _(k: Lake):
    return k.integrated.groupBy(
        fx.tri_state_status("meta_taxa_ano", "atingiu_meta_ano", TARGET_LABELS).alias("status")).agg(n_rows())


@query("safe_ratio", f"""SELECT l_linenumber, COUNT(q) AS n, MIN(q) AS lo, MAX(q) AS hi FROM
       (SELECT l_linenumber, {r("l_discount / NULLIF(l_tax, 0)")} AS q FROM lineitem) GROUP BY 1""")
def _(k: Lake):
    q = k.table("lineitem").select("l_linenumber", fx.safe_ratio("l_discount", "l_tax", 2).alias("q"))
    return q.groupBy("l_linenumber").agg(F.count("q").alias("n"), F.min("q").alias("lo"), F.max("q").alias("hi"))


@query("derive_parent_key", "SELECT c_custkey // 100 AS parent, COUNT(*) AS n FROM customer GROUP BY 1")
def _(k: Lake):
    return k.table("customer").groupBy(fx.derive_parent_key("c_custkey", 100).alias("parent")).agg(n_rows())


@query("dedup_any", "SELECT COUNT(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)")
def _(k: Lake):
    return cf.dedup_any(k.table("lineitem"), ["l_orderkey", "l_linenumber"]).agg(n_rows())


@query("dedup_latest", """SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS shipped, l_partkey
       FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
       ORDER BY l_shipdate DESC, l_partkey, l_suppkey) = 1""")
def _(k: Lake):
    latest = cf.dedup_latest(k.table("lineitem"), ["l_orderkey", "l_linenumber"],
                             [F.desc("l_shipdate"), F.asc("l_partkey"), F.asc("l_suppkey")])
    return latest.select("l_orderkey", "l_linenumber", F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"), "l_partkey")


@query("fill_default", """SELECT id_municipio, CAST(ano AS INT) AS ano, coalesce(meta_alfabetizacao_2001, 80.0) AS meta
       FROM wide""")
def _(k: Lake):
    return cf.fill_default(k.targets_wide, {"meta_alfabetizacao_2001": 80.0}).select(
        "id_municipio", "ano", F.col("meta_alfabetizacao_2001").alias("meta"))


@query("drop_null_keys", """SELECT o_orderkey, o_orderstatus, COUNT(*) AS n FROM orders LEFT JOIN lineitem
       ON o_orderkey = l_orderkey WHERE l_orderkey IS NOT NULL GROUP BY ALL""")
def _(k: Lake):
    o, li = k.table("orders"), k.table("lineitem").select("l_orderkey")
    return cf.drop_null_keys(o.join(li, o.o_orderkey == li.l_orderkey, "left"), ["l_orderkey"]).groupBy(
        "o_orderkey", "o_orderstatus").agg(n_rows())


@query("filter_in_keys", """SELECT event_type, COUNT(*) AS n FROM events WHERE user_id IN
       (SELECT c_custkey FROM customer WHERE c_acctbal > 3000) GROUP BY 1""")
def _(k: Lake):
    rich = k.table("customer").filter("c_acctbal > 3000").select(F.col("c_custkey").alias("user_id"))
    return cf.filter_in_keys(k.table("events"), rich, ["user_id"]).groupBy("event_type").agg(n_rows())


@query("distinct_keys", "SELECT DISTINCT user_id, event_type FROM events")
def _(k: Lake):
    return cf.distinct_keys(k.table("events"), ["user_id", "event_type"])


_gaps = "ano, id_municipio, rede, gap_meta_ano, atingiu_meta_ano, gap_meta_2030, dif_vs_uf, dif_vs_brasil"


@query("derived_gaps", f"SELECT {_gaps} FROM integ")
def _(k: Lake):
    return k.integrated.select(*_gaps.split(", "))


# --- joins ---------------------------------------------------------------------
@query("dim_join_broadcast", """SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
       LEFT JOIN region ON n_regionkey = r_regionkey""")
def _(k: Lake):
    dim = k.states.select(F.col("id_uf").alias("c_nationkey"), F.col("sigla_uf").alias("n_name"),
                          F.col("nome_regiao").alias("r_name"))
    return jn.dim_join_broadcast(k.table("customer"), dim, ["c_nationkey"], ["n_name", "r_name"]).select(
        "c_custkey", "n_name", "r_name")


@query("dim_parent_resolve", """SELECT CASE WHEN n_name IS NULL THEN 'rejected' ELSE 'resolved' END AS outcome,
       COUNT(*) AS n FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 6 <> 0)
       ON s_nationkey = n_nationkey GROUP BY 1""")
def _(k: Lake):
    parent = k.table("nation").filter("n_nationkey % 6 <> 0").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    found, lost = jn.dim_parent_resolve(k.table("supplier"), parent, ["s_nationkey"], "n_name")
    both = found.withColumn("outcome", F.lit("resolved")).unionByName(lost.withColumn("outcome", F.lit("rejected")))
    return both.groupBy("outcome").agg(n_rows())


_year_target = "ano, id_municipio, rede, taxa_alfabetizacao, meta_taxa"


@query("fact_join_multikey", """SELECT f.ano, f.id_municipio, f.rede, taxa_alfabetizacao, meta_taxa FROM fact f
       LEFT JOIN target t ON t.id_municipio = f.id_municipio AND t.rede = f.rede AND t.ano_meta = f.ano""")
def _(k: Lake):
    goal = k.targets.withColumnRenamed("ano_meta", "ano")
    return jn.fact_join_multikey(k.fact, goal, ["ano", "id_municipio", "rede"]).select(*_year_target.split(", "))


@query("join_renamed_keys", """SELECT f.ano, f.id_municipio, f.rede, taxa_alfabetizacao, meta_taxa FROM fact f
       LEFT JOIN target t ON t.id_municipio = f.id_municipio AND t.rede = f.rede AND t.ano_meta = f.ano""")
def _(k: Lake):
    out = jn.join_renamed_keys(k.fact, k.targets, {"id_municipio": "id_municipio", "rede": "rede", "ano": "ano_meta"})
    return out.select(*_year_target.split(", "))


@query("inner_join_agg", f"""SELECT p_brand, COUNT(*) AS n, {xsum("l_extendedprice")} AS price
       FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def _(k: Lake):
    return jn.inner_join_agg(k.table("lineitem"), k.table("part"), {"l_partkey": "p_partkey"}, ["p_brand"],
                             [n_rows(), fx.exact_sum("l_extendedprice").alias("price")])


@query("self_join_bounds", """SELECT ano, id_municipio, rede, min(ano) OVER w AS first_ano, max(ano) OVER w AS last_ano
       FROM fact WINDOW w AS (PARTITION BY id_municipio, rede)""")
def _(k: Lake):
    return jn.self_join_bounds(k.fact.select("ano", "id_municipio", "rede"), ["id_municipio", "rede"], "ano")


@query("prior_cycle_join", """SELECT f.ano, f.id_municipio, f.rede, f.taxa_alfabetizacao,
       p.taxa_alfabetizacao AS taxa_alfabetizacao_prior FROM fact f
       LEFT JOIN fact p ON p.id_municipio = f.id_municipio AND p.rede = f.rede AND p.ano = f.ano - 1""")
def _(k: Lake):
    return jn.prior_cycle_join(k.fact.select("ano", "id_municipio", "rede", "taxa_alfabetizacao"),
                               ["id_municipio", "rede"], "ano", ["taxa_alfabetizacao"])


@query("scalar_subquery_filter", """SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS ano FROM orders
       WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders) - 1""")
def _(k: Lake):
    orders = k.table("orders").select("o_orderkey", F.year("o_orderdate").alias("ano"))
    return jn.scalar_subquery_filter(orders, "ano", "max", -1)


@query("multi_left_assembly", f"""SELECT a.id_municipio, a.rede, a.taxa_alfabetizacao,
       p.taxa_alfabetizacao AS anterior, d.alunos, d.media FROM (SELECT * FROM fact WHERE ano = 2001) a
       LEFT JOIN (SELECT * FROM fact WHERE ano = 2000) p ON p.id_municipio = a.id_municipio AND p.rede = a.rede
       LEFT JOIN (SELECT id_municipio, rede, COUNT(*) AS alunos, {r(MEAN)} AS media FROM micro
       WHERE ano = 2001 GROUP BY ALL) d ON d.id_municipio = a.id_municipio AND d.rede = a.rede""")
def _(k: Lake):
    fact, seen = k.fact, F.col("avaliado")
    base = fact.filter("ano = 2001").select("id_municipio", "rede", "taxa_alfabetizacao")
    prior = fact.filter("ano = 2000").select("id_municipio", "rede", F.col("taxa_alfabetizacao").alias("anterior"))
    pupils = k.micro.filter("ano = 2001").groupBy("id_municipio", "rede").agg(
        F.count(F.lit(1)).alias("alunos"),
        fx.round_half_away(fx.weighted_mean("proficiencia_portugues", "peso_aluno", seen)).alias("media"))
    return jn.multi_left_assembly(base, [prior, pupils], ["id_municipio", "rede"])


_wide = ("ano, id_municipio, serie, rede, rede_nome, taxa_alfabetizacao, media_portugues, nome_municipio, sigla_uf, "
         "nome_uf, nome_regiao, nome_mesorregiao, meta_taxa_ano, meta_taxa_2030, percentual_participacao, "
         "nivel_alfabetizacao, taxa_uf, taxa_brasil_publica, gap_meta_ano, atingiu_meta_ano, gap_meta_2030, "
         "dif_vs_uf, dif_vs_brasil")


@query("integrated_fact", f"SELECT {_wide} FROM integ")
def _(k: Lake):
    return k.integrated_plan.select(*_wide.split(", "))


@query("orphan_rows", f"""WITH o AS (SELECT o_custkey FROM orders WHERE o_custkey NOT IN
       (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0))
       SELECT COUNT(*) AS orphans, (SELECT string_agg(CAST(x AS VARCHAR), ', ' ORDER BY CAST(x AS VARCHAR)) FROM
       (SELECT DISTINCT o_custkey AS x FROM o ORDER BY 1 LIMIT 5)) AS examples FROM o""")
def _(k: Lake):
    half = k.table("customer").filter("c_custkey % 2 = 0")
    return jn.orphan_rows(k.table("orders"), half, "o_custkey", "c_custkey")


@query("stream_static_join", """SELECT e.id_evento, u.nome_municipio, u.sigla_uf FROM ev0 e
       LEFT JOIN unit u ON u.id_municipio = e.id_municipio""")
def _(k: Lake):
    return jn.stream_static_join(k.events, k.event_units, ["id_municipio"]).select("id_evento", "nome_municipio", "sigla_uf")


@query("reconcile_join", """SELECT ano, id_municipio, rede, taxa_alfabetizacao, b,
       abs(taxa_alfabetizacao - b) AS difference, abs(taxa_alfabetizacao - b) > 0.1 AS divergent FROM
       (SELECT *, taxa_alfabetizacao + CASE WHEN id_municipio % 100 = 0 THEN 0.3 ELSE 0 END AS b FROM fact)
       WHERE taxa_alfabetizacao IS NOT NULL""")
def _(k: Lake):
    a = k.fact.select("ano", "id_municipio", "rede", "taxa_alfabetizacao")
    return jn.reconcile_join(a, second_source(k), ["ano", "id_municipio", "rede"], "taxa_alfabetizacao", "b", 0.1)


def second_source(k: Lake):
    """The indicator as another source publishes it: some units differ by 0.3."""
    shift = F.when(F.col("id_municipio") % 100 == 0, 0.3).otherwise(0.0)
    return k.fact.select("ano", "id_municipio", "rede", (F.col("taxa_alfabetizacao") + shift).alias("b"))


@query("join_key_harmonise", """SELECT c_nationkey, COUNT(*) AS n FROM customer JOIN nation
       ON c_nationkey = n_nationkey WHERE c_nationkey <> 4 GROUP BY 1""")
def _(k: Lake):
    left = k.table("customer").withColumn("c_nationkey", F.nullif("c_nationkey", F.lit(4)).cast("short"))
    right = k.table("nation").select(F.col("n_nationkey").cast("string").alias("c_nationkey"))
    key = ["c_nationkey"]
    return jn.join_key_harmonise(left, key).join(jn.join_key_harmonise(right, key), key).groupBy(
        F.col("c_nationkey").cast("int").alias("c_nationkey")).agg(n_rows())


@query("join_coverage", f"""SELECT 'territorio' AS "join", COUNT(nome_municipio) AS filled,
       {r("100.0 * COUNT(nome_municipio) / COUNT(*)")} AS pct FROM integ
       UNION ALL SELECT 'meta do ano', COUNT(meta_taxa_ano), {r("100.0 * COUNT(meta_taxa_ano) / COUNT(*)")} FROM integ
       UNION ALL SELECT 'participacao', COUNT(percentual_participacao),
       {r("100.0 * COUNT(percentual_participacao) / COUNT(*)")} FROM integ""")
def _(k: Lake):
    return jn.join_coverage(k.integrated, {"territorio": "nome_municipio", "meta do ano": "meta_taxa_ano",
                                           "participacao": "percentual_participacao"})


@query("join_strategy_compare", """SELECT s.strategy, f.ano, u.sigla_uf, COUNT(*) AS n FROM fact f
       LEFT JOIN unit u USING (id_municipio), (VALUES ('merge'), ('broadcast')) s(strategy) GROUP BY ALL""")
def _(k: Lake):
    plans = jn.join_strategy_compare(k.fact.select("ano", "id_municipio"), k.event_units, ["id_municipio"])
    rows = [df.groupBy("ano", "sigla_uf").agg(n_rows()).withColumn("strategy", F.lit(s)) for s, df in plans.items()]
    return rs.union_by_name(*rows)


# --- reshaping -------------------------------------------------------------------
@query("union_by_name", """SELECT c_custkey AS id, c_name AS nome, c_mktsegment AS segmento FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""")
def _(k: Lake):
    c = k.table("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("nome"),
                                   F.col("c_mktsegment").alias("segmento"))
    s = k.table("supplier").select(F.col("s_name").alias("nome"), F.col("s_suppkey").alias("id"))
    return rs.union_by_name(c, s, allow_missing=True)


_measures = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("unpivot_levels", "WITH x AS (" + " UNION ALL ".join(
    f"SELECT l_returnflag, {i} AS nivel, CAST({c} AS DOUBLE) AS proporcao FROM lineitem" for i, c in enumerate(_measures))
    + f") SELECT l_returnflag, nivel, COUNT(*) AS n, {xsum('proporcao')} AS total FROM x GROUP BY ALL")
def _(k: Lake):
    long = rs.unpivot_levels(k.table("lineitem"), ["l_returnflag"], _measures, "nivel", "proporcao")
    return long.groupBy("l_returnflag", "nivel").agg(n_rows(), fx.exact_sum("proporcao").alias("total"))


@query("unpivot_year_suffix", """SELECT id_municipio, CAST(ano AS INT) AS ano, ano_meta, meta_taxa FROM longt""")
def _(k: Lake):
    return rs.unpivot_year_suffix(k.targets_wide, ["id_municipio", "ano"], "meta_alfabetizacao_", "ano_meta", "meta_taxa")


@query("target_trajectory", "SELECT id_municipio, rede, ano_meta, meta_taxa FROM target")
def _(k: Lake):
    return k.targets


# --- scalar functions ----------------------------------------------------------------
@query("fn_string", """SELECT p_partkey, upper(p_name) AS up, lower(p_type) AS low, trim('  ' || p_name || ' ') AS cut,
       concat_ws('|', p_brand, p_type) AS joined, starts_with(p_type, 'ECON') AS econ,
       string_split(p_name, ' ')[-1] AS tail, split_part(p_brand || ':' || p_type, ':', 1) AS head FROM part""")
def _(k: Lake):
    return k.table("part").select(
        "p_partkey", F.upper("p_name").alias("up"), F.lower("p_type").alias("low"),
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("cut"),
        F.concat_ws("|", "p_brand", "p_type").alias("joined"), F.col("p_type").startswith("ECON").alias("econ"),
        fx.last_segment("p_name", " ").alias("tail"),
        fx.head_before(F.concat("p_brand", F.lit(":"), "p_type")).alias("head"))


@query("fn_regex", """SELECT c_custkey, regexp_extract(c_name, '(\\d{1})$', 1) AS last1,
       regexp_extract(c_name, '(\\d{4})$', 1) AS last4 FROM customer""")
def _(k: Lake):
    return k.table("customer").select("c_custkey", fx.trailing_digits("c_name", 1).alias("last1"),
                                      fx.trailing_digits("c_name", 4).alias("last4"))


@query("fn_timestamp", """SELECT id_evento, CASE WHEN event_id % 20 <> 3 THEN epoch_us(ts) // 1000 END AS ms FROM ev0""")
def _(k: Lake):
    return k.events.select("id_evento", F.unix_millis(fx.parse_timestamp("ts_evento")).alias("ms"))


@query("fn_date", """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, strftime(o_orderdate, '%Y/%m/%d') AS path,
       CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS INT) AS age FROM orders""")
def _(k: Lake):
    d = F.to_date("o_orderdate")
    return k.table("orders").select("o_orderkey", d.cast("string").alias("day"), F.date_format(d, "yyyy/MM/dd").alias("path"),
                                    F.datediff(F.lit("2002-01-01").cast("date"), d).alias("age"))


@query("fn_latency", "SELECT id_evento, CAST(latencia_ms AS BIGINT) AS latency FROM valid")
def _(k: Lake):
    return k.classify(k.events).filter("motivo_rejeicao IS NULL").select(
        "id_evento", fx.fn_latency("ts_convertido", k.processed_at()).alias("latency"))


@query("fn_math", f"""SELECT s_suppkey, {r("s_acctbal / 7")} AS rounded, abs(s_acctbal - 5000) AS distance,
       {r("100.0 * s_acctbal / 10000", 1)} AS pct, s_suppkey // 7 AS whole FROM supplier""")
def _(k: Lake):
    b = F.col("s_acctbal")
    return k.table("supplier").select(
        "s_suppkey", fx.round_half_away(b / 7).alias("rounded"), F.abs(b - 5000).alias("distance"),
        fx.round_half_away(100.0 * b / 10000, 1).alias("pct"), F.expr("s_suppkey div 7").alias("whole"))


@query("fn_null", """SELECT p_partkey, coalesce(NULLIF(p_size, 11), -1) AS filled, NULLIF(p_type, 'ECONOMY') IS NULL AS gone,
       p_size BETWEEN 10 AND 20 AS mid, p_brand IN ('Brand#1', 'Brand#2') AS listed FROM part""")
def _(k: Lake):
    return k.table("part").select(
        "p_partkey", F.coalesce(F.nullif("p_size", F.lit(11)), F.lit(-1)).alias("filled"),
        F.nullif("p_type", F.lit("ECONOMY")).isNull().alias("gone"), F.col("p_size").between(10, 20).alias("mid"),
        F.col("p_brand").isin("Brand#1", "Brand#2").alias("listed"))


@query("fn_json", """SELECT event_id, json_extract_string(props, '$.k') AS k,
       '{"id":' || event_id || ',"t":"' || event_type || '"}' AS body FROM events""")
def _(k: Lake):
    return k.table("events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"),
        F.to_json(F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("t"))).alias("body"))


@query("fn_hash", "SELECT c_custkey, sha256(c_name) AS h FROM customer")
def _(k: Lake):
    spread = fx.key_bucket("c_custkey", 4)
    return k.table("customer").filter(spread.between(0, 3)).select("c_custkey", F.sha2("c_name", 256).alias("h"))


@query("fn_bytes_label", """SELECT o_orderkey, CASE WHEN b < 1024 THEN printf('%.1f B', b)
       WHEN b < 1048576 THEN printf('%.1f KB', b / 1024) WHEN b < 1073741824 THEN printf('%.1f MB', b / 1048576)
       ELSE printf('%.1f GB', b / 1073741824) END AS label FROM (SELECT o_orderkey,
       CAST(o_orderkey AS DOUBLE) * o_orderkey * 1024 AS b FROM orders)""")
def _(k: Lake):
    key = F.col("o_orderkey")
    return k.table("orders").select("o_orderkey", fx.fn_bytes_label(key.cast("double") * key * 1024).alias("label"))
