"""Quality rules, reports and reconciliation on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from brisalake.operators import quality as dq
from brisalake.plans.lake import Lake
from brisalake.plans.marts import RISK_LABELS, mart_evolution, mart_indicator, mart_target_vs_actual
from brisalake.plans.oracle import r, xavg, xsum
from brisalake.plans.queries_conform import second_source
from brisalake.plans.registry import query


def check(name: str, dim: str, ok: str, detail: str, source: str, sev: str = "ERROR") -> str:
    """Oracle row of one rule."""
    bad = "WARN" if sev == "WARNING" else "FAIL"
    return (f"SELECT '{name}' AS verificacao, '{dim}' AS dimensao, CASE WHEN {ok} THEN 'PASS' ELSE '{bad}' END AS status, "
            f"{detail} AS detalhe, '{sev}' AS severidade FROM {source}")


def rows(df, *rules):
    return dq.run_rules(df, rules).drop("ordem")


_count = lambda t, m: check("row_count", "COMPLETUDE", f"n >= {m}", f"n || ' linhas (minimo esperado: {m})'",
                            f"(SELECT COUNT(*) AS n FROM {t})")
_null = lambda t, c, sev="ERROR": check(
    f"not_null:{c}", "COMPLETUDE", "n = 0", "n || ' nulos (' || printf('%.2f', coalesce(round(100.0 * n / t, 2), 0)) || '%)'",
    f"(SELECT COUNT(*) - COUNT({c}) AS n, COUNT(*) AS t FROM {t})", sev)
_dup = lambda t, keys: f"(SELECT COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT {keys} FROM {t})) AS n FROM {t})"
_ex = lambda src: f"(SELECT string_agg(CAST(v AS VARCHAR), ', ' ORDER BY v) FROM (SELECT DISTINCT v FROM {src} ORDER BY v LIMIT 5))"
_joined = "(SELECT l_orderkey, o_orderkey FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey)"


@query("dq_row_count", _count("lineitem", 1000))
def _(k: Lake):
    return rows(k.table("lineitem"), dq.dq_row_count(1000))


@query("dq_not_null", _null(_joined, "l_orderkey") + " UNION ALL " + _null(_joined, "o_orderkey", "WARNING")
       + " UNION ALL SELECT 'not_null:ausente', 'COMPLETUDE', 'FAIL', 'coluna inexistente', 'ERROR'")
def _(k: Lake):
    o, li = k.table("orders").select("o_orderkey"), k.table("lineitem").select("l_orderkey")
    joined = o.join(li, o.o_orderkey == li.l_orderkey, "left")
    return rows(joined, dq.dq_not_null(["l_orderkey"]), dq.dq_not_null(["o_orderkey"], "WARNING"), dq.dq_not_null(["ausente"]))


@query("dq_unique", check("unique:l_orderkey", "UNICIDADE", "n = 0", "n || ' duplicatas'", _dup("lineitem", "l_orderkey")))
def _(k: Lake):
    return rows(k.table("lineitem"), dq.dq_unique(["l_orderkey"]))


_key = "l_orderkey, l_linenumber"


@query("dq_composite_key", check("chave_composta:l_orderkey+l_linenumber", "UNICIDADE", "n = 0",
                                 "n || ' linhas duplicadas no grao'", _dup("lineitem", _key)))
def _(k: Lake):
    return rows(k.table("lineitem"), dq.dq_composite_key(_key.split(", ")))


@query("dq_domain", check("dominio:o_orderpriority", "VALIDADE", "n = 0",
                          "n || ' valores fora do dominio [''1-URGENT'', ''2-HIGH''] | ex.: [' || e || ']'",
                          "(SELECT COUNT(*) AS n, " + _ex("(SELECT o_orderpriority AS v FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH'))")
                          + " AS e FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH'))")
       + " UNION ALL SELECT 'dominio:o_orderstatus', 'VALIDADE', 'PASS', '0 valores fora do dominio [''F'', ''O'', ''P'']', 'ERROR'")
def _(k: Lake):
    return rows(k.table("orders"), dq.dq_domain("o_orderpriority", ["1-URGENT", "2-HIGH"]),
                dq.dq_domain("o_orderstatus", ["F", "O", "P"]))


@query("dq_range", check("faixa:l_discount", "VALIDADE", "n = 0", "n || ' valores fora de [0.01, 0.05]'",
                         "(SELECT COUNT(*) AS n FROM lineitem WHERE l_discount < 0.01 OR l_discount > 0.05)")
       + " UNION ALL " + check("faixa:l_quantity", "VALIDADE", "n = 0", "n || ' valores fora de [1, None]'",
                               "(SELECT COUNT(*) AS n FROM lineitem WHERE l_quantity < 1)"))
def _(k: Lake):
    return rows(k.table("lineitem"), dq.dq_range("l_discount", 0.01, 0.05), dq.dq_range("l_quantity", 1))


_half = "o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)"


@query("dq_referential", check("fk:o_custkey->c_custkey", "CONSISTENCIA", "n = 0",
                               "n || ' registros orfaos | ex.: [' || e || ']'",
                               f"(SELECT COUNT(*) AS n, {_ex(f'(SELECT o_custkey AS v FROM orders WHERE {_half})')} AS e FROM orders WHERE {_half})")
       + " UNION ALL SELECT 'fk:o_custkey->c_custkey', 'CONSISTENCIA', 'PASS', '0 registros orfaos', 'WARNING'")
def _(k: Lake):
    c = k.table("customer")
    return rows(k.table("orders"), dq.dq_referential("o_custkey", c.filter("c_custkey % 2 = 0"), "c_custkey"),
                dq.dq_referential("o_custkey", c, "c_custkey", "WARNING"))


@query("dq_row_sum", check("soma:2col=0.08", "CONSISTENCIA", "n = 0", "n || '/' || t || ' linhas fora da tolerancia +-0.035'",
                           """(SELECT COUNT(*) FILTER (abs(l_discount + l_tax - 0.08) > 0.035) AS n, COUNT(*) AS t
                           FROM lineitem)""", "WARNING"))
def _(k: Lake):
    return rows(k.table("lineitem"), dq.dq_row_sum(["l_discount", "l_tax"], 0.08, 0.035))


@query("dq_cross_table", check(
    "cross_table:taxa_alfabetizacao~b", "CONSISTENCIA", "n = 0",
    "n || '/' || t || ' divergencias (' || printf('%.2f', round(100.0 * n / t, 2)) || '%) acima de +-0.1'",
    """(SELECT COUNT(*) FILTER (id_municipio % 100 = 0) AS n, COUNT(*) AS t FROM fact
        WHERE taxa_alfabetizacao IS NOT NULL)""")
    + " UNION ALL SELECT 'cross_table:taxa_alfabetizacao~b', 'CONSISTENCIA', 'FAIL', 'nenhuma linha em comum', 'ERROR'")
def _(k: Lake):
    a, b, on = k.fact, second_source(k), ["ano", "id_municipio", "rede"]
    apart = b.withColumn("ano", F.col("ano") + 1000)
    return rows(a, dq.dq_cross_table(b, on, "taxa_alfabetizacao", "b", 0.1),
                dq.dq_cross_table(apart, on, "taxa_alfabetizacao", "b", 0.1))


_late = "(SELECT date_diff('day', CAST(MAX(ts) AS DATE), DATE '2024-02-05') AS n FROM events)"


@query("dq_freshness", check("freshness:ts", "ATUALIDADE", "n <= 10", "'ingestao mais recente ha ' || n || ' dia(s)'",
                             _late, "WARNING")
       + " UNION ALL " + check("freshness:ts", "ATUALIDADE", "n <= 1", "'ingestao mais recente ha ' || n || ' dia(s)'",
                               _late, "WARNING")
       + " UNION ALL SELECT 'freshness:event_type', 'ATUALIDADE', 'WARN', 'sem datas validas', 'WARNING'")
def _(k: Lake):
    return rows(k.table("events"), dq.dq_freshness("2024-02-05", "ts", 10), dq.dq_freshness("2024-02-05", "ts"),
                dq.dq_freshness("2024-02-05", "event_type"))


@query("dq_expectation", check("media_positiva", "REGRA_NEGOCIO", "x > 0", "'media do valor'",
                               "(SELECT avg(value) AS x FROM events)"))
def _(k: Lake):
    return rows(k.table("events"), dq.dq_expectation("media_positiva", F.avg("value") > 0, "media do valor"))


def line_rules(k: Lake):
    return [dq.dq_row_count(1000), dq.dq_not_null(["l_orderkey", "l_partkey"]), dq.dq_composite_key(_key.split(", ")),
            dq.dq_range("l_quantity", 1, 50), dq.dq_range("l_discount", 0.01, 0.05, "WARNING"),
            dq.dq_referential("l_partkey", k.table("part"), "p_partkey")]


def order_rules(k: Lake):
    return [dq.dq_row_count(100), dq.dq_unique(["o_orderkey"]), dq.dq_domain("o_orderstatus", ["F", "O", "P"]),
            dq.dq_referential("o_custkey", k.table("customer"), "c_custkey")]


_domain = lambda t, c, values, sev="ERROR": check(
    f"dominio:{c}", "VALIDADE", "n = 0", "n", f"(SELECT COUNT(*) AS n FROM {t} WHERE {c} NOT IN ({', '.join(repr(v) for v in values)}))", sev)
_range = lambda t, c, lo, hi, sev="ERROR": check(
    f"faixa:{c}", "VALIDADE", "n = 0", "n", f"(SELECT COUNT(*) AS n FROM {t} WHERE {c} NOT BETWEEN {lo} AND {hi})", sev)
_fk = lambda t, c, other, key: check(
    f"fk:{c}->{key}", "CONSISTENCIA", "n = 0", "n", f"(SELECT COUNT(*) AS n FROM {t} WHERE {c} NOT IN (SELECT {key} FROM {other}))")
_unique = lambda t, cols: check(
    f"unique:{cols[0]}" if len(cols) == 1 else "chave_composta:" + "+".join(cols), "UNICIDADE", "n = 0", "n", _dup(t, ", ".join(cols)))

# The same rules over the tables, in SQL.
LINE_SQL = [_count("lineitem", 1000), _null("lineitem", "l_orderkey"), _null("lineitem", "l_partkey"), _unique("lineitem", ["l_orderkey", "l_linenumber"]),
            _range("lineitem", "l_quantity", 1, 50), _range("lineitem", "l_discount", 0.01, 0.05, "WARNING"), _fk("lineitem", "l_partkey", "part", "p_partkey")]
ORDER_SQL = [_count("orders", 100), _unique("orders", ["o_orderkey"]), _domain("orders", "o_orderstatus", ["F", "O", "P"]),
             _fk("orders", "o_custkey", "customer", "c_custkey")]


def _of(entity: str, rules) -> str:
    return " UNION ALL ".join(f"SELECT '{entity}' AS entidade, verificacao, dimensao, status, severidade FROM ({sql})" for sql in rules)


def _report(entity: str, rules) -> str:
    return f"""SELECT 'bronze' AS camada, '{entity}' AS entidade, (SELECT COUNT(*) FROM {entity}) AS linhas,
        {r("100.0 * COUNT(*) FILTER (status = 'PASS') / COUNT(*)", 1)} AS score, COUNT(*) FILTER (status = 'PASS') AS "pass",
        COUNT(*) FILTER (status = 'FAIL') AS "fail", COUNT(*) FILTER (status = 'WARN') AS warn FROM ({_of(entity, rules)})"""


_line_report, _order_report = _report("lineitem", LINE_SQL), _report("orders", ORDER_SQL)


@query("dq_report", f"""SELECT camada, entidade, linhas, CAST(score AS DOUBLE) AS score, CAST("pass" AS BIGINT) AS "pass",
       CAST("fail" AS BIGINT) AS "fail", CAST(warn AS BIGINT) AS warn FROM ({_line_report})""")
def _(k: Lake):
    return dq.dq_report(k.table("lineitem"), "lineitem", "bronze", line_rules(k)).drop("verificacoes")


@query("dq_panel", f"""SELECT camada, entidade, linhas, CAST(score AS DOUBLE) AS score, CAST("pass" AS BIGINT) AS "pass",
       CAST("fail" AS BIGINT) AS "fail", CAST(warn AS BIGINT) AS warn, {r("avg(score) OVER ()", 1)} AS score_medio
       FROM ({_line_report} UNION ALL {_order_report})""")
def _(k: Lake):
    return dq.dq_panel(dq.dq_report(k.table("orders"), "orders", "bronze", order_rules(k)),
                       dq.dq_report(k.table("lineitem"), "lineitem", "bronze", line_rules(k)))


@query("dq_gate", f"""SELECT camada, entidade, linhas, CAST(score AS DOUBLE) AS score, CAST("pass" AS BIGINT) AS "pass",
       CAST("fail" AS BIGINT) AS "fail", CAST(warn AS BIGINT) AS warn FROM ({_order_report})""")
def _(k: Lake):
    report = dq.dq_report(k.table("orders"), "orders", "bronze", order_rules(k))
    dq.dq_gate(report)
    return report.drop("verificacoes")


_book = ["entidade", "verificacao", "dimensao", "status", "severidade"]


@query("dq_rulebook", f"""{_of("lineitem", LINE_SQL)} UNION ALL {_of("orders", ORDER_SQL)}
       UNION ALL SELECT 'ausente', 'tabela', 'COMPLETUDE', 'SKIP', 'WARNING'""")
def _(k: Lake):
    return dq.dq_rulebook(
        {"lineitem": k.table("lineitem"), "orders": k.table("orders")},
        {"lineitem": line_rules(k), "orders": order_rules(k), "ausente": [dq.dq_row_count(1)]}).select(*_book)


@query("dq_recent_coverage", f"""SELECT 'cobertura_ano_recente:taxa_alfabetizacao' AS verificacao, 'COMPLETUDE' AS dimensao,
       CASE WHEN s > 0.99 THEN 'PASS' ELSE 'WARN' END AS status,
       printf('%.2f', {r("100.0 * s")}) || '% das linhas de 2001' AS detalhe, 'WARNING' AS severidade FROM
       (SELECT CAST(COUNT(taxa_alfabetizacao) AS DOUBLE) / COUNT(*) AS s FROM fact WHERE ano = 2001)""")
def _(k: Lake):
    return dq.dq_recent_coverage(k.fact, "ano", "taxa_alfabetizacao")


@query("dq_silver_gate", f"""SELECT COUNT(*) AS linhas, COUNT(*) - COUNT(DISTINCT (ano, id_municipio, rede)) AS duplicadas,
       COUNT(*) FILTER (sigla_uf IS NULL OR nome_municipio IS NULL) AS sem_territorio, 'PASS' AS status FROM integ""")
def _(k: Lake):
    return dq.dq_silver_gate(k.integrated, ["ano", "id_municipio", "rede"], ["sigla_uf", "nome_municipio"])


_gold = {
    "gold_indicador_municipio": [_count("indicator", 100), _unique("indicator", ["ano", "id_municipio", "rede", "serie"]),
                                 _null("indicator", "nome_municipio"), _null("indicator", "sigla_uf"),
                                 _domain("indicator", "risco_alfabetizacao", RISK_LABELS), _range("indicator", "taxa_alfabetizacao", 0, 100)],
    "gold_meta_vs_realizado": [_count("panel", 1), _unique("panel", ["ano", "rede", "sigla_uf"]), _range("panel", "pct_municipios_na_meta", 0, 100)],
    "gold_evolucao_temporal": [_count("evo", 1), _null("evo", "id_municipio"), _null("evo", "rede"),
                               _domain("evo", "tendencia", ["Serie unica", "Melhora", "Piora", "Estavel"])]}


@query("dq_gold_gate", " UNION ALL ".join(_of(mart, rules) for mart, rules in _gold.items()))
def _(k: Lake):
    fact = k.integrated
    return dq.dq_gold_gate({"gold_indicador_municipio": k.stored("gold_indicador_municipio", lambda: mart_indicator(fact)),
                            "gold_meta_vs_realizado": k.stored("gold_meta_vs_realizado", lambda: mart_target_vs_actual(fact)),
                            "gold_evolucao_temporal": k.stored("evolution", lambda: mart_evolution(fact))}, minimum=100).select(*_book)


_w = lambda c: f"{xsum(c + ' * alunos')} / {xsum('alunos')}"


@query("reconstruct_indicator", f"""WITH g AS (SELECT ano, id_municipio, rede, COUNT(*) AS alunos,
       100.0 * coalesce({xsum("CASE WHEN alfabetizado THEN peso_aluno END")}, 0) / {xsum("peso_aluno")} AS r,
       {xsum("proficiencia_portugues * peso_aluno")} / {xsum("peso_aluno")} AS m FROM micro WHERE avaliado GROUP BY ALL),
       j AS (SELECT g.*, taxa_alfabetizacao AS t, abs(r - taxa_alfabetizacao) AS e, abs(m - media_portugues) AS em
       FROM g JOIN fact f USING (ano, id_municipio, rede))
       SELECT COUNT(*) AS combinacoes, {r(xavg("e", 8), 4)} AS erro_medio_taxa_pp, {r(xavg("em", 8), 4)} AS erro_medio_proficiencia,
       {r("100.0 * COUNT(*) FILTER (e < 0.05) / COUNT(*)", 1)} AS pct_dentro_005,
       {r(f"abs({_w('r')} - {_w('t')})", 4)} AS erro_nacional_pp, 'PASS' AS status FROM j""")
def _(k: Lake):
    return dq.reconstruct_indicator(k.micro, k.fact, ["ano", "id_municipio", "rede"])


@query("mapping_cross_check", f"""SELECT COUNT(*) AS comparados, COUNT(*) FILTER (id_municipio % 100 = 0) AS divergentes,
       {r("100.0 * COUNT(*) FILTER (id_municipio % 100 = 0) / COUNT(*)", 3)} AS pct,
       CASE WHEN 100.0 * COUNT(*) FILTER (id_municipio % 100 = 0) / COUNT(*) < 1 THEN 'PASS' ELSE 'FAIL' END AS status
       FROM fact WHERE taxa_alfabetizacao IS NOT NULL""")
def _(k: Lake):
    return dq.mapping_cross_check(k.fact, second_source(k), ["ano", "id_municipio", "rede"], "taxa_alfabetizacao", "b")
