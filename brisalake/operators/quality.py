"""Data-quality rules, reports and gates.

A rule is a declaration. ``dq_report`` compiles all single-table rules of an
entity into one aggregation; rules that need a shuffle of their own
(uniqueness, references, comparison with another table) add one small branch
each. Every result is a row (verificacao, dimensao, status, detalhe,
severidade); labels and detail texts are fixed values.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brisalake.functions import exact_avg, exact_sum, round_half_away, safe_ratio

RESULT = ["verificacao", "dimensao", "status", "detalhe", "severidade"]


@dataclass(frozen=True)
class Rule:
    """``inline`` gives (aggregates, ok, detail) for the shared pass; ``branch`` a
    one-row frame with columns ok and detail. ``columns`` must exist."""

    name: str
    dimension: str
    severity: str
    columns: tuple[str, ...] = ()
    missing: str = "coluna inexistente"
    inline: Callable[[str], tuple[list[Column], Column, Column]] | None = None
    branch: Callable[[DataFrame], DataFrame] | None = None


def status_of(ok: Column, severity: str) -> Column:
    return F.when(ok, "PASS").otherwise("WARN" if severity == "WARNING" else "FAIL")


def _fixed2(c: Column) -> Column:
    return F.format_string("%.2f", c)


def _say(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])


def dq_row_count(minimum: int, severity: str = "ERROR") -> list[Rule]:
    def inline(p):
        n = F.col(f"{p}n")
        return [F.count(F.lit(1)).alias(f"{p}n")], n >= minimum, _say(n, f" linhas (minimo esperado: {minimum})")
    return [Rule("row_count", "COMPLETUDE", severity, inline=inline)]


def dq_not_null(cols: Sequence[str], severity: str = "ERROR") -> list[Rule]:
    def build(c):
        def inline(p):
            n, total = F.col(f"{p}n"), F.col(f"{p}t")
            pct = F.coalesce(safe_ratio(100.0 * n, total, 2), F.lit(0.0))
            nan = F.typeof(F.col(c)).isin("double", "float") & (F.col(c).cast("string") == "NaN")
            return ([F.count_if(F.col(c).isNull() | nan).alias(f"{p}n"), F.count(F.lit(1)).alias(f"{p}t")],
                    n == 0, _say(n, " nulos (", _fixed2(pct), "%)"))
        return Rule(f"not_null:{c}", "COMPLETUDE", severity, (c,), inline=inline)
    return [build(c) for c in cols]


def _duplicates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("d")))


def dq_unique(cols: Sequence[str], severity: str = "ERROR") -> list[Rule]:
    def build(c):
        return Rule(f"unique:{c}", "UNICIDADE", severity, (c,), branch=lambda df: _duplicates(df, [c]).select(
            (F.col("d") == 0).alias("ok"), _say(F.col("d"), " duplicatas").alias("detail")))
    return [build(c) for c in cols]


def dq_composite_key(cols: Sequence[str], severity: str = "ERROR") -> list[Rule]:
    return [Rule(f"chave_composta:{'+'.join(cols)}", "UNICIDADE", severity, tuple(cols), "colunas ausentes",
                 branch=lambda df: _duplicates(df, cols).select(
                     (F.col("d") == 0).alias("ok"),
                     _say(F.col("d"), " linhas duplicadas no grao").alias("detail")))]


def _with_examples(bad: DataFrame, col: str, text: str) -> DataFrame:
    """Count of the bad rows and the five smallest distinct values.

    Values are counted before anything is gathered; only five rows are listed.
    """
    values = bad.groupBy(F.col(col).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    few = (values.orderBy("v").limit(5)
           .agg(F.array_join(F.transform(F.array_sort(F.collect_list("v")), lambda x: x.cast("string")), ", ")
                .alias("e")))
    examples = few.scalar()
    return (values.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("d"))
            .withColumn("e", examples)
            .select((F.col("d") == 0).alias("ok"),
                    F.when(F.col("d") == 0, _say(F.col("d"), text))
                    .otherwise(_say(F.col("d"), text, " | ex.: [", F.col("e"), "]")).alias("detail")))


def dq_domain(col: str, values: Sequence, severity: str = "ERROR") -> list[Rule]:
    def branch(df):
        bad = df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*values)).select(col)
        return _with_examples(bad, col, f" valores fora do dominio {list(values)}")
    return [Rule(f"dominio:{col}", "VALIDADE", severity, (col,), branch=branch)]


def dq_range(col: str, lo: float | None = None, hi: float | None = None, severity: str = "ERROR") -> list[Rule]:
    def inline(p):
        x = F.col(col).try_cast("double")
        bad = F.lit(False)
        bad = bad if lo is None else bad | (x < lo)
        bad = bad if hi is None else bad | (x > hi)
        n = F.col(f"{p}n")
        return [F.count_if(bad).alias(f"{p}n")], n == 0, _say(n, f" valores fora de [{lo}, {hi}]")
    return [Rule(f"faixa:{col}", "VALIDADE", severity, (col,), inline=inline)]


def dq_referential(col: str, ref: DataFrame, ref_col: str, severity: str = "ERROR") -> list[Rule]:
    def branch(df):
        known = ref.select(F.col(ref_col).alias("_k"))
        bad = (df.filter(F.col(col).isNotNull()).select(F.col(col).alias("_k"))
               .join(known, "_k", "left_anti"))
        return _with_examples(bad, "_k", " registros orfaos")
    return [Rule(f"fk:{col}->{ref_col}", "CONSISTENCIA", severity, (col,), branch=branch)]


def dq_row_sum(cols: Sequence[str], expected: float, tol: float = 0.5, severity: str = "WARNING") -> list[Rule]:
    def inline(p):
        filled = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in cols])
        total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])
        bad, rows = F.col(f"{p}b"), F.col(f"{p}r")
        return ([F.count_if(filled & (F.abs(total - expected) > tol)).alias(f"{p}b"),
                 F.count_if(filled).alias(f"{p}r")], bad == 0,
                F.when(rows == 0, "nenhuma linha preenchida").otherwise(
                    _say(bad, "/", rows, f" linhas fora da tolerancia +-{tol}")))
    return [Rule(f"soma:{len(cols)}col={expected}", "CONSISTENCIA", severity, tuple(cols), "colunas ausentes",
                 inline=inline)]


def dq_cross_table(ref: DataFrame, keys: Sequence[str], col: str, ref_col: str, tol: float = 0.01,
                   severity: str = "ERROR") -> list[Rule]:
    def branch(df):
        other = ref.select(*keys, F.col(ref_col).alias("_other"))
        both = df.select(*keys, col).join(other, list(keys)).dropna(subset=[col, "_other"])
        far, rows = F.col("far"), F.col("rows")
        return both.agg(F.count_if(F.abs(F.col(col) - F.col("_other")) > tol).alias("far"),
                        F.count(F.lit(1)).alias("rows")).select(
            ((rows > 0) & (far == 0)).alias("ok"),
            F.when(rows == 0, "nenhuma linha em comum").otherwise(
                _say(far, "/", rows, " divergencias (", _fixed2(safe_ratio(100.0 * far, rows, 2)),
                     f"%) acima de +-{tol}")).alias("detail"))
    return [Rule(f"cross_table:{col}~{ref_col}", "CONSISTENCIA", severity, (*keys, col), "chaves ausentes",
                 branch=branch)]


def dq_freshness(as_of: str, col: str = "_ingestion_date", max_days: int = 1,
                 severity: str = "WARNING") -> list[Rule]:
    def inline(p):
        late = F.datediff(F.lit(as_of).cast("date"), F.col(f"{p}d"))
        return ([F.max(F.col(col).try_cast("date")).alias(f"{p}d")], F.coalesce(late <= max_days, F.lit(False)),
                F.when(late.isNull(), "sem datas validas").otherwise(
                    _say("ingestao mais recente ha ", late, " dia(s)")))
    return [Rule(f"freshness:{col}", "ATUALIDADE", severity, (col,), inline=inline)]


def dq_expectation(name: str, ok: Column | bool, detail: str, dimension: str = "REGRA_NEGOCIO",
                   severity: str = "ERROR") -> list[Rule]:
    """A boolean computed elsewhere, or an aggregate condition over the table."""
    def inline(p):
        cond = ok if isinstance(ok, Column) else F.max(F.lit(bool(ok)))
        return [cond.alias(f"{p}x")], F.coalesce(F.col(f"{p}x"), F.lit(False)), F.lit(detail)
    return [Rule(name, dimension, severity, inline=inline)]


def dq_recent_coverage(df: DataFrame, year: str, col: str, minimum: float = 0.99) -> DataFrame:
    """Share of rows of the newest year that have ``col``, as a warning row."""
    newest = df.agg(F.max(year)).scalar()
    share = F.try_divide(F.count(col).cast("double"), F.count(F.lit(1)).cast("double"))
    return (df.filter(F.col(year) == newest).agg(share.alias("s"), F.max(year).alias("y"))
            .select(F.lit(f"cobertura_ano_recente:{col}").alias("verificacao"),
                    F.lit("COMPLETUDE").alias("dimensao"),
                    status_of(F.col("s") > minimum, "WARNING").alias("status"),
                    _say(_fixed2(round_half_away(100.0 * F.col("s"))), "% das linhas de ", F.col("y")).alias("detalhe"),
                    F.lit("WARNING").alias("severidade")))


def run_rules(df: DataFrame, rules: Sequence[Sequence[Rule]]) -> DataFrame:
    """Result rows of all rules; ``ordem`` keeps the declared order."""
    flat = [r for group in rules for r in group]
    frames, aggs, shared = [], [], []
    for i, rule in enumerate(flat):
        def row(ok, detail, rule=rule, i=i):
            return F.struct(F.lit(i).alias("ordem"), F.lit(rule.name).alias("verificacao"),
                            F.lit(rule.dimension).alias("dimensao"),
                            status_of(ok, rule.severity).alias("status"), detail.alias("detalhe"),
                            F.lit(rule.severity).alias("severidade"))
        absent = [c for c in rule.columns if c not in df.columns]
        if absent:
            text = rule.missing if rule.missing == "coluna inexistente" else f"{rule.missing}: {absent}"
            shared.append(row(F.lit(False), F.lit(text)))
        elif rule.inline is not None:
            more, ok, detail = rule.inline(f"r{i}_")
            aggs += more
            shared.append(row(ok, detail))
        else:
            frames.append(rule.branch(df).select(row(F.col("ok"), F.col("detail")).alias("r")))
    if shared:
        base = df.agg(*aggs) if aggs else df.agg(F.count(F.lit(1)).alias("_n"))
        frames.insert(0, base.select(F.explode(F.array(*shared)).alias("r")))
    return reduce(lambda a, b: a.union(b), frames).select("r.*")


def dq_rulebook(tables: Mapping[str, DataFrame], rules: Mapping[str, Sequence[Sequence[Rule]]]) -> DataFrame:
    """Declared rules per entity; rules for an unknown entity give one skipped row."""
    frames = []
    for entity, declared in rules.items():
        if entity in tables:
            frames.append(run_rules(tables[entity], declared).withColumn("entidade", F.lit(entity)))
        else:
            spark = next(iter(tables.values())).sparkSession
            frames.append(spark.range(1).select(
                F.lit(0).alias("ordem"), F.lit("tabela").alias("verificacao"), F.lit("COMPLETUDE").alias("dimensao"),
                F.lit("SKIP").alias("status"), F.lit("tabela ausente").alias("detalhe"),
                F.lit("WARNING").alias("severidade"), F.lit(entity).alias("entidade")))
    return reduce(lambda a, b: a.unionByName(b), frames)


def dq_report(df: DataFrame, entity: str, layer: str, rules: Sequence[Sequence[Rule]]) -> DataFrame:
    """One row: entity, layer, score, counts, rows evaluated and the result rows.

    The result rows are as many as the rules, so gathering them is bounded.
    """
    rows = df.agg(F.count(F.lit(1))).scalar()
    if not any(rules):
        return df.agg(F.count(F.lit(1)).alias("linhas")).select(
            F.lit(layer).alias("camada"), F.lit(entity).alias("entidade"), "linhas", F.lit(0.0).alias("score"),
            *[F.lit(0).cast("bigint").alias(c) for c in ("pass", "fail", "warn")],
            F.expr("cast(array() as array<struct<ordem:int,verificacao:string,dimensao:string,"
                   "status:string,detalhe:string,severidade:string>>)").alias("verificacoes"))
    results = run_rules(df, rules)
    passed, n = F.count_if(F.col("status") == "PASS"), F.count(F.lit(1))
    return results.agg(
        safe_ratio(100.0 * passed, n, 1).alias("score"), passed.alias("pass"),
        F.count_if(F.col("status") == "FAIL").alias("fail"), F.count_if(F.col("status") == "WARN").alias("warn"),
        F.array_sort(F.collect_list(F.struct("ordem", *RESULT))).alias("verificacoes")).select(
        F.lit(layer).alias("camada"), F.lit(entity).alias("entidade"), rows.alias("linhas"),
        "score", "pass", "fail", "warn", "verificacoes")


def dq_panel(*reports: DataFrame) -> DataFrame:
    """All reports ordered by layer and entity, with the mean score on every row."""
    stacked = reduce(lambda a, b: a.unionByName(b), [r.drop("verificacoes") for r in reports])
    mean = stacked.agg(round_half_away(exact_avg("score"), 1)).scalar()
    return stacked.withColumn("score_medio", mean).orderBy("camada", "entidade")


def dq_gate(report: DataFrame) -> None:
    """Stop with every failing detail if a check failed; reads only the failed rows of the report."""
    failed = (report.select("entidade", "camada", F.explode("verificacoes").alias("v"))
              .filter(F.col("v.status") == "FAIL")
              .select("entidade", "camada", "v.verificacao", "v.detalhe").toPandas())
    if len(failed):
        text = "; ".join(f"{r.verificacao} ({r.detalhe})" for r in failed.itertuples())
        first = failed.iloc[0]
        raise ValueError(f"[QUALITY GATE] {first.entidade} [{first.camada}]: "
                         f"{len(failed)} verificacao(oes) critica(s) falharam -> {text}")


def dq_silver_gate(df: DataFrame, grain: Sequence[str], required: Sequence[str]) -> DataFrame:
    """Rows, duplicates in the grain and rows lacking a required column, as one row."""
    lacking = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required])
    per_key = df.groupBy(*grain).agg(F.count(F.lit(1)).alias("n"), F.count_if(lacking).alias("l"))
    return per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("linhas"),
                       F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicadas"),
                       F.coalesce(F.sum("l"), F.lit(0)).alias("sem_territorio")).withColumn(
        "status", status_of((F.col("duplicadas") == 0) & (F.col("sem_territorio") == 0), "ERROR"))


def dq_gold_gate(marts: Mapping[str, DataFrame], minimum: int = 10_000) -> DataFrame:
    """Row count, key, territory, risk domain and rate range of the marts that are given.

    Give the marts as stored tables: rules with a shuffle of their own read them again.
    """
    book = {
        "gold_indicador_municipio": [
            dq_row_count(minimum), dq_composite_key(["ano", "id_municipio", "rede", "serie"]),
            dq_not_null(["nome_municipio", "sigla_uf"]),
            dq_domain("risco_alfabetizacao", ["Critico", "Alto", "Medio", "Baixo"]),
            dq_range("taxa_alfabetizacao", 0, 100)],
        "gold_meta_vs_realizado": [
            dq_row_count(1), dq_composite_key(["ano", "rede", "sigla_uf"]),
            dq_range("pct_municipios_na_meta", 0, 100)],
        "gold_evolucao_temporal": [
            dq_row_count(1), dq_not_null(["id_municipio", "rede"]),
            dq_domain("tendencia", ["Serie unica", "Melhora", "Piora", "Estavel"])]}
    return dq_rulebook(marts, {k: v for k, v in book.items() if k in marts})


def reconstruct_indicator(micro: DataFrame, published: DataFrame, on: Sequence[str],
                          tol: float = 0.5) -> DataFrame:
    """Rebuild the published rate from microdata and measure the error.

    ``micro`` needs avaliado, alfabetizado, peso_aluno, proficiencia_portugues;
    ``published`` taxa_alfabetizacao and media_portugues.
    """
    from brisalake.functions import weighted_mean, weighted_rate

    rebuilt = micro.filter("avaliado").groupBy(*on).agg(
        weighted_rate("alfabetizado", "peso_aluno").alias("r"),
        weighted_mean("proficiencia_portugues", "peso_aluno").alias("m"),
        F.count(F.lit(1)).alias("alunos"))
    both = rebuilt.join(published.select(*on, "taxa_alfabetizacao", "media_portugues"), list(on))
    err, err_m = F.abs(F.col("r") - F.col("taxa_alfabetizacao")), F.abs(F.col("m") - F.col("media_portugues"))
    by_pupils = lambda c: F.try_divide(exact_sum(F.col(c) * F.col("alunos")), exact_sum("alunos"))
    out = both.agg(
        F.count(F.lit(1)).alias("combinacoes"), round_half_away(exact_avg(err, 8), 4).alias("erro_medio_taxa_pp"),
        round_half_away(exact_avg(err_m, 8), 4).alias("erro_medio_proficiencia"),
        safe_ratio(100.0 * F.count_if(err < 0.05), F.count(err), 1).alias("pct_dentro_005"),
        round_half_away(F.abs(by_pupils("r") - by_pupils("taxa_alfabetizacao")), 4).alias("erro_nacional_pp"))
    return out.withColumn("status", status_of(
        (F.col("erro_nacional_pp") <= tol) & (F.col("erro_medio_taxa_pp") <= tol), "ERROR"))


def mapping_cross_check(a: DataFrame, b: DataFrame, on: Sequence[str], a_col: str, b_col: str,
                        tol: float = 0.1, max_pct: float = 1.0) -> DataFrame:
    """A code mapping proved by two sources: fails when too many pairs diverge."""
    from brisalake.operators.joins import reconcile_join

    n, far = F.count(F.lit(1)), F.count_if("divergent")
    pct = F.coalesce(F.try_divide(100.0 * far, n), F.lit(0.0))
    return reconcile_join(a, b, on, a_col, b_col, tol).agg(
        n.alias("comparados"), far.alias("divergentes"), round_half_away(pct, 3).alias("pct"),
        status_of(pct < max_pct, "ERROR").alias("status"))
