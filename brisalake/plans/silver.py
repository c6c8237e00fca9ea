"""Bronze to silver: builders for landed tables of the indicator's own shape.

A builder takes bronze frames as they land (texts, repeated rows, missing columns) and
returns a typed table with one row per grain. Facts come with the rows they reject and
the first reason. ``build_silver`` runs all builders in order, writes the tables and the
rejected rows, and stops if the integrated fact fails its gate.

Codes, words, cuts and labels are fixed values of the data; ``Rules`` takes others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brisalake.functions import (
    band_left_closed, cutoff_flag, decode_domain, derive_parent_key, encode_text_domain, normalize_bool, nullable_range, round_half_away)
from brisalake.operators.conform import conform_types, dedup_latest, project_rename
from brisalake.operators.joins import broadcast_if_small, integrated_fact
from brisalake.operators.quality import dq_silver_gate
from brisalake.operators.reshape import target_trajectory, unpivot_levels
from brisalake.sources.readers import optional_columns
from brisalake.sources.writers import write_partitioned

# Network codes, the words that stand for them in the target tables, and the score bands.
NETWORKS = {0: "Total", 1: "Federal", 2: "Estadual", 3: "Municipal", 4: "Privada", 5: "Publica"}
NETWORK_WORDS = {"total": 0, "federal": 1, "estadual": 2, "municipal": 3, "privada": 4, "pública": 5, "publica": 5}
BANDS = ((650, 700, 743, 800), ("Muito baixa", "Baixa", "Abaixo do corte", "Adequada", "Avancada"))
LEVELS = tuple(f"proporcao_aluno_nivel_{i}" for i in range(9))


@dataclass(frozen=True)
class Rules:
    networks: Mapping[int, str] = field(default_factory=lambda: dict(NETWORKS))
    network_words: Mapping[str, int] = field(default_factory=lambda: dict(NETWORK_WORDS))
    units: tuple[int, int] = (1_000_000, 9_999_999)
    unit_divisor: int = 100_000  # a unit's leading digits are its state
    rates: tuple[float, float] = (0.0, 100.0)
    scores: tuple[float, float] = (200.0, 1000.0)
    cut: float = 743.0
    bands: tuple[Sequence[float], Sequence[str]] = BANDS
    final_year: int = 2030
    final_target: float = 80.0


def one_row(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the same on every run: the first by its other columns."""
    return dedup_latest(df, keys, [F.asc_nulls_last(c) for c in df.columns if c not in keys])


def judge(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """(rows that meet every rule, the others with ``motivo``: the first rule not met); an unknown test is not met."""
    reason = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules])
    judged = df.withColumn("motivo", reason)
    return judged.filter("motivo IS NULL").drop("motivo"), judged.filter("motivo IS NOT NULL")


def state_dimension(bronze: DataFrame) -> DataFrame:
    """id_uf, sigla_uf, nome_uf, sigla_regiao, nome_regiao."""
    rows = bronze.select(F.col("id").try_cast("int").alias("id_uf"), F.upper(F.trim("sigla")).alias("sigla_uf"), F.trim("nome").alias("nome_uf"),
                         F.col("regiao_sigla").alias("sigla_regiao"), F.col("regiao_nome").alias("nome_regiao"))
    return one_row(rows.filter("id_uf IS NOT NULL"), ["id_uf"])


def unit_dimension(bronze: DataFrame, states: DataFrame, rules: Rules = Rules()) -> tuple[DataFrame, DataFrame]:
    """(units with their state's columns, units without a state).

    The state comes from the unit's code, not from the nesting of the source, which may
    lack levels; columns of absent levels are null.
    """
    known = optional_columns(bronze, {"microrregiao_nome": ("string", None), "microrregiao_mesorregiao_nome": ("string", None)})
    rows = known.select(F.col("id").try_cast("bigint").alias("id_municipio"), F.trim("nome").alias("nome_municipio"),
                        F.col("microrregiao_nome").alias("nome_microrregiao"), F.col("microrregiao_mesorregiao_nome").alias("nome_mesorregiao"))
    coded = one_row(rows, ["id_municipio"]).withColumn("id_uf", derive_parent_key("id_municipio", rules.unit_divisor).cast("int"))
    return judge(coded.join(broadcast_if_small(states), "id_uf", "left"),
                 [("codigo_ilegivel", F.col("id_municipio").isNotNull()), ("uf_inexistente", F.col("sigla_uf").isNotNull())])


def _indicator_types(df: DataFrame, key: str, kind: str) -> DataFrame:
    typed = {"ano": ("int", None), "serie": ("int", None), "rede": ("int", None), "taxa_alfabetizacao": ("double", 2), "media_portugues": ("double", 2)}
    return conform_types(df, {**typed, key: (kind, None)} if kind != "text" else typed)


def unit_indicator(bronze: DataFrame, rules: Rules = Rules()) -> tuple[DataFrame, DataFrame]:
    """(indicator per year, unit, grade and network with the nine level shares, rejected rows)."""
    present = optional_columns(bronze, {c: ("double", None) for c in LEVELS})
    typed = conform_types(_indicator_types(present, "id_municipio", "bigint"), {c: ("double", None) for c in LEVELS})
    good, bad = judge(typed, [("ano_ausente", F.col("ano").isNotNull()), ("unidade_fora_de_faixa", F.col("id_municipio").between(*rules.units)),
                              ("taxa_fora_de_faixa", F.col("taxa_alfabetizacao").between(*rules.rates))])
    rows = one_row(good.select("ano", "id_municipio", "serie", "rede", "taxa_alfabetizacao", "media_portugues", *LEVELS),
                   ["ano", "id_municipio", "serie", "rede"])
    return rows.withColumn("rede_nome", decode_domain("rede", rules.networks)), bad


def unit_fact(indicator: DataFrame, rules: Rules = Rules()) -> DataFrame:
    return indicator.select(
        "ano", "id_municipio", "serie", "rede", "rede_nome", "taxa_alfabetizacao", "media_portugues",
        derive_parent_key("id_municipio", rules.unit_divisor).cast("int").alias("id_uf"),
        cutoff_flag("taxa_alfabetizacao", rules.final_target).alias("alcancou_meta_2030"))


def level_distribution(indicator: DataFrame) -> DataFrame:
    """ano, id_municipio, rede, rede_nome, nivel, proporcao_alunos: a row per level that has a share."""
    return unpivot_levels(indicator, ["ano", "id_municipio", "rede", "rede_nome"], LEVELS, "nivel", "proporcao_alunos")


def state_indicator(bronze: DataFrame, states: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Indicator per year, state, grade and network, with the state's names."""
    rows = _indicator_types(bronze, "sigla_uf", "text").withColumn("sigla_uf", F.upper(F.trim("sigla_uf")))
    rows = one_row(rows.select("ano", "sigla_uf", "serie", "rede", "taxa_alfabetizacao", "media_portugues"), ["ano", "sigla_uf", "serie", "rede"])
    named = rows.withColumn("rede_nome", decode_domain("rede", rules.networks))
    return named.join(broadcast_if_small(states.select("sigla_uf", "id_uf", "nome_uf", "nome_regiao")), "sigla_uf", "left")


def pupils(bronze: DataFrame, rules: Rules = Rules()) -> tuple[DataFrame, DataFrame]:
    """(one row per year and pupil, rejected rows).

    A pupil without a score stays: absence counts in participation. The source's own
    pass flag holds; where it has none, the cut decides.
    """
    renamed = project_rename(bronze, {"proficiencia": "proficiencia_portugues"})
    known = optional_columns(renamed, {"peso_aluno": ("double", None), "alfabetizado": ("string", None), "id_escola": ("string", None),
                                       "presenca": ("int", None), "preenchimento_caderno": ("int", None)})
    typed = conform_types(known, {"ano": ("int", None), "id_municipio": ("bigint", None), "rede": ("int", None), "serie": ("int", None),
                                  "proficiencia_portugues": ("double", None), "peso_aluno": ("double", None)})
    score = F.col("proficiencia_portugues")
    good, bad = judge(typed, [("aluno_ausente", F.col("id_aluno").isNotNull()), ("unidade_fora_de_faixa", F.col("id_municipio").between(*rules.units)),
                              ("proficiencia_fora_de_faixa", nullable_range(score, *rules.scores))])
    rows = good.select("id_aluno", "ano", "id_municipio", "id_escola", "rede", "serie", "proficiencia_portugues",
                       normalize_bool("alfabetizado", cutoff_flag(score, rules.cut)).alias("alfabetizado"), "presenca", "preenchimento_caderno",
                       F.coalesce("peso_aluno", F.lit(1.0)).alias("peso_aluno"))
    return one_row(rows, ["ano", "id_aluno"]).withColumns({
        "avaliado": score.isNotNull(), "rede_nome": decode_domain("rede", rules.networks),
        "faixa_proficiencia": band_left_closed("proficiencia_portugues", *rules.bands)}), bad


def targets(bronze: DataFrame, keys: Sequence[str], rules: Rules = Rules()) -> DataFrame:
    """keys, rede, ano_meta, meta_taxa, rede_nome: the newest declaration of each target year."""
    typed = conform_types(bronze, {"ano": ("int", None)})
    for k in keys:
        typed = typed.withColumn(k, F.upper(F.trim(k)) if k == "sigla_uf" else F.col(k).try_cast("bigint"))
    found = target_trajectory(typed, list(keys), encode_text_domain("rede", rules.network_words), "ano")
    return found.withColumn("rede_nome", decode_domain("rede", rules.networks))


def participation(bronze: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """ano, id_municipio, rede, percentual_participacao, nivel_alfabetizacao; rows without a percentage do not count."""
    typed = conform_types(bronze, {"ano": ("int", None), "id_municipio": ("bigint", None), "percentual_participacao": ("double", None),
                                   "nivel_alfabetizacao": ("double", None)})
    rows = typed.select("ano", "id_municipio", encode_text_domain("rede", rules.network_words).alias("rede"), "percentual_participacao",
                        "nivel_alfabetizacao").filter("percentual_participacao IS NOT NULL")
    return one_row(rows, ["ano", "id_municipio", "rede"])


def country_context(bronze: DataFrame) -> DataFrame:
    rows = conform_types(bronze, {"ano": ("int", None), "taxa_alfabetizacao": ("double", None)})
    return one_row(rows.select("ano", F.col("taxa_alfabetizacao").alias("taxa_brasil_publica")), ["ano"])


def integrated(fact: DataFrame, units: DataFrame, goals: DataFrame, shares: DataFrame, states: DataFrame, country: DataFrame,
               rules: Rules = Rules()) -> DataFrame:
    """The wide fact of the marts, from silver tables."""
    context = states.select("ano", "sigla_uf", "rede", F.col("taxa_alfabetizacao").alias("taxa_uf"))
    names = units.select("id_municipio", "nome_municipio", "sigla_uf", "nome_uf", "nome_regiao", "nome_mesorregiao")
    return integrated_fact(fact, names, goals.drop("rede_nome"), shares, context, country, rules.final_year, rules.final_target)


class GateFailed(ValueError):
    """The integrated fact has repeated grain or rows without a territory."""


#: Tables that are written by partition.
PARTITIONS = {"fato_aluno": ("ano",), "fato_alfabetizacao_municipio": ("ano",)}


def build_silver(spark: SparkSession, bronze: Mapping[str, DataFrame], out: str, rules: Rules = Rules()) -> DataFrame:
    """Write every silver table whose bronze tables are given; table, linhas, rejeitadas.

    bronze   dim_uf_ibge, dim_municipio_ibge, indicador_municipio, indicador_uf, meta_municipio, meta_uf, meta_brasil, aluno

    Each table is written once and read back by those that follow, so no builder runs
    twice and lineage stays short. Rejected rows are in ``<out>/_rejeitadas/<table>``.
    A run replaces what an earlier one wrote.
    """
    written: list[tuple[str, int, int | None]] = []
    have = lambda *names: all(n in bronze for n in names)

    def write(df: DataFrame, path: str, parts: Sequence[str]) -> int:
        write_partitioned(df, path, parts)
        return spark.read.schema(df.schema).parquet(path).count()  # from the files' footers

    def table(name: str, df: DataFrame, rejected: DataFrame | None = None) -> DataFrame:
        bad = None if rejected is None else write(rejected, f"{out}/_rejeitadas/{name}", ())
        written.append((name, write(df, f"{out}/{name}", PARTITIONS.get(name, ())), bad))
        return spark.read.schema(df.schema).parquet(f"{out}/{name}")

    states = units = fact = state_fact = goals = shares = None
    if have("dim_uf_ibge"):
        states = table("dim_uf", state_dimension(bronze["dim_uf_ibge"]))
    if states is not None and have("dim_municipio_ibge"):
        units = table("dim_municipio", *unit_dimension(bronze["dim_municipio_ibge"], states, rules))
    if have("indicador_municipio"):
        indicator = table("indicador_municipio", *unit_indicator(bronze["indicador_municipio"], rules))
        fact = table("fato_indicador_municipio", unit_fact(indicator, rules))
        table("fato_distribuicao_nivel", level_distribution(indicator))
    if states is not None and have("indicador_uf"):
        state_fact = table("fato_indicador_uf", state_indicator(bronze["indicador_uf"], states, rules))
    if have("aluno"):
        table("fato_aluno", *pupils(bronze["aluno"], rules))
    if have("meta_municipio"):
        goals = table("dim_meta_municipio", targets(bronze["meta_municipio"], ["id_municipio"], rules))
        shares = table("fato_participacao_municipio", participation(bronze["meta_municipio"], rules))
    if have("meta_uf"):
        table("dim_meta_uf", targets(bronze["meta_uf"], ["sigla_uf"], rules))
    if have("meta_brasil") and None not in (units, fact, state_fact, goals, shares):
        wide = table("fato_alfabetizacao_municipio",
                     integrated(fact, units, goals, shares, state_fact, country_context(bronze["meta_brasil"]), rules))
        gate = dq_silver_gate(wide, ["ano", "id_municipio", "rede", "serie"], ["sigla_uf"]).first()
        if gate["duplicadas"] or gate["sem_territorio"]:
            raise GateFailed(f"{gate['duplicadas']} duplicadas, {gate['sem_territorio']} sem territorio")
    return spark.createDataFrame(written, "tabela string, linhas bigint, rejeitadas bigint")
