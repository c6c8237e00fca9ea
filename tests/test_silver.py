"""The silver builders on literal bronze frames."""

import pytest
from pyspark.sql import functions as F

from brisalake.plans import silver as sv


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def states(spark):
    return sv.state_dimension(frame(spark, [("35", " sp ", "São Paulo ", "SE", "Sudeste"), ("33", "RJ", "Rio", "SE", "Sudeste"), ("33", "RJ", "Rio", "SE", "Sudeste"),
                                            ("x", "??", "no code", None, None)], "id string, sigla string, nome string, regiao_sigla string, regiao_nome string"))


def test_states(spark):
    assert sorted(map(tuple, states(spark).collect())) == [(33, "RJ", "Rio", "SE", "Sudeste"), (35, "SP", "São Paulo", "SE", "Sudeste")]


def test_units_take_the_state_from_their_code(spark):
    raw = frame(spark, [("3500105", " Adamantina ", "a"), ("3500105", " Adamantina ", "b"), ("9900001", "nowhere", "a"), ("abc", "unreadable", None)],
                "id string, nome string, microrregiao_nome string")  # no meso-region in the source
    good, bad = sv.unit_dimension(raw, states(spark))
    assert [(r.id_municipio, r.nome_municipio, r.nome_microrregiao, r.nome_mesorregiao, r.sigla_uf) for r in good.collect()] == [(3500105, "Adamantina", "a", None, "SP")]
    assert {(r.nome_municipio, r.motivo) for r in bad.collect()} == {("nowhere", "uf_inexistente"), ("unreadable", "codigo_ilegivel")}


INDICATOR = "ano string, id_municipio string, serie string, rede string, taxa_alfabetizacao string, media_portugues string, proporcao_aluno_nivel_0 double, proporcao_aluno_nivel_8 double"


def test_indicator(spark):
    raw = frame(spark, [("2024", "3500105", "2", "3", "81.005", "700", 10.0, None), ("2024", "3500105", "2", "3", "81.005", "700", 10.0, None),
                        (None, "3500105", "2", "3", "50", "1", None, None), ("2024", "35", "2", "3", "50", "1", None, None),
                        ("2024", "3500105", "2", "9", "100.01", "1", None, None), ("2024", "3500105", "2", "9", "80", "n/d", 0.0, 5.0)], INDICATOR)
    rows, bad = sv.unit_indicator(raw)
    fact = {r.rede: r for r in sv.unit_fact(rows).collect()}
    assert (fact[3].taxa_alfabetizacao, fact[3].rede_nome, fact[3].id_uf, fact[3].alcancou_meta_2030) == (81.01, "Municipal", 35, True)
    assert (fact[9].rede_nome, fact[9].media_portugues, fact[9].alcancou_meta_2030) == (None, None, True) and len(fact) == 2
    assert sorted(r.motivo for r in bad.collect()) == ["ano_ausente", "taxa_fora_de_faixa", "unidade_fora_de_faixa"]
    assert sorted((r.rede, r.nivel, r.proporcao_alunos) for r in sv.level_distribution(rows).collect()) == [(3, 0, 10.0), (9, 0, 0.0), (9, 8, 5.0)]


def test_pupils(spark):
    scores = [None, 199.99, 200.0, 649.99, 650.0, 699.99, 700.0, 742.99, 743.0, 799.99, 800.0, 1000.01]
    flags = ["Sim", "Sim", "não", "1", "0.0", "true", "?", "?", None, "false", "verdadeiro", "Sim"]
    raw = frame(spark, [(f"a{i}", 2024, 3500105, 3, 2, s, f, None if i % 2 else 2.5) for i, (s, f) in enumerate(zip(scores, flags))]
                + [("a2", 2023, 3500105, 3, 2, 300.0, "1", 1.0), ("a2", 2024, 3500105, 3, 2, 200.0, "não", 2.5), (None, 2024, 3500105, 3, 2, 300.0, "1", 1.0)],
                "id_aluno string, ano int, id_municipio int, rede int, serie int, proficiencia double, alfabetizado string, peso_aluno double")
    good, bad = sv.pupils(raw)
    got = {(r.id_aluno, r.ano): r for r in good.collect()}
    assert len(got) == 11 and sorted(r.motivo for r in bad.collect()) == ["aluno_ausente", "proficiencia_fora_de_faixa", "proficiencia_fora_de_faixa"]
    bands = [got[(f"a{i}", 2024)].faixa_proficiencia for i in (0, 2, 3, 4, 5, 6, 7, 8, 9, 10)]
    assert bands == [None, "Muito baixa", "Muito baixa", "Baixa", "Baixa", "Abaixo do corte", "Abaixo do corte", "Adequada", "Adequada", "Avancada"]
    passed = [got[(f"a{i}", 2024)].alfabetizado for i in (0, 2, 3, 4, 5, 6, 7, 8, 9, 10)]
    assert passed == [True, False, True, False, True, False, False, True, False, True]
    assert [got[(f"a{i}", 2024)].avaliado for i in (0, 2)] == [False, True] and got[("a3", 2024)].peso_aluno == 1.0 and got[("a2", 2023)].alfabetizado


def test_targets_keep_the_newest_declaration(spark):
    raw = frame(spark, [("2023", "3500105", " PÚBLICA ", 50.0, 80), ("2024", "3500105", "publica", None, 85), ("2024", "3500105", "x", 1.0, 1), ("2024", "3500105", None, 2.0, 2)],
                "ano string, id_municipio string, rede string, meta_alfabetizacao_2024 double, meta_alfabetizacao_2030 int")
    got = {(r.id_municipio, r.rede, r.ano_meta): (r.meta_taxa, r.rede_nome) for r in sv.targets(raw, ["id_municipio"]).collect() if r.rede is not None}
    assert got == {(3500105, 5, 2024): (50.0, "Publica"), (3500105, 5, 2030): (85.0, "Publica")}


def bronze(spark):
    return {
        "dim_uf_ibge": frame(spark, [("35", "SP", "São Paulo", "SE", "Sudeste")], "id string, sigla string, nome string, regiao_sigla string, regiao_nome string"),
        "dim_municipio_ibge": frame(spark, [("3500105", "Adamantina")], "id string, nome string"),
        "indicador_municipio": frame(spark, [("2024", "3500105", "2", "5", "81", "700", 10.0, None), ("2024", "1", "2", "5", "81", "700", 10.0, None)], INDICATOR),
        "indicador_uf": frame(spark, [("2024", " sp", "2", "5", "70.126", None)], "ano string, sigla_uf string, serie string, rede string, taxa_alfabetizacao string, media_portugues string"),
        "meta_municipio": frame(spark, [(2024, 3500105, "Pública", 82.5, 90, 99.0, 2.0)],
                                "ano int, id_municipio int, rede string, meta_alfabetizacao_2024 double, meta_alfabetizacao_2030 int, percentual_participacao double, nivel_alfabetizacao double"),
        "meta_brasil": frame(spark, [(2024, "56.0")], "ano int, taxa_alfabetizacao string")}


def test_chain_and_rejected_rows(spark, tmp_path):
    out = str(tmp_path / "silver")
    for _ in range(2):  # a second run replaces the first
        report = {r.tabela: (r.linhas, r.rejeitadas) for r in sv.build_silver(spark, bronze(spark), out).collect()}
    assert report["indicador_municipio"] == (1, 1) and report["fato_alfabetizacao_municipio"] == (1, None) and "fato_aluno" not in report
    row = spark.read.parquet(f"{out}/fato_alfabetizacao_municipio").first()
    assert (row.sigla_uf, row.meta_taxa_ano, row.meta_taxa_2030, row.taxa_uf, row.gap_meta_ano, row.atingiu_meta_ano, row.dif_vs_uf, row.dif_vs_brasil,
            row.percentual_participacao) == ("SP", 82.5, 90.0, 70.13, -1.5, False, 10.87, 25.0, 99.0)
    assert [r.motivo for r in spark.read.parquet(f"{out}/_rejeitadas/indicador_municipio").collect()] == ["unidade_fora_de_faixa"]


def test_gate_stops_rows_without_a_territory(spark, tmp_path):
    landed = bronze(spark)
    landed["dim_municipio_ibge"] = landed["dim_municipio_ibge"].filter("false")
    with pytest.raises(sv.GateFailed, match="1 sem territorio"):
        sv.build_silver(spark, landed, str(tmp_path / "silver"))


def test_empty_tables(spark, tmp_path):
    report = sv.build_silver(spark, {k: v.filter(F.lit(False)) for k, v in bronze(spark).items()}, str(tmp_path / "silver"))
    assert {r.linhas for r in report.collect()} == {0}
