import re

import pytest
from pyspark.sql import functions as F

from brisalake.operators import analytics as an
from brisalake.operators import conform as cf
from brisalake.operators import joins as jn
from brisalake.operators import reshape as rs
from brisalake.operators import windows as wn


def test_split_keeps_every_row(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    good, bad = cf.valid_split(df, F.col("x") > 2)
    assert (good.count(), bad.count()) == (1, 2)


def test_required_columns(spark):
    with pytest.raises(ValueError, match="falta|missing"):
        cf.required_columns(spark.range(1), ["id", "absent"])


def test_trajectory_takes_newest_and_drops_nulls(spark):
    df = spark.createDataFrame(
        [(2023, "A", " Pública", 40.0, 80, None), (2024, "A", "publica", 45.0, None, None)],
        "ano int, sigla_uf string, rede string, meta_alfabetizacao_2024 double, meta_alfabetizacao_2030 int, outra double")
    code = F.when(F.lower(F.trim("rede")).isin("pública", "publica"), 5)
    got = {(r.rede, r.ano_meta): r.meta_taxa for r in rs.target_trajectory(df, ["sigla_uf"], code, "ano").collect()}
    assert got == {(5, 2024): 45.0, (5, 2030): 80.0}


def test_unpivot_counts_non_null_cells(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, None, None), (3, 0.0, 2.0)], "id int, p0 double, p1 double")
    out = rs.unpivot_levels(df, ["id"], ["p0", "p1"], "nivel", "p")
    assert sorted(map(tuple, out.collect())) == [(1, 0, 1.0), (3, 0, 0.0), (3, 1, 2.0)]


def test_trend_labels(spark):
    rows = [("one", 2023, 50.0), ("up1", 2023, 50.0), ("up1", 2024, 51.0), ("up", 2023, 50.0), ("up", 2024, 51.01),
            ("down", 2023, 50.0), ("down", 2024, 48.99), ("done", 2023, 70.0), ("done", 2024, 85.0),
            ("null", 2023, None), ("null", 2024, 60.0)]
    df = spark.createDataFrame(rows, "u string, ano int, v double").withColumn("t", F.lit(80.0))
    got = {r.u: r for r in wn.first_last_change(df, ["u"], "ano", "v", "t").collect()}
    assert {u: r.tendencia for u, r in got.items()} == {
        "one": "Serie unica", "up1": "Estavel", "up": "Melhora", "down": "Piora", "done": "Melhora", "null": None}
    assert got["done"].anos_estimados_para_meta == 0.0 and got["down"].anos_estimados_para_meta is None
    assert got["up"].anos_estimados_para_meta == 28.7 and got["null"].variacao_pp is None


def test_prior_cycle_is_strict(spark):
    df = spark.createDataFrame([(1, 2000, 1.0), (1, 2002, 2.0), (1, 2003, 3.0)], "u int, ano int, v double")
    got = {r.ano: r.v_prior for r in jn.prior_cycle_join(df, ["u"], "ano", ["v"]).collect()}
    assert got == {2000: None, 2002: None, 2003: 2.0}


def test_integrated_fact_meets_its_unit_by_one_key(spark):
    """Targets, participation and territory join on the unit alone; an unknown network meets nothing."""
    fact = spark.createDataFrame([(2024, 1, 2, 3, 60.0), (2024, 1, 2, 0, 50.0), (2023, 1, 2, 3, 40.0), (2024, 1, 2, None, 10.0)],
                                 "ano int, id_municipio int, serie int, rede int, taxa_alfabetizacao double")
    dims = spark.createDataFrame([(1, "n", "SP", "s", "r", "m")], "id_municipio int, nome_municipio string, sigla_uf string, nome_uf string, nome_regiao string, nome_mesorregiao string")
    targets = spark.createDataFrame([(1, 3, 2024, 55.0), (1, 3, 2030, 90.0), (1, None, 2024, 11.0)], "id_municipio int, rede int, ano_meta int, meta_taxa double")
    part = spark.createDataFrame([(2024, 1, 3, 90.0, 4.0), (2024, 1, None, 70.0, 2.0)], "ano int, id_municipio int, rede int, percentual_participacao double, nivel_alfabetizacao double")
    state = spark.createDataFrame([(2024, "SP", 3, 58.0)], "ano int, sigla_uf string, rede int, taxa_uf double")
    country = spark.createDataFrame([(2024, 59.0)], "ano int, taxa_brasil_publica double")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = jn.integrated_fact(fact, dims, targets, part, state, country)
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    got = {(r.ano, r.rede): (r.meta_taxa_ano, r.meta_taxa_2030, r.percentual_participacao, r.nivel_alfabetizacao) for r in out.collect()}
    assert got == {(2024, 3): (55.0, 90.0, 90.0, 4.0), (2024, 0): (None, 80.0, None, None), (2023, 3): (None, 90.0, None, None),
                   (2024, None): (None, 80.0, None, None)}
    keys = re.findall(r"Join \[([^\]]*)\]", plan)
    assert len(keys) >= 4 and all("id_municipio" not in k or "," not in k for k in keys)


def test_integrated_fact_never_multiplies(spark):
    fact = spark.createDataFrame([(2024, 1, 2, 3, 60.0)], "ano int, id_municipio int, serie int, rede int, taxa_alfabetizacao double")
    dims = spark.createDataFrame([(1, "n", "SP", "s", "r", "m")], "id_municipio int, nome_municipio string, sigla_uf string, nome_uf string, nome_regiao string, nome_mesorregiao string")
    targets = spark.createDataFrame([(1, 3, 2024, 55.0)], "id_municipio int, rede int, ano_meta int, meta_taxa double")
    part = spark.createDataFrame([(2024, 1, 3, 90.0, 4.0)] * 2, "ano int, id_municipio int, rede int, percentual_participacao double, nivel_alfabetizacao double")
    state = spark.createDataFrame([(2024, "SP", 3, 58.0)] * 2, "ano int, sigla_uf string, rede int, taxa_uf double")
    country = spark.createDataFrame([(2024, 56.0)] * 3, "ano int, taxa_brasil_publica double")
    row = jn.integrated_fact(fact, dims, targets, part, state, country).collect()
    assert len(row) == 1
    r = row[0]
    assert (r.gap_meta_ano, r.atingiu_meta_ano, r.meta_taxa_2030, r.gap_meta_2030, r.dif_vs_uf, r.dif_vs_brasil) == (
        5.0, True, 80.0, 20.0, 2.0, 4.0)


def test_upsert_is_idempotent(spark):
    old = spark.createDataFrame([(1, 10.0), (2, 20.0)], "id int, v double")
    new = spark.createDataFrame([(2, 21.0), (2, 22.0), (3, 30.0)], "id int, v double")
    once = wn.upsert_keep_last(old, new, ["id"], [F.desc("v")])
    twice = wn.upsert_keep_last(once, new, ["id"], [F.desc("v")])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [(1, 10.0), (2, 22.0), (3, 30.0)]


def test_broadcast_only_below_the_limit(spark):
    fact, dim = spark.range(1000).withColumnRenamed("id", "k"), spark.range(500).select(F.col("id").alias("k"), F.lit("x").alias("d"))
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(jn.dim_join_broadcast(fact, dim, ["k"], ["d"], 1 << 20)).lower()
    assert "broadcast" not in plan(jn.dim_join_broadcast(fact, dim, ["k"], ["d"], 10)).lower()
    both = jn.join_strategy_compare(fact, dim, ["k"])
    assert "SortMergeJoin" in both["merge"]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in both["broadcast"]._jdf.queryExecution().executedPlan().toString()


def test_metrics_and_standardise(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, 2.0, 2.0), (3.0, 2.0, 4.0)], "y double, base double, m double")
    got = {r.modelo: r for r in an.regression_metrics(df, "y", {"base": "base", "m": "m"}).collect()}
    assert (got["base"].MAE_pp, got["m"].MAE_pp, got["base"].R2, got["m"].ganho_pct, got["m"].melhor) == (0.67, 0.33, 0.0, 50.0, True)
    z = [round(r.y, 4) for r in an.standardise(df, ["y"]).orderBy("m").collect()]
    assert z == [-1.2247, 0.0, 1.2247]


def test_null_share_is_not_zero(spark):
    mart = spark.createDataFrame([("A", None), ("B", 0.0)], "sigla_uf string, pct_municipios_na_meta double")
    having, without = an.target_share_panel(mart)
    assert [r.sigla_uf for r in having.collect()] == ["B"] and [r.sigla_uf for r in without.collect()] == ["A"]
