import pytest
from pyspark.sql import functions as F

from brisalake.operators import quality as dq


def results(df, *rules):
    return {r.verificacao: r for r in dq.run_rules(df, rules).collect()}


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [(1, "a", 40.0, 60.0, "7", None), (2, "b", None, None, "x", None), (2, None, 90.0, None, "99", None)],
        "id int, t string, p0 double, p1 double, txt string, d date")


def test_rules_in_one_table(df):
    got = results(df, dq.dq_row_count(3), dq.dq_row_count(9, "WARNING"))
    assert got["row_count"].status == "WARN"
    got = results(df, dq.dq_not_null(["t", "nope"]), dq.dq_unique(["id", "t"]), dq.dq_domain("t", ["a"]),
                  dq.dq_range("txt", 0, 50), dq.dq_row_sum(["p0", "p1"], 100), dq.dq_freshness("2024-01-01", "d"))
    assert got["not_null:t"].detalhe == "1 nulos (33.33%)"
    assert (got["not_null:nope"].status, got["not_null:nope"].detalhe) == ("FAIL", "coluna inexistente")
    assert got["unique:id"].detalhe == "1 duplicatas" and got["unique:t"].status == "PASS"
    assert got["dominio:t"].detalhe == "1 valores fora do dominio ['a'] | ex.: [b]"
    assert got["faixa:txt"].detalhe == "1 valores fora de [0, 50]"
    assert got["soma:2col=100"].detalhe == "1/2 linhas fora da tolerancia +-0.5" and got["soma:2col=100"].status == "WARN"
    assert (got["freshness:d"].status, got["freshness:d"].detalhe) == ("WARN", "sem datas validas")


def test_references_and_cross_table(spark, df):
    ref = spark.createDataFrame([(1, 40.0)], "id int, q double")
    got = results(df, dq.dq_referential("id", ref, "id"), dq.dq_cross_table(ref, ["id"], "p0", "q"))
    assert got["fk:id->id"].detalhe == "2 registros orfaos | ex.: [2]"
    assert got["cross_table:p0~q"].status == "PASS"
    far = results(df, dq.dq_cross_table(ref.withColumn("id", F.lit(77)), ["id"], "p0", "q"))
    assert (far["cross_table:p0~q"].status, far["cross_table:p0~q"].detalhe) == ("FAIL", "nenhuma linha em comum")


def test_report_gate_and_empty(df):
    report = dq.dq_report(df, "tabela", "bronze", [dq.dq_row_count(1), dq.dq_unique(["id"])])
    r = report.first()
    assert (r.linhas, r.score, r["pass"], r.fail) == (3, 50.0, 1, 1)
    with pytest.raises(ValueError, match="QUALITY GATE.*unique:id .1 duplicatas"):
        dq.dq_gate(report)
    dq.dq_gate(dq.dq_report(df, "tabela", "bronze", [dq.dq_row_count(1)]))
    assert dq.dq_report(df, "tabela", "bronze", []).first().score == 0.0


def test_all_single_table_rules_share_one_aggregation(df):
    out = dq.run_rules(df, [dq.dq_row_count(1), dq.dq_not_null(["id", "t"]), dq.dq_range("p0", 0, 100), dq.dq_row_sum(["p0", "p1"], 100)])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1
