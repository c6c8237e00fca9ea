import json

from pyspark.sql import functions as F

from brisalake.streaming import events as ev
from brisalake.streaming import pipeline as pl

GOOD = {"id_evento": "e1", "tipo_evento": "avaliacao", "ts_evento": "2024-05-01T10:00:00Z", "id_municipio": 1,
        "rede": 3, "serie": 2, "proficiencia_portugues": 750.0, "origem": "app"}


def frame(spark, *changes):
    rows = [json.dumps({**GOOD, "id_evento": f"e{i}", **c}) for i, c in enumerate(changes)]
    raw = spark.createDataFrame([(r,) for r in rows], "value string")
    return raw.select(F.from_json("value", ev.EVENT_SCHEMA).alias("e")).select("e.*")


def dim(spark):
    return spark.createDataFrame([(1, "Cidade", "SP", "Sudeste")], "id_municipio bigint, nome_municipio string, sigla_uf string, nome_regiao string")


def test_first_reason_in_order(spark):
    events = frame(spark, {}, {"proficiencia_portugues": None, "id_municipio": 9}, {"proficiencia_portugues": 2500.0, "id_municipio": 9},
                   {"id_municipio": 9, "ts_evento": "ontem de manha"}, {"ts_evento": "ontem de manha"}, {"tipo_evento": None, "rede": None})
    got = {r.id_evento: r.motivo_rejeicao for r in ev.validate_event(events, dim(spark)).collect()}
    assert got == {"e0": None, "e1": "campos_obrigatorios_ausentes:proficiencia_portugues",
                   "e2": "proficiencia_fora_de_faixa:2500.0", "e3": "municipio_inexistente:9", "e4": "timestamp_invalido",
                   "e5": "campos_obrigatorios_ausentes:tipo_evento,rede"}
    text = frame(spark, {}).withColumn("proficiencia_portugues", F.lit("abc"))
    assert ev.validate_event(text, dim(spark)).first().motivo_rejeicao == "proficiencia_nao_numerica"


def test_enrich_and_dead_letters(spark):
    checked = ev.validate_event(frame(spark, {}, {"proficiencia_portugues": 742.9, "rede": 9}, {"id_municipio": 9}), dim(spark))
    now = F.lit("2024-05-01 10:00:01.5").cast("timestamp")
    got = {r.id_evento: r for r in ev.enrich_event(checked, proc_ts=now).collect()}
    assert (got["e0"].alfabetizado, got["e0"].rede_nome, got["e0"].latencia_ms, got["e0"].peso_aluno) == (True, "Municipal", 1500.0, 1.0)
    assert (got["e1"].alfabetizado, got["e1"].rede_nome) == (False, "Desconhecida")
    dead = ev.route_dead_letters(checked).collect()
    assert [json.loads(r.evento_original)["id_evento"] for r in dead] == ["e2"]


def test_two_sinks_survive_a_replayed_batch(spark, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    handle = pl.two_sink_batch(good, bad)
    batch = ev.validate_event(frame(spark, {}, {"id_municipio": 9}), dim(spark))
    for _ in range(2):
        handle(batch, 0)
    assert spark.read.parquet(good).count() == 1 and spark.read.parquet(bad).count() == 1


def test_restart_adds_nothing_and_upsert_replaces(spark, tmp_path):
    src, target = str(tmp_path / "src"), str(tmp_path / "target")
    spark.createDataFrame([(1, 1.0), (2, 2.0)], "id int, v double").coalesce(1).write.json(src)
    read = lambda: pl.stream_file_source(spark, src, "id int, v double", "json")
    run = lambda: pl.run_batches(read(), pl.upsert_batch(target, ["id"], [F.desc("v")]), str(tmp_path / "cp"))
    run(); run()
    assert pl.read_upserted(spark, target, ["id"]).count() == 2
    spark.createDataFrame([(2, 9.0), (3, 3.0), (3, 4.0)], "id int, v double").coalesce(1).write.mode("append").json(src)
    run()
    want = [(1, 1.0), (2, 9.0), (3, 4.0)]
    assert sorted(map(tuple, pl.read_upserted(spark, target, ["id"]).collect())) == want
    pl.fold_upserts(spark, target, str(tmp_path / "base"), ["id"])
    assert sorted(map(tuple, pl.read_upserted(spark, str(tmp_path / "base"), ["id"]).collect())) == want


def test_alert_rules(spark):
    state = spark.createDataFrame([(1, 20, 100.0, 69.9), (2, 20, 100.0, 70.0), (3, 20, 100.0, 40.0), (4, 19, 100.0, 0.0), (5, 20, 100.0, 45.0)],
                                  "id_municipio bigint, avaliados bigint, peso double, peso_alfabetizados double")
    base = spark.createDataFrame([(1, 80.0), (2, 80.0), (5, 0.0)], "id_municipio bigint, taxa_alfabetizacao double")
    got = {r.id_municipio: (r.tipo, r.delta_pp) for r in ev.baseline_alerts(state, base).collect()}
    assert got == {1: ("QUEDA_DE_DESEMPENHO", -10.1), 3: ("ABAIXO_DA_META", None), 5: ("ABAIXO_DA_META", 45.0)}


def test_lag_without_commit_counts_from_zero(spark):
    end = spark.createDataFrame([("t", 0, 10), ("t", 1, 5)], "topic string, partition int, end_offset bigint")
    done = spark.createDataFrame([("t", 0, 7)], "topic string, partition int, committed bigint")
    assert {r.partition: r.lag for r in ev.consumer_lag(end, done).collect()} == {0: 3, 1: 5}
