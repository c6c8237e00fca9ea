"""Streaming on the driver tables: batch forms and real streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from brisalake import functions as fx
from brisalake.operators.reshape import union_by_name
from brisalake.plans.lake import CUT, Lake
from brisalake.plans.oracle import r, rq, xsum
from brisalake.plans.registry import query
from brisalake.streaming import events as ev
from brisalake.streaming import levels
from brisalake.streaming import pipeline as pl
from brisalake.streaming import state as st

def n_rows():
    return F.count(F.lit(1)).alias("n")



def raw_stream(k: Lake):
    """The events table as a stream; it may be one file or a folder of files."""
    return pl.stream_file_source(k.spark, f"{k.folder}/events.parquet*", k.table("events").schema, "parquet")


def typed_stream(k: Lake):
    """Valid events as a stream, with parsed time, weight, flag and latency."""
    return ev.enrich_event(k.classify(k.as_events(raw_stream(k))), CUT, k.processed_at())


@query("stream_file_source", f"SELECT event_type, COUNT(*) AS n, {xsum('value')} AS total FROM events GROUP BY 1")
def _(k: Lake):
    sink = f"{k.work}/source"
    pl.stream_available_now(raw_stream(k), sink, f"{k.work}/cp_source")
    return k.spark.read.parquet(sink).groupBy("event_type").agg(
        n_rows(), F.sum(F.col("value").cast("decimal(28,4)")).cast("double").alias("total"))


@query("stream_available_now", "SELECT event_id, user_id, event_type FROM events")
def _(k: Lake):
    sink = f"{k.work}/now"
    pl.stream_available_now(raw_stream(k).select("event_id", "user_id", "event_type"), sink, f"{k.work}/cp_now")
    return k.spark.read.parquet(sink)


@query("stream_restart", "SELECT COUNT(*) AS n FROM events")
def _(k: Lake):
    sink, checkpoint = f"{k.work}/again", f"{k.work}/cp_again"
    pl.stream_available_now(raw_stream(k), sink, checkpoint)
    pl.stream_restart(raw_stream(k), sink, checkpoint)
    return k.spark.read.parquet(sink).agg(n_rows())


def messages(k: Lake):
    body = F.to_json(F.struct(*k.events.columns))
    return k.events.select(F.col("id_municipio").cast("string").cast("binary").alias("key"),
                           body.cast("binary").alias("value"), F.lit("avaliacoes").alias("topic"),
                           F.pmod(F.col("id_municipio"), F.lit(4)).cast("int").alias("partition"),
                           F.col("id_evento").cast("bigint").alias("offset"))


@query("parse_payload", """SELECT CAST(id_municipio AS VARCHAR) AS chave, CAST(id_municipio % 4 AS INT) AS "partition",
       event_id AS "offset", id_evento, tipo_evento, ts_evento, CAST(id_municipio AS BIGINT) AS id_municipio, rede,
       proficiencia_portugues, peso_aluno FROM ev0""")
def _(k: Lake):
    return ev.parse_payload(messages(k)).select("chave", "partition", "offset", "id_evento", "tipo_evento", "ts_evento",
                                                "id_municipio", "rede", "proficiencia_portugues", "peso_aluno")


@query("validate_event", "SELECT id_evento, motivo_rejeicao FROM ev")
def _(k: Lake):
    return k.classify(k.events).select("id_evento", "motivo_rejeicao")


@query("route_dead_letters", """SELECT id_evento, motivo_rejeicao, 'avaliacoes' AS topico_origem,
       CAST(id_municipio % 4 AS INT) AS particao, event_id AS "offset" FROM dead""")
def _(k: Lake):
    return ev.route_dead_letters(k.classify(ev.parse_payload(messages(k)))).select(
        "id_evento", "motivo_rejeicao", "topico_origem", "particao", "offset")


_valid = ("id_evento, nome_municipio, sigla_uf, rede_nome, alfabetizado, latencia_ms, peso_aluno")


@query("enrich_event", f"SELECT {_valid}, strftime(data_evento, '%Y-%m-%d') AS data_evento FROM valid")
def _(k: Lake):
    return k.valid.select(*_valid.split(", "), F.col("data_evento").cast("string").alias("data_evento"))


@query("two_sink_batch", """SELECT 'valid' AS sink, id_evento, CAST(NULL AS VARCHAR) AS motivo_rejeicao, false AS sem_hora FROM valid
       UNION ALL SELECT 'dlq', id_evento, motivo_rejeicao, false FROM dead""")
def _(k: Lake):
    good, bad = f"{k.work}/valid", f"{k.work}/dlq"
    stream = k.classify(k.as_events(raw_stream(k)))
    pl.run_batches(stream, pl.two_sink_batch(good, bad, CUT, k.processed_at()), f"{k.work}/cp_two")
    read = k.spark.read.parquet
    return union_by_name(
        read(good).select(F.lit("valid").alias("sink"), "id_evento", F.lit(None).cast("string").alias("motivo_rejeicao"),
                          F.col("ts_processamento").isNull().alias("sem_hora")),
        read(bad).select(F.lit("dlq").alias("sink"), "id_evento", "motivo_rejeicao", F.col("ts_rejeicao").isNull().alias("sem_hora")))


def windows(k: Lake):
    return ev.tumbling_window_agg(k.valid, "10 minutes", "sigla_uf")


@query("tumbling_window_agg", """SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS janela_inicio, sigla_uf, eventos, taxa_pct,
       latencia_p50_ms, latencia_p95_ms FROM win""")
def _(k: Lake):
    return windows(k).withColumn("janela_inicio", F.date_format("janela_inicio", "yyyy-MM-dd HH:mm:ss"))


@query("tumbling_window_stream", f"""SELECT strftime(time_bucket(INTERVAL '1 day', ts), '%Y-%m-%d') AS dia, sigla_uf,
       COUNT(*) AS eventos, {r("100.0 * coalesce(" + xsum("CASE WHEN alfabetizado THEN peso_aluno END") + ", 0) / NULLIF(" + xsum("peso_aluno") + ", 0)")} AS taxa_pct,
       {rq("quantile_cont(latencia_ms, 0.5)", 1)} AS latencia_p50_ms, {rq("quantile_cont(latencia_ms, 0.95)", 1)} AS latencia_p95_ms
       FROM valid GROUP BY ALL""")
def _(k: Lake):
    counts = pl.collect_parts(typed_stream(k), lambda batch: ev.window_counts(batch, "1 day", "sigla_uf"),
                              f"{k.work}/windows", f"{k.work}/cp_windows")
    return ev.windows_of(counts, "sigla_uf").withColumn("dia", F.date_format("janela_inicio", "yyyy-MM-dd")).drop("janela_inicio")


def in_batches(k: Lake, name: str, parts: int = 3):
    """The valid events landed in ``parts`` folders, read one folder a trigger: (land the next part, stream).

    Each task lands the rows it reads, so no task handles a whole part; a trigger takes as many files as the first part has.
    """
    folder, rows = f"{k.work}/{name}_in", k.valid
    files = iter(range(parts))

    def land():
        i = next(files)
        rows.filter(F.pmod(F.xxhash64("id_evento"), F.lit(parts)) == i).write.parquet(f"{folder}/part={i}")

    def stream():
        first = len(k.spark.read.schema(rows.schema).parquet(f"{folder}/part=0").inputFiles())
        return k.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", first).option("recursiveFileLookup", True).parquet(folder)
    return land, stream


@query("keyed_running_state", "SELECT id_municipio, avaliados, peso, peso_alfabetizados FROM state")
def _(k: Lake):
    """Two micro-batches, a restart from the checkpoint, one more: the totals go on."""
    land, stream = in_batches(k, "state")
    target, checkpoint = f"{k.work}/state", f"{k.work}/cp_state"
    land(), land()
    st.running_state(stream(), ["id_municipio"], target, checkpoint)
    land()
    st.running_state(stream(), ["id_municipio"], target, checkpoint)
    return pl.read_upserted(k.spark, target, ["id_municipio"])


_closed = """SELECT w, sigla_uf, latencia_ms, peso_aluno, alfabetizado FROM
       (SELECT *, time_bucket(INTERVAL '1 hour', ts) AS w FROM valid)
       WHERE w + INTERVAL '1 hour' <= (SELECT max(ts) - INTERVAL '10 minutes' FROM valid)"""


@query("closed_windows", f"""SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS janela_inicio, sigla_uf, COUNT(*) AS eventos,
       {r("100.0 * coalesce(" + xsum("CASE WHEN alfabetizado THEN peso_aluno END") + ", 0) / NULLIF(" + xsum("peso_aluno") + ", 0)")} AS taxa_pct,
       true AS p50_no_limite, true AS p95_no_limite FROM ({_closed}) GROUP BY w, sigla_uf""")
def _(k: Lake):
    """A run, a restart with copies of early events, which come too late to count, and the exact ranks of the sketches' cuts."""
    folder, sink, rows = f"{k.work}/closed_in", f"{k.work}/closed_out", k.valid
    for i, part in enumerate((rows, rows.filter("ts_convertido < '2024-01-02'"))):
        part.write.parquet(f"{folder}/part={i}")
        stream = k.spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).parquet(folder)
        st.closed_windows(stream, "1 hour", "sigla_uf", "10 minutes", sink, f"{k.work}/cp_closed")
    found = st.window_report(k.spark.read.parquet(sink), "sigla_uf")
    hour = F.window("ts_convertido", "1 hour")["start"].alias("janela_inicio")
    exact = rows.select(hour, "sigla_uf", "latencia_ms").join(found, ["janela_inicio", "sigla_uf"])
    v, n, slack = F.col("latencia_ms"), F.count(F.lit(1)), 3 * st.RANK_ERROR

    def inside(cut: str, p: float):
        c = F.col(cut)
        return (F.count_if(v < c) <= n * (p + slack) + 1) & (F.count_if(v <= c) >= n * (p - slack) - 1)

    keys = ["janela_inicio", "sigla_uf", "eventos", "taxa_pct"]
    judged = exact.groupBy(*keys).agg(inside("latencia_p50_ms", 0.5).alias("p50_no_limite"), inside("latencia_p95_ms", 0.95).alias("p95_no_limite"))
    return judged.withColumn("janela_inicio", F.date_format("janela_inicio", "yyyy-MM-dd HH:mm:ss"))


@query("windows_merged", f"""SELECT strftime(time_bucket(INTERVAL '1 day', w), '%Y-%m-%d') AS dia, sigla_uf, COUNT(*) AS eventos,
       {r("100.0 * coalesce(" + xsum("CASE WHEN alfabetizado THEN peso_aluno END") + ", 0) / NULLIF(" + xsum("peso_aluno") + ", 0)")} AS taxa_pct,
       COUNT(*) AS no_resumo FROM ({_closed}) GROUP BY ALL""")
def _(k: Lake):
    """Days from the stored sketches of closed hours, without the events."""
    sink = f"{k.work}/hours_out"
    stream = k.spark.readStream.schema(k.valid.schema).parquet(k.landed("valid"))
    st.closed_windows(stream, "1 hour", "sigla_uf", "10 minutes", sink, f"{k.work}/cp_hours")
    days = st.merged_windows(k.spark.read.parquet(sink), "1 day", "sigla_uf")
    report = st.window_report(days, "sigla_uf").select("janela_inicio", "sigla_uf", "eventos", "taxa_pct")
    n = days.select("janela_inicio", "sigla_uf", F.kll_sketch_get_n_double("latencia").alias("no_resumo"))
    return report.join(n, ["janela_inicio", "sigla_uf"]).withColumn("dia", F.date_format("janela_inicio", "yyyy-MM-dd")).drop("janela_inicio")


@query("window_late_data", """SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS janela_inicio, n AS eventos
       FROM (SELECT time_bucket(INTERVAL '1 hour', ts) AS w, COUNT(*) AS n FROM valid GROUP BY 1)
       WHERE w + INTERVAL '1 hour' <= (SELECT max(ts) - INTERVAL '10 minutes' FROM valid)""")
def _(k: Lake):
    """A run with the events, then one with copies of early events, which come too late to count."""
    folder, sink = f"{k.work}/late_in", f"{k.work}/late_out"
    rows = k.valid.select("id_evento", "ts_convertido")
    for i, part in enumerate((rows, rows.filter("ts_convertido < '2024-01-02'"))):
        part.write.parquet(f"{folder}/part={i}")
        stream = k.spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).parquet(folder)
        pl.stream_available_now(ev.window_late_data(stream, "1 hour", "10 minutes"), sink, f"{k.work}/cp_late")
    return k.spark.read.parquet(sink).withColumn("janela_inicio", F.date_format("janela_inicio", "yyyy-MM-dd HH:mm:ss"))


_alert = "tipo, severidade, id_municipio, sigla_uf, avaliados, taxa_stream_pct, taxa_oficial_pct, delta_pp"


def alerts(k: Lake):
    return ev.baseline_alerts(k.state, k.baseline)


@query("baseline_alerts", f"SELECT {_alert} FROM alert")
def _(k: Lake):
    return alerts(k).select(*_alert.split(", "))


@query("latency_sla_alerts", """SELECT 'LATENCIA_ACIMA_DO_SLA' AS tipo, 'ALTA' AS severidade,
       strftime(w, '%Y-%m-%d %H:%M:%S') AS janela_inicio, sigla_uf, latencia_p95_ms AS delta_pp, eventos AS avaliados
       FROM win WHERE latencia_p95_ms > 2000""")
def _(k: Lake):
    return ev.latency_sla_alerts(windows(k)).withColumn(
        "janela_inicio", F.date_format("janela_inicio", "yyyy-MM-dd HH:mm:ss"))


@query("dlq_rate_alert", f"""SELECT 'TAXA_DLQ_ALTA' AS tipo, {r("100.0 * d / n")} AS taxa_dlq_pct, n AS eventos,
       d AS rejeitados FROM (SELECT COUNT(*) AS n, COUNT(motivo_rejeicao) AS d FROM ev) WHERE 100.0 * d / n > 10""")
def _(k: Lake):
    return ev.dlq_rate_alert(k.valid, k.dead)


_dlq_alert = f"""(SELECT 'TAXA_DLQ_ALTA' AS tipo, {r("100.0 * d / n")} AS taxa_dlq_pct, n AS eventos, d AS rejeitados
       FROM (SELECT COUNT(*) AS n, COUNT(motivo_rejeicao) AS d FROM ev) WHERE 100.0 * d / n > 10)"""
# The three kinds in one table.
_alerts = f"""(SELECT {_alert}, CAST(NULL AS TIMESTAMP) AS w FROM alert
       UNION ALL BY NAME SELECT 'LATENCIA_ACIMA_DO_SLA' AS tipo, 'ALTA' AS severidade, w, sigla_uf, latencia_p95_ms AS delta_pp,
       eventos AS avaliados FROM win WHERE latencia_p95_ms > 2000
       UNION ALL BY NAME SELECT tipo, 'ALTA' AS severidade, taxa_dlq_pct AS delta_pp, eventos AS avaliados FROM {_dlq_alert})"""


def every_alert(k: Lake):
    return ev.all_alerts(alerts(k), ev.latency_sla_alerts(windows(k)), ev.dlq_rate_alert(k.valid, k.dead))


@query("alert_sink", f"""SELECT {_alert} FROM {_alerts}
       ORDER BY severidade, delta_pp NULLS LAST, id_municipio NULLS LAST, sigla_uf NULLS LAST, w NULLS LAST LIMIT 10""")
def _(k: Lake):
    return ev.alert_sink(every_alert(k), f"{k.work}/alerts", F.lit("2024-02-01T00:00:00")).select(*_alert.split(", "))


@query("alert_counts", f"SELECT tipo, severidade, COUNT(*) AS n FROM {_alerts} GROUP BY ALL")
def _(k: Lake):
    return every_alert(k).groupBy("tipo", "severidade").agg(n_rows())


def replayed(k: Lake):
    """A folder with the events and, in later files, a third of them again."""
    folder, rows = f"{k.work}/replay_in", k.table("events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "value")
    rows.write.parquet(f"{folder}/part=0")
    rows.filter("event_id % 3 = 0").withColumn("value", F.col("value") + 1000).write.parquet(f"{folder}/part=1")
    return k.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option(
        "recursiveFileLookup", True).parquet(folder)


@query("dedup_stream", "SELECT event_id, user_id FROM events")
def _(k: Lake):
    sink = f"{k.work}/once"
    stream = pl.dedup_stream(replayed(k), "event_id", "ts", "60 days")
    pl.stream_available_now(stream.select("event_id", "user_id"), sink, f"{k.work}/cp_once")
    return k.spark.read.parquet(sink)


@query("upsert_batch", """SELECT event_id, user_id, CASE WHEN event_id % 3 = 0 THEN value + 1000 ELSE value END AS value
       FROM events""")
def _(k: Lake):
    target = f"{k.work}/upserted"
    pl.run_batches(replayed(k), pl.upsert_batch(target, ["event_id"], [F.desc("ts"), F.desc("value")]), f"{k.work}/cp_up")
    return pl.read_upserted(k.spark, target, ["event_id"]).select("event_id", "user_id", "value")


@query("upsert_levels", """SELECT event_id, user_id, CASE WHEN event_id % 3 = 0 THEN value + 1000 ELSE value END AS value,
       strftime(ts, '%Y-%m-%d') AS dia, true AS poucas_pastas FROM events""")
def _(k: Lake):
    """Batches by event date, in levels of three: few folders to read, the newest value of each id."""
    target, rows = f"{k.work}/levels", k.table("events").select("event_id", "user_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("dia"))
    again = rows.filter("event_id % 3 = 0").withColumn("value", F.col("value") + 1000)
    handle, part = pl.upsert_batch(target, ["event_id"], [F.desc("value")], "dia", 3), F.pmod(F.xxhash64("event_id"), F.lit(3))
    for i in range(6):  # three batches of events, three of corrections, the last again as after a failure
        handle((rows if i < 3 else again).filter(part == i % 3), i)
    handle(again.filter(part == 2), 5)
    few = len(levels.runs(k.spark, target)) <= 2 * 3
    return pl.read_upserted(k.spark, target, ["event_id"]).withColumn("poucas_pastas", F.lit(few))


@query("replay_idempotence", """SELECT COUNT(*) AS antes, COUNT(*) FILTER (event_id % 3 = 0) + COUNT(*) FILTER (event_id % 50 = 0)
       AS recebidas, COUNT(*) + COUNT(*) FILTER (event_id % 50 = 0) AS depois,
       COUNT(*) + COUNT(*) FILTER (event_id % 50 = 0) AS reaplicado, true AS inalterado FROM events""")
def _(k: Lake):
    old = k.table("events").select("event_id", "value")
    fresh = old.filter("event_id % 50 = 0").withColumn("event_id", F.col("event_id") + 10000000000)
    batch = old.filter("event_id % 3 = 0").unionByName(fresh)
    return ev.replay_idempotence(old, batch, ["event_id"], [F.desc("value")])


@query("microbatch_sink", """SELECT strftime(data_evento, '%Y-%m-%d') AS data_evento, COUNT(*) AS n FROM valid GROUP BY 1""")
def _(k: Lake):
    path = f"{k.work}/micro"
    pl.microbatch_sink(typed_stream(k), path, f"{k.work}/cp_micro", "run-1")
    return k.spark.read.parquet(path).groupBy(F.col("data_evento").cast("string").alias("data_evento")).agg(n_rows())


@query("dlq_audit", """SELECT _defeito_injetado AS defeito, split_part(motivo_rejeicao, ':', 1) AS motivo,
       COUNT(*) AS eventos FROM dead GROUP BY ALL""")
def _(k: Lake):
    return ev.dlq_audit(k.dead)


@query("partition_spread_total", """SELECT COUNT(*) AS mensagens, 4::BIGINT AS particoes, true AS cada_chave_numa_so FROM events""")
def _(k: Lake):
    """All messages are in the four partitions, and every key in one."""
    spread = ev.partition_spread(k.table("events"), "user_id", 4)
    keys = k.table("events").groupBy("user_id").agg(F.count_distinct(fx.key_bucket("user_id", 4)).alias("n"))
    return spread.agg(F.sum("mensagens").alias("mensagens"), F.count(F.lit(1)).alias("particoes")).withColumn(
        "cada_chave_numa_so", keys.agg(F.max("n") == 1).scalar())


@query("partition_spread")
def _(k: Lake):
    return ev.partition_spread(k.table("events"), "user_id", 4)


_topic = """WITH m AS (SELECT 'avaliacoes' AS topic, CAST(id_municipio % 4 AS INT) AS "partition", event_id FROM ev0),
    e AS (SELECT topic, "partition", MAX(event_id) + 1 AS end_offset FROM m GROUP BY ALL),
    c AS (SELECT topic, "partition", MAX(event_id) + 1 AS committed FROM m WHERE event_id % 10 = 0 AND "partition" <> 3 GROUP BY ALL)"""


def lag(k: Lake):
    rows = messages(k).select("topic", "partition", "offset")
    last = F.max("offset") + 1
    done = rows.filter("offset % 10 = 0 AND partition <> 3")
    return ev.consumer_lag(rows.groupBy("topic", "partition").agg(last.alias("end_offset")),
                           done.groupBy("topic", "partition").agg(last.alias("committed")))


@query("consumer_lag", f"""{_topic} SELECT topic, e."partition", end_offset, coalesce(committed, 0) AS committed,
       end_offset - coalesce(committed, 0) AS lag FROM e LEFT JOIN c USING (topic, "partition")""")
def _(k: Lake):
    return lag(k)


_cuts = ", ".join(rq(f"quantile_cont(latencia_ms, {p})", 1) + f" AS latencia_{n}_ms" for p, n in (
    (0.5, "p50"), (0.9, "p90"), (0.95, "p95"), (0.99, "p99")))
_metrics = f"""(SELECT (SELECT COUNT(*) FROM ev) AS eventos_processados, COUNT(*) AS eventos_validos,
    (SELECT COUNT(*) FROM dead) AS eventos_dlq, {r("100.0 * (SELECT COUNT(*) FROM dead) / (SELECT COUNT(*) FROM ev)")} AS taxa_dlq_pct,
    {_cuts}, CAST((SELECT SUM(end_offset - coalesce(committed, 0)) FROM e LEFT JOIN c USING (topic, "partition")) AS BIGINT) AS lag_total,
    (SELECT COUNT(*) FROM win) AS janelas_processadas, (SELECT COUNT(*) FROM {_alerts}) AS alertas_gerados FROM valid)"""


def metrics(k: Lake):
    return ev.stream_metrics(k.valid, k.dead, windows(k), every_alert(k), lag(k))


@query("stream_metrics", f"{_topic} SELECT *, true AS tem_vazao, 1::BIGINT AS lotes, 0::BIGINT AS linhas_estado FROM {_metrics}")
def _(k: Lake):
    """Totals with the rates of the query that processed the events."""
    sink = f"{k.work}/metrics_sink"
    run = pl.stream_available_now(k.classify(k.as_events(raw_stream(k))), sink, f"{k.work}/cp_metrics")
    rates = st.throughput(st.query_progress(k.spark, run))
    out = ev.stream_metrics(k.valid, k.dead, windows(k), every_alert(k), lag(k), rates)
    return out.withColumn("tem_vazao", F.col("throughput_msg_s") > 0).drop("throughput_msg_s")


@query("stream_progress", """SELECT COUNT(*) AS linhas, COUNT(*) AS no_destino, true AS tem_vazao,
       COUNT(DISTINCT user_id) AS linhas_estado FROM events""")
def _(k: Lake):
    """Rows, rate and rows of state by the progress of a query, beside what its sink holds."""
    counts = raw_stream(k).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    target = f"{k.work}/progress"
    with st.rocksdb_state(k.spark):
        run = pl.run_batches(counts, pl.upsert_batch(target, ["user_id"], [F.desc("n")]), f"{k.work}/cp_progress", "update")
    written = pl.read_upserted(k.spark, target, ["user_id"]).agg(F.sum("n")).scalar()
    return st.throughput(st.query_progress(k.spark, run)).select(
        "linhas", written.alias("no_destino"), (F.col("throughput_msg_s") > 0).alias("tem_vazao"), "linhas_estado")


_ok = lambda name, test: f"SELECT '{name}' AS verificacao, CASE WHEN {test} THEN 'OK' ELSE 'ATENÇÃO' END AS status FROM s"


@query("stream_health", f"{_topic}, s AS (SELECT * FROM {_metrics}) " + " UNION ALL ".join([
    _ok("Consumer lag zerado", "lag_total = 0"), _ok("Latência p95 dentro do SLA", "latencia_p95_ms < 2000"),
    _ok("Taxa de DLQ abaixo de 10%", "taxa_dlq_pct < 10"), _ok("Todos os eventos válidos persistidos", "eventos_validos = (SELECT COUNT(*) FROM valid)")]))
def _(k: Lake):
    good, bad = f"{k.work}/health_valid", f"{k.work}/health_dlq"
    pl.run_batches(k.classify(k.as_events(raw_stream(k))), pl.two_sink_batch(good, bad, CUT, k.processed_at()), f"{k.work}/cp_health")
    written = k.spark.read.parquet(good)  # what the sink holds
    return ev.stream_health(metrics(k), written.agg(F.count(F.lit(1))).scalar())
