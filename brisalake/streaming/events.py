"""Event logic as plain DataFrame functions.

Every function works on a batch frame and, unless it says otherwise, on a
streaming frame; the stream wiring is in ``pipeline``. Reasons, alert types and
severities are fixed values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brisalake.functions import (
    as_col, cutoff_flag, decode_domain, exact_sum, fn_latency, head_before, key_bucket,
    parse_timestamp, round_half_away, round_settled, safe_ratio, weighted_rate)
from brisalake.operators.joins import broadcast_if_small
from brisalake.operators.ladder import join_same, quantiles
from brisalake.operators.windows import upsert_keep_last

EVENT_SCHEMA = ("id_evento string, tipo_evento string, ts_evento string, id_municipio bigint, id_escola string, "
                "id_aluno string, rede int, serie int, proficiencia_portugues double, peso_aluno double, "
                "origem string, _defeito_injetado string")
REQUIRED = ("id_evento", "tipo_evento", "ts_evento", "id_municipio", "rede", "proficiencia_portugues")
NETWORKS = {0: "Total", 1: "Federal", 2: "Estadual", 3: "Municipal", 4: "Privada", 5: "Publica"}
PASS_SCORE = 743.0


def parse_payload(messages: DataFrame, schema: str | T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Message rows (key, value, topic, partition, offset) to typed events.

    A payload that is not JSON gives an event of nulls, which validation rejects.
    """
    body = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(F.col("key").cast("string").alias("chave"), "topic", "partition", "offset",
                           F.col("value").cast("string").alias("evento_original"), body.alias("e")
                           ).select("*", "e.*").drop("e")


def validate_event(events: DataFrame, dim: DataFrame, lo: float = 200.0, hi: float = 1000.0,
                   required: Sequence[str] = REQUIRED) -> DataFrame:
    """Events with territory, parsed time and ``motivo_rejeicao`` (null if valid).

    The first failing test in order: mandatory fields, numeric score, score
    range, known unit, readable time. Detail may follow after a colon.
    ``dim`` is unique per id_municipio.
    """
    known = dim.withColumn("_known", F.lit(True))
    joined = (events.join(broadcast_if_small(known), "id_municipio", "left")
              .withColumn("ts_convertido", parse_timestamp("ts_evento")))
    score = F.col("proficiencia_portugues").try_cast("double")
    absent = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    reason = (F.when(F.size(absent) > 0, F.concat(F.lit("campos_obrigatorios_ausentes:"), F.array_join(absent, ",")))
              .when(score.isNull(), "proficiencia_nao_numerica")
              .when(~score.between(lo, hi), F.concat(F.lit("proficiencia_fora_de_faixa:"), score.cast("string")))
              .when(F.col("_known").isNull(),
                    F.concat(F.lit("municipio_inexistente:"), F.col("id_municipio").cast("string")))
              .when(F.col("ts_convertido").isNull(), "timestamp_invalido"))
    return joined.withColumn("motivo_rejeicao", reason).drop("_known")


def route_dead_letters(classified: DataFrame, rejected_at: Column | None = None) -> DataFrame:
    """Invalid events with reason, original payload, origin and time of rejection."""
    origin = lambda c, kind: F.col(c) if c in classified.columns else F.lit(None).cast(kind)
    own = [c for c in classified.columns
           if c not in ("motivo_rejeicao", "ts_convertido", "topic", "partition", "offset", "evento_original")]
    payload = (F.col("evento_original") if "evento_original" in classified.columns
               else F.to_json(F.struct(*own)))
    return classified.filter(F.col("motivo_rejeicao").isNotNull()).select(
        "id_evento", payload.alias("evento_original"), "motivo_rejeicao",
        origin("topic", "string").alias("topico_origem"), origin("partition", "int").alias("particao"),
        origin("offset", "bigint").alias("offset"), origin("_defeito_injetado", "string").alias("_defeito_injetado"),
        (F.current_timestamp() if rejected_at is None else rejected_at).alias("ts_rejeicao"))


def enrich_event(classified: DataFrame, cut: float = PASS_SCORE, proc_ts: Column | None = None,
                 networks: Mapping[int, str] = NETWORKS) -> DataFrame:
    """Valid events with network label, pass flag, latency, date and default weight."""
    now = F.current_timestamp() if proc_ts is None else proc_ts
    return (classified.filter(F.col("motivo_rejeicao").isNull())
            .withColumns({
                "rede_nome": decode_domain("rede", networks, "Desconhecida"),
                "alfabetizado": cutoff_flag("proficiencia_portugues", cut),
                "peso_aluno": F.coalesce("peso_aluno", F.lit(1.0)),
                "ts_processamento": now, "latencia_ms": fn_latency("ts_convertido", now).cast("double"),
                "data_evento": F.to_date("ts_convertido")})
            .drop("motivo_rejeicao", "_defeito_injetado"))


def window_counts(events: DataFrame, duration: str, by: str, ts: str = "ts_convertido") -> DataFrame:
    """Events, weight and passed weight per window, key and latency: what windows can be put together from.

    Counts of several batches add up, so a stream appends one small table per
    micro-batch; late events are in it like any other.
    """
    passed = F.coalesce(exact_sum(F.when(F.col("alfabetizado"), F.col("peso_aluno"))), F.lit(0.0))
    return (events.withColumn("janela_inicio", F.window(ts, duration)["start"]).filter(F.col("janela_inicio").isNotNull())
            .groupBy("janela_inicio", by, "latencia_ms")
            .agg(F.count(F.lit(1)).alias("n"), exact_sum("peso_aluno").alias("peso"), passed.alias("peso_alfabetizados")))


def windows_of(counts: DataFrame, by: str) -> DataFrame:
    """Event-time window and key from ``window_counts``: events, weighted rate, exact p50 and p95 latency."""
    keys = ["janela_inicio", by]
    rate = F.try_divide(100.0 * exact_sum("peso_alfabetizados"), exact_sum("peso"))
    sums = counts.groupBy(*keys).agg(F.sum("n").alias("eventos"), rate.alias("r"))
    cuts = quantiles(counts, keys, "latencia_ms", {"p50": 0.5, "p95": 0.95}, weight="n")
    return join_same(sums, cuts, keys).select(
        *keys, "eventos", round_half_away("r").alias("taxa_pct"),
        round_settled("p50", 1).alias("latencia_p50_ms"), round_settled("p95", 1).alias("latencia_p95_ms"))


def tumbling_window_agg(events: DataFrame, duration: str, by: str, ts: str = "ts_convertido") -> DataFrame:
    """Event-time window and key of a batch; a stream collects ``window_counts`` and reads ``windows_of`` them."""
    return windows_of(window_counts(events, duration, by, ts), by)


def keyed_running_state(events: DataFrame, key: Sequence[str]) -> DataFrame:
    """Count, weight and passed weight per unit."""
    return events.groupBy(*key).agg(
        F.count(F.lit(1)).alias("avaliados"), exact_sum("peso_aluno").alias("peso"),
        F.coalesce(exact_sum(F.when(F.col("alfabetizado"), F.col("peso_aluno"))), F.lit(0.0)).alias("peso_alfabetizados"))


def window_late_data(events: DataFrame, duration: str, delay: str, ts: str = "ts_convertido") -> DataFrame:
    """Events per window; on a stream rows later than ``delay`` are dropped."""
    return (events.withWatermark(ts, delay).groupBy(F.window(ts, duration).alias("_w"))
            .agg(F.count(F.lit(1)).alias("eventos"))
            .select(F.col("_w.start").alias("janela_inicio"), "eventos"))


def baseline_alerts(state: DataFrame, baseline: DataFrame, min_n: int = 20, drop: float = 10.0,
                    floor: float = 50.0) -> DataFrame:
    """Units with enough events that fall below their official rate or the floor.

    Comparison is on unrounded rates and strict; values are rounded for display.
    """
    rate = F.try_divide(100.0 * F.col("peso_alfabetizados"), F.col("peso"))
    joined = (state.filter(F.col("avaliados") >= min_n).withColumn("_r", rate)
              .join(baseline.select("id_municipio", F.col("taxa_alfabetizacao").alias("_o")), "id_municipio", "left"))
    kind = (F.when(F.col("_r") < F.col("_o") - drop, "QUEDA_DE_DESEMPENHO").when(F.col("_r") < floor, "ABAIXO_DA_META"))
    return (joined.withColumn("tipo", kind).filter(F.col("tipo").isNotNull())
            .withColumn("severidade", F.when(F.col("tipo") == "QUEDA_DE_DESEMPENHO", "ALTA").otherwise("MEDIA"))
            .select("tipo", "severidade", *[c for c in state.columns if c not in ("peso", "peso_alfabetizados")],
                    round_half_away("_r").alias("taxa_stream_pct"), round_half_away("_o").alias("taxa_oficial_pct"),
                    round_half_away(F.col("_r") - F.col("_o")).alias("delta_pp")))


def latency_sla_alerts(windows: DataFrame, sla_ms: float = 2000.0) -> DataFrame:
    """Windows whose p95 latency is above the agreed limit."""
    return windows.filter(F.col("latencia_p95_ms") > sla_ms).select(
        F.lit("LATENCIA_ACIMA_DO_SLA").alias("tipo"), F.lit("ALTA").alias("severidade"), "janela_inicio",
        "sigla_uf", F.col("latencia_p95_ms").alias("delta_pp"), F.col("eventos").alias("avaliados"))


def dlq_rate_alert(valid: DataFrame, dlq: DataFrame, max_pct: float = 10.0) -> DataFrame:
    """One row if more than ``max_pct`` percent of the events were rejected."""
    bad = dlq.agg(F.count(F.lit(1))).scalar()
    pct = safe_ratio(100.0 * F.col("rejeitados"), F.col("eventos"))
    return (valid.agg(F.count(F.lit(1)).alias("v")).withColumn("rejeitados", bad)
            .withColumn("eventos", F.col("v") + F.col("rejeitados"))
            .select(F.lit("TAXA_DLQ_ALTA").alias("tipo"), round_half_away(pct).alias("taxa_dlq_pct"), "eventos",
                    "rejeitados").filter(pct > max_pct))


def all_alerts(baseline: DataFrame, slow: DataFrame, rejected: DataFrame) -> DataFrame:
    """One table of the three kinds of alert: units below their baseline, slow windows, too many rejected events."""
    dlq = rejected.select("tipo", F.lit("ALTA").alias("severidade"), F.col("taxa_dlq_pct").alias("delta_pp"),
                          F.col("eventos").alias("avaliados"))
    return baseline.unionByName(slow, True).unionByName(dlq, True)


def alert_sink(alerts: DataFrame, path: str, at: Column, n: int = 10) -> DataFrame:
    """Store the alerts with their time; return the ``n`` most severe."""
    alerts.withColumn("ts_alerta", at).write.mode("overwrite").parquet(path)
    stored = alerts.sparkSession.read.parquet(path)
    ties = [F.asc_nulls_last(c) for c in ("delta_pp", "id_municipio", "sigla_uf", "janela_inicio") if c in stored.columns]
    return stored.orderBy("severidade", *ties).limit(n)


def replay_idempotence(existing: DataFrame, batch: DataFrame, key: Sequence[str],
                       order_by: Sequence[Column]) -> DataFrame:
    """Rows before, after one upsert and after a second one of the same batch."""
    once = upsert_keep_last(existing, batch, key, order_by)
    twice = upsert_keep_last(once, batch, key, order_by)
    n = F.count(F.lit(1))
    return (existing.agg(n.alias("antes")).withColumn("recebidas", batch.agg(n).scalar())
            .withColumn("depois", once.agg(n).scalar()).withColumn("reaplicado", twice.agg(n).scalar())
            .withColumn("inalterado", F.col("depois") == F.col("reaplicado")))


def dlq_audit(dlq: DataFrame, injected: str = "_defeito_injetado", reason: str = "motivo_rejeicao") -> DataFrame:
    """Injected defect against detected reason."""
    return dlq.groupBy(F.col(injected).alias("defeito"), head_before(reason).alias("motivo")).agg(
        F.count(F.lit(1)).alias("eventos"))


def partition_spread(df: DataFrame, key: str, n: int) -> DataFrame:
    """Messages per partition when keys are hashed."""
    return df.groupBy(key_bucket(key, n).alias("particao")).agg(F.count(F.lit(1)).alias("mensagens"))


def consumer_lag(end_offsets: DataFrame, committed: DataFrame) -> DataFrame:
    """Per partition: end offset minus committed offset, which is 0 if there is none."""
    return (end_offsets.join(committed, ["topic", "partition"], "left")
            .withColumn("committed", F.coalesce("committed", F.lit(0).cast("bigint")))
            .withColumn("lag", F.col("end_offset") - F.col("committed")))


def stream_metrics(valid: DataFrame, dlq: DataFrame, windows: DataFrame, alerts: DataFrame, lag: DataFrame,
                   rates: DataFrame | None = None) -> DataFrame:
    """One row of totals, reject rate, latency percentiles, lag, windows and alerts.

    ``rates`` is the row of ``state.throughput`` for the query that processed the
    events: it adds the micro-batches, the rows a second and the rows of state.
    """
    n = F.count(F.lit(1))
    cuts = quantiles(valid, [], "latencia_ms", {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99})
    one = (valid.agg(n.alias("eventos_validos")).withColumn("eventos_dlq", dlq.agg(n).scalar())
           .withColumn("q", cuts.select(F.struct("*")).scalar())
           .withColumn("lag_total", lag.agg(F.coalesce(F.sum("lag"), F.lit(0))).scalar())
           .withColumn("janelas_processadas", windows.agg(n).scalar())
           .withColumn("alertas_gerados", alerts.agg(n).scalar()))
    total = F.col("eventos_validos") + F.col("eventos_dlq")
    out = one.select(
        total.alias("eventos_processados"), "eventos_validos", "eventos_dlq",
        F.coalesce(safe_ratio(100.0 * F.col("eventos_dlq"), total, 2), F.lit(0.0)).alias("taxa_dlq_pct"),
        *[round_settled(F.coalesce(F.col(f"q.{p}"), F.lit(0.0)), 1).alias(f"latencia_{p}_ms")
          for p in ("p50", "p90", "p95", "p99")],
        "lag_total", "janelas_processadas", "alertas_gerados")
    if rates is None:
        return out
    run = rates.select(F.struct("lotes", "throughput_msg_s", "linhas_estado").alias("_run")).scalar()
    return out.withColumn("_run", run).select("*", "_run.*").drop("_run")


def stream_health(metrics: DataFrame, written: Column, sla_ms: float = 2000.0, max_dlq_pct: float = 10.0) -> DataFrame:
    """Four signals, OK or ATENÇÃO."""
    tests = [("Consumer lag zerado", F.col("lag_total") == 0),
             ("Latência p95 dentro do SLA", F.col("latencia_p95_ms") < sla_ms),
             (f"Taxa de DLQ abaixo de {max_dlq_pct:g}%", F.col("taxa_dlq_pct") < max_dlq_pct),
             ("Todos os eventos válidos persistidos", written == F.col("eventos_validos"))]
    rows = [F.struct(F.lit(name).alias("verificacao"),
                     F.when(ok, "OK").otherwise("ATENÇÃO").alias("status")) for name, ok in tests]
    return metrics.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
