"""Stage metrics, run summaries and history."""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

STAGE_SCHEMA = ("etapa string, camada string, status string, duracao_segundos double, linhas_entrada bigint, "
                "linhas_saida bigint, linhas_rejeitadas bigint, taxa_rejeicao_pct double, "
                "throughput_linhas_s double, erro string")
ALERT_SCHEMA = "severidade string, mensagem string"


class Stage:
    """Counters of one stage. ``count`` attaches an observation, so rows are
    counted while they are written and no extra job runs."""

    def __init__(self, name: str, layer: str):
        self.name, self.layer = name, layer
        self.rows = {"entrada": 0, "saida": 0, "rejeitadas": 0}
        self.alerts: list[tuple[str, str]] = []
        self.row: tuple | None = None
        self._observed: list[tuple[str, Observation]] = []

    def count(self, df: DataFrame, what: str) -> DataFrame:
        seen = Observation()
        self._observed.append((what, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("n"))

    def close(self, seconds: float, error: str | None, sla_s: float, max_reject_pct: float) -> None:
        if error is None:
            for what, seen in self._observed:
                self.rows[what] += seen.get["n"]
        base = self.rows["entrada"] or self.rows["saida"]
        reject = round(self.rows["rejeitadas"] / base * 100, 2) if base else 0.0
        # Severities and texts of the alerts.
        if error:
            self.alerts.append(("CRITICAL", f"Falha na etapa '{self.name}': {error}"))
        if seconds > sla_s:
            self.alerts.append(("WARNING", f"Etapa '{self.name}' levou {seconds}s (SLA {sla_s}s)"))
        if reject > max_reject_pct:
            self.alerts.append(("WARNING", f"Etapa '{self.name}' rejeitou {reject}% das linhas"))
        self.row = (self.name, self.layer, "FALHA" if error else "OK", seconds, self.rows["entrada"],
                    self.rows["saida"], self.rows["rejeitadas"], reject,
                    round(base / seconds, 1) if seconds else 0.0, error)


@contextmanager
def stage_metrics(name: str, layer: str = "-", sla_s: float = 120.0, max_reject_pct: float = 5.0) -> Iterator[Stage]:
    stage, start, error = Stage(name, layer), time.perf_counter(), None
    try:
        yield stage
    except Exception as exc:
        error = f"{type(exc).__name__}: {exc}"
        raise
    finally:
        stage.close(round(time.perf_counter() - start, 3), error, sla_s, max_reject_pct)


def stages_frame(spark: SparkSession, *stages: Stage) -> tuple[DataFrame, DataFrame]:
    """(stage rows, alert rows) of finished stages."""
    alerts = [a for s in stages for a in s.alerts]
    return (spark.createDataFrame([s.row for s in stages], STAGE_SCHEMA),
            spark.createDataFrame(alerts, ALERT_SCHEMA))


def run_summary(stages: DataFrame, alerts: DataFrame) -> DataFrame:
    """One row: stages, failures, rows, rejects, alerts, critical alerts."""
    told = alerts.agg(F.struct(F.count(F.lit(1)).alias("a"),
                               F.count_if(F.col("severidade") == "CRITICAL").alias("c")).alias("s")).scalar()
    return (stages.agg(F.count(F.lit(1)).alias("etapas_executadas"),
                       F.count_if(F.col("status") == "FALHA").alias("etapas_com_falha"),
                       F.coalesce(F.sum("linhas_saida"), F.lit(0)).alias("linhas_processadas"),
                       F.coalesce(F.sum("linhas_rejeitadas"), F.lit(0)).alias("linhas_rejeitadas"))
            .withColumn("_t", told)
            .select("*", F.col("_t.a").alias("alertas"), F.col("_t.c").alias("alertas_criticos")).drop("_t"))


def run_history(spark: SparkSession, path: str, entry: Mapping[str, object]) -> DataFrame:
    """Append who wrote what, when and how many rows; return the history.

    The entry's ``run_id`` names its own folder, so a repeated call replaces it.
    """
    when = entry.get("em") or datetime.now(timezone.utc).isoformat(timespec="seconds")
    row = [(str(entry["tabela"]), str(entry["operacao"]), int(entry["linhas"]), str(when))]
    (spark.createDataFrame(row, "tabela string, operacao string, linhas bigint, em string")
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/run_id={entry['run_id']}"))
    return spark.read.option("basePath", path).parquet(path)


@contextmanager
def cache_reuse(df: DataFrame) -> Iterator[DataFrame]:
    """A frame that several marts read: kept (memory, then disk), filled once, and released at the end."""
    kept = df.persist()
    try:
        kept.write.format("noop").mode("overwrite").save()
        yield kept
    finally:
        kept.unpersist()
