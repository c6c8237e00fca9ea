"""The driver tables seen as an indicator lake.

Only this module knows the star-schema tables; every operator works on any
frame with the documented columns.

units     customer with its nation and region (``rede`` is the market segment)
micro     lineitem of the customer's orders; evaluated if shipped status is F
fact      rate and mean score per year and unit, weighted by quantity
targets   wide targets per unit, two declared revisions
events    assessment events with known defects
"""

from __future__ import annotations

import threading
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from brisalake.functions import decode_domain, encode_text_domain, exact_sum, round_half_away, safe_ratio
from brisalake.operators.joins import integrated_fact
from brisalake.operators.reshape import target_trajectory
from brisalake.session import shared_folder
from brisalake.streaming.events import enrich_event, keyed_running_state, route_dead_letters, validate_event

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
SEGMENTS = {"furniture": 0, "automobile": 1, "machinery": 2, "building": 3, "household": 5}
FOCUS, LAST_YEAR = 3, 2001
SCORE_RANGE, CUT = (0.0, 1000.0), 50.0


@dataclass
class Silver:
    """Where the silver tables of one input folder are, and what is known of them."""

    root: str
    schemas: dict[str, StructType] = field(default_factory=dict)
    inputs: dict[str, DataFrame] = field(default_factory=dict)


_SILVER: dict[tuple[str, str], Silver] = {}
_LOCK = threading.RLock()


class Lake:
    """View of one input folder; the input tables must not change during the session."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        key = (spark.sparkContext.applicationId, folder)
        with _LOCK:
            if key not in _SILVER:
                _SILVER[key] = Silver(shared_folder(spark))
            self._silver = _SILVER[key]

    def table(self, name: str) -> DataFrame:
        if name not in self._silver.inputs:
            self._silver.inputs[name] = self.spark.read.parquet(self.path(name))
        return self._silver.inputs[name]

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    @cached_property
    def work(self) -> str:
        return shared_folder(self.spark)

    def stored(self, name: str, build) -> DataFrame:
        """Silver table: written once per session and folder to shared storage, then read.

        Marts and reports read the same silver tables, so the joins below them
        run once and lineage stays short. A table that is gone is built again.
        """
        path = f"{self._silver.root}/{name}"
        with _LOCK:
            if name in self._silver.schemas:
                try:
                    return self.spark.read.schema(self._silver.schemas[name]).parquet(path)
                except AnalysisException:
                    del self._silver.schemas[name]
            build().write.mode("overwrite").option("compression", "zstd").parquet(path)
            df = self.spark.read.parquet(path)
            self._silver.schemas[name] = df.schema
            return df

    def landed(self, name: str) -> str:
        """Folder of a silver table that has been stored."""
        getattr(self, name)
        return f"{self._silver.root}/{name}"

    @property
    def states(self) -> DataFrame:
        n, r = self.table("nation"), self.table("region")
        return n.join(r, n.n_regionkey == r.r_regionkey).select(
            F.col("n_nationkey").alias("id_uf"), F.col("n_name").alias("sigla_uf"),
            F.col("n_name").alias("nome_uf"), F.col("r_name").alias("nome_regiao"))

    @property
    def units(self) -> DataFrame:
        c = self.table("customer").select(
            F.col("c_custkey").alias("id_municipio"), F.col("c_name").alias("nome_municipio"),
            F.col("c_nationkey").alias("id_uf"), F.col("c_mktsegment").alias("rede_nome"),
            encode_text_domain("c_mktsegment", SEGMENTS).alias("rede"))
        return c.join(self.states, "id_uf", "left").withColumn("nome_mesorregiao", F.col("nome_regiao"))

    @property
    def order_units(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), F.year("o_orderdate").alias("ano"),
            F.col("o_custkey").alias("id_municipio"))

    @property
    def pupils(self) -> DataFrame:
        """Microdata without the unit's attributes; lineitem and orders meet once for all that read it."""
        return self.stored("pupils", self._pupils)

    def _pupils(self) -> DataFrame:
        """Texts become flags and scores before the join, so that only narrow rows are shuffled."""
        lines = self.table("lineitem").select(
            "l_orderkey", "l_linenumber", F.col("l_quantity").alias("peso_aluno"), (F.col("l_returnflag") != "R").alias("alfabetizado"),
            F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice")).alias("proficiencia_portugues"))
        return lines.join(self.order_units, "l_orderkey").select(
            "ano", "id_municipio", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id_aluno"),
            F.lit(2).alias("serie"), "proficiencia_portugues", "peso_aluno", "alfabetizado",
            F.col("proficiencia_portugues").isNotNull().alias("avaliado"))

    def _with_network(self, pupils: DataFrame) -> DataFrame:
        return pupils.join(self.units.select("id_municipio", "rede", "rede_nome"), "id_municipio")

    @property
    def micro(self) -> DataFrame:
        """Stores the pupils: a query that needs them beside the fact asks for them first."""
        return self._with_network(self.pupils)

    @property
    def micro_plan(self) -> DataFrame:
        """The same rows, not stored, for reports that use few of their columns or none."""
        return self._with_network(self._pupils())

    @property
    def sums(self) -> DataFrame:
        """Rate, participation, state and country context all come from these sums."""
        return self.stored("sums", self._sums)

    def _sums(self) -> DataFrame:
        """Exact sums per year and unit, reduced before the unit's attributes are joined.

        Pupils that are stored are read; they are not stored for the sums alone.
        """
        w, seen, ok = F.col("peso_aluno"), F.col("avaliado"), F.col("alfabetizado")
        rows = self.pupils if "pupils" in self._silver.schemas else self._pupils()
        agg = rows.groupBy("ano", "id_municipio").agg(
            F.count(F.lit(1)).alias("alunos"), F.count_if(seen).alias("avaliados"),
            exact_sum(F.when(seen, w)).alias("w"), exact_sum(F.when(seen & ok, w)).alias("wp"),
            exact_sum(F.when(seen, F.col("proficiencia_portugues") * w)).alias("wx"))
        return agg.join(self.units, "id_municipio")

    @staticmethod
    def _rate() -> Column:
        passed = F.coalesce(exact_sum("wp"), F.lit(0.0))
        return round_half_away(safe_ratio(100.0 * passed, exact_sum("w")))

    @property
    def fact(self) -> DataFrame:
        d = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("double")
        rate = safe_ratio(100.0 * d("wp"), "w", 2)
        return self.sums.select(
            "ano", "id_municipio", F.lit(2).alias("serie"), "rede", "rede_nome", "id_uf",
            rate.alias("taxa_alfabetizacao"), safe_ratio("wx", "w", 2).alias("media_portugues"),
            (rate >= 80.0).alias("alcancou_meta_2030"),
            safe_ratio(100.0 * F.col("avaliados"), "alunos", 2).alias("participacao"))

    @property
    def fact_units(self) -> DataFrame:
        """Fact with state and region, the frame most queries use."""
        return self.fact.join(self.units.select("id_municipio", "sigla_uf", "nome_regiao"), "id_municipio")

    @property
    def targets_wide(self) -> DataFrame:
        unit = F.col("id_municipio")
        base = self.units.select("id_municipio", F.concat(F.lit(" "), F.lower("rede_nome"), F.lit(" ")).alias("rede"),
                                 F.explode(F.array(F.lit(1998), F.lit(1999))).alias("ano"))
        goal = lambda y: F.when(F.pmod(unit, F.lit(5)) != 0,
                                (F.pmod(unit * 7 + y * 3 + F.col("ano"), F.lit(41)) + 40).cast("double"))
        return base.withColumns({f"meta_alfabetizacao_{y}": goal(y) for y in (1999, 2000, 2001)})

    @property
    def targets(self) -> DataFrame:
        return target_trajectory(self.targets_wide, ["id_municipio"], encode_text_domain("rede", SEGMENTS), "ano")

    @property
    def participation(self) -> DataFrame:
        """Only the network in focus reports participation."""
        return self.fact.filter(F.col("rede") == FOCUS).select(
            "ano", "id_municipio", "rede", F.col("participacao").alias("percentual_participacao"),
            F.floor(F.col("participacao") / 10).cast("double").alias("nivel_alfabetizacao"))

    @property
    def state_rate(self) -> DataFrame:
        return self.sums.groupBy("ano", "sigla_uf", "rede").agg(self._rate().alias("taxa_uf"))

    @property
    def country_rate(self) -> DataFrame:
        return self.sums.groupBy("ano").agg(self._rate().alias("taxa_brasil_publica"))

    @property
    def state_fact(self) -> DataFrame:
        return self.sums.groupBy("ano", "sigla_uf", "nome_uf", "nome_regiao", "rede", "rede_nome").agg(
            self._rate().alias("taxa_alfabetizacao"),
            safe_ratio(exact_sum("wx"), exact_sum("w"), 2).alias("media_portugues"))

    @property
    def state_targets(self) -> DataFrame:
        grid = self.states.filter(F.pmod("id_uf", F.lit(5)) != 0).select(
            "id_uf", "sigla_uf", F.explode(F.array(*[F.lit(v) for v in SEGMENTS.values()])).alias("rede"))
        return grid.withColumn("ano_meta", F.explode(F.array(F.lit(1999), F.lit(2000), F.lit(2001)))).select(
            "sigla_uf", "rede", "ano_meta",
            (F.pmod(F.col("id_uf") * 7 + F.col("ano_meta") * 3, F.lit(41)) + 40).cast("double").alias("meta_taxa"))

    @property
    def integrated(self) -> DataFrame:
        return self.stored("integrated", lambda: self.integrated_plan)

    @property
    def integrated_plan(self) -> DataFrame:
        return integrated_fact(self.fact.drop("participacao", "id_uf"), self.units, self.targets, self.participation,
                               self.state_rate, self.country_rate, LAST_YEAR, 80.0)

    @property
    def level_source(self) -> DataFrame:
        li = self.table("lineitem").select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
        return li.join(self.order_units, "l_orderkey").join(
            self.units.select("id_municipio", "rede", "rede_nome"), "id_municipio")

    # --- events ---------------------------------------------------------------
    @staticmethod
    def as_events(raw: DataFrame) -> DataFrame:
        kind = F.pmod("event_id", F.lit(20))
        # The defect names and the unreadable time.
        defect = (F.when(kind == 0, "score_ausente").when(kind == 1, "score_fora_de_faixa")
                  .when(kind == 2, "unidade_inexistente").when(kind == 3, "timestamp_malformado"))
        text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
        return raw.select(
            F.col("event_id").cast("string").alias("id_evento"), F.col("event_type").alias("tipo_evento"),
            F.when(kind == 3, "ontem de manha").otherwise(text).alias("ts_evento"),
            F.when(kind == 2, F.lit(9999999)).otherwise(F.col("user_id")).cast("bigint").alias("id_municipio"),
            F.lit("E1").alias("id_escola"), F.col("event_id").cast("string").alias("id_aluno"),
            F.pmod("event_id", F.lit(6)).cast("int").alias("rede"), F.lit(2).alias("serie"),
            F.when(kind == 0, F.lit(None)).when(kind == 1, 2500.0).otherwise(F.col("value")).alias("proficiencia_portugues"),
            F.get_json_object("props", "$.k").try_cast("double").alias("peso_aluno"), F.lit("tabela").alias("origem"),
            defect.alias("_defeito_injetado"))

    @property
    def events(self) -> DataFrame:
        return self.as_events(self.table("events"))

    @property
    def event_units(self) -> DataFrame:
        return self.units.select("id_municipio", "nome_municipio", "sigla_uf", "nome_regiao")

    @staticmethod
    def processed_at() -> Column:
        """Fixed processing time: event time plus 0 to 4,999 ms."""
        shift = F.pmod(F.col("id_evento").cast("bigint") * 37, F.lit(5000))
        return F.timestamp_millis(F.unix_millis("ts_convertido") + shift)

    def classify(self, events: DataFrame) -> DataFrame:
        return validate_event(events, self.event_units, *SCORE_RANGE)

    @property
    def valid(self) -> DataFrame:
        return self.stored("valid", lambda: enrich_event(self.classify(self.events), CUT, self.processed_at()))

    @property
    def dead(self) -> DataFrame:
        return self.stored("dead", lambda: route_dead_letters(
            self.classify(self.events), F.lit("2024-02-01T00:00:00")))

    @property
    def state(self) -> DataFrame:
        return keyed_running_state(self.valid, ["id_municipio", "nome_municipio", "sigla_uf"])

    @property
    def baseline(self) -> DataFrame:
        return self.fact.filter(F.col("ano") == LAST_YEAR).select("id_municipio", "taxa_alfabetizacao")

    @property
    def networks(self) -> Column:
        return decode_domain("rede", SEGMENTS)
