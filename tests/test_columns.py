import math

import pytest
from pyspark.sql import functions as F

from brisalake import functions as fx
from brisalake.plans.marts import RISK_CUTS, RISK_LABELS


def values(df, col):
    return [r[0] for r in df.select(col).collect()]


def test_left_closed_bands_keep_null(spark):
    df = spark.createDataFrame([(None,), (649.99,), (650.0,), (699.99,), (700.0,), (742.99,), (743.0,), (799.99,), (800.0,)], "s double")
    labels = ("Muito baixa", "Baixa", "Abaixo do corte", "Adequada", "Avancada")
    got = values(df, fx.band_left_closed("s", (650, 700, 743, 800), labels))
    assert got == [None, "Muito baixa", "Baixa", "Baixa", "Abaixo do corte", "Abaixo do corte", "Adequada", "Adequada", "Avancada"]
    assert values(df.limit(1), fx.band_left_closed("s", RISK_CUTS, RISK_LABELS)) == [None]


def test_right_closed_bands_include_first_edge(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 50.0, 50.1, 70.0, 85.0, 85.1, 100.0, 100.1, -1.0, None)], "s double")
    got = values(df, fx.band_right_closed("s", (0, 50, 70, 85, 100), ("M", "Me", "A", "C")))
    assert got == ["M", "M", "Me", "Me", "A", "C", "C", None, None, None]


def test_weighted_rate_zero_and_null(spark):
    rows = [("none", None, True, 1.0), ("zero", 5.0, False, 2.0), ("mix", 6.0, True, 3.0), ("mix", 4.0, False, 1.0), ("mix", None, True, 9.0)]
    df = spark.createDataFrame(rows, "g string, x double, ok boolean, w double")
    seen = F.col("x").isNotNull()
    out = df.groupBy("g").agg(fx.weighted_rate("ok", "w", seen).alias("r"), fx.weighted_mean("x", "w").alias("m"))
    got = {r.g: (r.r, r.m) for r in out.collect()}
    assert got == {"none": (None, None), "zero": (0.0, 5.0), "mix": (75.0, 5.5)}


def test_exact_sum_is_exact_and_signed(spark):
    df = spark.createDataFrame([(x,) for x in (0.1, 0.2, -0.7, 1e9, -1e9, None)], "x double")
    assert df.agg(fx.exact_sum("x")).first()[0] == -0.4
    assert df.filter("x is null").agg(fx.exact_sum("x")).first()[0] is None
    assert df.agg(fx.exact_avg("x")).first()[0] == -0.08


def test_rounding_half_away(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (2.5,), (-2.5,), (-0.001,), (None,)], "x double")
    assert values(df, fx.round_half_away("x")) == [0.13, -0.13, 2.5, -2.5, 0.0, None]
    assert values(df, fx.round_half_away("x", 0))[2:4] == [3.0, -3.0]


def test_domains_and_booleans(spark):
    df = spark.createDataFrame([(" PÚBLICA ",), ("publica",), ("x",), (None,)], "t string")
    assert values(df, fx.encode_text_domain("t", {"pública": 5, "publica": 5})) == [5, 5, None, None]
    flags = spark.createDataFrame([("Sim",), ("não",), ("1",), ("true",), ("?",), (None,)], "t string")
    assert values(flags, fx.normalize_bool("t", F.lit(False))) == [True, False, True, True, False, False]
    codes = spark.createDataFrame([(1,), (9,), (None,)], "c int")
    assert values(codes, fx.decode_domain("c", {1: "a"})) == ["a", None, None]
    assert values(codes, fx.decode_domain("c", {1: "a"}, "Desconhecida")) == ["a", "Desconhecida", "Desconhecida"]


def test_hash_tells_nulls_apart(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    for bits in (256, 64):
        assert len(set(values(df, fx.record_hash(df.columns, bits)))) == 2
    more = df.withColumn("_run", F.monotonically_increasing_id())
    assert values(more, fx.record_hash(more.columns)) == values(df, fx.record_hash(df.columns))


def test_small_helpers(spark):
    one = spark.range(1)
    value = lambda c: one.select(c).first()[0]
    assert value(fx.safe_ratio(F.lit(1), F.lit(0))) is None
    assert value(fx.parse_timestamp(F.lit("ontem de manha"))) is None
    assert value(fx.derive_parent_key(F.lit(3550308), 100000)) == 35
    assert [value(fx.fn_bytes_label(F.lit(n))) for n in (10, 2048, 5 * 1024**2, 3 * 1024**4)] == [
        "10.0 B", "2.0 KB", "5.0 MB", "3072.0 GB"]
    assert value(fx.nullable_range(F.lit(None).cast("double"), 0, 1)) is True
    a, b = (F.lit(t).cast("timestamp") for t in ("2024-01-01 00:00:00.250", "2024-01-01 00:00:01.750"))
    assert value(fx.fn_latency(a, b)) == 1500


def test_sums_never_round_saturate_or_hide_nan(spark):
    df = spark.createDataFrame([("tiny", 2e-5), ("tiny", 3e-5), ("tiny", 4e-5), ("big", 1.7e15), ("big", 1.8e15), ("huge", 1e17), ("huge", 3e17),
                                ("nan", 1.0), ("nan", float("nan")), ("inf", float("inf")), ("cents", 0.1), ("cents", 0.2), ("none", None)],
                               "g string, v double")
    got = {r.g: r for r in df.groupBy("g").agg(fx.exact_sum("v").alias("s"), fx.exact_avg("v").alias("m")).collect()}
    assert got["tiny"].m == pytest.approx(3e-5, rel=1e-12) and got["cents"].s == 0.3 and got["none"].s is None and got["none"].m is None
    assert got["big"].s == 3.5e15 and got["huge"].m == 2e17 and math.isnan(got["nan"].s) and got["inf"].s == math.inf


def test_rounding_leaves_what_it_cannot_round(spark):
    values = [1e17, -1e17, float("nan"), float("inf"), 2.345, -2.345, -0.001, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(fx.round_half_away("v")).collect()]
    assert got[:2] == [1e17, -1e17] and math.isnan(got[2]) and got[3:] == [math.inf, 2.35, -2.35, 0.0, None]
