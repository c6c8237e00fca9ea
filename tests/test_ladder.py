"""Order statistics against pandas and against Spark's own windows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from brisalake.operators import ladder as lad
from brisalake.operators import windows as wn
from brisalake.operators.aggregates import percentile_exact
from brisalake.operators.analytics import stratified_split


@pytest.fixture(scope="module")
def table(spark):
    """A hot group with many ties, negatives, nulls and a null group."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(3000):
        group = "hot" if i % 3 else rng.choice(["a", "b", None])
        value = None if i % 17 == 0 else (100.0 if i % 4 == 0 else float(np.round(rng.normal(0, 50), 2)))
        rows.append((i, group, value))
    return spark.createDataFrame(rows, "id long, g string, v double").persist()


def test_rank_equals_window(table):
    for desc in (True, False):
        order = F.desc_nulls_last("v") if desc else F.asc_nulls_last("v")
        out = wn.rank_within(table, ["g"], "v", desc).withColumn(
            "want", F.rank().over(Window.partitionBy("g").orderBy(order)))
        assert out.filter("rank <> want").count() == 0 and out.count() == 3000


def test_ntile_equals_window(table):
    w = Window.partitionBy("g").orderBy(F.asc_nulls_last("v"), "id")
    for n in (4, 7, 5000):
        out = wn.quartile_ntile(table, ["g"], "v", n, "id").withColumn("want", F.ntile(n).over(w))
        assert out.filter("quartile <> want").count() == 0 and out.count() == 3000


def test_percentile_rank_equals_pandas(table, spark):
    pdf = table.toPandas().sort_values("id")
    got = wn.percentile_rank_avg(table, "v").orderBy("id").toPandas()["pct_rank"]
    want = pdf["v"].rank(pct=True).reset_index(drop=True) * 100
    pd.testing.assert_series_equal(got, want, check_names=False)
    ties = spark.createDataFrame([(1.0,), (1.0,), (3.0,), (5.0,)], "v double")
    assert sorted(r.pct_rank for r in wn.percentile_rank_avg(ties, "v").collect()) == [37.5, 37.5, 75.0, 100.0]


def test_quantiles_equal_pandas(table):
    ps = [0.0, 0.1, 0.5, 0.95, 1.0]
    got = {r["g"]: list(r)[1:] for r in percentile_exact(table, ["g"], "v", ps).collect()}
    pdf = table.toPandas()
    for g, part in pdf.groupby(pdf["g"].where(pdf["g"].notna(), None), dropna=False):
        g = None if pd.isna(g) else g
        np.testing.assert_allclose(got[g], part["v"].quantile(ps), rtol=1e-12)


def test_quantile_of_nulls_is_null(spark):
    df = spark.createDataFrame([("x", None), ("y", 2.0)], "g string, v double")
    assert {r.g: r.m for r in lad.quantiles(df, ["g"], "v", {"m": 0.5}).collect()} == {"x": None, "y": 2.0}


def test_split_shares_every_stratum(table):
    train, test = stratified_split(table, "g", "id", 0.8)
    sizes = {r.g: r["count"] for r in table.groupBy("g").count().collect()}
    for r in train.groupBy("g").count().collect():
        assert r["count"] == int(sizes[r.g] * 0.8 + 0.5)
    assert train.join(test, "id").count() == 0 and train.count() + test.count() == 3000


def test_sample_is_bounded_and_stable(table):
    a = wn.stratified_sample(table, ["g"], 20, 1, "id")
    assert all(r["count"] == 20 for r in a.groupBy("g").count().collect())
    assert {r.id for r in a.collect()} == {r.id for r in wn.stratified_sample(table, ["g"], 20, 1, "id").collect()}


def test_sample_equals_a_window_over_the_hash(table):
    order = Window.partitionBy("g").orderBy(F.xxhash64("id", F.lit(7)), "id")
    want = {r.id for r in table.withColumn("n", F.row_number().over(order)).filter("n <= 50").collect()}
    assert {r.id for r in wn.stratified_sample(table, ["g"], 50, 7, "id").collect()} == want


def test_odd_numbers_and_texts_rank_as_windows_do(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, v, t) for i, (v, t) in enumerate(zip([nan, 1.0, inf, 5.0, None, -inf, 1.0, nan, 1e300, -5e-324] * 3, "b é abcd abce abcdz a  z abcd".split(" ") * 4))]
    df = spark.createDataFrame(rows, "id long, v double, t string").withColumn("g", F.lit(1))
    for col in ("v", "t"):
        for desc in (True, False):
            order = F.desc_nulls_last(col) if desc else F.asc_nulls_last(col)
            out = wn.rank_within(df, ["g"], col, desc).withColumn("want", F.rank().over(Window.partitionBy("g").orderBy(order)))
            assert out.filter("rank <> want").count() == 0
    out = wn.quartile_ntile(df, ["g"], "v", 4, "id").withColumn("want", F.ntile(4).over(Window.partitionBy("g").orderBy(F.asc_nulls_last("v"), "id")))
    assert out.filter("quartile <> want").count() == 0


def test_narrow_values_fall_into_many_bins(spark):
    epoch = spark.range(100_000).select((F.lit(1_700_000_000_000) + F.col("id") * 37).alias("at"), F.lit(1).alias("g"))
    sizes = [r["count"] for r in lad.with_bin(epoch, ["g"], "at").groupBy("_bin").count().collect()]
    assert sum(sizes) == 100_000 and max(sizes) < 1_000
    ids = spark.range(100_000).select((F.lit(10**15) + F.col("id")).alias("id"))
    assert ids.groupBy(lad.tie_bin(ids, "id")).count().agg(F.max("count")).first()[0] <= 1 << lad.TIE_BITS
