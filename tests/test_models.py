"""Forests: exact sums of the target, rows over all cores, predictions in the target's own unit."""

from pyspark.sql import functions as F

from brisalake.operators import models as md


def test_units_that_make_sums_exact(spark):
    units = lambda values: md.whole_units(spark.createDataFrame([(v,) for v in values], "y double"), "y")
    assert units([1.0, 7.0]) == 1.0 and units([0.1, 12.25, 99.99]) == 100.0 and units([0.1]) == 10.0
    assert units([1 / 3]) == 1.0 and units([1e12, 0.01]) == 1.0 and units([float("nan"), 0.1]) == 1.0 and units([]) == 1.0


def test_forest_repeats_whatever_the_order_of_its_rows(spark):
    rows = spark.range(600).select("id", (F.col("id") % 37).cast("double").alias("x"), (F.col("id") % 11).cast("double").alias("z"),
                                   (F.pmod(F.col("id") * 7919, F.lit(9973)) / 100).alias("y"))
    one = md.forest_model(rows.repartition(1).sortWithinPartitions("id"), ["x", "z"], "y", trees=5, depth=6)
    two = md.forest_model(rows.repartition(7, "x").sortWithinPartitions(F.desc("id")), ["x", "z"], "y", trees=5, depth=6)
    both = md.predict(one, rows, ["x", "z"], "a").join(md.predict(two, rows, ["x", "z"], "b").select("id", "b"), "id")
    got = both.agg(F.max(F.abs(F.col("a") - F.col("b"))).alias("d"), F.min("a").alias("low"), F.max("a").alias("high")).first()
    assert one.units == 100.0 and got.d == 0.0 and 0 <= got.low < got.high < 100
