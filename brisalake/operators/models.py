"""Regression with pyspark.ml."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assemble(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(df)


def ridge_model(train: DataFrame, features: Sequence[str], target: str, alpha: float = 1.0):
    """Ridge on standardised features with penalty ``alpha`` on the summed squared error.

    Spark divides the error by n and scales the target by its deviation, hence
    the regParam below.
    """
    size = train.agg(F.count(target).alias("n"), F.stddev(target).alias("s")).first()
    return LinearRegression(
        featuresCol="features", labelCol=target, elasticNetParam=0.0, standardization=True,
        regParam=alpha * size["s"] / size["n"]).fit(assemble(train, features))


@dataclass(frozen=True)
class UnitModel:
    """A regression fitted on its target in whole units; predictions come back in the target's own."""

    model: RandomForestRegressionModel
    units: float

    @property
    def featureImportances(self):
        return self.model.featureImportances

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(df).withColumn("prediction", F.col("prediction") / self.units)


def whole_units(df: DataFrame, target: str, decimals: int = 4) -> float:
    """The smallest power of ten that makes every target a whole number, if sums of their squares stay exact; else 1."""
    y = F.col(target).cast("double")
    whole = [F.every(F.abs(y * 10.0**d - F.round(y * 10.0**d)) <= 1e-6).alias(f"d{d}") for d in range(decimals + 1)]
    found = df.agg(F.count(y).alias("n"), F.max(F.abs(y)).alias("top"), *whole).first()
    fits = [d for d in range(decimals + 1) if found[f"d{d}"] and (found["top"] * 10.0**d) ** 2 * found["n"] * 10 < 2.0**53]
    return 10.0 ** fits[0] if fits else 1.0


def forest_model(train: DataFrame, features: Sequence[str], target: str, trees: int = 300, depth: int = 12):
    """Random forest whose result does not depend on the order in which tasks finish.

    Split gains come from sums of the target: over whole units they are exact, whatever
    their order. Rows are dealt over all cores by hash and sorted, so bags repeat too.
    """
    units = whole_units(train, target)
    rows = train.select(*features, target)
    rows = rows.repartition(train.sparkSession.sparkContext.defaultParallelism, *rows.columns).sortWithinPartitions(*rows.columns)
    scaled = rows.withColumn(target, F.round(F.col(target) * units) if units > 1 else F.col(target))
    return UnitModel(RandomForestRegressor(
        featuresCol="features", labelCol=target, numTrees=trees, maxDepth=depth, minInstancesPerNode=5,
        seed=42).fit(assemble(scaled, features)), units)


def predict(model, df: DataFrame, features: Sequence[str], out: str = "prediction") -> DataFrame:
    return model.transform(assemble(df, features)).drop("features").withColumnRenamed("prediction", out)


def feature_importance(model, features: Sequence[str], spark, n: int = 10) -> DataFrame:
    """The largest importances of a forest, or absolute standardised-free coefficients."""
    values = getattr(model, "featureImportances", None)
    values = model.coefficients if values is None else values
    rows = [(name, float(abs(v))) for name, v in zip(features, values.toArray())]
    return (spark.createDataFrame(rows, "feature string, importance double")
            .orderBy(F.desc("importance"), "feature").limit(n))
