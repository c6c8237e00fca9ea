"""K-means for all numbers of clusters and all starts at once.

An iteration is one job: every task adds up, for each model and cluster, the number of
its points, their sum and their squared distance; Spark adds up the tasks' parts. What
comes back is one short row per model and cluster. A single scan therefore serves all
models, and those that have settled drop out.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = "model int, cluster int, n bigint, total array<double>, cost double"


@dataclass
class Clusters:
    """Centres of one model; ``costs`` is the inertia before each iteration's move, and at the end."""

    columns: list[str]
    centres: np.ndarray
    costs: list[float] = field(default_factory=list)

    @property
    def inertia(self) -> float:
        return self.costs[-1]

    def nearest(self) -> Column:
        """Number of the nearest centre, the first of equally near ones; null if a column is."""
        x = F.array(*[F.col(c).cast("double") for c in self.columns])
        far = F.array(*[F.aggregate(F.zip_with(x, F.array(*map(F.lit, map(float, c))), lambda a, b: (a - b) * (a - b)),
                                    F.lit(0.0), lambda s, d: s + d) for c in self.centres])
        return (F.array_position(far, F.array_min(far)) - 1).cast("int")

    def transform(self, df: DataFrame, out: str = "cluster") -> DataFrame:
        return df.withColumn(out, self.nearest())


def starts(sample: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++ on a sample: each next centre with probability by its squared distance to those chosen."""
    centres = [sample[rng.integers(len(sample))]]
    far = ((sample - centres[0]) ** 2).sum(1)
    while len(centres) < k:
        pick = rng.choice(len(sample), p=far / far.sum()) if far.sum() > 0 else rng.integers(len(sample))
        centres.append(sample[pick])
        far = np.minimum(far, ((sample - centres[-1]) ** 2).sum(1))
    return np.array(centres)


def assignment_sums(points: DataFrame, models: Mapping[int, np.ndarray], columns: Sequence[str]) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """Per model: points and their sum by cluster, and the inertia. One job, one scan."""
    models = dict(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = {m: [np.zeros(len(c), np.int64), np.zeros(c.shape), np.zeros(len(c))] for m, c in models.items()}
        for batch in batches:
            x = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)], 1).astype(float)
            x = x[np.isfinite(x).all(1)]
            for m, centres in models.items():
                far = ((x[:, None, :] - centres[None]) ** 2).sum(2)
                own = far.argmin(1)
                n, total, cost = parts[m]
                n += np.bincount(own, minlength=len(centres))
                np.add.at(total, own, x)
                cost += np.bincount(own, weights=far[np.arange(len(x)), own], minlength=len(centres))
        rows = [(m, c, int(n[c]), total[c].tolist(), float(cost[c])) for m, (n, total, cost) in parts.items() for c in range(len(n))]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), kinds)], names=["model", "cluster", "n", "total", "cost"])

    total = F.array(*[F.sum(F.col("total")[i]) for i in range(len(columns))])
    summed = points.select(*columns).mapInArrow(run, PART).groupBy("model", "cluster").agg(
        F.sum("n").alias("n"), total.alias("total"), F.sum("cost").alias("cost"))
    out = {m: (np.zeros(len(c), np.int64), np.zeros(c.shape), 0.0) for m, c in models.items()}
    for r in summed.collect():  # one row per model and cluster
        n, sums, cost = out[r["model"]]
        n[r["cluster"]], sums[r["cluster"]] = r["n"], r["total"]
        out[r["model"]] = (n, sums, cost + r["cost"])
    return out


def multi_start(points: DataFrame, columns: Sequence[str], ks: Iterable[int], seeds: int = 10, sample: int = 2000,
                rounds: int = 50, tolerance: float = 1e-6) -> dict[int, Clusters]:
    """The model of least inertia for each k, of ``seeds`` starts each.

    Starts come from at most ``sample`` rows, chosen by hash. A model stops when its
    inertia falls by less than ``tolerance`` of it, or after ``rounds``. A cluster
    without points keeps its centre. Rows with a null or non-finite value take no part;
    without rows there are no models. Give a stored frame: it is read every round.
    """
    columns = list(columns)
    rows = points.select(*[F.col(c).cast("double").alias(c) for c in columns])
    chosen = rows.orderBy(F.xxhash64(*columns, F.lit(42)), *columns).limit(sample).collect()
    known = np.array([list(r) for r in chosen if None not in tuple(r)], float).reshape(-1, len(columns))
    known = known[np.isfinite(known).all(1)]
    if not len(known):
        return {}
    models = {}
    for k in ks:
        for s in range(seeds):
            models[len(models)] = (k, Clusters(columns, starts(known, k, np.random.default_rng([k, 42 + s]))))
    live = set(models)
    for _ in range(rounds + 1):
        sums = assignment_sums(rows, {m: models[m][1].centres for m in live}, columns)
        for m, (n, total, cost) in sums.items():
            model = models[m][1]
            model.costs.append(cost)
            if len(model.costs) > 1 and model.costs[-2] - cost <= tolerance * max(model.costs[-2], 1e-300) or len(model.costs) > rounds:
                live.discard(m)
            else:
                model.centres = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], model.centres)
        if not live:
            break
    return {k: min((m for q, m in models.values() if q == k), key=lambda m: m.inertia) for k in {k for k, _ in models.values()}}


def kmeans_select(df: DataFrame, cols: Sequence[str], ks: Iterable[int] = range(2, 7), min_k: int = 3,
                  seeds: int = 10) -> tuple[Clusters, DataFrame]:
    """Best model with k >= min_k by silhouette, and (k, silhueta, inercia, rodadas, inercia_desce) rows.

    ``inercia_desce`` says that no iteration of the chosen start raised the inertia,
    which k-means guarantees: a wrong sum or assignment would show.
    """
    best = multi_start(df, cols, ks, seeds)
    judge, scores, rows = ClusteringEvaluator(featuresCol="features", predictionCol="cluster"), {}, []
    for k, model in sorted(best.items()):
        placed = model.transform(df).filter("cluster IS NOT NULL").select(
            array_to_vector(F.array(*[F.col(c).cast("double") for c in cols])).alias("features"), "cluster")
        scores[k] = judge.evaluate(placed)
        falls = all(b <= a * (1 + 1e-12) for a, b in zip(model.costs, model.costs[1:]))
        rows.append((k, round(scores[k], 3), round(model.inertia, 4), len(model.costs), falls))
    chosen = max((k for k in best if k >= min_k), key=lambda k: scores[k])
    return best[chosen], df.sparkSession.createDataFrame(
        rows, "k int, silhueta double, inercia double, rodadas int, inercia_desce boolean")
