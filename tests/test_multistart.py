"""Clustering of all models at once against plain k-means."""

import numpy as np
import pytest

from brisalake.operators import multistart as ms


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(c, 0.4, (120, 2)) for c in ((0, 0), (4, 0), (0, 5))])
    rows = [(float(a), float(b)) for a, b in x] + [(None, 1.0), (float("nan"), 0.0), (1.0, None)]
    return spark.createDataFrame(rows, "a double, b double").repartition(5)


def plain(x, centres):
    far = ((x[:, None] - centres[None]) ** 2).sum(2)
    own = far.argmin(1)
    return own, far.min(1).sum()


def test_sums_of_one_iteration(spark, points):
    x = np.array([tuple(r) for r in points.collect() if None not in tuple(r)], float)
    x = x[np.isfinite(x).all(1)]
    models = {0: x[:2], 1: x[5:9], 2: np.array([[100.0, 100.0], [0.0, 0.0]])}
    got = ms.assignment_sums(points, models, ["a", "b"])
    for m, centres in models.items():
        own, cost = plain(x, centres)
        n, total, inertia = got[m]
        assert n.tolist() == np.bincount(own, minlength=len(centres)).tolist() and abs(inertia - cost) < 1e-6
        for c in range(len(centres)):
            assert np.allclose(total[c], x[own == c].sum(0))


def test_best_of_all_starts(points):
    best = ms.multi_start(points, ["a", "b"], range(2, 5), seeds=4)
    x = np.array([tuple(r) for r in points.collect() if None not in tuple(r)], float)
    x = x[np.isfinite(x).all(1)]
    for k, model in best.items():
        assert all(b <= a + 1e-9 for a, b in zip(model.costs, model.costs[1:]))
        own, cost = plain(x, model.centres)
        assert abs(cost - model.inertia) < 1e-6
        for c in range(k):
            assert np.allclose(model.centres[c], x[own == c].mean(0), atol=0.05)
    assert sorted(map(tuple, best[3].centres.round(0).tolist())) == [(0, 0), (0, 5), (4, 0)]
    placed = best[3].transform(points.filter("NOT isnan(a)")).filter("cluster IS NOT NULL").groupBy("cluster").count().collect()
    assert [r["count"] for r in placed] == [120, 120, 120]


def test_one_job_per_iteration(spark, points):
    tracker, group = spark.sparkContext.statusTracker(), "iterations"
    spark.sparkContext.setJobGroup(group, "one iteration")
    try:
        ms.assignment_sums(points, {m: np.zeros((3, 2)) + m for m in range(50)}, ["a", "b"])
        stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(stages) <= 6  # a scan and a sum, however many models


def test_selection(points):
    model, scores = ms.kmeans_select(points, ["a", "b"], seeds=3)
    assert len(model.centres) == 3
    rows = scores.orderBy("k").collect()
    assert [r.k for r in rows] == [2, 3, 4, 5, 6] and all(r.inercia_desce for r in rows)
    assert [r.inercia for r in rows] == sorted((r.inercia for r in rows), reverse=True)


def test_few_equal_or_no_rows(spark):
    same = spark.createDataFrame([(1.0,)] * 5, "a double")
    assert ms.multi_start(same, ["a"], [3], seeds=2)[3].inertia == 0.0
    assert ms.multi_start(same.filter("false"), ["a"], [2]) == {}
