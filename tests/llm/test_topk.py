"""Exact search against brute force."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from brisalake.llm import topk


def test_dual_search():
    rng = np.random.default_rng(0)
    for size in (1, 5, 400):
        queries, rows = rng.integers(-20, 20, (130, 6)), rng.integers(-20, 20, (size, 6))
        rows[: size // 2] = rows[0]  # many equal rows
        ids = rng.permutation(size) * 3
        floor = np.full(130, np.iinfo(np.int64).min)
        found = {}
        for q, i, s in zip(*topk.dual_search(queries, rows, ids, floor, 7)):
            found.setdefault(q, []).append((-s, i))
        for q in range(130):
            want = sorted(zip((-(rows @ queries[q])).tolist(), ids.tolist()))[:7]
            assert sorted(found[q]) == want


def test_large_components_stay_exact():
    a = np.array([[2**30, 1], [2**30, 0]])
    _, ids, score = topk.dual_search(a, a, np.array([1, 2]), np.full(2, np.iinfo(np.int64).min), 2)
    assert sorted(score.tolist()) == [2**60, 2**60, 2**60, 2**60 + 1] and len(ids) == 4


def test_top_k(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=5)], 0) for i in range(1, 260)]
    rows += [(300 + i, rows[4][1], 0) for i in range(60)]  # one vector many times
    rows += [(400, None, 0), (401, [1.0, None, 0.0, 0.0, 0.0], 0), (402, [float("nan")] * 5, 0), (403, [float("inf")] * 5, 0), (404, [1e30] * 5, 0),
             (None, [0.0] * 5, 0), (420, [1.0, 2.0], 0), (421, [3.0, 4.0], 0), (440, [], 0), (7, rows[6][1], 0)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score int").repartition(6)
    got = topk.top_k(spark, frame, F.col("vec_id") % 20 == 0, k=10, pivots=4, sample=64, block_rows=50, query_rows=8)
    known = {i: np.floor(np.array(v) * 64) for i, v, _ in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and (np.abs(v) < 1e6).all()}
    want = Counter()
    for q in (i for i in known if i % 20 == 0):
        scores = sorted((-int(known[q] @ v), i) for i, v in known.items() if i != q and len(v) == len(known[q]))
        want.update((q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:10]))
    assert Counter(map(tuple, got.collect())) == want


def test_no_vectors(spark):
    frame = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert topk.top_k(spark, frame, F.col("vec_id") % 20 == 0).count() == 0


def test_large_components_and_repeated_ids(spark):
    """Components of 2^25 and more, and one id with several vectors, as a query too."""
    big = float(2**26)
    rows = [(i, [float(i % 7), float(i % 5)]) for i in range(1, 60)] + [(70, [big, 1.0]), (71, [1.0, -big]), (72, [big, 0.0])]
    rows += [(30, [6.0, 6.0]), (20, [5.0, 5.0]), (20, [5.0, 5.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    got = topk.top_k(spark, frame, F.col("vec_id") % 20 == 0, k=6, pivots=3, sample=20, block_rows=16, query_rows=2)
    known = sorted({(i, tuple(int(x * 64) for x in v)) for i, v in rows})
    want = Counter()
    for a in (r for r in known if r[0] % 20 == 0):
        scores = sorted((-(a[1][0] * b[1][0] + a[1][1] * b[1][1]), b[0]) for b in known if b != a)
        want.update((a[0], n + 1, i, -s) for n, (s, i) in enumerate(scores[:6]))
    assert Counter(map(tuple, got.collect())) == want
