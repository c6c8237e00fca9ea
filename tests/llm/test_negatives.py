"""Hard negatives against brute force."""

from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brisalake.llm import negatives


def brute(rows, is_anchor, positives=5, wanted=5, low=80):
    """Rows as the operator counts them: distinct (id, label, whole vector)."""
    ok = lambda v: v is not None and None not in v and np.isfinite(v).all()
    known = sorted({(i, lab, tuple(int(np.floor(256 * float(x))) for x in v)) for i, v, lab in rows if i is not None and lab is not None and ok(v)})
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = Counter()
    for a in (r for r in known if is_anchor(r[0])):
        others = [(dot(a[2], r[2]), r[0], r[1]) for r in known if r is not a and len(r[2]) == len(a[2])]
        near = sorted((-s, i) for s, i, lab in others if lab == a[1])[:positives]
        for s, p in near:
            far = sorted((-t, i) for t, i, lab in others if lab != a[1] and low * -s <= 100 * t <= 100 * -s)[:wanted]
            out.update((a[0], p, n + 1, i, -s, -t) for n, (t, i) in enumerate(far))
    return out


def mine(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumn("score", F.lit("clash")).withColumn("key", F.lit(1))
    return negatives.hard_negatives(spark, frame.repartition(5), F.col("vec_id") % 10 == 0, F.col("label"), **options)


def awkward(seed=1, size=220, dim=4):
    rng = np.random.default_rng(seed)
    heads = rng.normal(size=(5, dim))
    rows = [(i, [float(x) for x in heads[i % 5] + rng.normal(size=dim) * 0.3], int(rng.integers(0, 4))) for i in range(1, size)]
    rows += [(1000 + i, rows[9][1], i % 3) for i in range(80)]  # one vector under many ids and labels
    rows += [(2000 + i, [1.0] * dim, 1) for i in range(20)]  # ties by the score
    rows += [rows[9], rows[9], (10, rows[30][1], rows[9][2]), (10, rows[31][1], (rows[9][2] + 1) % 4)]  # repeated rows, one id that differs
    rows += [(None, [1.0] * dim, 1), (3000, None, 1), (3010, [1.0] * dim, None), (3020, [1.0, None, 1.0, 1.0], 1), (3030, [float("nan")] * dim, 1),
             (3040, [float("inf")] + [1.0] * (dim - 1), 1), (3050, [0.0] * dim, 2), (3060, [], 1), (3070, [1.0, 2.0], 1), (3080, [1.0, 1.5], 1),
             (3081, [1.0, 1.4], 2), (3090, [-5.0] * dim, 3)]
    return rows


@pytest.mark.parametrize("options", [{}, {"pivots": 3, "sample": 40, "block_rows": 16, "group_rows": 4, "first": 1, "length": 2}])
def test_equals_brute_force(spark, options):
    rows = awkward()
    got = Counter(map(tuple, mine(spark, rows, **options).collect()))
    assert got == brute(rows, lambda i: i % 10 == 0) and len(got) > 200


def test_no_rows_and_no_anchors(spark):
    assert mine(spark, []).count() == 0
    assert mine(spark, [(1, [1.0, 2.0], 0), (3, [1.0, 2.5], 1)]).count() == 0


def test_a_walk_stops_when_certified():
    """Members of a narrow cluster see only the head of the list, and lose nothing."""
    rng = np.random.default_rng(4)
    head = np.array([1.0, 0, 0, 0, 0, 0])
    x = np.floor(256 * np.concatenate([head + rng.normal(size=(4000, 6)) * 0.05, rng.normal(size=(36000, 6)) * 0.4])).astype("<i8")
    members = x[:20]
    block = pd.DataFrame({"rows": [len(x)], "width": [8], "ids": [np.arange(len(x)).astype("<i8").tobytes()],
                          "labels": [np.zeros(len(x), "<i8").tobytes()], "vectors": [x.tobytes()]})
    asked = pd.DataFrame({"key": range(20), "label": 0, "n": 6, "v": list(members), "low": [[negatives.LOW]] * 20,
                          "high": [[negatives.HIGH]] * 20, "kth": [[negatives.LOW]] * 20})
    walk, seen = negatives.Walk(asked, block, head, 5, True), []
    real = negatives.exact_products
    try:
        negatives.exact_products = lambda a, b: seen.append(len(a) * len(b)) or real(a, b)
        got = walk.run()
    finally:
        negatives.exact_products = real
    assert sum(seen) < 0.5 * len(members) * len(x)
    for m in range(20):
        want = sorted((-s, i) for i, s in enumerate((x @ members[m]).tolist()))[:5]
        assert sorted(zip(-got[got.key == m].score, got[got.key == m].id)) == want


def test_blocks_hold_every_candidate_once(spark):
    rng = np.random.default_rng(2)
    rows = [(i, 0, [int(x) for x in rng.integers(-50, 50, 3)]) for i in range(500)]
    frame = spark.createDataFrame(rows, "key bigint, label bigint, v array<bigint>")
    cells = {3: negatives.directions(np.array([r[2] for r in rows]), 4)}
    blocks = negatives.pack(negatives.placed(frame, cells), 64).collect()
    assert sorted(i for b in blocks for i in np.frombuffer(b["ids"], "<i8")) == list(range(500))
    assert max(b["rows"] for b in blocks) <= 64 and len({b["block"] for b in blocks}) == len(blocks)
