"""Language-model scores against plain counting."""

import math
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brisalake.llm import lm_score
from helpers import awkward


def test_scores_equal_plain_counts(spark, docs):
    got = lm_score.score(docs, lm_score.count_models(docs, "text", F.col("doc_id") % 2 == 0)).collect()
    rows = [r[:2] for r in awkward()]
    parts = list(lm_score.grams(pa.array([t for _, t in rows])))
    counts = [[Counter(), Counter(), Counter()] for _ in range(2)]
    for (i, _), p in zip(rows, parts):
        for model in ([0, 1] if i is not None and i % 2 == 0 else [1]):
            for c, ids in zip(counts[model], p):
                c.update(ids.tolist())

    def loss(model, w, c, p):
        words, contexts, pairs = counts[model]
        share = lm_score.SHARE if contexts[c] else 0.0
        alone = (words[w] + 1) / (sum(words.values()) + lm_score.START)
        return -math.log(share * min(pairs[p] / max(contexts[c], 1), 1.0) + (1 - share) * alone)

    want = []
    for (i, _), (w, c, p) in zip(rows, parts):
        d = sum(loss(0, *x) - loss(1, *x) for x in zip(w.tolist(), c.tolist(), p.tolist()))
        want.append((str(i), len(w), d / len(w) if len(w) else 0.0))
    assert len(got) == len(want)
    for a, b in zip(sorted((str(r.id), r.n_words, r.score) for r in got), sorted(want)):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=1e-9)


def test_nothing_to_score(spark, no_docs):
    models = lm_score.count_models(no_docs, "text", F.lit(True))
    assert lm_score.score(no_docs, models).count() == 0


def test_models_grow_with_the_vocabulary(spark):
    """More words and pairs than any fixed table holds, against counts of the words themselves; also for other documents."""
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(150_000)}" for _ in range(3000)) for _ in range(300)]
    texts += ["w1 w2 W1 w2", "", None, "w1 w2 W1 w2"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    models = lm_score.count_models(frame, "text", F.col("doc_id") % 10 == 0)
    split = [(t or "").lower().split() for t in texts]
    words, contexts, pairs = ([Counter(), Counter()] for _ in range(3))
    for i, w in enumerate(split):
        for m in ([0, 1] if i % 10 == 0 else [1]):
            words[m].update(w)
            contexts[m].update(["", *w][:-1] if w else [])
            pairs[m].update(zip(["", *w], w))
    totals = [w.total() + max(lm_score.START, len(words[1])) for w in words]

    def losses(w):
        out = []
        for m in range(2):
            total = 0.0
            for c, x in zip(["", *w], w):
                share = lm_score.SHARE if contexts[m][c] else 0.0
                alone = (words[m][x] + 1) / totals[m]
                total -= math.log(share * pairs[m][c, x] / max(contexts[m][c], 1) + (1 - share) * alone)
            out.append(total / len(w) if w else None)
        return out

    other = ["w1 w2 never-seen w1 w2 w99", "w5 w4 w3", "", "never-seen"]
    others = spark.createDataFrame(list(enumerate(other)), "doc_id bigint, text string")
    assert len(words[1]) > 1 << 16 and len(pairs[1]) > 1 << 19
    for docs, parts in ((frame, split), (others, [t.split() for t in other])):
        got = {r.id: r for r in lm_score.score(docs, models).collect()}
        assert sorted(got) == list(range(len(parts)))
        for i, w in enumerate(parts):
            a, b = losses(w)
            assert got[i].n_words == len(w)
            if w:
                assert (got[i].target_loss, got[i].background_loss) == pytest.approx((a, b), abs=1e-9)
                assert got[i].score == pytest.approx(a - b, abs=1e-9)
            else:
                assert got[i].target_loss is None and got[i].score == 0


def test_a_chunk_sends_each_pair_once(spark):
    """A pair in every document costs its bucket one entry a chunk, as every other gram."""
    rng = random.Random(9)
    texts = [" ".join(["very common"] * 30 + [f"word{rng.randrange(20_000)}" for _ in range(300)]) for _ in range(400)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    models = lm_score.count_models(frame, "text", F.col("doc_id") % 2 == 0)
    sent = models.requests()[1].agg(F.sum("n").alias("n"), F.max("chunk").alias("chunks")).first()
    split = [t.split() for t in texts]
    distinct = len({w for x in split for w in x}) + len({w for x in split for w in ["", *x][:-1]}) + len(
        {p for x in split for p in zip(["", *x], x)})
    assert (sent.n, sent.chunks) == (distinct, 0)


def test_target_as_ids(spark, docs):
    """The target's documents may be given by their ids; texts are not joined with them."""
    good = docs.filter("doc_id % 2 = 0").select("doc_id")
    key = lambda r: tuple(map(str, r))
    by_mark, by_ids = (sorted(map(key, lm_score.score(docs, lm_score.count_models(docs, "text", t)).collect()))
                       for t in (F.col("doc_id") % 2 == 0, good))
    assert by_mark == by_ids
