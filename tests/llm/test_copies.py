"""Exact copies, near copies and repeated substrings against plain versions."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brisalake.llm import exact_dedup, jaccard, suffix_dedup
from brisalake.llm.common import Stage
from brisalake.llm.components import components
from helpers import awkward, words


def plain_dedup(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    biggest = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return Counter((i, biggest[t or ""], len(groups[t or ""])) for i, t in rows), len(groups)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(spark, docs, weak):
    """Also with a digest of two values, where only the full bytes tell texts apart."""
    digest = (lambda t: F.unhex(F.hex(F.pmod(F.length(t), F.lit(2))))) if weak else exact_dedup.sha
    got = exact_dedup.exact_dedup(spark, docs.path, per_trigger={"maxFilesPerTrigger": "1"}, digest=digest).collect()
    want, texts = plain_dedup([r[:2] for r in awkward()])
    assert Counter((r.id, r.keep_id, r.group_size) for r in got) == want
    assert sum(r.kept for r in got) == texts and all(r.id == r.keep_id for r in got if r.kept)
    assert len({(r["at"].file, r["at"].row) for r in got}) == len(got)


def test_exact_dedup_of_nothing(spark, no_docs):
    assert exact_dedup.exact_dedup(spark, no_docs.path).count() == 0


def shingles(text, width=5):
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()}


def plain_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            least[find(x)] = min(least.get(find(x), i), i)
    return Counter((i, len(sets[x]), i if not sets[x] else least.get(find(x))) for x, (i, _) in enumerate(rows))


@pytest.mark.parametrize("common_least", [1, 3])
def test_jaccard(spark, docs, common_least):
    """Whatever the sample calls common, the links are the same."""
    got = jaccard.jaccard_components(spark, docs, sample_one_in=1, common_least=common_least)
    assert Counter(map(tuple, got.collect())) == plain_components([r[:2] for r in awkward()])


def test_jaccard_opens_groups(spark):
    """A chain of documents, each near the next but not the one after, and a family without a common neighbour."""
    base = [f"w{i}" for i in range(100)]
    chain = [" ".join(base[3 * k:] + [f"n{j}" for j in range(3 * k)]) for k in range(12)]
    family = [" ".join([f"v{i}" if i != 7 * k else f"x{k}" for i in range(120)]) for k in range(15)]
    rows = list(enumerate(chain + family))
    got = jaccard.jaccard_components(spark, spark.createDataFrame(rows, "doc_id bigint, text string"), sample_one_in=1)
    assert Counter(map(tuple, got.collect())) == plain_components(rows)


def test_jaccard_of_nothing(spark, no_docs):
    assert jaccard.jaccard_components(spark, no_docs).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (102, 103), (200, 200)]
    got = {r.node: r.root for r in components(Stage(spark), spark.createDataFrame(edges, "a bigint, b bigint"), "t").collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 101: 100, 102: 100, 103: 100}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=0, max_size=40).map(lambda b: bytes(97 + x % 3 for x in b)), min_size=1, max_size=8), st.integers(2, 9))
def test_repeated_windows(segments, least):
    n = len(segments)
    got = suffix_dedup.repeated_windows(segments, np.arange(n) * 1000, np.zeros(n, bool), least)
    seen = Counter(s[i:i + least] for s in segments for i in range(len(s) - least + 1))
    assert [g.tolist() for g in got] == [[i for i in range(len(s) - least + 1) if seen[s[i:i + least]] > 1] for s in segments]


def plain_repeats(rows, least):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[j:j + least] for _, b in data for j in range(len(b) - least + 1))
    out = []
    for i, b in data:
        cover = np.zeros(len(b) + 1, int)
        for j in range(len(b) - least + 1):
            if seen[b[j:j + least]] > 1:
                cover[j] += 1
                cover[j + least] -= 1
        gone = np.cumsum(cover)[:len(b)] > 0
        spans = int((gone[1:] & ~gone[:-1]).sum() + (len(gone) > 0 and gone[0]))
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("limit", [2000, 2])
def test_repeats(spark, docs, monkeypatch, limit):
    """Also with groups split as soon as they have three different segments."""
    monkeypatch.setattr(suffix_dedup, "GROUP_SEGMENTS", limit)
    got = suffix_dedup.remove_repeats(spark, docs).select(
        "id", "n_bytes", "n_removed", "n_spans", F.coalesce(F.sha2("kept", 256), F.lower(F.hex("sha"))))
    assert Counter(map(tuple, got.collect())) == plain_repeats([r[:2] for r in awkward()], 400)


def test_repeats_of_nothing(spark, no_docs):
    assert suffix_dedup.remove_repeats(spark, no_docs).count() == 0


def test_default_trigger_makes_several_batches_of_30_gb(spark, docs, monkeypatch):
    class Stop(Exception):
        pass

    def stop(*args):
        given.append(args[-1])
        raise Stop

    given = []
    monkeypatch.setattr(exact_dedup, "first_seen", stop)
    with pytest.raises(Stop):
        exact_dedup.exact_dedup(spark, docs.path)
    assert (30 << 30) // int(given[0]["maxBytesPerTrigger"]) >= 4
