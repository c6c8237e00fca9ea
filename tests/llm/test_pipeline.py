"""The pipeline's stages, each against a plain version on what the one before it kept."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brisalake.llm import quality
from helpers import SCHEMA, awkward, words
from test_copies import shingles
from test_texts import plain_targets

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "row", "id", "score", "digest", "n"]
STEPS = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(awkward(), SCHEMA).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 3 > 0), 0) for i in range(0, 60, 2)] + [(None, 1, None), (4, None, 0)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def stored(spark, tmp_path, df):
    df.write.parquet(str(tmp_path))
    return spark.read.parquet(str(tmp_path))


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = list(STEPS)
    assert names == ["quality_classifier", "exact_dedup", "ngram_jaccard_join", "source_mixing", "packing"]

    trees = quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    good = stored(spark, tmp_path / "a", STEPS["quality_classifier"](spark, docs, folder))
    want = docs.filter(quality.score(F.col("text"), trees) >= 0.3)
    assert good.columns == COLUMNS and Counter(good.collect()) == Counter(want.collect()) and 0 < good.count() < docs.count()

    single = stored(spark, tmp_path / "b", STEPS["exact_dedup"](spark, good, folder))
    best = {}
    for r in good.collect():
        key = -1 if r.doc_id is None else r.doc_id
        best[r.text or ""] = max(best.get(r.text or "", -2), key)
    assert single.columns == COLUMNS
    assert Counter((r.text or "", -1 if r.doc_id is None else r.doc_id) for r in single.collect()) == Counter(best.items())

    rows = single.collect()
    sets, root = [shingles(r.text) for r in rows], list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = [new if x == old else x for x in root]
    first = {}
    for x, r in zip(root, rows):
        first[x] = min(first.get(x, (True, 0)), (r.doc_id is None, r.doc_id or 0))
    far = stored(spark, tmp_path / "c", STEPS["ngram_jaccard_join"](spark, single, folder))
    assert far.columns == COLUMNS and Counter((r.doc_id is None, r.doc_id or 0) for r in far.collect()) == Counter(first.values())

    mixed = stored(spark, tmp_path / "d", STEPS["source_mixing"](spark, far, folder))
    sizes, taken = Counter(), Counter()
    for r in far.collect():
        sizes[r.source] += len(words(r.text))
    for r in mixed.collect():
        taken[r.source] += len(words(r.text))
        assert r.n_chars == len(r.text)
    assert mixed.columns == COLUMNS
    for source, target in plain_targets(sizes).items():
        assert abs(taken[source] - target) <= 1

    pieces = STEPS["packing"](spark, mixed, folder).collect()
    sequences = Counter()
    for p in pieces:
        sequences[p.sequence_id] += p.length
    assert max(sequences.values()) <= 1024 and len(pieces) >= mixed.count()
    assert Counter(p.doc_id for p in pieces if p.start == 0) == Counter(r.doc_id for r in mixed.collect())


def test_stages_of_nothing(spark, folder, tmp_path):
    none = stored(spark, tmp_path / "none", spark.read.parquet(f"{folder}/documents.parquet").limit(0))
    for name, step in corpus_pipeline.STAGES:
        assert step(spark, none, folder).count() == 0, name


def tokens_by_document(pieces):
    """Per document: its copies' sizes and how many tokens of them are packed."""
    whole, packed = Counter(), Counter()
    for p in pieces:
        whole[p.doc_id, p.doc_tokens] += p.start == 0
        packed[p.doc_id] += p.length
    return whole, packed


def test_run_equals_its_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for i, (name, step) in enumerate(corpus_pipeline.STAGES):
        docs = step(spark, docs, folder)
        if i < len(corpus_pipeline.STAGES) - 1:
            docs = stored(spark, tmp_path / name, docs)
    got, want = (tokens_by_document(x.collect()) for x in (corpus_pipeline.run(spark, folder), docs))
    assert got == want and sum(got[1].values()) > 0


def test_columns_named_like_the_stages_own(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("_corpus_row", F.lit("kept")).withColumn("_corpus_at", F.lit("kept"))
    docs = stored(spark, tmp_path / "in", docs)
    for name in ("exact_dedup", "ngram_jaccard_join"):
        docs = stored(spark, tmp_path / name, STEPS[name](spark, docs, folder))
        assert docs.columns == [*COLUMNS, "_corpus_row", "_corpus_at"]
        assert {(r["_corpus_row"], r["_corpus_at"]) for r in docs.collect()} == {("kept", "kept")}
