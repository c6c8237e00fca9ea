"""Token files: round trip, order, encodings and selective reads."""

import glob
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from brisalake.llm import token_files
from brisalake.llm.queries import word_tokenizer


def encode(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(word_tokenizer())


@pytest.fixture(scope="module")
def files(spark, docs, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tokens"))
    token_files.write_tokens(docs, folder, word_tokenizer(), shards=4, row_group_bytes=1 << 12, page_rows=5)
    return folder


def test_round_trip(spark, docs, files, tokenizer):
    got = sorted(token_files.read_tokens(spark, files).collect(), key=lambda r: r.start)
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(encode(tokenizer, r.text))
    at, last = 0, -1
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids)
        assert (-1 if r.doc_id is None else r.doc_id) >= last  # null first, then ascending
        texts[r.doc_id].remove(r.ids)
        at, last = at + r.n_tokens, -1 if r.doc_id is None else r.doc_id
    assert not any(texts.values())


def test_checksums(spark, files):
    for r, c in zip(sorted(token_files.read_tokens(spark, files).collect(), key=lambda r: r.start),
                    sorted(token_files.with_checksum(token_files.read_tokens(spark, files)).collect(), key=lambda r: r.start)):
        assert c.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and c.start == r.start


@pytest.mark.parametrize("text", ["", " ", "It's 12 o'clock\tnow here x", "á ́b\n\nC", "<|endoftext|> x<|startoftext|>y", "ΑΣ ΣΑ.",
                                  "x" * 5000, "\x1c\x1f a\x85b", "été " * 3000,
                                  "İstanbul ½ Ⅷ ǅ ﬁ 가각 \u200b\u2028x", "don't 'sun' we'll O'Neil", "a,.!?b ((x)) <>|", "漢字かな交じり文 1２3"])
def test_words_are_borders(tokenizer, text):
    ids = np.frombuffer(token_files.word_encoder(word_tokenizer())(text), "<u4").tolist()
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def test_words_that_leave_and_come_back(tokenizer):
    words = token_files.Words(tokenizer.model, tokenizer.get_vocab_size(), keep=3)
    for _ in range(2):
        for w in ("a", "b1", "ça", "d", "e.", "a", "f", "x" * 200):
            assert np.frombuffer(words[w], "<u4").tolist() == tokenizer.encode(w, add_special_tokens=False).ids
    assert len(words) <= 3 and len(words.old) <= 3


def test_very_long_text(spark, tmp_path, tokenizer):
    text = "Long words, and 12 more. " * 120_000  # three megabytes in one row
    frame = spark.createDataFrame([(1, text), (2, "b")], "doc_id bigint, text string")
    token_files.write_tokens(frame, str(tmp_path), word_tokenizer())
    assert [r.ids for r in token_files.read_tokens(spark, str(tmp_path)).orderBy("start").collect()] == [encode(tokenizer, text), encode(tokenizer, "b")]


def test_encodings_and_page_index(files):
    for path in glob.glob(f"{files}/tokens/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        for g in range(meta.num_row_groups):
            for c in (meta.row_group(g).column(i) for i in range(meta.num_columns)):
                assert c.has_offset_index and (c.has_column_index or c.path_in_schema.startswith("ids"))
                if c.path_in_schema in token_files.DELTA:
                    assert "DELTA_BINARY_PACKED" in c.encodings and "RLE_DICTIONARY" not in c.encodings
                if c.path_in_schema.startswith("ids"):
                    assert "RLE_DICTIONARY" in c.encodings


def test_row_groups_and_pages_are_bounded(spark, tmp_path):
    frame = spark.range(4000).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(0, 60), i -> hash(id, i))) AS text")
    token_files.write_tokens(frame, str(tmp_path), word_tokenizer(), shards=1, row_group_bytes=1 << 18, page_rows=100)
    (path,) = glob.glob(f"{tmp_path}/tokens/*.parquet")
    meta = pq.ParquetFile(path).metadata
    assert meta.num_row_groups > 2 and max(meta.row_group(g).total_byte_size for g in range(meta.num_row_groups)) < 1 << 20


def test_selective_reads(spark, files):
    everything = sorted(token_files.read_tokens(spark, files).collect(), key=lambda r: r.start)
    numbers = token_files.read_tokens(spark, files, ids=False)
    assert sorted(map(tuple, numbers.collect())) == sorted(((r.doc_id, r.start, r.n_tokens) for r in everything)) if all(
        r.doc_id is not None for r in everything) else numbers.count() == len(everything)
    assert "ids" not in numbers._jdf.queryExecution().executedPlan().toString()
    some = token_files.read_tokens(spark, files, documents=(5, 9))
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id,5), LessThanOrEqual(doc_id,9)" in some._jdf.queryExecution().toString()
    assert sorted(r.start for r in some.collect()) == [r.start for r in everything if r.doc_id is not None and 5 <= r.doc_id <= 9]
    total = everything[-1].start + everything[-1].n_tokens
    for first, last in ((0, 1), (total // 3, total // 3 + 40), (total // 4, 3 * total // 4), (total - 1, total), (total, total + 5)):
        got = token_files.read_tokens(spark, files, places=(first, last))
        assert sorted(r.start for r in got.collect()) == [r.start for r in everything if r.start < last and r.start + r.n_tokens > first]


def test_one_id_over_many_shards(spark, tmp_path, tokenizer):
    frame = spark.createDataFrame([(7, f"text {i}") for i in range(300)], "doc_id bigint, text string").repartition(3)
    token_files.write_tokens(frame, str(tmp_path), word_tokenizer(), shards=4)
    shards = spark.read.parquet(f"{tmp_path}/shards").collect()
    assert len(shards) > 1 and sum(s.documents for s in shards) == 300
    got = token_files.read_tokens(spark, str(tmp_path)).orderBy("start").collect()
    assert [r.start for r in got] == list(np.cumsum([0] + [r.n_tokens for r in got[:-1]]))
    assert sorted(r.ids for r in got) == sorted(encode(tokenizer, f"text {i}") for i in range(300))


def test_no_documents(spark, no_docs, tmp_path):
    token_files.write_tokens(no_docs, str(tmp_path), word_tokenizer())
    assert token_files.with_checksum(token_files.read_tokens(spark, str(tmp_path))).count() == 0
