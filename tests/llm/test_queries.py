"""Every registered query on the smallest driver tables against a plain reading of its contract."""

import hashlib
import os
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

from brisalake.llm import queries
from helpers import words

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return con


@pytest.fixture(scope="module")
def texts(tables):
    return dict(tables.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


def run(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle_sql(spark, tables, name):
    got = queries.QUERIES[name](spark, SF)
    want = tables.execute(queries.ORACLES[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in got.collect()))) == sorted(map(repr, want.fetchall()))


def test_op1(spark, texts):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in texts.items():
        w = words(t.translate(lower))
        sets[i] = {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in run(spark, "op1_token_group_jaccard")} == {i: (len(sets[i]), top(i)) for i in sets}


def test_op3(spark, texts):
    rows = run(spark, "op3_boosted_quality")
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_op4(spark, texts):
    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in run(spark, "op4_cost_balanced_packing"):
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for i, t in texts.items():
        ids, at = np.array(tokenizer.encode(t, add_special_tokens=False).ids + [0], "<u4"), 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024


def test_op5(spark, texts, tables):
    source = dict(tables.execute("SELECT doc_id, source FROM documents").fetchall())
    rows = run(spark, "op5_splitting_tree_mixing")
    by_source = defaultdict(list)
    for r in rows:
        assert r.size == len(words(texts[r.doc_id])) and 0 <= r.taken <= 2 * r.size
        by_source[source[r.doc_id]].append(r)
    for part in by_source.values():
        assert {r.source_size for r in part} == {sum(r.size for r in part)} and len({r.target for r in part}) == 1
        assert abs(sum(r.taken for r in part) - part[0].target) <= 2
    total = sum(r.size for r in rows)
    assert abs(sum(p[0].target for p in by_source.values()) - min(1.5 * total, 2 * total)) < 1e-3 * total


def test_op6(spark, texts):
    rows = {r.doc_id: r for r in run(spark, "op6_bwt_repeats")}
    starts = defaultdict(int)
    raw = {i: t.encode() for i, t in texts.items()}
    for b in raw.values():
        for j in range(len(b) - 399):
            starts[hash(b[j:j + 400])] += 1
    for i, b in raw.items():
        gone = np.zeros(len(b) + 1, np.int64)
        for j in range(len(b) - 399):
            if starts[hash(b[j:j + 400])] > 1:
                gone[j:j + 400] = 1
        r, edge = rows[i], np.diff(np.concatenate([[0], gone]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(b), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(kept).hexdigest())


def test_op8(spark, tables):
    turns = defaultdict(list)
    for c, role, text in tables.execute("SELECT conv_id, coalesce(role, ''), coalesce(text, '') FROM conversations ORDER BY conv_id, turn").fetchall():
        turns[c].append((role, text))
    turns[-7] = [(r, "</s>[INST] ok [/INST]") for r in ("user", "assistant")]
    rows = {r.conv_id: r for r in run(spark, "op8_typed_chat")}
    assert set(rows) == set(turns)
    for c, said in turns.items():
        learned = "".join(t for r, t in said if r == "assistant")
        r = rows[c]
        assert (r.n_turns, r.turns_sha256) == (len(said), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in said).encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest()) and r.formatted_chars > r.loss_chars


def test_op10(spark, texts):
    patterns = [re.compile(r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A),
                re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")]
    for r in run(spark, "op10_randomness_secrets"):
        found = [[], [], []]
        for kind, (p, least) in enumerate(zip(patterns, (6, 20, 24))):
            for m in p.finditer(texts[r.doc_id]):
                if len(m.group(1) if kind == 0 else m.group()) >= least:
                    found[kind].append(m.span())
        spans = sorted((a, k, b) for k, f in enumerate(found) for a, b in f)
        listed = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(map(len, found))
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest() and set(filter(None, listed.split(","))) <= set(r.spans.split(","))


def test_op12(spark, texts):
    tokenizer = Tokenizer.from_file(queries.word_tokenizer())
    rows, at = {r.doc_id: r for r in run(spark, "op12_token_lists")}, 0
    for i in sorted(texts):
        ids = np.array(tokenizer.encode(texts[i], add_special_tokens=False).ids + [2], "<u4")
        assert tuple(rows[i]) == (i, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert len(rows) == len(texts)


def test_op2(spark, texts):
    rows = {r.doc_id: r for r in run(spark, "op2_cross_entropy_difference")}
    assert set(rows) == set(texts) and all(r.n_words == len(words(texts[i])) for i, r in rows.items())
    assert all(abs(r.score - (r.target_loss - r.background_loss)) < 1e-9 for r in rows.values() if r.n_words)
