"""The trie against a plain one, and its hash table."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from brisalake.llm import prefix_trie as pt

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, prefix string"


def conversations(seed=0, n=60):
    rng = np.random.default_rng(seed)
    words = ["yes", "no", "", None, "é", "a longer answer", "x" * 400]
    rows = []
    for c in range(n):
        for t in range(int(rng.integers(1, 14))):
            rows.append((c, None if t == 0 and c % 9 == 0 else t, ("user", "assistant", None)[int(rng.integers(0, 3)) if c % 4 == 0 else t % 2],
                         words[int(rng.integers(0, 2 if t < 4 else 7))], 1, "clash"))
    for c in range(100, 160):  # the same conversation very often
        rows += [(c, t, "user", f"same {t}", None, None) for t in range(3)]
    rows += [(-3, t, "user", "below zero", None, None) for t in range(12)] + [(None, 1, "user", "nobody", None, None)]
    rows += [(204, 0, "user", "no base", None, None), (209, 0, "user", "twice", None, None), (209, 0, "user", "twice", None, None)]
    return rows


def key(turn):
    role, text = (x or "" for x in turn)
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def plain(rows, graft=True):
    own = defaultdict(list)
    for c, t, role, text, *_ in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, key((role, text)), role or "", text or ""))
    own = {c: [r[3:] for r in sorted(v)] for c, v in own.items()}
    built = own if not graft else {}
    for c in own if graft else ():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, who in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(who) - 1) * (len(p[-1][1].encode()) if p else 0)
    sha = lambda p: hashlib.sha256(",".join(map(str, sorted(ends.get(p, ())))).encode()).hexdigest()
    return Counter((min(w), len(p), min(members[p[:-1]]) if p else None, len(w), children[p], leaves[p], saved[p], sha(p)) for p, w in members.items())


def run(spark, rows, **options):
    digests = pt.turn_digests(spark.createDataFrame(rows, SCHEMA).repartition(5))
    c = F.col("conv")
    grafted = pt.graft(digests, c - F.pmod(c, F.lit(5)), (F.crc32(c.cast("string")) % 9).cast("int"), 8)
    return Counter(map(tuple, pt.prefix_trie(spark, grafted, **options).collect()))


def test_equals_a_plain_trie(spark):
    rows = conversations()
    assert run(spark, rows) == plain(rows)


def test_many_cells_and_shards(spark):
    """Components cut by few members and few turns, one shard per few nodes."""
    rows = conversations(5)
    assert run(spark, rows, spread=3, depth=2, shard_nodes=7) == plain(rows)


def test_without_grafting_and_long_conversation(spark):
    rows = conversations(2, 20) + [(500, t, "user", f"turn {t}", None, None) for t in range(900)]
    none = pt.graft(pt.turn_digests(spark.createDataFrame(rows, SCHEMA)), F.col("conv"), F.lit(0), 0)
    assert Counter(map(tuple, pt.prefix_trie(spark, none, depth=100).collect())) == plain(rows, graft=False)


def test_no_conversations(spark):
    assert not run(spark, [])


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 5000):
        known = rng.integers(0, 2**63, (n, 4)).astype(np.uint64)
        table = pt.SlotTable(known)
        assert sorted(table.find(known)) == list(range(n))
        assert (table.find(rng.integers(0, 2**63, (3000, 4)).astype(np.uint64)) == -1).all()


def test_equal_words_of_digests():
    """Digests that agree in three of four words are still told apart."""
    known = np.zeros((300, 4), np.uint64)
    known[:, 3] = np.arange(300)
    assert sorted(pt.SlotTable(known).find(known)) == list(range(300))


def test_ends_over_several_ranges(spark, monkeypatch):
    ids = [5, 70_000, 3, 200_000, 66_000, -5]
    paths = spark.createDataFrame([(i, 0, bytearray(32), 0, True) for i in ids], pt.PATHS)
    got = pt.end_hashes(paths).collect()
    assert [r.ends_sha256 for r in got] == [hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()]
