"""Trie of conversation prefixes, one node per distinct sequence of turns.

Turns are reduced to digests before anything is shuffled. Each conversation streams
through once, in order, and yields the digest of every prefix; equal prefixes meet in
a count combined before the shuffle. Nodes are then summed from the leaves up in
shards. A minimal perfect hash gives each prefix of a shard its slot; the digest
stored at the slot verifies every lookup, so a parent that lies in another shard is
told apart from one of this shard. Counts lie in flat arrays by slot and are added
through the array of parent slots, deepest turns first.

Shards hold whole components. A component is a connected part of the trie whose nodes
have similar numbers of members (the same power of ``SPREAD``) and lie within the same
``DEPTH`` turns, so it has at most SPREAD * DEPTH nodes however many conversations
share a prefix. Cells of (depth range, power) are summed one after another, deepest
and least shared first; what leaves a component is added up per parent for the next.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brisalake.llm.common import Stage, mixed

SPREAD, DEPTH = 1024, 1024
SHARD_NODES = 1 << 16
ID_BITS = 16  # conversations whose ids differ in these bits only have their end list joined in one row
PATHS = "conv bigint, depth bigint, prefix binary, bytes bigint, last boolean"
SUMS = ("prefix binary, parent binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
        "n_leaves bigint, saved bigint, crosses boolean")


class SlotTable:
    """Minimal perfect hash of distinct 32-byte digests: every digest has a slot of its own below their number.

    At each level the digests left are thrown into twice as many places; those alone in
    theirs take the next slots, the others go to the next level.
    """

    def __init__(self, digests: np.ndarray):
        self.levels, left, used = [], np.arange(len(digests)), 0
        while len(left):
            size = max(64, 2 * len(left))
            place = self.throw(digests[left], len(self.levels), size)
            alone = np.bincount(place, minlength=size) == 1
            self.levels.append((size, alone, used + np.cumsum(alone) - alone))
            used += int(alone.sum())
            left = left[~alone[place]]
        self.stored = np.zeros_like(digests)
        self.stored[self.candidates(digests)] = digests

    @staticmethod
    def throw(digests: np.ndarray, level: int, size: int) -> np.ndarray:
        h = np.full(len(digests), level + 1, np.uint64)
        for word in digests.T:
            h = mixed(h ^ word)
        return (h % np.uint64(size)).astype(np.int64)

    def candidates(self, digests: np.ndarray) -> np.ndarray:
        slots, left = np.full(len(digests), -1), np.arange(len(digests))
        for level, (size, alone, rank) in enumerate(self.levels):
            place = self.throw(digests[left], level, size)
            here = alone[place]
            slots[left[here]] = rank[place[here]]
            left = left[~here]
        return slots

    def find(self, digests: np.ndarray) -> np.ndarray:
        """The slot of each digest; -1 for one that is not in the table."""
        slots = self.candidates(digests)
        same = (slots >= 0) & (self.stored[slots] == digests).all(1) if len(self.stored) else np.zeros(len(digests), bool)
        return np.where(same, slots, -1)


def digest_words(column) -> np.ndarray:
    """Digests as rows of four 64-bit words; null is zeros."""
    return np.frombuffer(b"".join(x if x is not None else bytes(32) for x in column), "<u8").reshape(-1, 4)


def sum_shard(part: pd.DataFrame) -> pd.DataFrame:
    """Children, leaves and saved bytes of one shard's nodes; every component of it is whole."""
    table = SlotTable(own := digest_words(part["prefix"]))
    slot = table.find(own)

    def scatter(values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(values), np.int64)
        out[slot] = values
        return out

    def column(name: str) -> np.ndarray:
        return scatter(part[name].to_numpy(np.int64))

    parent = scatter(table.find(digest_words(part["parent"])))
    parent[slot[part["parent"].isna().to_numpy()]] = -1
    depth, children = column("depth"), column("carried_children")
    inside = np.flatnonzero(parent >= 0)
    np.add.at(children, parent[inside], 1)
    leaves = column("carried_leaves") + (children == 0)
    saved = column("carried_saved") + (column("n_convs") - 1) * column("bytes")
    inside = inside[np.argsort(-depth[inside], kind="stable")]
    for level in np.split(inside, np.flatnonzero(np.diff(depth[inside])) + 1):
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    return part[["prefix", "parent", "conv_id", "depth", "parent_conv_id", "n_convs"]].assign(
        n_children=children[slot], n_leaves=leaves[slot], saved=saved[slot], crosses=parent[slot] < 0)


def turn_digests(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """conv, pos, digest, bytes: the turns of each conversation, numbered from 1.

    In order of ``turn``, null first; turns of one number go by their digest, so the
    order is the same on every run. Null role and text are empty; repeated rows are
    turns of their own; a row without a conversation takes no part; other columns are
    not read. Texts are not shuffled, digests are.
    """
    name, body = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(name).cast("string"), F.lit(":"), name, body), 256))
    rows = turns.select(F.col(conversation).cast("bigint").alias("conv"), F.col(turn).alias("turn"), digest.alias("digest"),
                        F.octet_length(body).cast("bigint").alias("bytes")).filter("conv IS NOT NULL")
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "digest", "bytes")
    return rows.select("conv", F.row_number().over(order).alias("pos"), "digest", "bytes")


def graft(rows: DataFrame, base: Column, head: Column, most: int) -> DataFrame:
    """conv, part, pos, digest, bytes: each conversation with its head taken from another one.

    ``base`` and ``head`` say, from ``conv``, which conversation the first turns come
    from and how many (at most ``most``); the conversation's own turns follow from the
    one after its first ``head``. A part -1 stands for the conversation itself, so one
    that is left without turns is still there.
    """
    convs = rows.select("conv").distinct()
    heads = rows.filter(F.col("pos") <= most).withColumnRenamed("conv", "base")
    taken = convs.select("conv", base.alias("base"), head.alias("head")).join(heads, "base").filter("pos <= head")
    own = rows.filter(F.col("pos") > head).select("conv", F.lit(1).alias("part"), "pos", "digest", "bytes")
    own = own.unionByName(taken.select("conv", F.lit(0).alias("part"), "pos", "digest", "bytes"))
    return own.unionByName(convs.select("conv", F.lit(-1).alias("part"), F.lit(0).alias("pos"),
                                        F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("bigint").alias("bytes")))


def prefix_paths(rows: DataFrame) -> DataFrame:
    """conv, depth, prefix, bytes, last: every prefix of every conversation, the empty one included.

    A prefix's digest covers the digests of its turns in order, which is sequential: a
    conversation streams through one task, a row at a time.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["conv", "depth", "prefix", "bytes", "last"], [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.bool_()]
        conv, depth, prefix, held = None, 0, b"", None
        for batch in batches:
            out = []
            for c, part, digest, size in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if held is not None:
                    out.append((*held, c != conv))
                if c != conv:
                    conv, depth, prefix = c, 0, hashlib.sha256(b"root").digest()
                else:
                    depth, prefix = depth + 1, hashlib.sha256(prefix + digest).digest()
                held = (c, depth, prefix, size)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names=names)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip((*held, True), kinds)], names=names)

    ordered = rows.repartition("conv").sortWithinPartitions("conv", "part", "pos")
    return ordered.select("conv", "part", "digest", "bytes").mapInArrow(run, PATHS)


def end_hashes(paths: DataFrame) -> DataFrame:
    """prefix, ends_sha256: of the conversations that end there, their ids in rising order, joined by commas.

    Ids are first joined by ranges of 2 ** ID_BITS, so that a prefix where very many end
    streams through its task as a few rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, running, done = None, None, []
        for batch in batches:
            for prefix, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if prefix != now:
                    if now is not None:
                        done.append((now, running.hexdigest()))
                    now, running = prefix, hashlib.sha256(ids.encode())
                else:
                    running.update(f",{ids}".encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*done), (pa.binary(), pa.string()))],
                                                 names=["prefix", "ends_sha256"])
                done.clear()
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([running.hexdigest()])],
                                             names=["prefix", "ends_sha256"])

    near = F.shiftright("conv", ID_BITS).alias("range")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    ends = paths.filter("last").groupBy("prefix", near).agg(joined.alias("ids"))
    return ends.repartition("prefix").sortWithinPartitions("prefix", "range").select("prefix", "ids") \
        .mapInArrow(run, "prefix binary, ends_sha256 string")


def prefix_trie(spark: SparkSession, rows: DataFrame, spread: int = SPREAD, depth: int = DEPTH,
                shard_nodes: int = SHARD_NODES) -> DataFrame:
    """A row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``rows`` are conv, part, pos, digest, bytes as ``graft`` gives them, a row of part -1
    for each conversation. No conversations give no rows, not even a root.
    """
    stage = Stage(spark)
    paths = stage.store(prefix_paths(rows), "paths")
    nodes = stage.store(paths.groupBy("prefix").agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv_id")), "nodes")
    power = sum(((F.col("n_convs") > spread ** k).cast("int") for k in range(1, 7) if spread ** k < 2 ** 62), F.lit(0))
    path = Window.partitionBy("conv").orderBy("depth")
    known = paths.join(nodes, "prefix").withColumn("power", power).withColumn("range", F.floor(F.col("depth") / depth))
    known = known.select("*", F.lag("prefix").over(path).alias("parent"), F.lag("conv_id").over(path).alias("parent_conv_id"),
                         F.first("prefix").over(Window.partitionBy("conv", "power", "range").orderBy("depth")).alias("top"))
    known = known.filter("conv = conv_id").drop("conv", "last")  # each node once, from its smallest member's path
    known = stage.store(known, "known")
    cells = known.groupBy("range", "power").count().collect()  # few: powers of members times ranges of depth
    done: DataFrame | None = None
    for i, cell in enumerate(sorted(cells, key=lambda c: (-c["range"], c["power"]))):
        part = known.filter((F.col("range") == cell["range"]) & (F.col("power") == cell["power"]))
        zero = F.lit(0).cast("bigint")
        if done is None:
            part = part.select("*", *[zero.alias(f"carried_{c}") for c in ("children", "leaves", "saved")])
        else:
            carried = done.filter("crosses").groupBy(F.col("parent").alias("prefix")).agg(
                F.count("*").alias("carried_children"), F.sum("n_leaves").alias("carried_leaves"), F.sum("saved").alias("carried_saved"))
            part = part.join(carried, "prefix", "left").fillna(0, ["carried_children", "carried_leaves", "carried_saved"])
        shards = -(-cell["count"] // shard_nodes)
        summed = part.groupBy(F.pmod(F.xxhash64("top"), F.lit(shards)).alias("shard")).applyInPandas(
            lambda p: sum_shard(p), SUMS)
        stored = stage.store(summed, f"sums-{i}")
        done = stored if done is None else done.unionByName(stored)
    if done is None:
        done = spark.createDataFrame([], SUMS)
    none = hashlib.sha256(b"").hexdigest()
    return done.join(stage.store(end_hashes(paths), "ends"), "prefix", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))
