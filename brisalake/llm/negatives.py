"""Hard negatives by shared candidate lists of anchor clusters.

Anchors are clustered by direction. For a cluster with centre c and angular spread t,
a candidate v at angle w from c scores at most |a| |v| cos(max(0, w - t)) with any
member a: one list of candidates, sorted by |v| cos(max(0, w - t)), serves all
members. Each member walks it from the top until the bound at its place falls below
what it still needs, which certifies that nothing further down belongs to its result.

On the cluster, candidates lie in blocks of bounded size that are tight in direction
(a cell of the nearest pivot, a narrow range of angles to it). A group of at most
``group_rows`` anchors orders the blocks by the same kind of bound. Its first blocks
are one list, walked in one task; the thresholds found there rule out most other
blocks, and what remains is walked in further lists of bounded length, in parallel.
Positives are walked first; their scores are the windows in which negatives are sought.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brisalake.llm.common import Stage
from brisalake.llm.topk import exact_products, fitting, matrix, whole

LOW, HIGH = -(2**63), 2**63 - 1
STEP = 1024  # candidates walked at a time
SLACK = 1e-6  # radians, and relative to a bound: against rounding
MERGE = 50_000
BLOCK = "n int, cell int, block bigint, rows int, near double, far double, longest double, width int, ids binary, labels binary, vectors binary"


def angles(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Angle of each row to the centre; 0 for a row of zeros, which scores 0 with everything."""
    size = np.sqrt((x * x).sum(1)) * np.sqrt(centre @ centre)
    return np.arccos(np.clip(np.divide(x @ centre, size, out=np.ones(len(x)), where=size > 0), -1, 1))


def directions(x: np.ndarray, count: int, rounds: int = 8) -> np.ndarray:
    """Unit vectors near which the rows lie: spherical k-means from a farthest-first start."""
    x = x[(x != 0).any(1)].astype(float)
    if not len(x):
        return np.zeros((0, x.shape[1]))
    x /= np.sqrt((x * x).sum(1))[:, None]
    heads, best = [0], x @ x[0]
    while len(heads) < min(count, len(x)):
        heads.append(int(best.argmin()))
        best = np.maximum(best, x @ x[heads[-1]])
    centres = x[heads]
    for _ in range(rounds):
        nearest = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        size = np.sqrt((sums * sums).sum(1))
        centres = np.where(size[:, None] > 1e-9, sums / np.maximum(size, 1e-9)[:, None], centres)
    return centres


def by_length(sample: list[list[int]], count: int) -> dict[int, np.ndarray]:
    return {n: directions(matrix([v for v in sample if len(v) == n]), count) for n in {len(v) for v in sample}}


def placed(rows: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """``rows`` (key, label, v) with n, the nearest centre (cell; -1 without one), the angle to it and the length."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            sizes = part["v"].map(len).to_numpy(int)
            cell, angle, length = np.full(len(part), -1), np.zeros(len(part)), np.zeros(len(part))
            for n in np.unique(sizes):
                at = np.flatnonzero(sizes == n)
                x = matrix(part["v"].iloc[at]).reshape(len(at), n).astype(float)
                length[at] = np.sqrt((x * x).sum(1))
                if len(known := centres.get(int(n), np.zeros((0, n)))):
                    cell[at] = (x @ known.T).argmax(1)
                    for c in np.unique(cell[at]):
                        angle[at[cell[at] == c]] = angles(x[cell[at] == c], known[c])
            yield part.assign(n=sizes, cell=cell, angle=angle, length=length)[["key", "label", "n", "cell", "angle", "length", "v"]]

    return rows.select("key", "label", "v").mapInPandas(
        run, "key bigint, label bigint, n int, cell int, angle double, length double, v array<bigint>")


def pack(rows: DataFrame, block_rows: int) -> DataFrame:
    """Placed candidates in blocks of one cell and a narrow range of angles; a cell of any size spreads over many tasks."""
    def block(part: pd.DataFrame, number: int) -> pd.DataFrame:
        x = matrix(part["v"]).reshape(len(part), -1)
        width = next(w for w in (1, 2, 4, 8) if w == 8 or (np.abs(x) < 2 ** (8 * w - 1)).all())
        near, far = (0.0, np.pi) if part["cell"].iloc[0] < 0 else (part["angle"].min(), part["angle"].max())
        return pd.DataFrame({"n": part["n"].iloc[:1], "cell": part["cell"].iloc[0], "block": number, "rows": len(part), "near": near,
                             "far": far, "longest": part["length"].max(), "width": width, "ids": part["key"].to_numpy("<i8").tobytes(),
                             "labels": part["label"].to_numpy("<i8").tobytes(), "vectors": x.astype(f"<i{width}").tobytes()})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, held = TaskContext.get().partitionId() << 32, None
        for part in batches:
            held = part if held is None else pd.concat([held, part])
            place = (held["n"].to_numpy(np.int64) << 32) + held["cell"].to_numpy()
            cuts, start = [*(np.flatnonzero(np.diff(place)) + 1), len(held)], 0
            for end in cuts:
                while start < end and (end - start >= block_rows or end < len(held)):
                    take = min(block_rows, end - start)
                    yield block(held.iloc[start:start + take], number)
                    number, start = number + 1, start + take
            held = held.iloc[start:]
        if held is not None and len(held):
            yield block(held, number)

    dealt = rows.repartitionByRange("n", "cell", "angle", "key").sortWithinPartitions("n", "cell", "angle", "key")
    return dealt.mapInPandas(run, BLOCK)


def group_anchors(rows: DataFrame, group_rows: int) -> DataFrame:
    """Placed anchors with the number of their group: one cluster, at most ``group_rows`` of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, last, filled = (TaskContext.get().partitionId() << 32) - 1, None, 0
        for batch in batches:
            out = []
            for place in zip(batch.column("n").to_pylist(), batch.column("cell").to_pylist()):
                if place != last or filled == group_rows:
                    group, last, filled = group + 1, place, 0
                filled += 1
                out.append(group)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int64())], names=[*batch.schema.names, "group"])

    dealt = rows.repartitionByRange("n", "cell", "angle", "key").sortWithinPartitions("n", "cell", "angle", "key")
    return dealt.mapInArrow(run, "key bigint, label bigint, n int, cell int, angle double, length double, v array<bigint>, group bigint")


class Walk:
    """One list of candidates and the members that walk it; each has windows of scores in which it keeps its k best."""

    def __init__(self, members: pd.DataFrame, blocks: pd.DataFrame, centre: np.ndarray | None, k: int, same: bool):
        n = int(members["n"].iloc[0])
        self.a, self.k, self.same = matrix(members["v"]).reshape(len(members), n), k, same
        self.label, self.key = members["label"].to_numpy(np.int64), members["key"].to_numpy(np.int64)
        self.length = np.sqrt((self.a.astype(float) ** 2).sum(1))
        windows = max(len(w) for w in members["low"])
        fill = lambda name, empty: np.array([[*w, *[empty] * (windows - len(w))] for w in members[name]], np.int64)
        self.low, self.high = fill("low", HIGH), fill("high", LOW)
        self.need = np.maximum(self.low, fill("kth", LOW))
        v = [np.frombuffer(b.vectors, f"<i{b.width}").reshape(b.rows, n) for b in blocks.itertuples()]
        x = np.concatenate(v).astype(np.int64)
        fitting(self.a, x)
        size = np.sqrt((x.astype(float) ** 2).sum(1))
        if centre is None:
            limit = size
        else:
            spread = angles(self.a.astype(float), centre).max()
            limit = size * np.cos(np.maximum(angles(x.astype(float), centre) - spread - SLACK, 0))
        order = np.argsort(-limit, kind="stable")  # the cluster's list, sorted once for all members
        self.x, self.limit = x[order], limit[order] + SLACK * size.max(initial=0)
        self.ids = np.concatenate([np.frombuffer(b, "<i8") for b in blocks["ids"]])[order]
        self.labels = np.concatenate([np.frombuffer(b, "<i8") for b in blocks["labels"]])[order]
        self.best = [np.zeros(0, np.int64) for _ in range(4)]  # member, window, score, id
        self.fresh: list[tuple[np.ndarray, ...]] = []

    def merge(self) -> None:
        m, w, s, i = (np.concatenate([b, *(f[j] for f in self.fresh)]) for j, b in enumerate(self.best))
        by = np.lexsort((i, ~s, w, m))
        m, w, s, i = m[by], w[by], s[by], i[by]
        place = m * self.low.shape[1] + w
        rank = np.arange(len(m)) - np.searchsorted(place, place, side="left")
        full = rank == self.k - 1
        np.maximum.at(self.need, (m[full], w[full]), s[full])
        self.best = [x[rank < self.k] for x in (m, w, s, i)]
        self.fresh.clear()

    def run(self) -> pd.DataFrame:
        """key, window, score, id of every member's k best per window within this list."""
        open_ = self.low <= self.high
        for at in range(0, len(self.x), STEP):
            least = np.where(open_, self.need, HIGH).astype(float).min(1)
            walking = np.flatnonzero(open_.any(1) & (self.length * self.limit[at] + 1 >= least - SLACK * np.abs(least)))
            if not len(walking):
                break  # certified: the list only falls from here
            got = exact_products(self.a[walking], self.x[at:at + STEP])
            fits = (self.label[walking, None] == self.labels[None, at:at + STEP]) == self.same
            for w in range(self.low.shape[1]):
                m, c = np.nonzero(fits & (got >= self.need[walking, w, None]) & (got <= self.high[walking, w, None]))
                if len(m):
                    self.fresh.append((walking[m], np.full(len(m), w), got[m, c], self.ids[at + c]))
            if self.fresh:
                self.merge()
        m, w, s, i = self.best
        return pd.DataFrame({"key": self.key[m], "window": w, "score": s, "id": i})


class Lists:
    """The blocks each group of anchors can open, in order of their bound, and how to walk them."""

    def __init__(self, stage: Stage, data: DataFrame, asked: DataFrame, pivots: int, sample: int, block_rows: int, group_rows: int,
                 first: int, length: int):
        self.stage, self.first, self.length = stage, first, length
        # Bounded on the driver: ``sample`` candidates and ``sample`` anchors, from which the directions are made.
        some = lambda rows: [r["v"] for r in rows.orderBy(F.xxhash64("key"), "key").limit(sample).select("v").collect()]
        count = lambda rows, each: max(1, min(pivots, -(-rows.count() // each)))
        cells = by_length(some(data), count(data, block_rows))
        self.clusters = by_length(some(asked), count(asked, group_rows // 4))
        self.blocks = stage.store(pack(placed(data, cells), block_rows), "blocks")
        self.asked = stage.store(group_anchors(placed(asked, self.clusters), group_rows), "asked")
        groups = self.asked.groupBy("n", "cell", "group").agg(F.max("angle").alias("spread"))
        clusters = self.clusters

        def seen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            """A row per group and cell of candidates, with the angle between the two directions."""
            for part in batches:
                out = []
                for g in part.itertuples():
                    known, own = cells.get(g.n, np.zeros((0, g.n))), clusters.get(g.n, np.zeros((0, g.n)))
                    if g.cell >= 0 and len(known):
                        turn = np.arccos(np.clip(known @ own[g.cell], -1, 1))
                        out += [(g.n, c, g.group, t, g.spread) for c, t in enumerate(turn)]
                        out.append((g.n, -1, g.group, 0.0, np.pi))
                    else:
                        out += [(g.n, c, g.group, 0.0, np.pi) for c in range(-1, len(known))]
                yield pd.DataFrame(out, columns=["n", "cell", "group", "turn", "spread"])

        pairs = groups.mapInPandas(seen, "n int, cell int, group bigint, turn double, spread double").join(
            self.blocks.select("n", "cell", "block", "near", "far", "longest"), ["n", "cell"])
        apart = F.greatest(F.lit(0.0), F.col("turn") - F.col("spread") - F.col("far"),
                           F.col("near") - F.col("turn") - F.col("spread")) - 2 * SLACK
        bound = F.col("longest") * F.cos(F.greatest(F.lit(0.0), apart))
        order = Window.partitionBy("group").orderBy(F.desc("bound"), "block")
        self.pairs = stage.store(pairs.select("group", "block", (bound + SLACK * F.col("longest")).alias("bound"))
                                 .withColumn("place", F.row_number().over(order)), "pairs")

    def walk(self, name: str, windows: DataFrame, k: int, same: bool) -> DataFrame:
        """key, window, score, id, rank of the k best per key and window (``windows``: key, window, low, high).

        ``same`` seeks rows of the anchor's own label, otherwise of other labels.
        """
        start = windows.withColumn("kth", F.lit(LOW))
        first = self.round(f"{name}-first", self.pairs.filter(F.col("place") <= self.first), start, k, same)
        kth = first.groupBy("key", "window").agg(F.count("*").alias("found"), F.min("score").alias("least"))
        reached = start.drop("kth").join(kth, ["key", "window"], "left").select(
            "key", "window", "low", "high", F.when(F.col("found") >= k, F.col("least")).otherwise(F.lit(LOW)).alias("kth"))
        reached = self.stage.store(reached, f"{name}-reached")
        rest = self.round(f"{name}-rest", self.pairs.filter(F.col("place") > self.first), reached, k, same)
        best = Window.partitionBy("key", "window").orderBy(F.desc("score"), "id")
        ranked = first.unionByName(rest).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        return self.stage.store(ranked, name)

    def round(self, name: str, pairs: DataFrame, windows: DataFrame, k: int, same: bool) -> DataFrame:
        """Walk those of ``pairs`` that some member's open window still needs."""
        need = F.greatest("low", "kth")
        listed = windows.filter("low <= high").groupBy("key").agg(
            F.sort_array(F.collect_list(F.struct("window", "low", "high", "kth"))).alias("w"), F.min(need).alias("need"))
        members = self.asked.join(listed, "key")
        least = F.when(F.col("length") > 0, F.col("need") / F.col("length")).when(F.col("need") <= 0, F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
        groups = members.groupBy("group").agg(F.min(least).alias("least"))
        margin = F.abs("least") * SLACK + F.lit(SLACK)
        opened = pairs.join(groups, "group").filter(F.col("bound") >= F.col("least") - F.when(margin.isNotNull() & ~F.isnan(margin) & (margin < float("inf")), margin).otherwise(F.lit(0.0)))
        opened = self.stage.store(opened.select("group", "block", F.floor((F.col("place") - 1) / self.length).alias("list")), f"{name}-opened")
        walks = members.join(opened.select("group", "list").distinct(), "group").select(
            "group", "list", "key", "label", "n", "cell", "v", *[F.col(f"w.{c}").alias(c) for c in ("window", "low", "high", "kth")])
        again = opened.select(*[F.col(c).alias(c) for c in opened.columns])
        blocks = again.join(self.blocks.select("block", "rows", "width", "ids", "labels", "vectors"), "block")
        clusters = self.clusters

        def run(members: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
            if not len(members) or not len(blocks):
                return pd.DataFrame({"key": [], "window": [], "score": [], "id": []}, dtype="int64")
            n, cell = int(members["n"].iloc[0]), int(members["cell"].iloc[0])
            found = Walk(members, blocks, clusters[n][cell] if cell >= 0 else None, k, same).run()
            numbers = dict(zip(members["key"], members["window"]))
            return found.assign(window=[numbers[key][w] for key, w in zip(found["key"], found["window"])])

        found = walks.groupBy("group", "list").cogroup(blocks.groupBy("group", "list")).applyInPandas(
            run, "key bigint, window bigint, score bigint, id bigint")
        return self.stage.store(found, name)


def hard_negatives(spark: SparkSession, vectors: DataFrame, is_anchor: Column, label: Column, id_column: str = "vec_id",
                   vector_column: str = "embedding", scale: int = 256, positives: int = 5, negatives: int = 5, low: int = 80,
                   pivots: int = 64, sample: int = 4096, block_rows: int = 2048, group_rows: int = 256, first: int = 16,
                   length: int = 32) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor's positives are its ``positives`` best other rows of its label; for each,
    the ``negatives`` best rows of other labels that score at least ``low`` per cent of
    the positive and at most as much. All order is by falling score, then rising id.
    A positive with a negative score has no such rows.

    A row with a null id, a null label, a null vector or a null or non-finite component
    (or one whose whole part does not fit in 64 bits) takes no part; an inner product
    that does not fit raises. The same row again (id, label and vector) counts once;
    rows of one id that differ are different rows. Vectors of different lengths are
    never compared; of equal vectors with one label only the smallest ids can be in a
    result, so copies are searched once. An empty table, or no anchors, give no rows;
    other columns are not read.
    """
    stage = Stage(spark)
    v = whole(F.col(vector_column), scale)
    rows = vectors.select(F.col(id_column).cast("bigint").alias("id"), label.cast("bigint").alias("label"), is_anchor.alias("anchor"), v.alias("v"))
    rows = rows.filter("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").groupBy("id", "label", "v").agg(F.max("anchor").alias("anchor"))
    rows = stage.store(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    copies = Window.partitionBy("v", "label").orderBy("id", "row")
    data = rows.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= max(positives + 1, negatives))
    data = stage.store(data.select(F.col("id").alias("key"), "label", "v"), "data")
    asked = stage.store(rows.filter("anchor").groupBy("v", "label").agg(F.min("row").alias("key")), "keys")
    lists = Lists(stage, data, asked, pivots, sample, block_rows, group_rows, first, length)
    everything = asked.select("key", F.lit(0).cast("bigint").alias("window"), F.lit(LOW).alias("low"), F.lit(HIGH).alias("high"))
    near = lists.walk("positives", everything, positives + 1, True)
    # low per cent of a score, rounded up: the rest of it, rounded down, taken off without overflow.
    rest = F.expr(f"(score div 100) * {100 - low} + ((score % 100) * {100 - low}) div 100")
    wanted = near.filter("score >= 0").select("key", "score").distinct().select(
        "key", F.col("score").alias("window"), (F.col("score") - rest).alias("low"), F.col("score").alias("high"))
    far = lists.walk("negatives", stage.store(wanted, "wanted"), negatives, False)
    square = F.aggregate("v", F.lit(0).cast("bigint"), lambda a, x: a + x * x)
    anchors = rows.filter("anchor").join(asked, ["v", "label"]).select("row", F.col("id").alias("anchor_id"), square.alias("own"), "key")
    found = anchors.join(near.select("key", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), "rank"), "key")
    # The anchor itself is one of the rows of its own id and square, if it is there at all.
    itself = (F.col("positive_id") == F.col("anchor_id")) & (F.col("positive_score") == F.col("own"))
    one = Window.partitionBy("row", "positive_id", "positive_score").orderBy("rank")
    others = found.withColumn("copy", F.row_number().over(one)).filter(~(itself & (F.col("copy") == 1)))
    in_order = Window.partitionBy("row").orderBy("rank")
    chosen = others.withColumn("number", F.row_number().over(in_order)).filter(F.col("number") <= positives)
    return chosen.drop("rank").join(far.select("key", F.col("window").alias("positive_score"), "rank", F.col("id").alias("negative_id"),
                                               F.col("score").alias("negative_score")), ["key", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
