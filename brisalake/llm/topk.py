"""Exact top-k by inner product: dual-tree search over cover trees.

Rows are dealt into blocks of bounded size by the nearest of a few pivots; queries
are cut into chunks of bounded size. For each block and chunk a task builds a cover
tree of either side and walks both trees together. A pair of nodes is dropped when no
inner product between them can reach the worst k-th score of the query node's
queries: for centres q, d and covering radii rq, rd it is at most
q.d + rq |d| + rd |q| + rq rd. Each query starts with the k-th best score in a
bounded sample of the rows, a valid lower bound, which also drops whole cells before
anything is shuffled. Every row is indexed, and pruning never changes the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brisalake.llm.common import Stage

LEAF, FAN = 256, 8
MERGE = 50_000  # candidates gathered before they are merged into the best
SLACK = 1e-6  # against rounding of the bound, relative to its parts


class CoverTree:
    """Nodes over a reordered matrix: a centre, its covering radius, a range of rows, and children or none.

    The children's centres are taken farthest first, the node's own to begin with: any
    two of them are at least as far apart as any row is from the nearest, to which it
    belongs.
    """

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(x))
        self.nodes: list[tuple[np.ndarray, float, float, int, int, list[int]]] = []
        todo = [(0, len(x), None)]
        while todo:
            lo, hi, parent = todo.pop()
            rows = self.order[lo:hi].copy()
            centre = x[rows[0]]
            far = np.sqrt(((x[rows] - centre) ** 2).sum(1))
            number = len(self.nodes)
            self.nodes.append((centre, float(far.max()), float(np.sqrt(centre @ centre)), lo, hi, []))
            if parent is not None:
                self.nodes[parent][5].append(number)
            if hi - lo <= leaf or far.max() == 0:
                continue
            nearest, heads = np.zeros(len(rows), np.int64), [0]
            for j in range(1, FAN):
                head = int(far.argmax())
                if far[head] == 0:
                    break
                heads.append(head)
                other = np.sqrt(((x[rows] - x[rows[head]]) ** 2).sum(1))
                nearest[other < far] = j
                far = np.minimum(far, other)
            at = lo
            for j, head in enumerate(heads):
                group = np.flatnonzero(nearest == j)
                group = rows[np.concatenate([[head], group[group != head]])]  # the head comes first: it is the child's centre
                self.order[at:at + len(group)] = group
                todo.append((at, at + len(group), number))
                at += len(group)
        self.sorted = x[self.order]


def dual_search(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query, id, score) of each query's k best rows that reach its floor; ties go to the smaller id."""
    fitting(queries, rows)
    top = max(np.abs(queries).max(initial=0), np.abs(rows).max(initial=0))
    exact_in_double = float(top) ** 2 * rows.shape[1] < 2**52
    qt, dt = CoverTree(queries.astype(float)), CoverTree(rows.astype(float))
    q_rows = qt.sorted if exact_in_double else queries[qt.order]
    d_rows = dt.sorted if exact_in_double else rows[dt.order]
    d_ids = ids[dt.order]
    worst = floor[qt.order].astype(np.int64)
    best = [np.zeros(0, np.int64) for _ in range(3)]  # query, score, id; by query, then best first
    fresh: list[tuple[np.ndarray, ...]] = []

    def merge() -> None:
        """Keep each query's k best; its k-th raises what later pairs must reach."""
        q, s, i = (np.concatenate([b, *(f[j] for f in fresh)]) for j, b in enumerate(best))
        by = np.lexsort((i, ~s, q))  # ~s sorts like -s and cannot overflow
        q, s, i = q[by], s[by], i[by]
        first = np.searchsorted(q, q, side="left")
        rank = np.arange(len(q)) - first
        np.maximum.at(worst, q[rank == k - 1], s[rank == k - 1])
        for j, x in enumerate((q, s, i)):
            best[j] = x[rank < k]
        fresh.clear()

    def bound(a: int, b: int) -> float:
        qc, rq, nq, *_ = qt.nodes[a]
        dc, rd, nd, *_ = dt.nodes[b]
        parts = abs(qc @ dc) + rq * nd + rd * nq + rq * rd
        return qc @ dc + rq * nd + rd * nq + rq * rd + SLACK * parts + SLACK

    todo = [(bound(0, 0), 0, 0)]
    while todo:
        limit, a, b = todo.pop()
        _, rq, _, qlo, qhi, q_children = qt.nodes[a]
        _, rd, _, dlo, dhi, d_children = dt.nodes[b]
        if limit < worst[qlo:qhi].min():
            continue
        if not q_children and not d_children:
            got = np.asarray(q_rows[qlo:qhi] @ d_rows[dlo:dhi].T).astype(np.int64)
            q, d = np.nonzero(got >= worst[qlo:qhi, None])
            if len(q):
                fresh.append((q + qlo, got[q, d], d_ids[dlo + d]))
                if sum(len(f[0]) for f in fresh) > MERGE:
                    merge()
            continue
        if d_children and (rd >= rq or not q_children):
            pairs = [(a, c) for c in d_children]
        else:
            pairs = [(c, b) for c in q_children]
        todo.extend(sorted((bound(x, y), x, y) for x, y in pairs))  # the most promising pair is walked first
    merge()
    return qt.order[best[0]], best[2], best[1]


def matrix(lists) -> np.ndarray:
    return np.stack([np.asarray(v, np.int64) for v in lists]) if len(lists) else np.zeros((0, 0), np.int64)


def whole(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, or null for a vector that takes no part."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) * scale >= 2.0**63))
    return F.when(vector.isNotNull() & ~bad, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def top_k(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id",
          vector_column: str = "embedding", scale: int = 64, pivots: int = 32, sample: int = 4096, block_rows: int = 4096,
          query_rows: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best other rows, ties to the smaller id.

    A vector that is null, has a null or non-finite component or one whose whole part
    does not fit in 64 bits, or has no id, takes no part; an inner product that does
    not fit raises. Rows with the same id and different vectors are different rows,
    each of them a query if the id is; the same vector again counts once. Vectors of different lengths are never compared.
    With fewer than k others all are returned; an empty table gives no rows; other
    columns are not read. Rows with the same vector are searched once: as ties go to
    smaller ids, only the k + 1 smallest ids of a vector can appear.
    """
    stage = Stage(spark)
    v = whole(F.col(vector_column), scale)
    rows = vectors.select(F.col(id_column).cast("bigint").alias("id"), is_query.alias("query"), v.alias("v"))
    rows = rows.filter("id IS NOT NULL AND v IS NOT NULL").groupBy("id", "v").agg(F.max("query").alias("query"))
    rows = stage.store(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    copies = Window.partitionBy("v").orderBy("id")
    data = rows.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= k + 1).select("id", "v", F.size("v").alias("n"))
    data = stage.store(data, "data")
    asked = stage.store(rows.filter("query").groupBy("v").agg(F.min("row").alias("key")), "asked")

    # Bounded on the driver: ``sample`` vectors, and the radius and size of ``pivots`` cells a length.
    some = [(r.n, r.v) for r in data.orderBy(F.xxhash64("id"), "id").limit(sample).select("n", "v").collect()]
    by_length = {n: matrix([x for m, x in some if m == n]) for n in {n for n, _ in some}}

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            cell, far = np.full(len(part), -1), np.zeros(len(part))
            for n, at in part.groupby("n").indices.items():
                centres = by_length[n][:pivots].astype(float) if n in by_length else np.zeros((0, n))
                if not len(centres):
                    centres = np.zeros((1, n))
                x = matrix(part["v"].iloc[at]).reshape(len(at), n).astype(float)
                d = np.sqrt(np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1), 0))
                cell[at], far[at] = d.argmin(1), d.min(1)
            yield part.assign(cell=cell, far=far)[["id", "n", "cell", "far", "v"]]

    placed = stage.store(data.select("id", "n", "v").mapInPandas(nearest, "id bigint, n int, cell int, far double, v array<bigint>"), "placed")
    cells = {(r.n, r.cell): (r.far, -(-r.rows // block_rows)) for r in
             placed.groupBy("n", "cell").agg(F.max("far").alias("far"), F.count("*").alias("rows")).collect()}
    chunks = max(1, -(-asked.count() // query_rows))

    def routed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Queries with their floor, once for each block of the cells that can reach it."""
        for part in batches:
            out = []
            for n, at in part.groupby("n").indices.items():
                x = matrix(part["v"].iloc[at]).reshape(len(at), n)
                known = by_length.get(n, np.zeros((0, n), np.int64))
                floor = np.full(len(at), np.iinfo(np.int64).min)
                if len(known) > k:
                    for i in range(0, len(at), 1024):
                        s = exact_products(x[i:i + 1024], known)
                        floor[i:i + 1024] = np.partition(s, len(known) - k - 1, axis=1)[:, len(known) - k - 1]
                norm = np.sqrt((x.astype(float) ** 2).sum(1))
                for (m, cell), (far, salts) in cells.items():
                    if m != n:
                        continue
                    centre = known[cell].astype(float) if len(known) else np.zeros(n)
                    reach = x @ centre + norm * far
                    ok = np.flatnonzero(reach + SLACK * (norm * (far + np.sqrt(centre @ centre)) + 1) >= floor)
                    for salt in range(salts if len(ok) else 0):
                        out.append(pd.DataFrame({"n": n, "cell": cell, "salt": salt, "chunk": part["chunk"].iloc[at[ok]].to_numpy(),
                                                 "key": part["key"].iloc[at[ok]].to_numpy(), "floor": floor[ok],
                                                 "v": part["v"].iloc[at[ok]].to_list()}))
            if out:
                yield pd.concat(out)

    def search(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"key": [], "id": [], "score": []}, dtype="int64")
        q, ids, score = dual_search(matrix(left["v"]), matrix(right["v"]), right["id"].to_numpy(), left["floor"].to_numpy(), k + 1)
        return pd.DataFrame({"key": left["key"].to_numpy()[q], "id": ids, "score": score})

    place = ["n", "cell", "salt", "chunk"]
    salts = F.create_map(*[x for (n, c), (_, s) in cells.items() for x in (F.lit(f"{n}:{c}"), F.lit(s))]) if cells else F.lit(None)
    blocks = placed.withColumn("salt", F.pmod(F.xxhash64("id"), salts[F.concat_ws(":", "n", "cell")] if cells else F.lit(1)).cast("int"))
    blocks = blocks.select("id", "n", "cell", "salt", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), "v")
    sent = asked.select("key", F.size("v").alias("n"), F.pmod(F.xxhash64("key"), F.lit(chunks)).cast("int").alias("chunk"), "v") \
        .mapInPandas(routed, "n int, cell int, salt int, chunk int, key bigint, floor bigint, v array<bigint>")
    found = sent.groupBy(*place).cogroup(blocks.groupBy(*place)).applyInPandas(search, "key bigint, id bigint, score bigint")
    best = Window.partitionBy("key").orderBy(F.desc("score"), "id")
    found = stage.store(found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k + 1).drop("rank"), "found")
    square = F.aggregate("v", F.lit(0).cast("bigint"), lambda a, x: a + x * x)
    members = rows.filter("query").join(asked, "v").select("row", F.col("id").alias("query_id"), square.alias("own"), "key")
    same = Window.partitionBy("row", "vec_id", "score").orderBy("key")
    ranks = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    answers = members.join(found.withColumnRenamed("id", "vec_id"), "key").withColumn("copy", F.row_number().over(same))
    answers = answers.filter("NOT (vec_id = query_id AND score = own AND copy = 1)")  # the query itself
    return answers.withColumn("rank", F.row_number().over(ranks)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def fitting(a: np.ndarray, b: np.ndarray) -> None:
    """Raise if an inner product does not fit in 64 bits; sums on the way may wrap."""
    longest = [np.sqrt((x.astype(float) ** 2).sum(1)).max(initial=0) for x in (a, b)]
    if longest[0] * longest[1] < 2.0**62:
        return
    for i in range(0, len(a), 256):
        if np.abs(a[i:i + 256].astype(float) @ b.astype(float).T).max(initial=0) >= 2.0**63:
            raise ValueError("inner products do not fit in 64 bits")


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products, through doubles where these are exact."""
    fitting(a, b)
    top = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if float(top) ** 2 * a.shape[1] < 2**52:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T
