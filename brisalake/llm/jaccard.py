"""N-gram Jaccard join by a token-group matrix.

Documents are sets of word shingles. Two of them can be similar enough only if they
share one of the first ``n - ceil(0.8 n) + 1`` tokens of each in a common order; this
order puts tokens that many documents of a sample share last, so that common passages
are rarely looked at. (The sample steers cost only: any order gives the same links.)

1. Equal sets are one class, kept as one representative.
2. Similar documents are partitioned into groups: representatives that share one of
   their smallest tokens with a leader and have been verified against it. Copies of
   one text with different edits differ in some of these tokens, seldom in all.
3. Leaders that share a token with many others are compared with its hub, the leader
   with the most shared tokens: of a family of near copies the one nearest to the text
   they come from. Then all leaders that can be similar by the tokens they share are
   compared. Groups of similar leaders are joined: a family is one group from here on.
4. The matrix holds, per leading token, the groups whose union has it. Tokens of a
   single group say nothing about links between groups and are dropped, so a family
   adds one row per token, however large. Every document of the smaller of two groups
   is bounded by what it shares with the larger one's union; where that may do, it is
   compared with the group's hub, which joins most groups that belong together. Only what
   is still apart is opened, and its documents bounded and compared one by one.
5. Links between groups make components; classes and copies inherit theirs.

Bounds count leading tokens cut to 48 bits, each as often as a document has it: tokens
that fall together raise a bound and lose nothing.
Every comparison is exact on whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brisalake.llm.common import BLANK, Stage, byte_chunks, mixed, small_side, span_hashes, spans, text_or_empty
from brisalake.llm.components import components

HUB_LEADERS = 8  # leaders of a token from which on they are compared with its hub first (steers cost only)
LEADING = 3  # smallest tokens of a set that may lead it to a group
COMMON = np.int64(1) << np.int64(62)  # set in the place of a common token, so that it sorts last
BUCKET_TOKENS = 500_000
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WEIGHTS = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 64, 64, dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct 62-bit shingle hashes of each text, as int64."""
    for lo, hi, flat, starts in byte_chunks(texts):
        flat = LOWER[flat]
        first, end = spans(~BLANK[flat], starts)
        word = mixed(span_hashes(flat, first, end))
        at = np.searchsorted(first, starts)
        whole = np.zeros(max(len(word) - width + 1, 0), np.uint64)
        for j in range(width):
            whole += word[j:j + len(whole)] * WEIGHTS[j]
        whole = (mixed(whole) >> np.uint64(2)).astype(np.int64)
        for i in range(hi - lo):
            a, n = at[i], at[i + 1] - at[i]
            if n >= width:
                t = np.sort(whole[a:a + n - width + 1])
                yield t[np.concatenate([[True], t[1:] != t[:-1]])] if len(t) else t
            elif n:
                total = (word[a:a + n] * WEIGHTS[:n]).sum(dtype=np.uint64) + np.uint64(n)
                yield (mixed(np.array([total])) >> np.uint64(2)).astype(np.int64)
            else:
                yield np.zeros(0, np.int64)


def common_tokens(docs: DataFrame, width: int, one_in: int, least: int, most: int) -> np.ndarray:
    """Up to ``most`` tokens that at least ``least`` documents of a 1 in ``one_in`` sample share (sorted)."""
    sample = docs.filter(F.pmod(F.xxhash64("id"), F.lit(one_in)) == 0).select("body")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = np.concatenate([np.zeros(0, np.int64), *shingle_sets(batch.column(0), width)])
            yield packed(tokens, np.zeros(len(tokens), np.int64), 64)

    def count(bucket: int, tokens: np.ndarray, _: np.ndarray) -> pa.RecordBatch:
        t, n = np.unique(tokens, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(t[n >= least]), pa.array(n[n >= least])], names=["token", "n"])

    counted = gathered(sample.mapInArrow(deal, PACKED), count, "token bigint, n bigint")
    top = counted.orderBy(F.desc("n"), "token").limit(most).select("token").toPandas()["token"]
    return np.sort(top.to_numpy(np.int64))


PACKED = "bucket int, tokens binary, rows binary"


def short(tokens: np.ndarray) -> bytes:
    """The low 48 bits of each token; enough to find candidates, which are verified on whole tokens."""
    return tokens.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def from_short(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.view(np.int64).ravel()


def packed(tokens: np.ndarray, rows: np.ndarray, buckets: int, rest: np.ndarray | None = None) -> pa.RecordBatch:
    """(token, row) pairs as one row per bucket, in arrays; ``rest`` stands for a token within its bucket."""
    bucket = tokens % buckets
    order = np.argsort(bucket, kind="stable")
    tokens, rows, bucket = (tokens if rest is None else rest)[order], rows[order], bucket[order]
    cut = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]]) if len(bucket) else [0]
    parts = list(zip(cut[:-1], cut[1:]))
    return pa.RecordBatch.from_arrays([
        pa.array([int(bucket[a]) for a, _ in parts], pa.int32()), pa.array([tokens[a:b].tobytes() for a, b in parts], pa.binary()),
        pa.array([rows[a:b].tobytes() for a, b in parts], pa.binary())], names=["bucket", "tokens", "rows"])


def gathered(df: DataFrame, fn, schema: str, width=np.int64) -> DataFrame:
    """fn(bucket, tokens, rows) for each bucket; buckets hold about BUCKET_TOKENS pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def close() -> pa.RecordBatch:
            tokens, rows = (np.frombuffer(b"".join(x[i] for x in held), kind) for i, kind in ((0, width), (1, np.int64)))
            return fn(now, tokens, rows)

        for batch in batches:
            for bucket, tokens, rows in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if held and bucket != now:
                    yield close()
                    held.clear()
                now = bucket
                held.append((tokens, rows))
        if held:
            yield close()

    return df.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


MEASURED = ("id bigint, doc_key binary, n bigint, digest binary, smallest array<bigint>, prefix_size bigint, last bigint, "
            "rare binary, common binary")


def measure(docs: DataFrame, width: int, percent: int, common: np.ndarray) -> DataFrame:
    """Per document its set's size and digest, its smallest tokens, and its prefix split into rare and common tokens."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t in shingle_sets(batch.column(2), width):
                n = len(t)
                take = n - -(-percent * n // 100) + 1 if n else 0
                often = np.zeros(n, bool)
                if len(common) and n:
                    often = common[np.minimum(np.searchsorted(common, t), len(common) - 1)] == t
                rare, shared = t[~often][:take], t[often]
                shared = shared[:take - len(rare)]
                last = int(shared[-1] | COMMON) if len(shared) else int(rare[-1]) if len(rare) else None
                out.append((n, hashlib.blake2b(t.tobytes(), digest_size=16).digest() if n else None,
                            t[:LEADING].tolist(), take, last, short(rare), (shared | COMMON).tobytes()))
            kinds = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            columns = [pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=[
                "id", "doc_key", "n", "digest", "smallest", "prefix_size", "last", "rare", "common"])

    return docs.select("id", "doc_key", "body").mapInArrow(run, MEASURED)


def unpacked(df: DataFrame) -> DataFrame:
    """(row, tokens) to (token, row)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = [np.frombuffer(x, np.int64) for x in batch.column(1).to_pylist()]
            rows = np.repeat(np.asarray(batch.column(0)), [len(t) for t in tokens])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *tokens])), pa.array(rows)],
                                             names=["token", "row"])
    return df.mapInArrow(run, "token bigint, row bigint")


def shared_tokens(prefixes: DataFrame, buckets: int) -> DataFrame:
    """(token, row) of the rare tokens that at least two rows have."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1).to_pylist()
            rows = np.repeat(np.asarray(batch.column(0)), [len(t) // 6 for t in lists])
            tokens = from_short(b"".join(lists))
            for_bucket = tokens % buckets
            yield packed(for_bucket, rows, buckets, (tokens // buckets).astype(np.uint32))

    def several(bucket: int, tokens: np.ndarray, rows: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(tokens, kind="stable")
        t, r = tokens[order], rows[order]
        same = t[1:] == t[:-1]
        keep = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        token = (np.int64(bucket) << np.int64(32)) + t[keep].astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(token), pa.array(r[keep])], names=["token", "row"])

    return gathered(prefixes.mapInArrow(deal, PACKED), several, "token bigint, row bigint", np.uint32)


def overlap(a: Column, b: Column) -> Column:
    """Tokens that two sorted sets share."""
    @F.arrow_udf("bigint")
    def count(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(left.to_pylist(), right.to_pylist()):
            x, y = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
            if len(x) > len(y):
                x, y = y, x
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            out.append(int((y[at] == x).sum()))
        return pa.array(out, pa.int64())
    return count(a, b)


def similar(a: str, b: str, percent: int) -> Column:
    """Whether two columns of sets reach the similarity; sizes are checked before anything is counted."""
    na, nb = F.length(a) / 8, F.length(b) / 8
    both = overlap(F.col(a), F.col(b))
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & ((100 + percent) * both >= percent * (na + nb))


def jaccard_components(spark: SparkSession, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                       width: int = 5, percent: int = 80, sample_one_in: int = 16, common_least: int = 3,
                       common_most: int = 300_000) -> DataFrame:
    """id, n_shingles, component_id, one row per document.

    Words are runs of anything but the six ASCII blanks, after lower-casing A-Z. A
    text with fewer than ``width`` words has its whole sequence as its one shingle; a
    null, empty or blank text has none, links with nothing and is its own component.
    A component's id is the smallest id in it (nulls aside; null if there is no
    other). Repeated rows and equal ids are documents like any other; an empty table
    gives no rows; other columns are not read.
    """
    stage = Stage(spark)
    text, ident = text_or_empty(text_column), F.col(id_column).cast("bigint")
    key = F.unhex(F.md5(F.concat(F.coalesce(ident.cast("string"), F.lit("~")), F.lit("|"), text).cast("binary")))
    docs = docs.select(ident.alias("id"), key.alias("doc_key"), text.alias("body"))
    common = common_tokens(docs, width, sample_one_in, common_least, common_most)
    all_docs = stage.store(measure(docs, width, percent, common).withColumn("row", F.monotonically_increasing_id()), "measured")

    # Classes of equal sets, by their representative.
    classes = stage.store(all_docs.filter("n > 0").groupBy("digest").agg(F.min("row").alias("row"), F.min("id").alias("least_id")), "classes")
    reps = stage.store(classes.join(all_docs.select("row", "n", "smallest", "prefix_size", "last", "doc_key"), "row"), "representatives")

    # Leading tokens that several representatives have.
    total = all_docs.agg(F.sum(F.length("rare"))).first()[0] or 0
    rare = shared_tokens(all_docs.select("row", "rare"), max(1, total // 6 // BUCKET_TOKENS))
    often = unpacked(all_docs.filter(F.length("common") > 0).select("row", "common"))
    tokens = stage.store(rare.unionByName(often).join(reps.select("row"), "row", "left_semi"), "tokens")

    def sets_of(wanted: DataFrame, name: str) -> DataFrame:
        """(row, tokens) of the wanted rows, made from their texts."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                made = pa.array([t.tobytes() for t in shingle_sets(batch.column(1), width)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), made], names=["row", "tokens"])

        keys = small_side(stage.store(reps.select("row", "doc_key").join(wanted, "row"), f"{name}-keys"))
        found = docs.select("doc_key", "body").join(keys, "doc_key").select("row", "body")
        return stage.store(found.mapInArrow(run, "row bigint, tokens binary"), name)

    # Groups: a leader shares one of the smallest tokens, and is verified.
    leading = stage.store(reps.select("row", "n", F.explode("smallest").alias("token")), "leading")
    leaders = leading.groupBy("token").agg(F.min(F.struct("row", "n")).alias("lead"), F.count("*").alias("many")).filter("many > 1")
    leaders = stage.store(leaders.select("token", "lead"), "leaders-of-tokens")
    near = leading.join(leaders, "token").filter(f"row <> lead.row AND 100 * least(n, lead.n) >= {percent} * greatest(n, lead.n)")
    led = stage.store(near.select("row", F.col("lead.row").alias("leader")).distinct(), "led")
    wanted = led.select("row").union(led.select("leader")).distinct()
    sets = sets_of(wanted, "led-sets")
    similar_to_leader = led.join(sets.select(F.col("row").alias("leader"), F.col("tokens").alias("lead")), "leader").join(
        sets, "row").filter(similar("tokens", "lead", percent))
    grouped = components(stage, stage.store(similar_to_leader.select(F.col("row").alias("a"), F.col("leader").alias("b")), "grouped"),
                         "groups").toDF("row", "leader")
    stage.drop("leading", "leaders-of-tokens", "led", "led-sets-keys")
    ties = tokens.groupBy("row").agg(F.count("*").alias("ties"))
    member = stage.store(reps.join(grouped, "row", "left").join(ties, "row", "left").select(
        "row", "n", "prefix_size", "last", F.coalesce("ties", F.lit(0)).alias("ties"), F.coalesce("leader", "row").alias("grp")), "member")

    def verified(p: DataFrame, x: str, y: str, name: str) -> DataFrame:
        """The pairs (x, y, ...) whose sets are similar; sets not made yet are made from the texts."""
        nonlocal sets
        missing = p.select(F.col(x).alias("row")).union(p.select(y)).distinct().join(sets.select("row"), "row", "left_anti")
        sets = sets.unionByName(sets_of(missing, f"{name}-sets"))
        left = p.join(sets.select(F.col("row").alias(x), F.col("tokens").alias("left_set")), x)
        both = left.join(sets.select(F.col("row").alias(y), F.col("tokens").alias("right_set")), y)
        return stage.store(both.filter(similar("left_set", "right_set", percent)).select(*p.columns), name)

    def of_row(x: str) -> DataFrame:
        return member.select(F.col("row").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("n", "prefix_size", "last")])

    facts = ("n", "prefix_size", "last")

    def leaders_as(x: str) -> DataFrame:
        found = tokens.join(member.filter("row = grp").drop("grp"), "row")
        return found.select("token", F.col("row").alias(x), "ties", *[F.col(c).alias(f"{c}_{x}") for c in facts])

    def merged(found: DataFrame, name: str) -> DataFrame:
        """The members, after groups whose leaders are linked have become one."""
        roots = components(stage, found, name)
        return stage.store(member.join(roots, member["grp"] == roots["node"], "left").select(
            "row", *facts, "ties", F.coalesce("root", "grp").alias("grp")), f"member-{name}")

    # Groups that one text has split into: leaders that share a token with many meet the hub they share most with.
    a = stage.store(leaders_as("a"), "leaders")
    hubs = a.groupBy("token").agg(F.max(F.struct("ties", F.col("a").alias("b"))).alias("hub"), F.count("*").alias("many"))
    hubs = hubs.filter(F.col("many") >= HUB_LEADERS).select("token", F.col("hub.b").alias("b"))
    best = a.join(hubs, "token").filter("a <> b").groupBy("a", "b").agg(F.count("*").alias("many"))
    best = stage.store(best.groupBy("a").agg(F.max(F.struct("many", "b")).alias("hub")).select("a", F.col("hub.b").alias("b")), "hubs")
    of_hub = a.toDF("token", "b", "ties_b", *[f"{c}_b" for c in facts]).join(best.select("b").distinct(), "b", "left_semi").drop("ties_b")
    met = a.join(best, "a").join(of_hub, ["token", "b"]).groupBy("a", "b", *[f"{c}_{x}" for c in facts for x in "ab"]).agg(
        F.count("*").alias("shared")).filter(qualifies("a", "b", percent))
    to_hubs = verified(stage.store(met.select("a", "b"), "met"), "a", "b", "hub-links")
    member = merged(to_hubs, "hub-groups")

    # All leaders that may be similar are compared, and similar ones joined.
    a, b = (leaders_as(x).drop("ties") for x in "ab")
    sizes = (F.col("a") < F.col("b")) & (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    pairs = a.join(b, "token").filter(sizes).groupBy("a", "b", *[f"{c}_{x}" for c in facts for x in "ab"]).agg(F.count("*").alias("shared"))
    pairs = pairs.filter(qualifies("a", "b", percent))
    links = verified(stage.store(pairs.select("a", "b"), "pairs"), "a", "b", "leader-links")
    links = links.unionByName(to_hubs)
    member = merged(links, "leaders")

    # The matrix: (token, group) over all documents, without the tokens of one group.
    groups = stage.store(member.groupBy("grp").agg(
        F.count("*").alias("members"), F.min("n").alias("n_low"), F.max("n").alias("n_high"), F.min("last").alias("last_low"),
        F.max("last").alias("last_high"), F.max(F.struct("ties", "row"))["row"].alias("hub")), "groups")
    placed = tokens.join(member.select("row", "grp"), "row")
    several = placed.groupBy("token").agg(F.min("grp").alias("low"), F.max("grp").alias("high")).filter("low < high").select("token")
    placed = stage.store(placed.join(several, "token").join(groups.select("grp", "members"), "grp"), "placed")
    matrix = placed.select("token", F.col("grp").alias("other"), F.col("members").alias("many")).distinct()

    # Documents of the smaller group ask the larger one: bounded by what they share with its union. Pairs of single
    # documents have been compared as leaders.
    asked = placed.join(matrix, "token").filter("many > 1 AND (members < many OR members = many AND grp < other)")
    asked = asked.groupBy("row", "grp", "other").agg(F.count("*").alias("shared"))
    asked = asked.join(of_row("row"), "row").join(groups.withColumnRenamed("grp", "other"), "other").filter(reaches("row", percent))
    asked = stage.store(asked.select("row", "grp", "other", "hub"), "asked")
    near = verified(asked, "row", "hub", "near-leaders").select(F.col("grp").alias("a"), F.col("other").alias("b"))
    roots = components(stage, near, "near-groups")

    # Open what is still apart: the group's documents bounded and compared one by one.
    def root_of(p: DataFrame, x: str) -> DataFrame:
        found = p.join(roots.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")), x, "left")
        return found.withColumn(f"root_{x}", F.coalesce(f"root_{x}", x))

    apart = root_of(root_of(asked, "grp"), "other").filter("root_grp <> root_other").select("row", "grp", "other")
    inside = placed.select("token", F.col("row").alias("document"), F.col("grp").alias("other"))
    opened = placed.select("token", "row").join(apart, "row").join(inside, ["token", "other"])
    opened = opened.groupBy("row", "document", "grp", "other").agg(F.count("*").alias("shared"))
    opened = opened.join(of_row("row"), "row").join(of_row("document"), "document").filter(qualifies("row", "document", percent))
    opened = stage.store(opened.select("row", "document", "grp", "other"), "opened")
    more = verified(opened, "row", "document", "opened-links").select(F.col("grp").alias("a"), F.col("other").alias("b"))
    roots = components(stage, links.union(near).union(more), "groups-linked")

    own = reps.select("digest", "row", "least_id").join(grouped, "row", "left").withColumn("node", F.coalesce("leader", "row"))
    own = stage.store(own.join(roots, "node", "left").select("digest", "least_id", F.coalesce("root", "node").alias("root")), "own")
    named = own.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_class = stage.store(own.join(named, "root").select("digest", "component_id"), "components")
    out = all_docs.select("id", "n", "digest").join(by_class, "digest", "left")
    return out.select("id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def qualifies(a: str, b: str, percent: int) -> Column:
    """Whether two documents can be similar, by sizes and the leading tokens they share.

    The document whose prefix ends first sees all that its prefix shares, so what it
    does not share is missing from the other: at most its size less the overlap needed.
    """
    na, nb = F.col(f"n_{a}"), F.col(f"n_{b}")
    fits = 100 * F.least(na, nb) >= percent * F.greatest(na, nb)
    needed = F.ceil(percent * (na + nb) / (100.0 + percent) - 1e-9)
    of = lambda x: F.col(f"prefix_size_{x}") - F.col("shared") <= F.col(f"n_{x}") - needed
    return fits & F.when(F.col(f"last_{a}") <= F.col(f"last_{b}"), of(a)).otherwise(of(b))


def reaches(x: str, percent: int) -> Column:
    """Whether a document can be similar to any of a group, by the leading tokens it shares with the group's union.

    The union holds what every single document holds, so the bounds of ``qualifies``
    hold with the group's sizes: the document's own prefix if a document of the group
    may end later, and any document's of the sizes that fit if one may end earlier.
    """
    n, shared = F.col(f"n_{x}"), F.col("shared")
    fits = (100 * F.col("n_high") >= percent * n) & (100 * n >= percent * F.col("n_low"))
    least = F.greatest(F.col("n_low"), F.ceil(percent * n / 100.0 - 1e-9))
    most = F.least(F.col("n_high"), F.floor(100.0 * n / percent + 1e-9))
    needed = F.ceil(percent * (n + least) / (100.0 + percent) - 1e-9)
    own = (F.col(f"last_{x}") <= F.col("last_high")) & (F.col(f"prefix_size_{x}") - shared <= n - needed)
    theirs = (F.col(f"last_{x}") > F.col("last_low")) & (shared >= percent * (n + most) / (100.0 + percent) - percent * most / 100.0 - 1e-6)
    return fits & (own | theirs)
