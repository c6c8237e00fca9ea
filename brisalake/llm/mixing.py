"""Mixing sources to target weights through a multivariate-hypergeometric splitting tree.

1. Sizes: words of every document, stored with a row number (one scan of the texts).
2. Targets: the mix's words are shared out by weight; a source gives at most
   ``max_epochs`` times its size, and what it cannot give is shared out again.
3. Blocks: a document is one block, a very long one several. In each pass over a
   source its blocks are put in a pseudo-random order (by hash, ranked in hash
   ranges of bounded size), and the source's quota is the shortest run of them that
   holds its target; its last block is cut to the word.
4. Tree: the vector of exact block quotas is split in two again and again, each
   time by a draw from the multivariate hypergeometric distribution, until every
   output shard has its count of blocks of each source. Shards then take disjoint
   runs of the permuted blocks, and every shard shuffles its own.

All of it is DataFrame expressions; random numbers are hashes of seed and place, so
reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brisalake.llm.common import WORD, Stage, word_count

RANK_ROWS = 1024  # rows of one hash range, ranked together in a task


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from a hash."""
    return (F.pmod(F.xxhash64(*parts), F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)


def source_targets(sized: DataFrame, weights: tuple[float, ...], share: float, max_epochs: float) -> DataFrame:
    """source, source_size, blocks_hint, target: one row per source.

    Sources in code point order, null last, weigh ``weights``, repeating. Filling
    up from the source with the smallest limit per weight, a source is at its limit
    if what is left, shared by weight among the rest, would exceed it. The windows
    below see one row per source, never documents.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), turn.cast("int") + 1)
    every = Window.partitionBy(F.lit(1))
    fill = Window.orderBy("per_weight", "turn").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy("per_weight", "turn").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    t = sums.select("source", "source_size", w.alias("weight"), F.row_number().over(order).alias("turn"))
    t = t.withColumn("limit", max_epochs * F.col("source_size")).withColumn("per_weight", F.col("limit") / F.col("weight"))
    t = t.withColumn("total", share * F.sum("source_size").over(every))
    t = t.withColumn("level", (F.col("total") - F.coalesce(F.sum("limit").over(fill), F.lit(0.0))) / F.sum("weight").over(rest))
    # The first source whose limit is above the level sets the level of all after it.
    level = F.min(F.when(F.col("per_weight") >= F.col("level"), F.struct("turn_up", "level"))).over(every)
    t = t.withColumn("turn_up", F.row_number().over(Window.orderBy("per_weight", "turn"))).withColumn("free", level)
    at_limit = F.col("free").isNull() | (F.col("turn_up") < F.col("free.turn_up"))
    return t.select("source", "turn", "source_size",
                    F.when(at_limit, F.col("limit")).otherwise(F.col("weight") * F.col("free.level")).alias("target"))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """Good ones among ``draws`` of ``total`` without replacement, by inversion of u from the mode outwards.

    Twelve standard deviations either side hold all that a double can tell from 0.
    """
    def range_of(v: Column) -> Column:
        n, k, c = v["n"], v["k"], v["c"]
        low, high = F.greatest(F.lit(0.0), c - (n - k)), F.least(k, c)
        mode = F.greatest(low, F.least(high, F.floor((c + 1) * (k + 1) / (n + 2)).cast("double")))
        variance = c * (k / n) * (1 - k / n) * (n - c) / F.greatest(n - 1, F.lit(1.0))
        reach = F.ceil(12 * F.sqrt(F.greatest(variance, F.lit(0.0))) + 12).cast("double")
        return F.struct(n.alias("n"), k.alias("k"), c.alias("c"), v["u"].alias("u"), mode.alias("mode"),
                        F.least(high - mode, reach).cast("bigint").alias("ups"), F.least(mode - low, reach).cast("bigint").alias("downs"))

    def walk(w: Column, sign: int, start: Column, mark: Column) -> Column:
        """(sum of the weights from start on, the first place where it reaches the mark or null)."""
        m = w["ups"] if sign > 0 else w["downs"]
        steps = F.when(m > 0, F.sequence(F.lit(1).cast("bigint"), m)).otherwise(F.array().cast("array<bigint>"))
        n, k, c = w["n"], w["k"], w["c"]

        def go(acc: Column, i: Column) -> Column:
            x = w["mode"] + sign * i
            if sign > 0:  # the weight of x from that of x - 1, or of x + 1
                p = acc["p"] * (k - x + 1) * (c - x + 1) / (x * (n - k - c + x))
            else:
                p = acc["p"] * (x + 1) * (n - k - c + x + 1) / ((k - x) * (c - x))
            return F.struct(p.alias("p"), (acc["sum"] + p).alias("sum"),
                            F.coalesce(acc["at"], F.when(acc["sum"] + p >= mark, x)).alias("at"))

        return F.aggregate(steps, F.struct(F.lit(1.0).alias("p"), start.alias("sum"), F.lit(None).cast("double").alias("at")), go)

    def found(w: Column, mark: Column) -> Column:
        right = walk(w, 1, F.lit(1.0), mark)
        either = let(right, lambda r: F.coalesce(r["at"], walk(w, -1, r["sum"], mark)["at"], w["mode"]))
        return F.when(mark <= 1.0, w["mode"]).otherwise(either)

    never = F.lit(float("inf"))
    inverted = let(F.struct(total.cast("double").alias("n"), good.cast("double").alias("k"), draws.cast("double").alias("c"), u.alias("u")),
                   lambda v: let(range_of(v), lambda w: let(walk(w, 1, F.lit(1.0), never)["sum"], lambda r: let(
                       w["u"] * walk(w, -1, r, never)["sum"], lambda mark: found(w, mark)))))
    return F.when((total <= 0) | (good <= 0) | (draws <= 0), F.lit(0)).when(draws >= total, good).otherwise(inverted).cast("bigint")


def splitting_tree(stage: Stage, quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """shard, quota array: blocks of each source (in the order of ``quotas``) for every shard.

    A node holds the shards [lo, hi) and its quota vector; its left child draws the
    blocks of the lower half of the shards source by source, each conditional on
    those before, which together is one multivariate-hypergeometric draw.
    """
    total = F.aggregate("q", F.lit(0).cast("bigint"), lambda a, x: a + x)
    nodes = quotas.agg(F.sort_array(F.collect_list(F.struct("turn", "pass", "blocks"))).alias("v")).select(
        F.lit(0).cast("bigint").alias("lo"), F.lit(shards).cast("bigint").alias("hi"), F.col("v.blocks").alias("q"))
    levels = max(0, (shards - 1).bit_length())
    for level in range(levels):
        if level:
            nodes = stage.store(nodes.repartition("lo") if level >= 6 else nodes, f"level-{level}")
        mid = F.shiftright(F.col("lo") + F.col("hi"), 1)
        capacity = F.floor(total * (mid - F.col("lo")) / (F.col("hi") - F.col("lo"))).cast("bigint")

        def draw(acc: Column, i: Column) -> Column:
            x = F.element_at("q", i + 1)
            got = hypergeometric(acc["left"], x, acc["room"], uniform(F.lit(seed), F.lit(level), F.col("lo"), i))
            return F.struct((acc["left"] - x).alias("left"), (acc["room"] - got).alias("room"),
                            F.concat(acc["got"], F.array(got)).alias("got"))

        start = F.struct(total.alias("left"), F.col("capacity").alias("room"), F.array().cast("array<bigint>").alias("got"))
        nodes = nodes.withColumn("mid", mid).withColumn("capacity", capacity)
        drawn = F.aggregate(F.sequence(F.lit(0), F.size("q") - 1), start, draw)["got"]
        nodes = nodes.withColumn("left", F.when(F.col("hi") - F.col("lo") > 1, drawn))
        child = F.when(F.col("left").isNull(), F.array(F.struct("lo", "hi", "q"))).otherwise(F.array(
            F.struct("lo", F.col("mid").alias("hi"), F.col("left").alias("q")),
            F.struct(F.col("mid").alias("lo"), "hi", F.zip_with("q", "left", lambda a, b: a - b).alias("q"))))
        nodes = nodes.select(F.explode(child).alias("n")).select("n.lo", "n.hi", "n.q")
    return nodes.select(F.col("lo").alias("shard"), F.col("q").alias("quota"))


def mix(spark: SparkSession, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        source_column: str = "source", weights: tuple[float, ...] = (5.0, 2.0, 1.0), share: float = 1.5,
        max_epochs: int = 2, block_words: int = 8192, shard_blocks: int = 4096, seed: int = 7,
        keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(documents with their targets, drawn blocks).

    The first has row, id, source, size, source_size, target and the columns
    ``keep``; one row per input row. The second has row, id, source, pass, start
    (first word), words, shard, place (in the shard). A null text has no words; a
    null source is a source; a source without words has target 0; rows with equal
    ids are told apart by their row number and share the hash only with exact
    repeats, whose order does not show in the result; an empty table gives no
    rows. Other columns are read only if named in ``keep``.
    """
    stage = Stage(spark)
    sized = stage.store(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("bigint").alias("id"),
        F.col(source_column).alias("source"), word_count(text_column).alias("size"),
        *[F.col(c).alias(f"kept_{c}") for c in keep]), "sized")
    targets = stage.store(source_targets(sized.select("source", "size"), weights, share, max_epochs), "targets")
    same_source = lambda a, b: a["source"].eqNullSafe(b["source"])
    joined = sized.join(F.broadcast(targets) if targets.count() <= 100_000 else targets, same_source(sized, targets)) \
        .drop(targets["source"])

    # Passes over a source: whole ones, then one that ends at the target.
    passes = F.ceil(F.col("target") / F.greatest("source_size", F.lit(1))).cast("int")
    blocks = F.ceil(F.col("size") / block_words).cast("int")
    place = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    narrow = joined.select("row", "id", "size", "source", "source_size", "target", "turn",
                           F.explode(place(blocks)).alias("block"), passes.alias("passes"))
    narrow = narrow.select("*", F.explode(place(F.col("passes"))).alias("pass"))
    start = F.col("block").cast("bigint") * block_words
    words = F.least(F.col("size") - start, F.lit(block_words).cast("bigint"))
    h = F.xxhash64(F.lit(seed), "pass", "id", "size", "block")
    bins = F.greatest(F.lit(1), F.ceil(F.col("source_blocks") / RANK_ROWS)).cast("bigint")
    counts = stage.store(joined.groupBy("turn").agg(F.sum(blocks).alias("source_blocks")), "counts")
    narrow = narrow.join(F.broadcast(counts) if targets.count() <= 100_000 else counts, "turn")
    # The top bits of the hash choose the range, so ranges follow one another in hash order.
    bin_ = F.floor((F.shiftrightunsigned(h, 11).cast("double") / float(1 << 53)) * bins).cast("bigint")
    dealt = narrow.select("row", "id", "source", "turn", "source_size", "target", "pass", start.alias("start"),
                          words.alias("words"), F.shiftrightunsigned(h, 11).alias("h"), bin_.alias("bin"))
    own = Window.partitionBy("turn", "pass", "bin").orderBy("h", "row", "start")
    dealt = dealt.withColumn("rank", F.row_number().over(own) - 1).withColumn(
        "before", F.sum("words").over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("words"))
    dealt = stage.store(dealt, "dealt")
    bin_sums = dealt.groupBy("turn", "pass", "bin").agg(F.count("*").alias("n"), F.sum("words").alias("bin_words"))
    earlier = Window.partitionBy("turn", "pass").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bin_sums = bin_sums.select("turn", "pass", "bin", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("rank0"),
                               F.coalesce(F.sum("bin_words").over(earlier), F.lit(0)).alias("words0"))
    bin_sums = stage.store(bin_sums, "bins")
    wanted = F.round("target").cast("bigint") - F.col("pass") * F.col("source_size")
    drawn = dealt.join(bin_sums, ["turn", "pass", "bin"]).withColumn(
        "take", F.least("words", wanted - F.col("words0") - F.col("before"))).filter("take > 0")
    drawn = stage.store(drawn.select("row", "id", "source", "turn", "pass", "start", F.col("take").alias("words"), "h",
                                     (F.col("rank0") + F.col("rank")).alias("rank")), "drawn")

    # Exact quotas, their tree, and the shard of every block.
    quotas = stage.store(drawn.groupBy("turn", "pass").agg(F.count("*").alias("blocks")), "quotas")
    n_blocks = quotas.agg(F.sum("blocks")).first()[0] or 0
    if not n_blocks:
        return joined, drawn.select("row", "id", "source", "pass", "start", "words", F.lit(0).cast("bigint").alias("shard"),
                                    F.lit(0).alias("place"))
    leaves = splitting_tree(stage, quotas, max(1, -(-n_blocks // shard_blocks)), seed)
    number = F.row_number().over(Window.orderBy("turn", "pass")) - 1
    leaves = leaves.select("shard", F.posexplode("quota").alias("number", "n")).join(
        F.broadcast(quotas.withColumn("number", number)), "number")
    upto = Window.partitionBy("turn", "pass").orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # A shard's run of ranks, listed at every chunk of ranks it touches, so that blocks find it by an equality.
    runs = leaves.filter("n > 0").withColumn("hi", F.sum("n").over(upto)).withColumn("lo", F.col("hi") - F.col("n"))
    runs = runs.withColumn("chunk", F.explode(F.sequence(F.floor(F.col("lo") / RANK_ROWS),
                                                         F.floor((F.col("hi") - 1) / RANK_ROWS))))
    runs = stage.store(runs.select("turn", "pass", "chunk", "shard", "lo", "hi"), "runs")
    chunked = drawn.withColumn("chunk", F.floor(F.col("rank") / RANK_ROWS))
    found = chunked.join(runs, ["turn", "pass", "chunk"]).filter("rank >= lo AND rank < hi")
    local = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "shard", "h"), "row", "start")
    drawn = found.select("row", "id", "source", "pass", "start", "words", "shard",
                         (F.row_number().over(local) - 1).alias("place"))
    return joined, stage.store(drawn, "mixed")


def taken_words(documents: DataFrame, drawn: DataFrame) -> DataFrame:
    """The documents with ``taken``: their words in the mix, repeats counted."""
    sums = drawn.groupBy("row").agg(F.sum("words").alias("taken"))
    return documents.join(sums, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("bigint")))


def mixed_texts(documents: DataFrame, drawn: DataFrame, text_column: str = "text") -> DataFrame:
    """A row per drawn block with the columns kept of its document; a part of one has that part's words and the blanks after them, the first part those before them too."""
    text = F.col(f"kept_{text_column}")
    parts = F.regexp_extract_all(text, F.lit(f"{WORD}[\\x20\\x09-\\x0D]*"), F.lit(0))
    both = documents.select("row", "size", *[c for c in documents.columns if c.startswith("kept_")]).join(
        drawn.drop("id", "source"), "row")
    cut = F.array_join(F.slice(parts, (F.col("start") + 1).cast("int"), F.col("words").cast("int")), "")
    lead = F.when(F.col("start") == 0, F.regexp_extract(text, "^[\\x20\\x09-\\x0D]*", 0)).otherwise("")
    cut = F.concat(lead, cut)
    return both.withColumn(f"kept_{text_column}", F.when(F.col("words") == F.col("size"), text).otherwise(cut))
