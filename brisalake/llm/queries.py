"""One registered query per operator, over the driver's tables, and its oracle SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brisalake.llm import (chat, exact_dedup, jaccard, lm_score, mixing, negatives, packing, prefix_trie, quality, secrets,
                           suffix_dedup, token_files, topk)
from brisalake.llm.common import Stage, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def ranks_file() -> str:
    """The byte-level BPE whose tokenizer file is byte_bpe_50k.json, as ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@query("op4_cost_balanced_packing")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(table(spark, folder, "documents"), ranks_file())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


@query("op5_splitting_tree_mixing")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    documents, drawn = mixing.mix(spark, table(spark, folder, "documents"))
    return mixing.taken_words(documents, drawn).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


@query("op7_stateful_exact_dedup", """
    WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
         g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY body)
    SELECT d.doc_id, keep_id, group_size, d.doc_id = keep_id AS kept, sha256(d.body) AS text_sha256
    FROM d JOIN g USING (body)""")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    rows = exact_dedup.exact_dedup(spark, f"{folder}/documents.parquet")
    return rows.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                       F.lower(F.hex("digest")).alias("text_sha256"))


@query("op3_boosted_quality")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    trees = quality.fit(docs, table(spark, folder, "labels"))
    scored = docs.select("doc_id", quality.held_out("doc_id").alias("held_out"), quality.score(F.col("text"), trees).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query("op8_typed_chat")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    control = F.lit("</s>[INST] ok [/INST]")
    own = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), control.alias("text"))
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.conversation_digests(chat.format_turns(turns))


@query("op10_randomness_secrets")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(spark, table(spark, folder, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(F.col("id").alias("doc_id"), count(0).alias("n_assign"), count(1).alias("n_access"),
                        count(2).alias("n_hex"), F.sha2(secrets.span_list(F.col("base")), 256).alias("base_sha256"),
                        secrets.span_list(F.col("spans")).alias("spans"))


@query("op9_dual_tree_topk", """
    WITH r AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
               WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
    SELECT q.vec_id AS query_id, CAST(row_number() OVER best AS INTEGER) AS rank, d.vec_id, list_dot_product(q.v, d.v)::BIGINT AS score
    FROM r q JOIN r d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0
    WINDOW best AS (PARTITION BY q.vec_id ORDER BY list_dot_product(q.v, d.v) DESC, d.vec_id)
    QUALIFY rank <= 20""")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(spark, table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op1_token_group_jaccard")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard.jaccard_components(spark, table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


@query("op6_bwt_repeats")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    rows = suffix_dedup.remove_repeats(spark, table(spark, folder, "documents"))
    kept = F.coalesce(F.sha2("kept", 256), F.lower(F.hex("sha")))
    return rows.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", kept.alias("kept_sha256"))


@query("op2_cross_entropy_difference")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Target: the documents labelled good. Background: all documents."""
    good = table(spark, folder, "labels").filter("quality = 1").select("doc_id")
    docs = table(spark, folder, "documents")
    return lm_score.score(docs, lm_score.count_models(docs, "text", good)).withColumnRenamed("id", "doc_id")


@query("op11_shared_list_negatives", """
    WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
               FROM embeddings
               WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
         s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
               FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
         p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
               QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id,
           row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
    QUALIFY rank <= 5""")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(spark, table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label)


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op12_token_lists")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    files = Stage(spark).path("token_lists")
    token_files.write_tokens(table(spark, folder, "documents"), files, word_tokenizer())
    return token_files.with_checksum(token_files.read_tokens(spark, files))


@query("op13_prefix_trie", """
    WITH h AS (SELECT c, list_reduce([4294967295::BIGINT] || list_transform(string_split(c::VARCHAR, ''), lambda d: ord(d)::BIGINT),
                      lambda crc, d: list_reduce([xor(crc, d), 1, 1, 1, 1, 1, 1, 1, 1],
                                                 lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc
               FROM (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL)),
         t AS (SELECT conv_id AS c, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
               FROM conversations GROUP BY conv_id),
         r AS (SELECT h.c, list_concat(coalesce(b.turns, [])[:xor(crc, 4294967295) % 9], t.turns[xor(crc, 4294967295) % 9 + 1:]) AS turns
               FROM h JOIN t USING (c) LEFT JOIN t b ON b.c = h.c - h.c % 5),
         m AS (SELECT c, d, turns[:d] AS prefix, d = len(turns) AS ended FROM r, unnest(range(len(turns) + 1)) AS u(d)),
         n AS (SELECT prefix, d, min(c) AS conv_id, count(*) AS n_convs,
                      sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ended), '')) AS ends_sha256
               FROM m GROUP BY prefix, d),
         k AS (SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM n x WHERE x.d = n.d + 1 AND x.prefix[:n.d] = n.prefix) AS n_children
               FROM n LEFT JOIN n p ON p.d = n.d - 1 AND p.prefix = n.prefix[:n.d - 1])
    SELECT a.conv_id, a.d AS depth, a.parent_conv_id, a.n_convs, a.n_children,
           count(*) FILTER (b.n_children = 0) AS n_leaves,
           coalesce(sum((b.n_convs - 1) * octet_length(encode(b.prefix[b.d].text))), 0)::BIGINT AS saved_tokens, a.ends_sha256
    FROM k a JOIN k b ON b.d >= a.d AND b.prefix[:a.d] = a.prefix
    GROUP BY ALL""")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Each conversation begins with turns of the first of its five, as many as its checksum says."""
    rows = prefix_trie.turn_digests(table(spark, folder, "conversations"))
    c = F.col("conv")
    grafted = prefix_trie.graft(rows, c - F.pmod(c, F.lit(5)), (F.crc32(c.cast("string")) % 9).cast("int"), 8)
    return prefix_trie.prefix_trie(spark, grafted)
