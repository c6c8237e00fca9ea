"""Cross-entropy difference of two matched n-gram models.

The target model is counted on the target documents, the background model on all
documents, over one vocabulary. Words, contexts and pairs of words are grams, 64-bit
hashes of their own kind. Documents are dealt into chunks of some megabytes. A chunk
sends each of its distinct grams once, with its counts, to the gram's bucket; the
bucket adds up what all chunks sent and answers every chunk with the totals, in the
order in which it asked. So a common gram costs a bucket one entry a chunk, and no
table of pairs meets a table of documents. A document's score is the mean over its
words of target loss less background loss, in nats: the lower, the more it reads like
the target.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisalake.llm.common import BLANK, Stage, byte_chunks, mixed, shuffles_freed, span_hashes, spans, text_or_empty

START = 1 << 16  # words that the add-one frequency allows for at least
FIRST = 0  # the context of a text's first word
SHARE = 0.7  # weight of the pair's own frequency
UNIT = 2.0**32  # losses are summed as whole parts of a nat, so no order of tasks changes a digit
CHUNK_BYTES = 1 << 23  # text of a chunk
BUCKET_BYTES = 1 << 21  # text whose grams make up a bucket
KINDS = np.array([0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0], np.uint64)  # words, contexts, pairs
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def grams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(words, contexts, pairs) of each text, as 64-bit hashes."""
    for lo, hi, flat, starts in byte_chunks(texts):
        flat = LOWER[flat]
        first, end = spans(~BLANK[flat], starts)
        h = mixed(span_hashes(flat, first, end))
        at = np.searchsorted(first, starts)
        before = np.concatenate([np.zeros(1, np.uint64), h[:-1]])[:len(h)]
        before[at[:-1][at[:-1] < at[1:]]] = FIRST
        pair = mixed(before * np.uint64(0x9E3779B97F4A7C15) + h).view(np.int64)
        word, context = h.view(np.int64), before.view(np.int64)
        for a, b in zip(at[:-1], at[1:]):
            yield word[a:b], context[a:b], pair[a:b]


ASKED = "bucket bigint, chunk bigint, n bigint, grams binary, target binary, every binary"
MESSAGE, MESSAGE_NAMES = [pa.int64()] * 3 + [pa.binary()] * 3, [x.split()[0] for x in ASKED.split(", ")]
ANSWERS = "bucket bigint, chunk bigint, target binary, every binary, words bigint, word_target bigint, word_every bigint"


def planes(a: np.ndarray) -> bytes:
    """64-bit numbers by their lowest bytes, the next ones and so on; small numbers compress to what they hold."""
    return np.ascontiguousarray(a).view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(data: bytes, kind=np.int64) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(kind).ravel()


class Chunk:
    """The distinct grams of some documents by kind and bucket, and where among its kind's each word's gram is."""

    def __init__(self, texts: pa.Array, buckets: int):
        parts = list(grams(texts))
        self.sizes = np.array([len(p[0]) for p in parts], np.int64)
        kinds, self.places, homes = [], [], []
        for kind, mask in enumerate(KINDS):
            g, place = np.unique(mixed(np.concatenate([p[kind] for p in parts]).view(np.uint64) ^ mask), return_inverse=True)
            kinds.append(g)
            self.places.append(place.astype(np.int32))
            # A bucket is a range of grams of one kind, so that they are close together.
            homes.append(((g >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64) * 3 + kind)
        self.lengths = [len(g) for g in kinds]
        self.grams, self.buckets = np.concatenate(kinds), np.concatenate(homes)

    def counts(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often the target's and all documents have each gram."""
        good = np.repeat(wanted, self.sizes)
        target, every = ([np.bincount(p[w], minlength=n) for p, n in zip(self.places, self.lengths)] for w in (good, slice(None)))
        return np.concatenate(target), np.concatenate(every)

    def by_word(self, n: np.ndarray) -> list[np.ndarray]:
        """Numbers of the grams as those of each word, its context and its pair."""
        return [k[p] for k, p in zip(np.split(n, np.cumsum(self.lengths)[:-1]), self.places)]

    def parts(self) -> list[tuple[int, int, int]]:
        """(bucket, first, end) of the grams of each bucket."""
        cuts = [0, *(np.flatnonzero(np.diff(self.buckets)) + 1).tolist(), len(self.grams)]
        return [(int(self.buckets[a]), a, b) for a, b in zip(cuts[:-1], cuts[1:]) if a < b]


def chunked(docs: DataFrame, id_column: str, text_column: str, target: Column | None = None) -> tuple[DataFrame, int]:
    """(chunk, id, body, wanted) of each document, dealt by what it holds, and the bytes of all texts."""
    body = text_or_empty(text_column)
    size = docs.agg(F.sum(F.octet_length(body))).first()[0] or 0
    wanted = F.lit(False) if target is None else F.coalesce(target, F.lit(False))
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), body.alias("body"), wanted.alias("wanted"))
    return rows.withColumn("chunk", F.pmod(F.xxhash64("id", "body"), F.lit(1 + size // CHUNK_BYTES))), size


def asked(rows: DataFrame, buckets: int, counted: bool, targets: DataFrame | None = None) -> DataFrame:
    """What each chunk sends to the buckets: its grams, with their counts if the documents are those of the models.

    ``targets`` are ids of documents that are wanted besides the marked ones; they meet
    the documents' ids and chunks, not their texts.
    """
    def ask(documents: pa.Table, ids: pa.Table | None) -> pa.Table:
        out = []
        if len(documents):
            chunk = Chunk(documents.column("body").combine_chunks(), buckets)
            wanted = documents.column("wanted").combine_chunks()
            if ids is not None:
                wanted = pc.or_(wanted, pc.is_in(documents.column("id").combine_chunks(), ids.column("id").combine_chunks(), skip_nulls=True))
            nothing = np.zeros(len(chunk.grams), np.int64)
            target, every = chunk.counts(wanted.to_numpy(zero_copy_only=False)) if counted else (nothing, nothing)
            number = documents.column("chunk")[0].as_py()
            for bucket, a, b in chunk.parts():  # sorted grams are sent as differences, which are shorter
                steps = np.diff(chunk.grams[a:b], prepend=np.uint64(0))
                out.append((bucket, number, b - a, planes(steps), planes(target[a:b]), planes(every[a:b])))
        return pa.Table.from_arrays([pa.array(x, k) for x, k in zip(zip(*out) if out else [()] * 6, MESSAGE)], names=MESSAGE_NAMES)

    by_chunk = rows.groupBy("chunk")
    if targets is None:
        return by_chunk.applyInArrow(lambda documents: ask(documents, None), ASKED)
    found = rows.select("chunk", "id").join(targets.toDF("id"), "id", "left_semi").distinct().select("chunk", "id").toDF("chunk", "id")
    return by_chunk.cogroup(found.groupBy("chunk")).applyInArrow(ask, ASKED)


def added_up(sent: DataFrame, fn, schema: str) -> DataFrame:
    """fn(bucket, messages, grams, place of each message's grams in them, target, every) for each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def close() -> pa.RecordBatch:
            g = np.concatenate([np.cumsum(from_planes(m[2], np.uint64), dtype=np.uint64) for m in held])
            target, every = (np.concatenate([from_planes(m[i]) for m in held]) for i in (3, 4))
            found, place = np.unique(g, return_inverse=True)
            total = [np.zeros(len(found), np.int64) for _ in range(2)]
            for t, counts in zip(total, (target, every)):
                np.add.at(t, place, counts)
            return fn(now, held, found, place, *total)

        for batch in batches:
            for bucket, *message in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if held and bucket != now:
                    yield close()
                    held.clear()
                now = bucket
                held.append(message)
        if held:
            yield close()

    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


def answers(bucket: int, messages: list, found: np.ndarray, place: np.ndarray, target: np.ndarray, every: np.ndarray) -> pa.RecordBatch:
    """The totals of each message's grams, and once the bucket's number of words and what they add up to."""
    out, a = [], 0
    for chunk, n, *_ in messages:
        at = place[a:a + n]
        a += n
        if chunk is not None:
            out.append((bucket, chunk, planes(target[at]), planes(every[at]), 0, 0, 0))
    if bucket % 3 == 0:
        out.append((bucket, None, None, None, int((every > 0).sum()), int(target.sum()), int(every.sum())))
    kinds = [pa.int64()] * 2 + [pa.binary()] * 2 + [pa.int64()] * 3
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out) if out else [()] * 7, kinds)], names=[
        "bucket", "chunk", "target", "every", "words", "word_target", "word_every"])


@dataclass
class Models:
    """Both models, as the documents they are counted on; stored totals by bucket for other documents."""

    docs: DataFrame
    text_column: str
    id_column: str
    target: Column | None
    targets: DataFrame | None
    totals: DataFrame | None = None
    buckets: int = 0

    def requests(self) -> tuple[DataFrame, DataFrame, int]:
        """The documents by chunk, what the chunks send and the number of buckets."""
        rows, size = chunked(self.docs, self.id_column, self.text_column, self.target)
        buckets = 1 + size // BUCKET_BYTES
        return rows, asked(rows, buckets, True, self.targets), buckets

    def counted(self) -> tuple[DataFrame, int]:
        """All grams with their totals, as one message a bucket that asks for no answer."""
        def sums(bucket: int, _: list, found: np.ndarray, __: np.ndarray, target: np.ndarray, every: np.ndarray) -> pa.RecordBatch:
            row = (bucket, None, len(found), planes(np.diff(found, prepend=np.uint64(0))), planes(target), planes(every))
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, MESSAGE)], names=MESSAGE_NAMES)

        if self.totals is None:
            _, sent, self.buckets = self.requests()
            self.totals = Stage(self.docs.sparkSession).store(added_up(sent, sums, ASKED), "totals")
        return self.totals, self.buckets


def count_models(docs: DataFrame, text_column: str, target: Column | DataFrame, id_column: str = "doc_id") -> Models:
    """Both models on all documents; ``target`` marks the target's (null is false) or is a frame of their ids.

    The counts are made when documents are scored: those of ``docs`` itself are counted
    and priced in one exchange, for others the totals are stored once.
    """
    ids = target if isinstance(target, DataFrame) else None
    return Models(docs, text_column, id_column, target if ids is None else None, ids)


def score(docs: DataFrame, models: Models, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, n_words, target_loss, background_loss (per word, null without words) and score, one row per document.

    A pair costs its frequency after the context, mixed with the word's add-one
    frequency. Without words the score is 0. Null and repeated ids are kept as they
    are; an empty table gives no rows; other columns are not read. Pairs that the models
    have not counted cost what their word does. Documents that the models are counted on
    are best given as the same frame.
    """
    stage = Stage(docs.sparkSession)
    if docs is models.docs and (text_column, id_column) == (models.text_column, models.id_column):
        rows, sent, buckets = models.requests()
    else:
        totals, buckets = models.counted()
        rows, _ = chunked(docs, id_column, text_column)
        sent = totals.unionByName(asked(rows, buckets, False))
    with shuffles_freed(stage.spark):
        found = stage.store(added_up(sent, answers, ANSWERS), "answers")
    t = found.agg(*[F.sum(x) for x in ("words", "word_target", "word_every")]).first()
    vocabulary, of_target, of_all = (x or 0 for x in t)
    whole = [float(x + max(START, vocabulary)) for x in (of_target, of_all)]
    names = ["id", "n_words", "target_sum", "every_sum"]

    def price(documents: pa.Table, answered: pa.Table) -> pa.Table:
        if not len(documents):
            return pa.Table.from_arrays([pa.array([], pa.int64())] * 4, names=names)
        chunk = Chunk(documents.column("body").combine_chunks(), buckets)
        by_bucket = {b: (x, y) for b, x, y in zip(*(answered.column(c).to_pylist() for c in ("bucket", "target", "every")))}
        row = np.repeat(np.arange(len(documents)), chunk.sizes)
        sums = []
        for model, total in enumerate(whole):
            n = np.concatenate([np.zeros(0, np.int64), *[from_planes(by_bucket[b][model]) for b, _, _ in chunk.parts()]])
            word, context, pair = chunk.by_word(n)
            share = np.where(context > 0, SHARE, 0.0)
            nats = -np.log(share * pair / np.maximum(context, 1) + (1 - share) * ((word + 1) / total))
            loss = np.zeros(len(documents), np.int64)
            np.add.at(loss, row, np.rint(nats * UNIT).astype(np.int64))
            sums.append(loss)
        return pa.Table.from_arrays([documents.column("id").combine_chunks(), *map(pa.array, (chunk.sizes, *sums))], names=names)

    replies = found.filter("chunk IS NOT NULL").select("chunk", "bucket", "target", "every")
    priced = rows.select("chunk", "id", "body").groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(
        price, ", ".join(f"{x} bigint" for x in names))
    per_word = lambda x: F.try_divide(F.col(x) / UNIT, F.col("n_words"))
    return priced.select("id", "n_words", per_word("target_sum").alias("target_loss"), per_word("every_sum").alias("background_loss")).withColumn(
        "score", F.coalesce(F.col("target_loss") - F.col("background_loss"), F.lit(0.0)))
