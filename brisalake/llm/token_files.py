"""Token ids in Parquet: one row per document, its ids a list column, in document order.

Texts are dealt into shards by document id and encoded where they are sorted, so ids
are made once and written where they are made. A row carries its shard and the ids
before it in that shard; a table of one row per shard says how many ids come before
the shard. Spark's own writer makes the files: ids are dictionary-encoded (a
vocabulary fits one dictionary page, so an id costs its width in bits), numbers that
rise from row to row are delta-encoded, row groups and pages are bounded, and every
page has its entry in the page index. Reading numbers only never touches the pages of
ids, and a filter on documents or on places skips row groups and pages.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brisalake.llm.common import small_batches, text_or_empty, worker_cache

ROWS = "doc_id bigint, shard int, at bigint, n_tokens bigint, ids array<int>"
CACHE_WORDS, LONG_WORD = 300_000, 100
# How the tokenizer file cuts a text in lower case, for any text and for ASCII.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
ASCII_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
#: Letters that lower by their place or to two, and blanks that not all libraries hold for such.
ODD = re.compile(r"[\x1c-\x1f\x85\u180e\u200bΣİ]")
#: Columns whose values rise within a shard, or are too various for a dictionary: delta-encoded.
DELTA = ("doc_id", "at", "n_tokens")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if it prints, else one from 256 on, in order."""
    shown = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return {b: chr(b if b in shown else next(hidden)) for b in range(256)}


class Words(dict):
    """Ids of words in lower case as bytes, each made once; of the words beyond ``keep`` those in use stay."""

    def __init__(self, model, size: int, keep: int = CACHE_WORDS):
        self.tokenize, self.letters, self.keep, self.old = model.tokenize, byte_letters(), keep, {}
        self.packed = [i.to_bytes(4, "little") for i in range(size)]

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            pieces = ASCII_PIECE.findall(word) if word.isascii() else [
                p.encode().decode("latin-1").translate(self.letters) for p in PIECE.findall(word)]
            ids = b"".join([self.packed[t.id] for p in pieces for t in self.tokenize(p)])
        if len(word) <= LONG_WORD:
            if len(self) >= self.keep:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids


def word_encoder(tokenizer: str) -> Callable[[str], bytes]:
    """Text to little-endian 32-bit ids by a tokenizer file that cuts texts into pieces by ``PIECE``, in lower case.

    Pieces never hold white space, so a text is the run of its words: the text is
    normalised and cut here by the file's own rule, and the library's model encodes the
    pieces of each distinct word once per worker. Texts with anything that the two may
    lower or cut differently (special tokens, ``ODD``) go to the library as they are.
    """
    def make() -> dict:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(tokenizer)
        return {"words": Words(library.model, library.get_vocab_size()), "library": library}

    kept = worker_cache(f"words {tokenizer}", make)
    library, word_ids = kept["library"], kept["words"].__getitem__

    def ids(text: str) -> bytes:
        if "<|" in text or ODD.search(text):
            return np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        plain = text if text.isascii() else unicodedata.normalize("NFC", text)
        return b"".join(map(word_ids, plain.lower().split()))

    return ids


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, id_column: str = "doc_id",
                 text_column: str = "text", shards: int | None = None, row_group_bytes: int = 32 << 20,
                 page_bytes: int = 256 << 10, page_rows: int = 1000) -> None:
    """Write ``folder/tokens`` and ``folder/shards``.

    Rows are in ascending order of document, null first; rows of one document id keep
    the order in which they are read, and as they differ in that, a document id with
    any share of all rows is dealt over several shards. A null or empty text is
    ``end_id`` alone; an empty table gives two empty tables; other columns are not
    read. Without ``shards`` their number follows the session's shuffle partitions,
    merged by adaptive execution. A text is one row, however long.
    """
    spark = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard, at = word_encoder(tokenizer), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            made = [encode(t.as_py()) + end for t in batch.column(1)]
            sizes = np.array([len(x) // 4 for x in made], np.int64)
            places = np.concatenate([[0], np.cumsum(sizes)])
            lists = pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(np.frombuffer(b"".join(made), "<i4")))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(sizes), shard, np.int32)), pa.array(at + places[:-1]), pa.array(sizes), lists],
                names=["doc_id", "shard", "at", "n_tokens", "ids"])
            at += int(places[-1])

    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), text_or_empty(text_column).alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    dealt = rows.repartitionByRange(shards, "doc_id", "row") if shards else rows.repartitionByRange("doc_id", "row")
    encoded = dealt.sortWithinPartitions("doc_id", "row").select("doc_id", "text").mapInArrow(run, ROWS)
    options = {"parquet.writer.version": "v2", "parquet.block.size": row_group_bytes, "parquet.page.size": page_bytes,
               "parquet.page.row.count.limit": page_rows, **{f"parquet.enable.dictionary#{c}": "false" for c in DELTA}}
    with small_batches(spark):
        encoded.write.mode("overwrite").options(**options).parquet(f"{folder}/tokens")
    stored = spark.read.schema(ROWS).parquet(f"{folder}/tokens")
    totals = stored.groupBy("shard").agg(F.count("*").alias("documents"), F.sum("n_tokens").alias("tokens"),
                                         F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    # One row per shard: few enough for a running sum in one task.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("bigint"))) \
        .write.mode("overwrite").parquet(f"{folder}/shards")


SHARDS = "shard int, documents bigint, tokens bigint, first_id bigint, last_id bigint, base bigint"


def read_tokens(spark: SparkSession, folder: str, documents: tuple[int, int] | None = None,
                places: tuple[int, int] | None = None, ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens and, unless ``ids`` is false, the list of ids.

    ``documents`` keeps ids from the first to the last, both included. ``places`` keeps
    the documents that hold any of the ids from the first place to before the last,
    counted over all documents. Both reach the scan as filters on the rows' numbers.
    """
    rows = spark.read.schema(ROWS).parquet(f"{folder}/tokens")
    shards = spark.read.schema(SHARDS).parquet(f"{folder}/shards").select("shard", "base", "tokens")
    if documents:
        rows = rows.filter(F.col("doc_id").between(*documents))
    if places:
        first, last = places
        shards = shards.filter((F.col("base") < last) & (F.col("base") + F.col("tokens") > first))
        # Few rows: those of the shards that the range crosses. Within one shard ``at`` is a filter for the scan.
        crossed = shards.orderBy("shard").limit(2).collect()
        if len(crossed) == 1:
            base = crossed[0]["base"]
            rows = rows.filter((F.col("shard") == crossed[0]["shard"]) & (F.col("at") < last - base)
                               & (F.col("at") + F.col("n_tokens") > first - base))
    start = F.col("base") + F.col("at")
    found = rows.join(shards, "shard")
    if places:
        found = found.filter((start < last) & (start + F.col("n_tokens") > first))
    return found.select("doc_id", start.alias("start"), "n_tokens", *(["ids"] if ids else []))


def with_checksum(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32: the ids as little-endian unsigned 32-bit numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            flat, places = lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), lists.offsets.to_numpy()
            sums = [zlib.crc32(flat[a:b]) for a, b in zip(places, places[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())],
                                             names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return rows.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
