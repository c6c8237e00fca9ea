"""Cost-balanced packing of tokenised documents into sequences.

A document of n tokens costs ``linear * n + quadratic * n * n``: attention pays
for the square. Every task reads its documents in windows of a bounded number of
tokens, opens just as many sequences as the window's tokens fill, and deals the
documents out from the longest down, each to the sequence of lowest cost that
still has room for it. Only when no sequence has the room is a document cut to
fill one, so a window leaves less than one sequence of padding. There is no
shuffle: ids never leave the task that made them, and a repeated task gives the
same rows.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brisalake.llm.common import text_or_empty, worker_cache

SCHEMA = ("doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, "
          "offset bigint")
#: A blank between other blanks or before the end, where splitting at blanks may not be a token border.
UNSAFE = re.compile(r"\s (?:\s|$)")
CACHE_WORDS = 600_000


def rank_encoder(ranks: str) -> Callable[[str], bytes]:
    """Text to little-endian unsigned 32-bit ids of a byte-level BPE given as a file of ranks.

    The vocabulary equals that of the tokenizer file of the same name, so the
    ids are the same; tests compare them. Words repeat, so each is encoded once
    per worker: a blank that follows a non-blank always begins a new piece.
    """
    import public_tokenizers
    import tiktoken

    def make() -> dict:
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        special = {"<|endoftext|>": len(table)}
        return {"words": {}, "bpe": tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN,
                                                      mergeable_ranks=table, special_tokens=special)}

    kept = worker_cache(f"bpe {ranks}", make)
    encode, words = kept["bpe"].encode, kept["words"]
    plain = lambda s: np.array(encode(s, allowed_special="all"), dtype="<u4").tobytes()

    def ids(text: str) -> bytes:
        if UNSAFE.search(text):
            return plain(text)
        first, *rest = text.split(" ")
        try:
            return plain(first) + b"".join(map(words.__getitem__, rest))
        except KeyError:
            if len(words) > CACHE_WORDS:
                words.clear()
            for w in rest:
                if w not in words:
                    words[w] = plain(" " + w)
            return plain(first) + b"".join(map(words.__getitem__, rest))

    return ids


def assign(sizes: list[int], capacity: int, linear: float, quadratic: float) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Pieces (document, start, length, sequence, offset) and the number of sequences they fill."""
    total = sum(sizes)
    n_sequences = -(-total // capacity)
    pieces, tails, opened = [], [], 0
    for d, size in enumerate(sizes):
        for start in range(0, size - capacity + 1, capacity):  # a whole sequence each: these come first
            pieces.append((d, start, capacity, opened, 0))
            opened += 1
        if size % capacity:
            tails.append((size % capacity, d, size - size % capacity))
    tails.sort(key=lambda t: (-t[0], t[1]))
    # By room left: a heap of (cost, sequence), and its lowest cost.
    heaps: list[list] = [[] for _ in range(capacity + 1)]
    heaps[capacity] = [(0.0, s) for s in range(opened, n_sequences)]
    lowest = np.full(capacity + 1, np.inf)
    if heaps[capacity]:
        lowest[capacity] = 0.0
    for size, d, start in tails:
        while size:
            room = size + int(np.argmin(lowest[size:]))
            if lowest[room] == np.inf:  # none has the room: fill the widest gap
                room = int(np.flatnonzero(lowest[:size] < np.inf)[-1])
            cost, s = heapq.heappop(heaps[room])
            lowest[room] = heaps[room][0][0] if heaps[room] else np.inf
            take = min(size, room)
            pieces.append((d, start, take, s, capacity - room))
            if left := room - take:
                heapq.heappush(heaps[left], (cost + linear * take + quadratic * take * take, s))
                lowest[left] = heaps[left][0][0]
            start, size = start + take, size - take
    return pieces, n_sequences


def pack(docs: DataFrame, ranks: str, id_column: str = "doc_id", text_column: str = "text", capacity: int = 1024,
         window_tokens: int = 1 << 21, linear: float = 1.0, quadratic: float = 1 / 1024) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` holds the piece's tokens as little-endian unsigned 32-bit numbers.
    A document's tokens end with id 0. A null or empty text is that id alone; a
    null doc_id stays null; rows with the same doc_id are packed each on its
    own; other columns are ignored, whatever their names; an empty table gives
    no rows. Of documents as long as one another the one read first goes first.
    ``window_tokens`` bounds what a task holds: larger windows balance over more
    documents, and each window ends with less than ``capacity`` of padding.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, held, opened = rank_encoder(ranks), [], TaskContext.get().partitionId() << 36

        def flush() -> pa.RecordBatch:
            nonlocal opened
            sizes = [len(x) // 4 for _, x in held]
            pieces, n = assign(sizes, capacity, linear, quadratic)
            rows = list(zip(*pieces))
            arrays = [pa.array([held[d][0] for d in rows[0]], pa.int64()), pa.array(rows[1], pa.int64()),
                      pa.array(rows[2], pa.int64()),
                      pa.array([held[d][1][4 * s:4 * (s + k)] for d, s, k, _, _ in pieces], pa.binary()),
                      pa.array([sizes[d] for d in rows[0]], pa.int64()),
                      pa.array(np.array(rows[3], np.int64) + opened), pa.array(rows[4], pa.int64())]
            opened += n
            held.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "length", "ids", "doc_tokens",
                                                             "sequence_id", "offset"])

        tokens = 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py()) + b"\0\0\0\0"
                held.append((key, ids))
                tokens += len(ids) // 4
                if tokens >= window_tokens:
                    yield flush()
                    tokens = 0
        if held:
            yield flush()

    return docs.select(F.col(id_column).cast("bigint"), text_or_empty(text_column)).mapInArrow(run, SCHEMA)
