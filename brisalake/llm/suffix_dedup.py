"""Removal of long repeated substrings by the Burrows-Wheeler transform.

Every byte covered by a string of ``least`` bytes that starts anywhere else too is
removed. One transform of a corpus fits no task, so strings that can be equal are
brought together first:

1. Anchors. In every window of ``least`` bytes the gram with the smallest hash (the
   last of equal ones) is an anchor. It depends on the window's content alone, so
   equal windows hold the same anchor at the same place. Only anchors that occur at
   two places or more go on.
2. Segments. All windows that an anchor stands for, as one piece of text. Equal
   segments are one with many places, combined before the shuffle.
3. Groups of segments with one anchor. A group with very many different segments (the
   edge of a passage that a third of the documents share) is split: each segment is
   compared with one of them, which settles the windows they share, and what reaches
   further meets only the segments that leave it at the same byte in the same way.
4. In a task, groups are joined to texts of bounded size. Breadth-first backward
   extension on the text's transform derives the common prefixes of neighbouring
   suffixes by increasing length and stops at ``least``: suffixes with no shorter
   prefix between them start the same window, and it counts if their places in the
   corpus differ.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brisalake.llm.common import RANDOM, Stage, byte_chunks, mixed, ranges, text_or_empty

GRAM = 64  # long enough that grams are seldom equal by chance
BATCH_BYTES = 1 << 20
GROUP_SEGMENTS = 2000
SEPARATOR = b"\xff"  # no byte of UTF-8


# --- one text in memory ------------------------------------------------------
def sorting(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(an order that sorts the keys, the sorted keys). With room for the place in a key's low bits it sorts values, which is faster."""
    bits = len(key).bit_length()
    if int(key.max(initial=0)).bit_length() + bits > 63:
        order = np.argsort(key)
        return order, key[order]
    both = np.sort((key << bits) | np.arange(len(key)))
    return both & ((1 << bits) - 1), both >> bits


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Places of the suffixes, sorted by at least their first ``depth`` symbols (positive, below 512)."""
    n = len(symbols)
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(4, np.int64)])
    key = np.zeros(n, np.int64)
    for j in range(4):
        key = (key << 9) | padded[j:j + n]
    known = 4
    while True:
        order, ordered = sorting(key)
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        if known >= depth or rank[order[-1]] == n - 1:
            return order
        after = np.zeros(n, np.int64)
        after[:max(n - known, 0)] = rank[known:] + 1
        key, known = rank * (n + 1) + after, 2 * known


def short_prefixes(symbols: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(order of the suffixes, common prefix of each with the one before it, or ``least`` if no shorter).

    Interval expansion: from the interval of all suffixes, the intervals of c.w are
    found from that of w through the transform. The first level at which an interval
    ends at a place is the common prefix there; it is expanded only then.
    """
    n = len(symbols)
    order = suffix_order(symbols, least + 1)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    before = np.where(order > 0, symbols[order - 1], 0)  # the transform; 0 where nothing precedes
    previous = np.where(order > 0, place[order - 1], -1)
    prefix = np.full(n + 1, least, np.int64)
    prefix[0] = prefix[n] = -1
    low, high = np.array([0]), np.array([n])
    for level in range(least):
        if not len(low):
            break
        size = high - low
        at = ranges(low, size)
        key = np.repeat(np.arange(len(low)), size) * 512 + before[at]
        there = before[at] > 0
        at, key = at[there], key[there]
        if not len(at):
            break
        by, key = sorting(key)
        target = previous[at[by]]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count = np.diff(np.concatenate([first, [len(key)]]))
        low = np.minimum.reduceat(target, first)
        high = low + count
        new = prefix[high] == least
        low, high = low[new], high[new]
        prefix[high] = level
    return order, prefix[:n]


def repeated_windows(segments: list[bytes], places: np.ndarray, many: np.ndarray, least: int) -> list[np.ndarray]:
    """For each segment the starts of its windows that begin at another place too.

    ``places``: where a segment starts in the corpus, as a number; ``many``: whether
    it has several places.
    """
    lengths = np.array([len(s) for s in segments])
    starts = np.cumsum(lengths + 1) - lengths - 1
    symbols = np.frombuffer(SEPARATOR.join(segments) + SEPARATOR, np.uint8).astype(np.int64) + 1
    order, prefix = short_prefixes(symbols, least)
    owner = np.repeat(np.arange(len(segments)), lengths + 1)
    within = np.arange(len(symbols)) - starts[owner]
    whole = (within + least <= lengths[owner])[order]  # the window ends before the separator
    group = np.cumsum(prefix < least)[whole]
    suffix = order[whole]
    if not len(suffix):
        return [np.zeros(0, np.int64) for _ in segments]
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    spot = places[owner[suffix]] + within[suffix]
    differ = np.minimum.reduceat(spot, first) != np.maximum.reduceat(spot, first)
    differ |= np.logical_or.reduceat(many[owner[suffix]], first)
    size = np.diff(np.concatenate([first, [len(suffix)]]))
    hit = np.sort(suffix[np.repeat(differ, size)])
    cut = np.searchsorted(hit, np.concatenate([starts, [len(symbols)]]))
    return [hit[a:b] - s for a, b, s in zip(cut[:-1], cut[1:], starts)]


def joined_runs(starts: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Sorted starts of equally wide ranges as maximal runs."""
    if not len(starts):
        return []
    new = np.flatnonzero(np.concatenate([[True], starts[1:] > starts[:-1] + width]))
    last = np.concatenate([new[1:] - 1, [len(starts) - 1]])
    return list(zip(starts[new].tolist(), (starts[last] + width).tolist()))


# --- anchors and segments ----------------------------------------------------
def anchors(flat: np.ndarray, starts: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(place, hash, start of its first window, end of its last) of the anchors in texts that lie end to end.

    Every window has one anchor, so an anchor's windows are what its segment holds.
    """
    sizes = np.diff(starts)
    long = np.flatnonzero(sizes >= least)
    if not len(long):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h, step, power = RANDOM[flat], 1, np.array([0x9E3779B97F4A7C15], np.uint64)  # an array: wraps without a warning
    while step < GRAM:
        h = h[:-step] * power + h[step:]
        step, power = 2 * step, power * power
    h = mixed(h)
    low = np.uint64(0xFFFFFFFF)
    key = (h & ~low) | (low - np.arange(len(h), dtype=np.uint64))
    width = least - GRAM + 1
    blocks = -(-len(key) // width)
    square = np.full(blocks * width, np.iinfo(np.uint64).max)
    square[:len(key)] = key
    square = square.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    at = ranges(starts[:-1][long], sizes[long] - least + 1)
    best = np.minimum(behind[at], ahead[at + width - 1])
    place = (low - (best & low)).astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    last = np.concatenate([new[1:] - 1, [len(place) - 1]])
    return place[new], h[place[new]], at[new], at[last] + least


def find_anchors(docs: DataFrame, least: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, flat, starts in byte_chunks(batch.column(1)):
                place, h, first, end = anchors(flat, starts, least)
                row = np.searchsorted(starts, place, side="right") - 1
                within = [pa.array(x - starts[row]) for x in (place, first, end)]
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), ids.take(pa.array(row + lo)), *within],
                                                 names=["grp", "tid", "pos", "lo", "hi"])
    return docs.select("tid", "body").mapInArrow(run, "grp bigint, tid binary, pos bigint, lo bigint, hi bigint")


SEGMENTS = "grp bigint, seg binary, anchor int, tids binary, starts binary"
RUNS = "tid binary, lo bigint, hi bigint"


def cut_batch(runs: list[tuple[bytes, int, int]], held: dict) -> pa.RecordBatch:
    """Settled runs, then segments: rows of one or the other."""
    n, m = len(runs), len(held)
    tid, lo, hi = zip(*runs) if runs else ((), (), ())
    values = list(held.values())
    columns = [(pa.binary(), list(tid) + [None] * m), (pa.int64(), list(lo) + [None] * m), (pa.int64(), list(hi) + [None] * m),
               (pa.int64(), [None] * n + [k[0] for k in held]), (pa.binary(), [None] * n + [k[1] for k in held]),
               (pa.int32(), [None] * n + [k[2] for k in held]), (pa.binary(), [None] * n + [b"".join(t for t, _ in v) for v in values]),
               (pa.binary(), [None] * n + [np.array([x for _, x in v], np.int64).tobytes() for v in values])]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for k, v in columns],
                                      names=["tid", "lo", "hi", "grp", "seg", "anchor", "tids", "starts"])


def settle(key: tuple[int, bytes, int], places: list, least: int) -> tuple[list, list]:
    """(runs, places to go on with): a segment at several places is repeated as a whole; two of them tell others so."""
    if len(places) < 2 or len(key[1]) < least:
        return [], places[:2] if len(set(places)) > 1 else places[:1]
    return [(t, at, at + len(key[1])) for t, at in places], places[:2]


def cut_segments(texts: DataFrame, least: int) -> DataFrame:
    """(tid, body, at: array of (grp, pos, lo, hi)) to segments, equal ones combined and settled within a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0

        def flush() -> pa.RecordBatch:
            nonlocal size
            runs = []
            for key, places in held.items():
                own, held[key] = settle(key, sorted(set(places)), least)
                runs += own
            out = cut_batch(runs, held)
            held.clear()
            size = 0
            return out

        for batch in batches:
            for tid, body, at in zip(batch.column(0), batch.column(1), batch.column(2)):
                tid, data = tid.as_py(), body.as_py().encode()
                for x in at.as_py():
                    seg = data[x["lo"]:x["hi"]]
                    places = held.setdefault((x["grp"], seg, x["pos"] - x["lo"]), [])
                    places.append((tid, x["lo"]))
                    size += len(seg) if len(places) == 1 else 24
                if size > 16 << 20:
                    yield flush()
        if held:
            yield flush()

    return texts.select("tid", "body", "at").mapInArrow(run, f"{RUNS}, {SEGMENTS}")


def runs_batch(rows: list[tuple[bytes, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.binary(), pa.int64(), pa.int64()))],
                                      names=["tid", "lo", "hi"])


def places_of(tids: bytes, starts: bytes) -> list[tuple[bytes, int]]:
    return [(tids[16 * i:16 * i + 16], x) for i, x in enumerate(np.frombuffer(starts, np.int64).tolist())]


def repeated_runs(segments: DataFrame, least: int) -> DataFrame:
    """(tid, lo, hi) of the bytes covered by repeated windows around the groups' anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[tuple[bytes, list]] = []  # segments of whole groups, with their places
        group: dict[bytes, list] = {}
        now, size, alone = None, 0, []

        def close() -> None:
            nonlocal size
            if len(group) > 1:
                ready.extend(group.items())
                size += sum(map(len, group))
            else:  # the same segment everywhere
                for seg, spots in group.items():
                    alone.extend(settle((0, seg, 0), sorted(set(spots)), least)[0])
            group.clear()

        def flush() -> pa.RecordBatch:
            nonlocal size
            out, segs, places = list(alone), [s for s, _ in ready], [sorted(set(p)) for _, p in ready]
            alone.clear()
            if not ready:
                return runs_batch(out)
            many = np.array([len(p) > 1 for p in places])
            texts: dict[bytes, int] = {}
            number = np.array([(texts.setdefault(p[0][0], len(texts)) << 40) + p[0][1] for p in places], np.int64)
            found = repeated_windows(segs, number, many, least)
            for seg, spot, several, windows in zip(segs, places, many, found):
                cover = [(0, len(seg))] if several and len(seg) >= least else joined_runs(windows, least)
                out.extend((tid, start + a, start + b) for tid, start in spot for a, b in cover)
            ready.clear()
            size = 0
            return runs_batch(out)

        for batch in batches:
            for grp, seg, tids, starts in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4))):
                if grp != now:
                    close()
                    if size >= BATCH_BYTES or len(alone) > 50_000:
                        yield flush()
                    now = grp
                group.setdefault(seg, []).extend(places_of(tids, starts))
        close()
        if ready or alone:
            yield flush()

    return segments.repartition("grp").sortWithinPartitions("grp").mapInArrow(run, RUNS)


def split_group(pairs: DataFrame, least: int) -> DataFrame:
    """Segments of large groups, each with one segment ``ref`` of its group: runs settled by the two, and its next groups.

    A window that is not settled reaches further left than what the two share, and
    goes on with all segments that leave ``ref`` there by the same byte; or it does
    not, but reaches further right. Segments are trimmed to what such windows reach.
    """
    reach = least - GRAM

    def shared(a: bytes, b: bytes) -> int:
        n = min(len(a), len(b))
        differ = np.flatnonzero(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n))
        return int(differ[0]) if len(differ) else n

    def key_of(grp: int, side: bytes, n: int, byte: bytes) -> int:
        return int.from_bytes(hashlib.blake2b(b"%d %s %d %s" % (grp, side, n, byte), digest_size=8).digest(), "little", signed=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, held = [], {}

            def go_on(key: int, seg: bytes, at: int, begin: int, own: list) -> None:
                if len(seg) >= least:
                    held.setdefault((key, seg, at), []).extend((t, x + begin) for t, x in own)

            for grp, seg, at, tids, starts, ref, ref_at, ref_tids, ref_starts in zip(*(batch.column(i).to_pylist() for i in range(9))):
                own, refs = places_of(tids, starts), places_of(ref_tids, ref_starts)
                if seg == ref and at == ref_at:
                    both = sorted(set(own + refs))
                    runs += settle((grp, seg, at), both, least)[0]
                    continue
                left, right = shared(seg[:at][::-1], ref[:ref_at][::-1]), shared(seg[at + GRAM:], ref[ref_at + GRAM:])
                if left + GRAM + right >= least:
                    runs += [(t, x + at - left, x + at + GRAM + right) for t, x in own]
                    runs += [(t, x + ref_at - left, x + ref_at + GRAM + right) for t, x in refs]
                if left < at:
                    end = min(len(seg), at + GRAM + reach - left - 1)
                    go_on(key_of(grp, b"L", left, seg[at - left - 1:at - left]), seg[:end], at, 0, own)
                if at + GRAM + right < len(seg):
                    begin = at - min(left, reach - right - 1)
                    go_on(key_of(grp, b"R", right, seg[at + GRAM + right:at + GRAM + right + 1]), seg[begin:], at - begin, begin, own)
            for key, places in held.items():
                more, held[key] = settle(key, sorted(set(places)), least)
                runs += more
            yield cut_batch(sorted(set(runs)), held)

    ref = [F.col(f"ref.{c}").alias(f"ref_{c}") for c in ("seg", "anchor", "tids", "starts")]
    return pairs.select("grp", "seg", "anchor", "tids", "starts", *ref).mapInArrow(run, f"{RUNS}, {SEGMENTS}")


# --- the operator ------------------------------------------------------------
def cut_texts(texts: DataFrame) -> DataFrame:
    """(tid, body, runs) to what is left of each text."""
    schema = "tid binary, n_removed bigint, n_spans bigint, kept binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for tid, body, runs in zip(batch.column(0), batch.column(1), batch.column(2)):
                data, spans = body.as_py().encode(), []
                for r in sorted((r["lo"], r["hi"]) for r in runs.as_py()):
                    if spans and r[0] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], r[1])
                    else:
                        spans.append(list(r))
                kept, at = [], 0
                for a, b in spans:
                    kept.append(data[at:a])
                    at = b
                out.append((tid.as_py(), sum(b - a for a, b in spans), len(spans), b"".join(kept) + data[at:]))
            columns = list(zip(*out)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.binary(), pa.int64(), pa.int64(), pa.binary()))],
                                             names=["tid", "n_removed", "n_spans", "kept"])

    return texts.select("tid", "body", "runs").mapInArrow(run, schema)


def remove_repeats(spark: SparkSession, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                   least: int = 400) -> DataFrame:
    """id, n_bytes, n_removed, n_spans, kept (the bytes left, or null where none were removed), sha (of the whole text).

    One row per document. Texts are UTF-8 bytes, null the empty text; matches stay
    inside a text; a text shorter than ``least`` loses nothing; a text that occurs in
    several rows (repeated rows included) loses everything if it is long enough.
    Strings are judged on the input, not on what is left. Null and repeated ids are
    kept as they are; an empty table gives no rows; other columns are not read.
    """
    stage = Stage(spark)
    text, ident = text_or_empty(text_column), F.col(id_column).cast("bigint")
    sha = F.unhex(F.sha2(text.cast("binary"), 256))
    row_key = F.unhex(F.md5(F.concat(F.coalesce(ident.cast("string"), F.lit("~")), F.lit("|"), text).cast("binary")))
    docs = docs.select(ident.alias("id"), sha.alias("sha"), F.substring(sha, 1, 16).alias("tid"), row_key.alias("row_key"),
                       F.octet_length(text).cast("bigint").alias("n_bytes"), text.alias("body"))
    rows = stage.store(docs.drop("body"), "rows")
    texts = stage.store(rows.groupBy("tid").agg(F.min("row_key").alias("row_key"), F.count("*").alias("copies")), "texts")

    found = stage.store(find_anchors(docs.filter(F.col("n_bytes") >= least), least), "anchors")
    spot = F.xxhash64("tid", "pos")
    shared = found.groupBy("grp").agg(F.min(spot).alias("low"), F.max(spot).alias("high")).filter("low < high").select("grp")
    shared = found.join(stage.store(shared, "shared"), "grp").distinct()
    at = stage.store(shared.groupBy("tid").agg(F.collect_list(F.struct("grp", "pos", "lo", "hi")).alias("at")), "at")
    wanted = stage.store(docs.select("row_key", "body").join(at.join(texts, "tid"), "row_key")
                         .select("tid", "body", "at", "copies"), "wanted")

    done = stage.store(cut_segments(wanted, least), "cut")
    parts, level = [], 0
    while True:
        parts.append(done.filter("tid IS NOT NULL").select("tid", "lo", "hi"))
        segments = done.filter("grp IS NOT NULL").select("grp", "seg", "anchor", "tids", "starts")
        sizes = segments.groupBy("grp").agg(F.count_distinct(F.xxhash64("seg")).alias("many"))
        large = stage.store(sizes.filter(F.col("many") > GROUP_SEGMENTS).select("grp"), f"large-{level}")
        if large.isEmpty():
            parts.append(repeated_runs(segments, least))
            break
        parts.append(repeated_runs(segments.join(large, "grp", "left_anti"), least))
        hot = segments.join(large, "grp")
        ref = hot.groupBy("grp").agg(F.min(F.struct(F.xxhash64(F.lit(level), "seg"), "seg", "anchor", "tids", "starts")).alias("ref"))
        ref = stage.store(ref, f"ref-{level}")
        done = stage.store(split_group(hot.join(ref, "grp"), least), f"split-{level}")
        level += 1

    runs = functools.reduce(DataFrame.unionByName, parts)
    runs = stage.store(runs.distinct(), "runs")
    by_text = runs.groupBy("tid").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))
    left = stage.store(cut_texts(wanted.filter("copies = 1").join(by_text, "tid")), "left")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= least)
    per_text = stage.store(texts.join(left, "tid", "left").select("tid", "copies", "n_removed", "n_spans", "kept"), "per-text")
    return rows.join(per_text, "tid").select(
        "id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(whole, F.lit(b"")).otherwise(F.col("kept")).alias("kept"), "sha")
