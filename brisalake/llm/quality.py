"""Quality score: histogram gradient-boosted trees over document statistics.

Statistics are computed for whole texts, vectorised over the bytes of a batch. The
trees are fitted on a bounded sample of labelled rows, on histograms of binned
statistics, and flattened into three arrays, which a task walks for all its
documents and all trees at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brisalake.llm.common import BLANK, byte_chunks, byte_table, span_hashes, spans, sum_by_row, text_or_empty

STATISTICS = ("log_bytes", "log_words", "word_bytes", "word_bytes_sd", "upper", "digit", "punctuation", "symbol", "blank",
              "newline", "wide", "line_bytes", "distinct_words", "top_word", "repeats_previous", "distinct_lines",
              "entropy", "sentence_ends", "capitals_at_start", "upper_words", "symbol_words", "control")


UPPER, DIGIT = byte_table(bytes(range(65, 91))), byte_table(bytes(range(48, 58)))
PUNCTUATION, SYMBOL = byte_table(b".,;:!?'\"()-"), byte_table(b"#$%&*+/<=>@[\\]^_`{|}~")
CONTROL = byte_table(bytes(x for x in range(32) if x not in b"\t\n\r"))


def _distinct(row: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes per row and how often the most frequent one occurs."""
    if not len(h):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((h, row))
    r, v = row[order], h[order]
    new = np.flatnonzero(np.concatenate([[True], (r[1:] != r[:-1]) | (v[1:] != v[:-1])]))
    counts = np.diff(np.concatenate([new, [len(r)]]))
    top = np.zeros(n)
    np.maximum.at(top, r[new], counts)
    return np.bincount(r[new], minlength=n).astype(float), top


def statistics(column: pa.Array) -> np.ndarray:
    """One row of STATISTICS per text."""
    parts = [np.zeros((0, len(STATISTICS)))]
    for lo, hi, flat, starts in byte_chunks(column):
        n, size = hi - lo, np.diff(starts).astype(float)
        some = np.maximum(size, 1)
        share = lambda mask: sum_by_row(mask, starts) / some
        blank, upper, symbol = BLANK[flat], UPPER[flat], SYMBOL[flat]
        first, end = spans(~blank, starts)
        row = np.searchsorted(starts, first, side="right") - 1
        length = (end - first).astype(float)
        words = np.bincount(row, minlength=n).astype(float)
        per = lambda x: np.bincount(row, weights=x, minlength=n) / np.maximum(words, 1)
        mean = per(length)
        h = span_hashes(flat, first, end)
        distinct, top = _distinct(row, h, n)
        again = np.concatenate([[False], (h[1:] == h[:-1]) & (row[1:] == row[:-1])]) if len(h) else np.zeros(0, bool)
        last = flat[end - 1] if len(end) else flat[:0]
        within = lambda mask: (lambda s: (s[end] - s[first]) / np.maximum(length, 1))(np.concatenate([[0], np.cumsum(mask)]))
        lines_first, lines_end = spans(flat != 10, starts)
        line_row = np.searchsorted(starts, lines_first, side="right") - 1
        lines = np.bincount(line_row, minlength=n).astype(float)
        line_distinct, _ = _distinct(line_row, span_hashes(flat, lines_first, lines_end), n)
        owner = np.repeat(np.arange(n), np.diff(starts))
        counts = np.bincount(owner * 256 + flat, minlength=n * 256).reshape(n, 256) / some[:, None]
        entropy = -(counts * np.log2(np.where(counts > 0, counts, 1))).sum(1)
        parts.append(np.column_stack([
            np.log1p(size), np.log1p(words), mean, np.sqrt(np.maximum(per(length**2) - mean**2, 0)), share(upper),
            share(DIGIT[flat]), share(PUNCTUATION[flat]), share(symbol), share(blank), share(flat == 10),
            share(flat >= 128), size / np.maximum(lines, 1), distinct / np.maximum(words, 1), top / np.maximum(words, 1),
            per(again), line_distinct / np.maximum(lines, 1), entropy, per(np.isin(last, (33, 46, 63))),
            per(UPPER[flat[first]] if len(first) else first), per(within(upper) > 0.5), per(within(symbol) > 0),
            share(CONTROL[flat])]))
    return np.vstack(parts)


@dataclass
class Trees:
    """Complete trees of one depth, a row each: node i's children are 2i + 1 (x <= threshold) and 2i + 2."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        n, trees, depth = len(x), len(self.feature), int(np.log2(self.value.shape[1])) if len(self.feature) else 0
        node, tree, rows = np.zeros((n, trees), np.int64), np.arange(trees)[None, :], np.arange(n)[:, None]
        for _ in range(depth):
            node = 2 * node + 1 + (x[rows, self.feature[tree, node]] > self.threshold[tree, node])
        total = self.start + self.value[tree, node - (2**depth - 1)].sum(1)
        return 1 / (1 + np.exp(-total))


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.15,
          ridge: float = 1.0, least: float = 5.0) -> Trees:
    """Log-loss boosting; each level of a tree takes one histogram of gradients over (node, statistic, bin)."""
    n, k = x.shape
    inner, leaves = 2**depth - 1, 2**depth
    if not n:
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), 0.0)
    prior = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(k)]
    binned = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
    flat = binned + np.arange(k) * bins
    start = float(np.log(prior / (1 - prior)))
    total, out = np.full(n, start), ([], [], [])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        feature, threshold, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(n, np.int64)
        for level in range(depth):
            m, base = 2**level, 2**level - 1
            at = ((node - base)[:, None] * (k * bins) + flat).ravel()
            hist = lambda w: np.bincount(at, np.repeat(w, k), m * k * bins).reshape(m, k, bins).cumsum(2)
            gl, hl = hist(g), hist(h)
            gt, ht = gl[:, :1, -1:], hl[:, :1, -1:]
            gain = gl**2 / (hl + ridge) + (gt - gl)**2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
            gain[(hl < least * 0.25) | (ht - hl < least * 0.25)] = 0
            best = gain.reshape(m, -1).argmax(1)
            for i in np.flatnonzero(gain.reshape(m, -1).max(1) > 1e-6):
                j, b = divmod(int(best[i]), bins)
                if b < len(edges[j]):
                    feature[base + i], threshold[base + i] = j, edges[j][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        leaf = node - inner
        value = -rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + ridge)
        total += value[leaf]
        for kept, new in zip(out, (feature, threshold, value)):
            kept.append(new)
    return Trees(*map(np.array, out), start)


def statistics_column(text: Column) -> Column:
    @F.arrow_udf("array<double>")
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            x = statistics(texts)
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
    return measure(text)


def held_out(id_column: str) -> Column:
    """The fifth of the documents that no label is learned from."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        label_column: str = "quality", max_rows: int = 20_000, **boosting) -> Trees:
    """Trees for P(label 1), from at most ``max_rows`` labelled documents outside the held-out fifth.

    Above that bound the ids with the smallest hashes are taken. Of several texts of
    one id the one with the smallest digest counts; of several labels of one id the smallest counts; null ids and labels, and labels
    without a document, do not. Without any label every score is 0.5.
    """
    known = (labels.filter(~held_out(id_column) & F.col(id_column).isNotNull() & F.col(label_column).isNotNull())
             .groupBy(F.col(id_column).alias("key")).agg(F.min(label_column).cast("double").alias("mark")))
    sample = known.orderBy(F.xxhash64("key"), "key").limit(max_rows)
    rows = docs.select(F.col(id_column).alias("key"), text_or_empty(text_column).alias("body")).join(
        F.broadcast(sample), "key")
    measured = rows.select("key", "mark", F.sha2("body", 256).alias("digest"), statistics_column(F.col("body")).alias("x"))
    one = measured.groupBy("key", "mark").agg(F.min(F.struct("digest", "x"))["x"].alias("x"))  # at most max_rows rows
    got = one.toPandas().sort_values(["key", "mark"])
    x = np.array(got["x"].tolist(), float).reshape(len(got), len(STATISTICS))
    return boost(x, got["mark"].to_numpy(float), **boosting)


def score(text: Column, trees: Trees) -> Column:
    """Score of a text from 0 to 1, higher if label 1 is likelier; null is scored as the empty text."""
    @F.arrow_udf("double")
    def walk(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            x = statistics(texts)
            yield pa.array(np.concatenate([trees.score(x[i:i + 1024]) for i in range(0, len(x), 1024)] or [np.zeros(0)]))
    return walk(text_or_empty(text))
