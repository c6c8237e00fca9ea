"""Secret scan: known patterns and a randomness test battery.

Known patterns are matched in every whole text. The battery looks at every other
long run of token characters, infers its encoding from the characters it uses, and
tests the hypothesis that it is random in that encoding: chi-squared uniformity over
the alphabet, the number of runs above and below the alphabet's middle, and serial
correlation. Natural words fail it if they are long. For short runs too, the
hypothesis that a run is natural is tested: how much its characters surprise a model
of character pairs, counted on the corpus's own short runs. Over the whole corpus,
rejections of either hypothesis are controlled by false discovery rate within strata
of encoding and length; a run counts as a secret if it is rejected as natural and
not as random, whatever its length from LEAST_RUN on.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brisalake.llm.common import Stage, byte_chunks, ranges, spans, text_or_empty

# The base patterns. Kinds in the order of the contract; "random" follows them.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_VALUE, ACCESS_CHARS = 6, 20
KEYWORDS = ("passw", "secret", "token", "api")

LOWER, UPPERS, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: From the narrowest: (name, alphabet in order). A run's encoding is the first that has all its characters.
ENCODINGS = (("hex", DIGITS + "abcdef"), ("HEX", DIGITS + "ABCDEF"), ("base32", UPPERS + "234567"), ("lower", LOWER),
             ("upper", UPPERS), ("lower36", DIGITS + LOWER), ("upper36", DIGITS + UPPERS), ("letters", UPPERS + LOWER),
             ("base62", UPPERS + LOWER + DIGITS), ("base64", UPPERS + LOWER + DIGITS + "+/"),
             ("base64url", UPPERS + LOWER + DIGITS + "-_"), ("mixed", UPPERS + LOWER + DIGITS + "+/-_"))
LEAST_RUN = 16
BIN, LAST_BIN = 0.01, 1600  # p values as -log10 p in bins
Z_BIN, LAST_Z = 0.05, 2000  # deviations from natural text in bins
WORD_RUN = 8  # shorter runs do not say how far natural text spreads

TOKEN = np.zeros(256, bool)
TOKEN[np.frombuffer((UPPERS + LOWER + DIGITS + "+/-_").encode(), np.uint8)] = True
MEMBER = np.zeros((len(ENCODINGS), 256), bool)
INDEX = np.zeros((len(ENCODINGS), 256), np.int64)
for _i, (_, _alphabet) in enumerate(ENCODINGS):
    _codes = np.frombuffer(_alphabet.encode(), np.uint8)
    MEMBER[_i, _codes], INDEX[_i, _codes] = True, np.arange(len(_codes))


#: Characters as classes: letters whatever their case, digits, each of the others.
SIGNS = "+/-_"
CLASSES = len(LOWER) + 1 + len(SIGNS)
CLASS = np.zeros(256, np.int64)
for _i, _c in enumerate(LOWER):
    CLASS[ord(_c)] = CLASS[ord(_c.upper())] = _i
CLASS[np.frombuffer(DIGITS.encode(), np.uint8)] = len(LOWER)
for _i, _c in enumerate(SIGNS):
    CLASS[ord(_c)] = len(LOWER) + 1 + _i


def token_runs(flat: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end places of the runs of token characters."""
    return spans(TOKEN[flat], starts)


def pair_model(docs: DataFrame, text_column: str) -> np.ndarray:
    """Chance of each class after each other in natural text: the corpus's runs too short to be candidates.

    What comes to the driver has a bound: pairs of classes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            for _, _, flat, starts in byte_chunks(batch.column(0)):
                first, end = token_runs(flat, starts)
                short = end - first < LEAST_RUN
                at = ranges(first[short], end[short] - first[short] - 1)
                held += np.bincount(CLASS[flat[at]] * CLASSES + CLASS[flat[at + 1]], minlength=len(held))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(held), dtype=np.int32)), pa.array(held)], names=["pair", "n"])

    counts = np.zeros((CLASSES, CLASSES))
    for pair, n in docs.select(text_or_empty(text_column)).mapInArrow(run, "pair int, n bigint").groupBy("pair").agg(F.sum("n")).collect():
        counts[pair // CLASSES, pair % CLASSES] = n
    alone = (counts.sum(0) + 1) / (counts.sum() + CLASSES)
    return 0.95 * (counts + 5 * alone) / (counts.sum(1, keepdims=True) + 5) + 0.05 / CLASSES


def deviation(flat: np.ndarray, first: np.ndarray, end: np.ndarray, model: np.ndarray) -> np.ndarray:
    """How far each run's surprise lies above that of natural text with the same contexts, in standard deviations."""
    surprise = -np.log(model)
    mean = (model * surprise).sum(1)
    variance = (model * surprise**2).sum(1) - mean**2
    owner = np.repeat(np.arange(len(first)), end - first - 1)
    at = ranges(first, end - first - 1)
    before, after = CLASS[flat[at]], CLASS[flat[at + 1]]
    above = np.bincount(owner, surprise[before, after] - mean[before], len(first))
    return above / np.sqrt(np.maximum(np.bincount(owner, variance[before], len(first)), 1e-12))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches, in order."""
    low, found = text.lower(), []
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def normal_tail(z: np.ndarray) -> np.ndarray:
    """P(Z > z), to a relative error below 1e-6 (a rational fit of the scaled tail)."""
    x = np.abs(z) / math.sqrt(2)
    t = 1 / (1 + 0.5 * x)
    # Chebyshev coefficients of erfc.
    c = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223,
         0.17087277)
    poly = np.zeros_like(t)
    for a in reversed(c):
        poly = a + t * poly
    tail = 0.5 * t * np.exp(-x * x + poly)
    return np.where(z >= 0, tail, 1 - tail)


def battery(flat: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(encoding, p) of each run: p of the hypothesis that it is random, from three tests (Bonferroni)."""
    length = end - first
    starts = np.cumsum(length) - length
    at = np.arange(int(length.sum())) + np.repeat(first - starts, length)
    codes = flat[at]
    fits = np.stack([np.logical_and.reduceat(MEMBER[i][codes], starts) for i in range(len(ENCODINGS))])
    encoding = fits.argmax(0)
    owner = np.repeat(np.arange(len(first)), length)
    symbol = INDEX[encoding[owner], codes]
    m = np.array([len(a) for _, a in ENCODINGS])[encoding].astype(float)
    n = length.astype(float)
    counts = np.unique(owner * 128 + symbol, return_counts=True)
    squares = np.bincount(counts[0] // 128, counts[1].astype(float) ** 2, len(first))
    # Chi-squared, its first two moments matched by a gamma, then the cube-root normal.
    chi2 = m / n * squares - n
    scale = (n - 1) / n
    df = (m - 1) / scale
    q = np.maximum(chi2 / scale / df, 0)
    p_uniform = normal_tail((np.cbrt(q) - (1 - 2 / (9 * df))) / np.sqrt(2 / (9 * df)))
    high = symbol >= (m / 2)[owner]
    change = np.concatenate([[False], (high[1:] != high[:-1]) & (owner[1:] == owner[:-1])])
    runs = 1 + np.bincount(owner, change, len(first))
    up = np.bincount(owner, high, len(first))
    both = 2 * up * (n - up)
    spread = np.sqrt(np.maximum(both * (both - n) / (n * n * (n - 1)), 1e-12))
    p_runs = 2 * normal_tail(np.abs(runs - both / n - 1) / spread)
    centred = symbol - (np.bincount(owner, symbol, len(first)) / n)[owner]
    product = np.concatenate([centred[:-1] * centred[1:] * (owner[1:] == owner[:-1]), [0.0]])
    variance = np.bincount(owner, centred**2, len(first))
    r = np.bincount(owner, product, len(first)) / np.maximum(variance, 1e-12)
    p_serial = 2 * normal_tail(np.abs(r + 1 / n) * np.sqrt(n))
    p_serial[variance == 0], p_runs[(up == 0) | (up == n)] = 0, np.minimum(p_runs, 2.0 ** (1 - n))[(up == 0) | (up == n)]
    return encoding, np.minimum(1.0, 3 * np.minimum(np.minimum(p_uniform, p_runs), p_serial))


def scan(docs: DataFrame, model: np.ndarray, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id, base spans, battery candidates and the spread of natural runs of every row, in one pass over whole texts."""
    schema = ("id bigint, base array<struct<start: int, kind: int, end: int>>, "
              "runs array<struct<start: int, end: int, stratum: int, p_bin: int, z_bin: int>>, squares double, words bigint")
    base_type = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    runs_type = pa.list_(pa.struct([(x, pa.int32()) for x in ("start", "end", "stratum", "p_bin", "z_bin")]))

    def candidates(texts: pa.Array, base: list) -> tuple[list[list], np.ndarray, np.ndarray]:
        out, squares, words = [[] for _ in base], np.zeros(len(base)), np.zeros(len(base), np.int64)
        for lo, hi, flat, starts in byte_chunks(texts):
            first, end = token_runs(flat, starts)
            row = np.searchsorted(starts, first, side="right") - 1
            word = (end - first >= WORD_RUN) & (end - first < LEAST_RUN)
            natural = deviation(flat, first[word], end[word], model) ** 2
            squares[lo:hi] = np.bincount(row[word], natural, hi - lo)
            words[lo:hi] = np.bincount(row[word], minlength=hi - lo)
            long = end - first >= LEAST_RUN
            first, end, row = first[long], end[long], row[long]
            if not len(first):
                continue
            encoding, p = battery(flat, first, end)
            chars = np.concatenate([[0], np.cumsum((flat & 0xC0) != 0x80)])
            start, stop = chars[first] - chars[starts[row]], chars[end] - chars[starts[row]]
            stratum = encoding * 64 + np.log2(end - first).astype(int)
            p_bin = np.minimum(np.floor(-np.log10(np.maximum(p, 1e-300)) / BIN), LAST_BIN).astype(int)
            z_bin = np.clip(np.floor(deviation(flat, first, end, model) / Z_BIN), 0, LAST_Z).astype(int)
            for r, a, b, s, q, z in zip((row + lo).tolist(), start.tolist(), stop.tolist(), stratum.tolist(), p_bin.tolist(), z_bin.tolist()):
                if not any(x[0] < b and a < x[2] for x in base[r]):
                    out[r].append({"start": a, "end": b, "stratum": s, "p_bin": q, "z_bin": z})
        return out, squares, words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            base = [base_spans(t.as_py()) for t in texts]
            runs, squares, words = candidates(texts, base)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([[dict(zip(("start", "kind", "end"), x)) for x in b] for b in base], base_type),
                pa.array(runs, runs_type), pa.array(squares), pa.array(words)], names=["id", "base", "runs", "squares", "words"])

    return docs.select(F.col(id_column).cast("bigint"), text_or_empty(text_column)).mapInArrow(run, schema)


def discovery_limits(runs: DataFrame, rate: float) -> dict[int, int]:
    """For each stratum, the smallest p bin whose runs are rejected as not random (Benjamini and Hochberg's step-up).

    The counts that come to the driver have a bound: encodings x octaves of length x bins.
    """
    counts: dict[int, list[tuple[int, int]]] = {}
    for s, b, n in runs.groupBy("stratum", "p_bin").count().collect():
        counts.setdefault(s, []).append((b, n))
    limits = {}
    for s, bins in counts.items():
        total, seen, limit = sum(n for _, n in bins), 0, LAST_BIN + 1
        for b, n in sorted(bins, reverse=True):  # from the smallest p
            seen += n
            if 10 ** (-b * BIN) <= rate * seen / total:
                limit = b
        limits[s] = limit
    return limits


def natural_limits(runs: DataFrame, spread: float, rate: float) -> dict[int, int]:
    """For each stratum, the smallest z bin whose runs are rejected as natural (the same step-up and bound)."""
    counts: dict[int, list[tuple[int, int]]] = {}
    for s, z, n in runs.groupBy("stratum", "z_bin").count().collect():
        counts.setdefault(s, []).append((z, n))
    limits = {}
    for s, bins in counts.items():
        total, seen, limit = sum(n for _, n in bins), 0, LAST_Z + 1
        for z, n in sorted(bins, reverse=True):
            seen += n
            if normal_tail(np.array([z * Z_BIN / spread]))[0] <= rate * seen / total:
                limit = z
        limits[s] = limit
    return limits


def find_secrets(spark: SparkSession, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 rate: float = 0.05) -> DataFrame:
    """A row per document: id and spans, an array of (start, kind, end) by start, then kind.

    Starts and ends count code points, ends are exclusive; kinds are places in
    KINDS. Base matches always stay; the battery adds runs that overlap none of
    them. A null or empty text has no spans; null and repeated ids are kept as they
    are; an empty table gives no rows; other columns are not read.
    """
    stage = Stage(spark)
    scanned = stage.store(scan(docs, pair_model(docs, text_column), id_column, text_column), "scanned")
    runs = scanned.select(F.explode("runs").alias("r")).select("r.stratum", "r.p_bin", "r.z_bin")
    squares, words = scanned.agg(F.sum("squares"), F.sum("words")).first()
    spread = max(1.0, math.sqrt(squares / words)) if words else 1.0  # natural text spreads more than the model of pairs
    limits = discovery_limits(runs, rate)
    as_map = lambda x: F.create_map(*[F.lit(int(v)) for kv in x.items() for v in kv])
    limit, least = (as_map(limits), as_map(natural_limits(runs, spread, rate))) if limits else (None, None)

    def secret(r):
        return (r["p_bin"] < F.try_element_at(limit, r["stratum"])) & (r["z_bin"] >= F.try_element_at(least, r["stratum"]))

    added = F.filter("runs", secret) if limits else F.filter("runs", lambda r: F.lit(False))
    added = F.transform(added, lambda r: F.struct(r["start"].alias("start"), F.lit(3).alias("kind"), r["end"].alias("end")))
    return scanned.select("id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def span_list(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")
