"""Column builders shared by every layer.

All of them are built-in expressions, so they stay inside whole-stage codegen.
Measures are summed exactly (``exact_sum``): the result does not depend on the
order in which tasks finish, so a retried stage gives the same digits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted spellings of a boolean in the source files.
TRUE_WORDS = ("sim", "true", "1")
FALSE_WORDS = ("não", "nao", "false", "0")
# Spellings that other exports use; pass () to have them fall back like any unknown text.
MORE_TRUE = ("1.0", "s", "verdadeiro")
MORE_FALSE = ("0.0", "n", "falso")


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- rounding and sums ------------------------------------------------------
WHOLE = float(1 << 53)  # doubles from here on have no fraction


def round_half_away(c: Column | str, scale: int = 2) -> Column:
    """Round a double half away from zero, the same way on every engine.

    NaN, infinities and numbers too large to have such decimals stay as they are.
    """
    c, k = as_col(c).cast("double"), float(10**scale)
    up = F.floor(F.abs(c) * k + 0.5).cast("double") / k
    rounded = F.when((c < 0) & (up != 0), -up).otherwise(up)
    return F.when(F.isnan(c) | (F.abs(c) * k >= WHOLE), c).otherwise(rounded)


def exact_sum(c: Column | str, scale: int = 4) -> Column:
    """Sum of a measure; exact, whatever the order of the rows, if its values have ``scale`` decimals at most.

    Such values become whole numbers of 10^-scale, summed in two integer halves: no
    rounding while adding, no decimal object per row. If any value has more
    decimals, is NaN or infinite, or is too large, the sum is the ordinary one of
    doubles. More than 10^11 rows before a half overflows, which is an error.
    """
    value = as_col(c).cast("double")
    scaled = value * float(10**scale)
    nearest = F.floor(scaled + 0.5)
    whole = (F.abs(scaled) < WHOLE) & (F.abs(scaled - nearest) <= 1e-4 + F.abs(scaled) * 4e-15)
    units = F.when(whole, nearest)
    high, low = F.sum(F.shiftright(units, 20)), F.sum(units.bitwiseAND(F.lit((1 << 20) - 1).cast("bigint")))
    total = high.cast("decimal(20,0)") * F.lit(1 << 20) + low.cast("decimal(20,0)")
    return F.when(F.count(value) == F.count(units), total.cast("double") / float(10**scale)).otherwise(F.sum(value))


def exact_avg(c: Column | str, scale: int = 4) -> Column:
    c = as_col(c)
    return F.try_divide(exact_sum(c, scale), F.count(c).cast("double"))


def safe_ratio(num: Column | str, den: Column | str, scale: int | None = None) -> Column:
    """num / den, null when den is zero or null."""
    ratio = F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))
    return ratio if scale is None else round_half_away(ratio, scale)


def round_settled(c: Column | str, scale: int = 2) -> Column:
    """Round an interpolated value: first drop the digits in which binary noise
    would decide a decimal tie either way."""
    return round_half_away(round_half_away(c, 6), scale)


# --- conditional and weighted aggregates ------------------------------------
def conditional_count(cond: Column) -> Column:
    return F.count_if(cond)


def conditional_share(cond: Column, base: Column | None = None, scale: int | None = 2) -> Column:
    """Percent of the rows in ``base`` that meet ``cond``; null without base rows."""
    base = F.lit(True) if base is None else base
    return safe_ratio(100.0 * F.count_if(cond & base), F.count_if(base), scale)


def weighted_mean(x: Column | str, w: Column | str, when: Column | None = None) -> Column:
    """Sum of x*w over sum of w, for the rows that meet ``when`` and have a value."""
    x, w = as_col(x), as_col(w)
    keep = x.isNotNull() if when is None else when & x.isNotNull()
    return F.try_divide(exact_sum(F.when(keep, x * w)), exact_sum(F.when(keep, w)))


def weighted_rate(flag: Column | str, w: Column | str, when: Column | None = None) -> Column:
    """Percent of the weight whose flag is true; 0 if none passed, null if no weight."""
    flag, w = as_col(flag), as_col(w)
    keep = F.lit(True) if when is None else when
    passed = F.coalesce(exact_sum(F.when(keep & flag, w)), F.lit(0.0))
    return F.try_divide(100.0 * passed, exact_sum(F.when(keep, w)))


def conditional_stddev(x: Column | str, when: Column) -> Column:
    return F.stddev(F.when(when, as_col(x)))


# --- predicates, domains, bands ---------------------------------------------
def nullable_range(c: Column | str, lo: float, hi: float) -> Column:
    c = as_col(c)
    return c.isNull() | c.between(lo, hi)


def _lookup(key: Column, mapping: Mapping) -> Column:
    pairs = [F.lit(v) for item in mapping.items() for v in item]
    kind = "int" if all(isinstance(k, int) for k in mapping) else "string"
    return F.try_element_at(F.create_map(*pairs), key.cast(kind))


def decode_domain(c: Column | str, mapping: Mapping, default: str | None = None) -> Column:
    """Code to label; an unknown code gives ``default``."""
    label = _lookup(as_col(c), mapping)
    return label if default is None else F.coalesce(label, F.lit(default))


def encode_text_domain(c: Column | str, mapping: Mapping[str, int]) -> Column:
    """Free text to code, ignoring case and outer blanks; unknown text gives null."""
    return _lookup(F.lower(F.trim(as_col(c))), mapping)


def normalize_bool(c: Column | str, fallback: Column, more_true: Sequence[str] = MORE_TRUE,
                   more_false: Sequence[str] = MORE_FALSE) -> Column:
    """Yes/no text to boolean, else the fallback."""
    text = F.lower(F.trim(as_col(c).cast("string")))
    words = {**{w: True for w in (*TRUE_WORDS, *more_true)}, **{w: False for w in (*FALSE_WORDS, *more_false)}}
    return F.coalesce(_lookup(text, words), fallback)


def cutoff_flag(score: Column | str, cut: float) -> Column:
    return as_col(score) >= F.lit(cut)


def band_left_closed(c: Column | str, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """labels[i] below cuts[i], the last label otherwise; null stays null."""
    if len(labels) != len(cuts) + 1:
        raise ValueError("need one label more than cuts")
    c = as_col(c)
    band = F.when(c.isNull(), F.lit(None).cast("string"))
    for cut, label in zip(cuts, labels):
        band = band.when(c < cut, F.lit(label))
    return band.otherwise(F.lit(labels[-1]))


def band_right_closed(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """labels[i] in (edges[i], edges[i+1]]; the first bin also holds its lower edge."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need one edge more than labels")
    c = as_col(c)
    band = F.when(c.isNull() | (c < edges[0]), F.lit(None).cast("string"))
    for edge, label in zip(edges[1:], labels):
        band = band.when(c <= edge, F.lit(label))
    return band


def tri_state_status(target: Column | str, reached: Column | str, labels: Sequence[str]) -> Column:
    """(no target, reached, below)."""
    none, yes, no = labels
    return (F.when(as_col(target).isNull(), F.lit(none))
            .when(as_col(reached), F.lit(yes)).otherwise(F.lit(no)))


def derive_parent_key(c: Column | str, divisor: int) -> Column:
    """Leading digits of a hierarchical code, by integer division."""
    c = as_col(c).cast("bigint")
    whole = c - F.pmod(c, F.lit(divisor).cast("bigint"))
    return F.call_function("div", whole, F.lit(divisor).cast("bigint"))


# --- hashes, time, text ------------------------------------------------------
def record_hash(columns: Sequence[str], bits: int = 256) -> Column:
    """Fingerprint of the business columns; technical ``_`` columns do not count.

    Every value is written with its length and a null as its own token, so neither
    moving a null nor a separator inside a text can give the hash of other values.
    """
    names = sorted(c for c in columns if not c.startswith("_"))
    if bits == 64:
        return F.xxhash64(*[x for n in names for x in (F.col(n), F.col(n).isNull())])
    text = lambda n: F.col(n).cast("string")
    parts = [F.coalesce(F.concat(F.length(text(n)).cast("string"), F.lit(":"), text(n)), F.lit("-")) for n in names]
    return F.sha2(F.concat_ws("|", *parts), bits)


def fn_latency(event_ts: Column | str, proc_ts: Column | str) -> Column:
    """Processing time minus event time in milliseconds."""
    return F.unix_millis(as_col(proc_ts)) - F.unix_millis(as_col(event_ts))


def parse_timestamp(c: Column | str) -> Column:
    """ISO-8601 text, with or without Z; anything else gives null."""
    return F.try_to_timestamp(as_col(c))


def trailing_digits(c: Column | str, digits: int) -> Column:
    return F.regexp_extract(as_col(c), rf"(\d{{{digits}}})$", 1)


def last_segment(c: Column | str, sep: str) -> Column:
    return F.element_at(F.split(as_col(c), sep), -1)


def head_before(c: Column | str, sep: str = ":") -> Column:
    return F.substring_index(as_col(c), sep, 1)


def key_bucket(c: Column | str, n: int) -> Column:
    """Partition number a keyed message would get."""
    return F.pmod(F.crc32(as_col(c).cast("string").cast("binary")), F.lit(n)).cast("int")


def fn_bytes_label(c: Column | str) -> Column:
    """Bytes as text: B, KB, MB or GB with one decimal."""
    c = as_col(c).cast("double")
    text = lambda power, unit: F.concat(F.format_string("%.1f", F.bround(c / 1024**power, 1)), F.lit(f" {unit}"))
    return (F.when(c < 1024, text(0, "B")).when(c < 1024**2, text(1, "KB"))
            .when(c < 1024**3, text(2, "MB")).when(c.isNotNull(), text(3, "GB")))
