"""Row-wise feature expressions (no shuffle, whole-stage codegen friendly).

Every function returns a ``Column`` (or a list of ``(name, Column)`` pairs) so
callers can add many features in one ``select``. Missing values are SQL NULL;
comparison flags treat NULL as false, as the pandas originals do.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def c(name_or_col) -> Column:
    if isinstance(name_or_col, Column):
        return name_or_col
    # back-ticks keep names with dots (``PM2.5``) literal
    return F.col(f"`{name_or_col}`") if "." in name_or_col and "`" not in name_or_col else F.col(name_or_col)


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 int; NULL (unknown) counts as false."""
    return F.coalesce(cond, F.lit(False)).cast("int")


# ---------------------------------------------------------------- cleaning

def to_numeric(col, to: str = "double") -> Column:
    """Lenient coercion: bad text -> NULL, textual 'nan' -> NULL (never NaN)."""
    x = F.trim(c(col).cast("string")).try_cast(to)
    if to in ("double", "float"):
        x = F.nanvl(x, F.lit(None).cast(to))
    return x


def strip(col) -> Column:
    """Trim all leading/trailing whitespace (tabs and newlines too)."""
    return F.regexp_replace(c(col), r"^\s+|\s+$", "")


def replace_value(col, old, new) -> Column:
    x = c(col)
    return F.when(x == F.lit(old), F.lit(new)).otherwise(x)


def floor_at(col, lo=0) -> Column:
    """x < lo -> lo; NULL stays NULL (``greatest`` would skip the NULL)."""
    x = c(col)
    return F.when(x < lo, F.lit(lo)).otherwise(x)


def null_if(col, cond: Column) -> Column:
    """Predicate -> missing; an unknown predicate keeps the value."""
    return F.when(F.coalesce(cond, F.lit(False)), F.lit(None)).otherwise(c(col))


def clip(col, lo, hi) -> Column:
    x = c(col)
    return F.when(x < lo, F.lit(lo)).when(x > hi, F.lit(hi)).otherwise(x)


# ---------------------------------------------------------------- dates (F1, F2)

def date_parts(col) -> list[tuple[str, Column]]:
    return [("month", F.month(c(col))), ("day", F.dayofmonth(c(col)))]


def season(month_col) -> list[tuple[str, Column]]:
    """Season flags (3-5, 6-8, 9-11, 12-2) and the ordinal 1..4."""
    m = c(month_col)
    spring, summer = m.between(3, 5), m.between(6, 8)
    fall, winter = m.between(9, 11), m.isin(12, 1, 2)
    return [
        ("spring", flag(spring)),
        ("summer", flag(summer)),
        ("fall", flag(fall)),
        ("winter", flag(winter)),
        ("season", flag(spring) + 2 * flag(summer) + 3 * flag(fall) + 4 * flag(winter)),
    ]


# ---------------------------------------------------------------- wind vectors

def polar_to_xy(speed, degrees) -> tuple[Column, Column]:
    """Compass direction (0 = north, clockwise) + speed -> (x east, y north)."""
    theta = (F.lit(90.0) - c(degrees)) * F.lit(math.pi / 180.0)
    return c(speed) * F.cos(theta), c(speed) * F.sin(theta)


def xy_features(speed, degrees, suffix: str = "") -> list[tuple[str, Column]]:
    x, y = polar_to_xy(speed, degrees)
    east, south = flag(x >= 0), flag(y <= 0)
    return [
        (f"East{suffix}", east),
        (f"South{suffix}", south),
        (f"xvec{suffix}", F.abs(x)),
        (f"yvec{suffix}", F.abs(y)),
        (f"xvec_E{suffix}", F.abs(x) * east),
        (f"yvec_S{suffix}", F.abs(y) * south),
    ]


# ---------------------------------------------------------------- numeric features

def power(col, degree: int) -> Column:
    x = c(col)
    out = x
    for _ in range(degree - 1):
        out = out * x
    return out


def powers(cols: Iterable[str], degrees=(2, 3)) -> list[tuple[str, Column]]:
    return [(f"{col}_p{d}", power(col, d)) for col in cols for d in degrees]


def lag_mean(item: str, n: int = 9) -> Column:
    """Mean of ``item_1..item_n``; any NULL lag makes the mean NULL."""
    total = c(f"{item}_1")
    for i in range(2, n + 1):
        total = total + c(f"{item}_{i}")
    return total / F.lit(float(n))


def all_zero_flag(item: str, n: int = 9) -> Column:
    total = c(f"{item}_1")
    for i in range(2, n + 1):
        total = total + c(f"{item}_{i}")
    return flag(total == 0)


def interact(a, bs: Sequence[str], prefix: str | None = None) -> list[tuple[str, Column]]:
    prefix = prefix if prefix is not None else f"{a}_x_"
    return [(f"{prefix}{b}", c(a) * c(b)) for b in bs]


# ---------------------------------------------------------------- categorical

def map_levels(col, mapping: Mapping) -> Column:
    """Dictionary lookup; an unknown key gives NULL (pandas ``map``)."""
    if not mapping:
        return F.lit(None)
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*kv), c(col))


def one_hot(col, levels: Sequence, prefix: str) -> list[tuple[str, Column]]:
    """One 0/1 column per level of a fixed list; NULL -> all zeros."""
    return [(f"{prefix}_{lvl}", flag(c(col) == F.lit(lvl))) for lvl in levels]


def cut(col, edges: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """Right-closed, left-open bins ``(e[i], e[i+1]]``; outside -> NULL."""
    labels = labels or [f"c{i}" for i in range(1, len(edges))]
    x = c(col)
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > lo) & (x <= hi)
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def bucket_ceiling(year) -> Column:
    """<= 1930 -> 1930; (1930, 1980] -> next decade ceiling; > 1980 unchanged."""
    y = c(year)
    return (
        F.when(y <= 1930, F.lit(1930))
        .when(y <= 1980, (F.ceil(y / F.lit(10.0)) * 10).cast("int"))
        .otherwise(y)
    )


# ---------------------------------------------------------------- arrays and strings

def split_array(col, sep: str) -> Column:
    """Split on a literal separator (regex characters such as '|' escaped)."""
    return F.split(c(col), re.escape(sep))


def title_year(col) -> Column:
    """Year in ``Title (1995)``: text after the last '(' minus its last char."""
    tail = F.try_element_at(F.split(c(col), r"\("), F.lit(-1))
    has_paren = F.instr(c(col), "(") > 0
    trimmed = F.substring(tail, F.lit(1), F.length(tail) - 1)
    return F.when(has_paren, trimmed.try_cast("int"))


def left_pad(arr, n: int, pad) -> Column:
    """Pad on the left to length n; longer arrays stay unchanged."""
    a = c(arr)
    return F.concat(F.array_repeat(F.lit(pad), F.greatest(F.lit(n) - F.size(a), F.lit(0))), a)


def split_first(col, sep: str = ",") -> tuple[Column, Column]:
    """Split at the first separator only: (head, rest re-joined)."""
    parts = F.split(c(col), sep, 2)
    return parts.getItem(0), F.try_element_at(parts, F.lit(2))


# ---------------------------------------------------------------- vector maths

def dot(a, b) -> Column:
    """Dot product of two numeric arrays (NULL if either is NULL)."""
    return F.aggregate(F.zip_with(c(a), c(b), lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def dot_literal(cols: Sequence[str], coef: Sequence[float], intercept: float | None = None) -> Column:
    """Unrolled w'x for literal coefficients (stays a flat codegen expression)."""
    out = F.lit(float(intercept)) if intercept is not None else None
    for name, w in zip(cols, coef):
        term = c(name) * F.lit(float(w))
        out = term if out is None else out + term
    return out if out is not None else F.lit(0.0)


def dot_array_literal(arr, coef: Sequence[float]) -> Column:
    """w'x where x is an array column and w a literal vector."""
    w = F.array(*[F.lit(float(v)) for v in coef])
    return dot(arr, w)


def sigmoid(z) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-c(z)))


def rating_sigmoid(z, lo: float = 1.0, hi: float = 5.0) -> Column:
    return F.lit(lo) + F.lit(hi - lo) * sigmoid(z)


def ordinal_probs(z, cuts: Sequence[float]) -> Column:
    """Cumulative-logit class probabilities: s_k = sigmoid(c_k - z)."""
    s = [sigmoid(F.lit(float(ck)) - c(z)) for ck in cuts]
    probs = [s[0]] + [s[i] - s[i - 1] for i in range(1, len(s))] + [F.lit(1.0) - s[-1]]
    return F.array(*probs)


def scale_array(arr, by: float) -> Column:
    return F.transform(c(arr), lambda x: x.cast("double") / F.lit(float(by)))


def stretch(arr, top: float = 255.0) -> Column:
    """Per-row min-max stretch to [0, top]; a flat row maps to 0."""
    a = c(arr)
    lo, hi = F.array_min(a).cast("double"), F.array_max(a).cast("double")
    return F.transform(
        a,
        lambda x: F.when(hi > lo, (x.cast("double") - lo) * F.lit(top) / (hi - lo)).otherwise(F.lit(0.0)),
    )


def contrast(arr) -> Column:
    return F.array_max(c(arr)) - F.array_min(c(arr))


def to_indicator(col, k: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: (i == c(col)).cast("int"))


def multi_hot(arr, k: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.array_contains(c(arr), i).cast("int"))


def argmax(arr) -> Column:
    """0-based index of the first maximum."""
    return (F.array_position(c(arr), F.array_max(c(arr))) - 1).cast("int")


def row_mean(arr) -> Column:
    a = c(arr)
    return F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v) / F.size(a)


def unstandardize(col, mean: float, std: float) -> Column:
    return c(col) * F.lit(float(std)) + F.lit(float(mean))
