"""Personal data by boosted trees over candidate spans.

Generators with high recall propose spans for each kind, overlapping ones too: the strict formats
(whose valid matches are the base spans and always stay), the same formats without their checks, and
loose ones (national phone numbers, spelled-out addresses, digits in odd groupings). A candidate
becomes a row of format and context features; gradient-boosted trees score it, and a threshold for
each kind, calibrated on candidates that the trees have not seen, selects what is added to the base.

The trees are trained here, on at most `TRAIN_ROWS` labelled candidates (those with the smallest hash)
of two thirds of at most `TRAIN_DOCS` distinct texts (those with the smallest hash); both bounds are
parameters. The thresholds come from the candidates of all documents
with another text, counted by kind, score and label where they are read. The label of a candidate is
weak supervision: 1 if it is a valid strict match of its kind (also without the mark that makes it
strict: a phone's plus, an address's at sign) or overlaps one; 0 if it overlaps one of another kind or
fails the check of its kind. The others, which no strict format speaks about, have no label. Model and thresholds are small and broadcast; documents are
scanned where they are read, in time linear in their length but for looking up each candidate among
the sorted spans (its logarithm).

Defined cases: null text is empty; a text without candidates has no spans; equal texts have equal
spans; without training candidates, or if no threshold reaches `PRECISION`, nothing is added to the
base; repeated rows are scanned alike; an empty table gives an empty result; other columns pass
through, but those named like a result column are replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

KINDS = ("email", "ip", "card", "phone")
TRAIN_DOCS = 4_000
TRAIN_ROWS = 100_000
TREES = 60
DEPTH = 3
RATE = 0.2
BINS = 32
PRECISION = 0.95
#: Steps of the score that a threshold can take.
STEPS = 1_000
SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Loose forms; each is bounded in length, so no text makes them slow.
_LOOSE = (
    ("email", re.compile(r"(?<![\w.%+-])[\w.%+-]{1,64} ?(?:\(at\)|\[at\]|@) ?[\w-]{1,64}(?: ?(?:\.|\(dot\)|\[dot\]) ?[\w-]{1,64}){1,4}")),
    ("ip", re.compile(r"(?<![0-9.])[0-9]{1,3}(?: ?[.,] ?[0-9]{1,3}){3}(?![0-9.])")),
    ("card", re.compile(r"(?<![0-9])[0-9]{3,6}(?:[\x20./_-]{1,2}[0-9]{2,6}){2,5}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9+])(?:00[0-9]{1,3}[\x20.-]?)?\(?[0-9]{2,5}\)?(?:[\x20./-][0-9]{2,5}){1,4}(?![0-9])")),
)
_CONTEXT = {
    "email": ("mail", "@", "contact"),
    "ip": ("ip", "host", "server"),
    "card": ("card", "visa", "carte", "karte", "tarjeta"),
    "phone": ("tel", "phone", "call", "fax", "mobil"),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = ord(d) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def strict(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, whether the checks hold) of the strict formats: leftmost, not overlapping within a kind."""
    if "@" in text:
        last = 0
        for m in _DOMAIN.finditer(text):
            at = m.start()
            before = text[last:at]
            start = last + len(before.rstrip(_LOCAL))
            if start < at:
                yield "email", start, m.end(), True
                last = m.end()
    for m in _DOTTED.finditer(text):
        parts, at = m.group().split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            start = at + sum(len(p) + 1 for p in parts[:i]) if i else at
            yield "ip", start, start + sum(map(len, four)) + 3, all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four)
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        yield "card", m.start(), m.end(), 12 <= len(digits) <= 19 and luhn(digits)
    if "+" in text:
        for m in _PHONE.finditer(text):
            yield "phone", m.start(), m.end(), 9 <= len(_digits(m.group())) <= 15


def base_spans(found: list[tuple[str, int, int, bool]]) -> list[tuple[str, int, int]]:
    return sorted(((k, s, e) for k, s, e, ok in found if ok), key=_by_place)


def _by_place(span: tuple[str, int, int]) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


class Taken:
    """Spans in which no two of one group overlap; tells the groups that a further span overlaps."""

    def __init__(self, spans: list[tuple[str, int, int]]):
        self.groups: dict[str, list[tuple[int, int]]] = {}
        for group, s, e in spans:
            self.add(group, s, e)

    def add(self, group: str, s: int, e: int) -> None:
        insort(self.groups.setdefault(group, []), (s, e))

    def over(self, s: int, e: int) -> set[str]:
        out = set()
        for group, spans in self.groups.items():
            # the spans of a group end in the order of their starts, so the last that starts before e decides
            at = bisect_left(spans, (e, -1))
            if at and spans[at - 1][1] > s:
                out.add(group)
        return out


def candidates(text: str, found: list[tuple[str, int, int, bool]]) -> list[tuple[str, int, int]]:
    """Spans that any generator proposes besides the base."""
    out = {(k, s, e) for k, s, e, ok in found if not ok and e - s >= 7}
    for kind, pattern in _LOOSE:
        out.update((kind, m.start(), m.end()) for m in pattern.finditer(text))
    return sorted(out - {(k, s, e) for k, s, e, ok in found if ok}, key=_by_place)


def describe(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context features of a candidate."""
    span, before, after = text[start:end], text[max(0, start - 24) : start], text[end : end + 12]
    digits = _digits(span)
    groups = re.findall(r"[0-9]+", span)
    sizes = [len(g) for g in groups] or [0]
    marks = [c for c in span if not c.isalnum()]
    words = before.lower()
    return [
        float(KINDS.index(kind)),
        float(len(span)),
        float(len(digits)),
        float(len(groups)),
        float(max(sizes)),
        float(min(sizes)),
        float(len(marks)),
        float(len(set(marks))),
        float(span.count(".")),
        float(span.count("-")),
        float(span.count(" ")),
        float("(" in span),
        float(span[:1] == "+"),
        float("@" in span),
        float(sum(c.isalpha() for c in span)),
        float(max((min(int(g[:6]), 999_999) for g in groups), default=0)),
        float(luhn(digits)) if digits else 0.0,
        float(before[-1:].isspace() or not before),
        float(before[-1:].isalnum()),
        float(after[:1].isspace() or not after),
        float(after[:1].isalnum()),
        float(any(w in words for w in _CONTEXT[kind])),
        float(sum(c.isdigit() for c in before)),
        float(sum(c.isdigit() for c in after)),
        float(before.rstrip()[-1:] in (":", "=")),
    ]


class Trees(NamedTuple):
    """Boosted complete trees of one depth: features, cuts and leaves by level order."""

    start: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - (2**DEPTH - 1)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def boost(x: np.ndarray, y: np.ndarray) -> Trees:
    """Newton boosting of the logistic loss over binned features."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)], 1)
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(p / (1 - p)))
    f, inner = np.full(len(y), start), 2**DEPTH - 1
    features, thresholds, leaves = [], [], []
    for _ in range(TREES):
        q = 1 / (1 + np.exp(-f))
        g, h = y - q, np.maximum(q * (1 - q), 1e-6)
        feature, cut, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(y), np.int64)
        for at in range(inner):
            mine = np.flatnonzero(node == at)
            best = 1e-6
            total_g, total_h = g[mine].sum(), h[mine].sum()
            for j, c in enumerate(cuts):
                if not len(mine) or not len(c):
                    continue
                left_g = np.cumsum(np.bincount(binned[mine, j], g[mine], len(c) + 1))[:-1]
                left_h = np.cumsum(np.bincount(binned[mine, j], h[mine], len(c) + 1))[:-1]
                gain = left_g**2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1) - total_g**2 / (total_h + 1)
                k = int(np.argmax(gain))
                if gain[k] > best:
                    best, feature[at], cut[at] = gain[k], j, c[k]
            node[mine] = 2 * at + 1 + (x[mine, feature[at]] > cut[at])
        place = node - inner
        sums, weights = np.bincount(place, g, inner + 1), np.bincount(place, h, inner + 1)
        leaf = RATE * sums / (weights + 1)
        f += leaf[place]
        features.append(feature)
        thresholds.append(cut)
        leaves.append(leaf)
    return Trees(start, np.array(features), np.array(thresholds), np.array(leaves))


class Model(NamedTuple):
    trees: Trees | None
    thresholds: tuple[float, ...]  # by kind; above 1: nothing is added


def _passes(kind: str, span: str) -> bool:
    """Whether a loose form holds the check of its kind."""
    digits = _digits(span)
    if kind == "ip":
        return all(int(g) <= 255 for g in re.findall("[0-9]{1,9}", span))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def _labelled(text: str) -> Iterator[tuple[list[float], int]]:
    """Features and label of the candidates that have one."""
    found = list(strict(text))
    base = base_spans(found)
    for kind, s, e in base:
        yield describe(text, kind, s, e), 1
        if kind in ("phone", "email"):
            mark, loose = ("+", "") if kind == "phone" else ("@", "(at)")
            span = text[s:e].replace(mark, loose)
            # a candidate's features reach 24 characters back and 12 ahead
            before = text[max(0, s - 24) : s]
            yield describe(before + span + text[e : e + 12], kind, len(before), len(before) + len(span)), 1
    taken = Taken(base)
    for kind, s, e in candidates(text, found):
        over = taken.over(s, e)
        if kind in over:
            yield describe(text, kind, s, e), 1
        elif over or not _passes(kind, text[s:e]):
            yield describe(text, kind, s, e), 0


def fit(docs: DataFrame, text_col: str = "text") -> Model:
    """Trees from the candidates of at most TRAIN_DOCS distinct texts, thresholds from those of all others."""
    texts = docs.select(F.col(text_col).cast("string").alias("text")).filter(F.length("text") > 0).withColumn("order", F.xxhash64("text"))
    last = texts.select("order").distinct().orderBy("order").limit(TRAIN_DOCS).agg(F.max("order")).first()[0]
    nothing = Model(None, (2.0,) * len(KINDS))
    if last is None:
        return nothing
    # by the text, so that copies are on one side
    seen = (F.col("order") <= last) & (F.pmod(F.xxhash64(F.lit(3), "text"), F.lit(3)) > 0)

    def run(batches):
        for batch in batches:
            rows = [row for text in batch.column("text").to_pylist() for row in _labelled(text)]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.list_(pa.float64())), pa.array([y for _, y in rows], pa.int32())], names=["x", "y"])

    found = texts.filter(seen).dropDuplicates(["order"]).select("text").mapInArrow(run, "x array<double>, y int")
    rows = found.orderBy(F.xxhash64("x", "y")).limit(TRAIN_ROWS).collect()
    rows.sort(key=lambda r: (r["y"], r["x"]))
    if len({r["y"] for r in rows}) < 2:
        return nothing
    x, y = np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows], float)
    trees = boost(x, y)
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def score(batches):
        edges = np.arange(STEPS + 1) / STEPS
        counts = np.zeros(len(KINDS) * (STEPS + 1) * 2, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                rows = [row for text in batch.slice(lo, 512).column("text").to_pylist() for row in _labelled(text)]
                if rows:
                    x, y = np.array([x for x, _ in rows]), np.array([y for _, y in rows])
                    step = np.searchsorted(edges, shared.value.probability(x), "right") - 1
                    counts += np.bincount((x[:, 0].astype(np.int64) * (STEPS + 1) + step) * 2 + y, minlength=len(counts))
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(counts[at], pa.int64())], names=["at", "c"])

    counts = np.zeros(len(KINDS) * (STEPS + 1) * 2, np.int64)
    for r in texts.filter(~seen).select("text").mapInArrow(score, "at long, c long").groupBy("at").agg(F.sum("c").alias("c")).collect():
        counts[r["at"]] = r["c"]
    return Model(trees, tuple(_threshold(c) for c in counts.reshape(len(KINDS), STEPS + 1, 2)))


def _threshold(counts: np.ndarray) -> float:
    """The lowest score, one half at least, from which on the unseen candidates (by step, label) reach PRECISION."""
    above = np.cumsum(counts[::-1], 0)[::-1]
    every = above.sum(1)
    steps = np.arange(len(counts))
    good = np.flatnonzero((every > 0) & (above[:, 1] >= PRECISION * every) & (counts.sum(1) > 0) & (2 * steps >= STEPS))
    return float(good[0] / STEPS) if len(good) else 2.0


def find(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with base_spans and spans (all: kind, start, end in code points; by start, kind)."""
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("base_spans", "spans")])
    schema = T.StructType([*kept.schema.fields, T.StructField("base_spans", T.ArrayType(SPAN)), T.StructField("spans", T.ArrayType(SPAN))])
    arrow = to_arrow_schema(schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch, base, every in _scan(batches, shared.value, text_col):
            columns = {n: batch.column(n) for n in batch.schema.names}
            for name, spans in (("base_spans", base), ("spans", every)):
                columns[name] = pa.array([[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in spans], arrow.field(name).type)
            yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in arrow], schema=arrow)

    return kept.mapInArrow(run, schema)


def _scan(batches: Iterator[pa.RecordBatch], model: Model, text_col: str) -> Iterator[tuple[pa.RecordBatch, list, list]]:
    """Batches of a few rows with the base spans and all spans of each."""
    for whole in batches:
        for lo in range(0, whole.num_rows, 512):
            batch = whole.slice(lo, 512)
            base, taken, x, where = [], [], [], []
            for r, text in enumerate(batch.column(text_col).to_pylist()):
                found = list(strict(text)) if text else []
                base.append(base_spans(found))
                taken.append(Taken(base[-1]))
                if text and model.trees:
                    for span in candidates(text, found):
                        x.append(describe(text, *span))
                        where.append((r, span))
            added: list[list] = [[] for _ in base]
            if x:
                score = model.trees.probability(np.array(x))
                for i in np.argsort(-score, kind="stable").tolist():
                    r, (kind, s, e) = where[i]
                    if score[i] >= model.thresholds[KINDS.index(kind)] and not taken[r].over(s, e):
                        added[r].append((kind, s, e))
                        taken[r].add("added", s, e)
            yield batch, base, [sorted(b + a, key=_by_place) for b, a in zip(base, added, strict=True)]


def replaced(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    if not spans:
        return text
    parts, at = [], 0
    for kind, s, e in spans:
        # a span that begins inside the one before only lengthens it
        if s >= at:
            parts += (text[at:s], "[", kind.upper(), "]")
        at = max(at, e)
    return "".join((*parts, text[at:]))


def redact(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with every span replaced by its kind in brackets; overlapping spans become one."""
    arrow = to_arrow_schema(docs.schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch, _, every in _scan(batches, shared.value, text_col):
            texts = [replaced(text, spans) for text, spans in zip(batch.column(text_col).to_pylist(), every, strict=True)]
            columns = {n: batch.column(n) for n in batch.schema.names} | {text_col: pa.array(texts, pa.string())}
            yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in arrow], schema=arrow)

    return docs.mapInArrow(run, docs.schema)
