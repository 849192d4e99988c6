"""Benchmark decontamination by FM-indexes of the training shards.

Every task cuts its documents into shards of at most `SHARD_WORDS` words and builds an
FM-index of each: suffix array by prefix doubling, Burrows-Wheeler transform held in a wavelet
matrix with rank counters, and the suffix positions of every `SAMPLE`-th word of a document.
All benchmark windows (10 consecutive words of an item) are searched backwards in it together;
the rows found walk to a sampled position, and overlapping or touching occurrences merge into
removal spans. No shuffle: the training rows stay where they are read.

The benchmark is the query set. It is read in blocks of about `BLOCK_WORDS` words; each block is
broadcast (its size is bounded by that parameter) and searched by one narrow pass over the
documents that adds to the findings of the pass before, so a benchmark of any size works.

Defined cases: null or empty text has no words and is clean; an item without words is never
found; an item of fewer than 10 words is one window; equal item ids count once; repeated rows are
separate documents; null item ids are left out; an empty benchmark leaves every document clean;
other columns pass through, but those named like a result column are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.llm._text import ALNUM, LOWER, flat, slices, word_hashes, words

WINDOW = 10
SHARD_WORDS = 1 << 19
SHARD_BYTES = 4 << 20
SAMPLE = 16
BLOCK_WORDS = 1 << 20
PIECE_WORDS = 10_000
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
FOUND = ["n_words", "hit_spans", "text_spans", "items"]


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Suffix order of a sequence whose last symbol is unique; only still tied suffixes are sorted again."""
    n = len(s)
    nxt = np.append(s[1:], -1).astype(np.int64) + 1
    key = s.astype(np.int64) * (int(s.max()) + 2) + nxt
    sa = np.argsort(key, kind="stable")
    rank = np.full(2 * n + 1, -1, np.int64)
    tied, key, h = np.arange(n), key[sa], 2
    while True:
        new = np.ones(len(tied) + 1, bool)
        new[1:-1] = key[1:] != key[:-1]
        heads = np.flatnonzero(new[:-1])
        rank[sa[tied]] = np.repeat(tied[heads], np.diff(np.append(heads, len(tied))))
        tied = tied[~(new[:-1] & new[1:])]
        if not len(tied):
            return sa
        at = sa[tied]
        key = rank[at] * (n + 1) + rank[np.minimum(at + h, 2 * n)] + 1
        order = np.argsort(key, kind="stable")
        sa[tied], key, h = at[order], key[order], 2 * h


class WaveletMatrix:
    """Access and rank over a sequence of small integers, each for whole arrays of positions."""

    def __init__(self, seq: np.ndarray):
        self.n, top = len(seq), int(seq.max()) if len(seq) else 0
        self.shifts = list(range(max(1, top.bit_length()) - 1, -1, -1))
        self.bits, self.ones, self.zeros = [], [], []
        seq = seq.astype(np.uint32)
        for shift in self.shifts:
            bit = (seq >> np.uint32(shift)) & np.uint32(1) == 1
            packed = np.zeros((self.n // 64 + 1) * 8, np.uint8)
            raw = np.packbits(bit, bitorder="little")
            packed[: len(raw)] = raw
            block = packed.view(np.uint64)
            count = np.zeros(len(block) + 1, np.int64)
            np.cumsum(np.bitwise_count(block), out=count[1:])
            self.bits.append(block)
            self.ones.append(count)
            self.zeros.append(self.n - int(count[-1]))
            seq = np.concatenate([seq[~bit], seq[bit]])
        self.first = np.full(top + 1, -1, np.int64)
        heads = np.flatnonzero(np.append(True, seq[1:] != seq[:-1])) if self.n else np.zeros(0, np.int64)
        self.first[seq[heads]] = heads

    def _rank1(self, level: int, i: np.ndarray) -> np.ndarray:
        block, left = i >> 6, (i & 63).astype(np.uint64)
        below = self.bits[level][block] & ((np.uint64(1) << left) - np.uint64(1))
        return self.ones[level][block] + np.bitwise_count(below)

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of symbol[k] before position i[k]."""
        at = i
        for level, shift in enumerate(self.shifts):
            one = self._rank1(level, at)
            at = np.where((symbol >> shift) & 1 == 1, self.zeros[level] + one, at - one)
        return at - self.first[symbol]

    def access_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position, and its occurrences before it."""
        at, symbol = i, np.zeros(len(i), np.int64)
        for level, shift in enumerate(self.shifts):
            bit = (self.bits[level][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            one = self._rank1(level, at)
            symbol |= bit.astype(np.int64) << shift
            at = np.where(bit, self.zeros[level] + one, at - one)
        return symbol, at - self.first[symbol]


class FMIndex:
    """Index of a shard of documents, each a run of word hashes; `bounds` are the documents' bounds."""

    def __init__(self, hashes: np.ndarray, bounds: np.ndarray):
        docs = len(bounds) - 1
        self.vocabulary, ids = np.unique(hashes, return_inverse=True)
        # every document ends in a separator of its own: symbols 0 .. docs - 1, words above
        ends = bounds[1:] + np.arange(docs)
        text = np.empty(len(hashes) + docs, np.int64)
        word = np.ones(len(text), bool)
        word[ends] = False
        text[ends] = np.arange(docs)
        text[word] = ids + docs
        sa = suffix_array(text)
        text[ends] = 0
        text[word] = ids + 1
        self.counts = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(self.vocabulary) + 1))])
        self.bwt = WaveletMatrix(text[sa - 1])
        starts = bounds[:-1] + np.arange(docs)
        doc = np.repeat(np.arange(docs), np.diff(bounds) + 1)
        sampled = ((np.arange(len(text)) - starts[doc]) % SAMPLE == 0)[sa]
        self.sampled = sampled
        self.sample_rank = np.cumsum(sampled) - 1
        self.samples = (sa - doc[sa])[sampled]  # position among the words of the shard

    def search(self, windows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of windows (rows of word hashes, last word first): (window, first word) pairs."""
        at = np.searchsorted(self.vocabulary, windows)
        at[at == len(self.vocabulary)] = 0
        used = np.arange(windows.shape[1]) < sizes[:, None]
        known = (self.vocabulary[at] == windows) | ~used
        live = np.flatnonzero(known.all(1))
        symbols = at + 1
        lo, hi = self.counts[symbols[live, 0]], self.counts[symbols[live, 0] + 1]
        for step in range(1, windows.shape[1]):
            go = sizes[live] > step
            if not go.any():
                break
            c = symbols[live[go], step]
            lo[go], hi[go] = self.counts[c] + self.bwt.rank(c, lo[go]), self.counts[c] + self.bwt.rank(c, hi[go])
            left = lo < hi
            live, lo, hi = live[left], lo[left], hi[left]
            if not len(live):
                break
        n = hi - lo
        rows = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else lo
        return np.repeat(live, n), self.locate(rows)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        out, back, todo = np.empty(len(rows), np.int64), 0, np.arange(len(rows))
        rows = rows.astype(np.int64)
        while len(todo):
            done = self.sampled[rows]
            out[todo[done]] = self.samples[self.sample_rank[rows[done]]] + back
            todo, rows = todo[~done], rows[~done]
            c, before = self.bwt.access_rank(rows)
            rows, back = self.counts[c] + before, back + 1
        return out


def _covered(n: int, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    change = np.bincount(first, minlength=n + 1) - np.bincount(first + size, minlength=n + 1)
    return np.cumsum(change[:n]) > 0


def _shard_hits(hashes: np.ndarray, at: np.ndarray, block) -> tuple[np.ndarray, np.ndarray]:
    """Which words lie in an occurrence, and the distinct (row, item number) pairs found."""
    windows, sizes, owners, owner_bounds, _ = block
    hit, pairs = np.zeros(len(hashes), bool), np.zeros((0, 2), np.int64)
    if not len(windows):
        return hit, pairs
    for a in range(0, len(hashes), SHARD_WORDS):
        z = min(len(hashes), a + SHARD_WORDS + WINDOW - 1)
        bounds = np.unique(np.clip(at, a, z)) - a
        which, first = FMIndex(hashes[a:z], bounds).search(windows, sizes)
        if not len(which):
            continue
        first += a
        hit |= _covered(len(hashes), first, sizes[which])
        n = owner_bounds[which + 1] - owner_bounds[which]
        item = owners[np.repeat(owner_bounds[which] - np.cumsum(n) + n, n) + np.arange(n.sum())]
        doc = np.repeat(np.searchsorted(at, first, "right") - 1, n)
        pairs = np.unique(np.concatenate([pairs, np.stack([doc, item], 1)]), axis=0)
    return hit, pairs


def _annotate(batches: Iterator[pa.RecordBatch], broadcast, text_col: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    block = broadcast.value
    for batch in batches:
        data, bounds = flat(batch.column(text_col))
        again = "items" in batch.schema.names
        for lo, hi in slices(bounds, SHARD_BYTES):
            out, edges = batch.slice(lo, hi - lo), bounds[lo : hi + 1] - bounds[lo]
            part = LOWER[data[bounds[lo] : bounds[hi]]]
            starts, ends, at = words(part, edges, ALNUM)
            hit, pairs = _shard_hits(word_hashes(part, starts, ends), at, block)
            items: list[list[str]] = out.column("items").to_pylist() if again else [[] for _ in range(hi - lo)]
            for doc, item in pairs.tolist():
                items[doc].append(block[4][item])
            if again:
                for doc, spans in enumerate(out.column("hit_spans").to_pylist()):
                    for s in spans:
                        hit[at[doc] + s["start"] : at[doc] + s["end"]] = True
            hit_spans: list[list[tuple]] = [[] for _ in range(hi - lo)]
            text_spans: list[list[tuple]] = [[] for _ in range(hi - lo)]
            for doc in np.unique(np.searchsorted(at, np.flatnonzero(hit), "right") - 1).tolist():
                edge = np.flatnonzero(np.diff(np.concatenate([[0], hit[at[doc] : at[doc + 1]].view(np.int8), [0]])))
                s, e = edge[::2], edge[1::2]
                hit_spans[doc] = list(zip(s.tolist(), e.tolist(), strict=True))
                base = edges[doc]
                points = np.concatenate([[0], np.cumsum((part[base : edges[doc + 1]] & 0xC0) != 0x80)])
                text_spans[doc] = list(zip(points[starts[at[doc] + s] - base].tolist(), points[ends[at[doc] + e - 1] - base].tolist(), strict=True))
            columns = {n: out.column(n) for n in out.schema.names}
            columns["n_words"] = pa.array(np.diff(at), pa.int64())
            columns["items"] = pa.array([sorted(set(x)) for x in items], schema.field("items").type)
            for name, spans in (("hit_spans", hit_spans), ("text_spans", text_spans)):
                columns[name] = pa.array([[{"start": s, "end": e} for s, e in x] for x in spans], schema.field(name).type)
            yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in schema], schema=schema)


def _pieces(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Items as word arrays of at most PIECE_WORDS words that overlap by a window less one word."""
    lowered = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = items.select(F.col(id_col).cast("string").alias("item"), F.regexp_extract_all(lowered, F.lit(WORD), 0).alias("words"))
    w = w.filter(F.col("item").isNotNull() & (F.size("words") > 0))
    last = F.greatest(F.lit(0), F.size("words") - WINDOW)
    w = w.select("item", "words", F.explode(F.sequence(F.lit(0), last, F.lit(PIECE_WORDS))).alias("at"))
    return w.select("item", "at", F.slice("words", F.col("at") + 1, PIECE_WORDS + WINDOW - 1).alias("words"))


def _block(rows) -> tuple:
    """Distinct windows of a block of pieces: hashes (last word first), sizes, owning items."""
    names, owner, windows, sizes = {}, [], [], []
    for item, _, piece in rows:
        raw = [w.encode() for w in piece]
        ends = np.cumsum([len(w) for w in raw])
        h = word_hashes(np.frombuffer(b"".join(raw), np.uint8), ends - [len(w) for w in raw], ends)
        k = min(WINDOW, len(h))
        rolled = np.lib.stride_tricks.sliding_window_view(h, k)[:, ::-1]
        full = np.zeros((len(rolled), WINDOW), np.uint64)
        full[:, :k] = rolled
        windows.append(full)
        sizes.append(np.full(len(full), k))
        owner.append(np.full(len(full), names.setdefault(item, len(names))))
    if not windows:
        return np.zeros((0, WINDOW), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64), []
    table = np.concatenate([np.concatenate(windows), np.concatenate(sizes).astype(np.uint64)[:, None]], 1)
    table, which = np.unique(table, axis=0, return_inverse=True)
    pairs = np.unique(np.stack([which.ravel(), np.concatenate(owner)], 1), axis=0)
    return table[:, :WINDOW], table[:, WINDOW].astype(np.int64), pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(table) + 1)), list(names)


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """docs with n_words, hit_spans (words), text_spans (code points) and the items found in each row."""
    spark = docs.sparkSession
    pieces = _pieces(benchmark, item_col, item_text_col)
    total = pieces.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = max(1, math.ceil(total / BLOCK_WORDS))
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in FOUND])
    schema = T.StructType([*kept.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("hit_spans", SPANS), T.StructField("text_spans", SPANS), T.StructField("items", T.ArrayType(T.StringType()))])
    arrow = to_arrow_schema(schema)
    out = kept
    for b in range(blocks):
        mine = pieces if blocks == 1 else pieces.filter(F.pmod(F.xxhash64("item", "at"), F.lit(blocks)) == b)
        block = spark.sparkContext.broadcast(_block(mine.toLocalIterator()))
        out = out.mapInArrow(lambda it, block=block: _annotate(it, block, text_col, arrow), schema)
    return out


def remove_spans(text, spans):
    """SQL: the text without the given code point spans (sorted, disjoint); a line break marks each cut."""
    bounds = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["end"]))
    ends = F.concat(F.transform(spans, lambda s: s["start"]), F.array(F.length(text).cast("long")))
    kept = F.zip_with(bounds, ends, lambda a, z: F.substring(text, (a + 1).cast("int"), (z - a).cast("int")))
    return F.when(F.size(spans) > 0, F.array_join(kept, "\n")).otherwise(text)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with every occurrence of a benchmark window cut out of its text."""
    found = find_contamination(docs, benchmark, text_col=text_col)
    return found.withColumn(text_col, remove_spans(F.col(text_col), F.col("text_spans"))).select(*[F.col(f"`{c}`") for c in docs.columns])
