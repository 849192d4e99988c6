"""Removal of repeated byte strings by suffix arrays.

Every byte that lies in a string of `length` bytes which also starts anywhere else goes; strings are
judged on the input. Suffix arrays are built per shard by induced sorting (`suffix_array`), and
permuted common prefixes (`permuted_lcp`) tell which suffixes share their first `length` bytes with
a neighbour of the array.

Shards hold what has to be compared, wherever it comes from. Every window of `length` bytes is
routed by the least hash among its GRAM-byte grams, so equal windows go to one place. Consecutive
windows with one such hash, its anchor, form a piece of text (at most RUN windows; together they
overlap by length - 1 bytes). Anchors are counted first; a bitmap of fixed size then tells tasks
which anchors occur twice, so text that repeats nothing isn't shuffled. Pieces are dealt by a hash of
their anchor, sorted by it, and read as a stream: blocks of about BLOCK bytes, cut between anchors, each get
their array. Equal pieces enter a block's text once, with their number.

An anchor of more than HOT pieces (a second bitmap) is split further: pieces are counted by digest,
and where one occurs once, the distinct ones are cut into single windows, which are counted by 128-bit
digests, summed per task before the shuffle; so no group of a shard has more than HOT pieces and no
key gathers in one task. Both bitmaps may name
anchors too many; that costs time and changes no result. From some 10^8 repeated anchors on (30 GB
of repeated text) more is shuffled than needed; BITS is the parameter for that.

Texts are known by 128-bit digests, so copies of one text get their spans once. Spans come back to
the texts in one join; nothing but the bitmaps (32 MB each) passes the driver.

Defined cases: null text is empty and stays whole; rows that repeat a text repeat each other and go
entirely if they have `length` bytes, whatever their ids; an empty table gives an empty result;
columns other than id and text are not carried. Texts are valid UTF-8 (so they hold no byte 0xFF);
what is left of them is bytes, as a cut can fall inside a character. A very long text is one row and
has to fit into a task a few times over.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._spark import hot_lookup, small_batches, stored
from tessera.llm._text import flat, mix, slices

LENGTH = 200
GRAM = 16
#: Windows of a piece at most.
RUN = 4096
#: Bytes of text that one suffix array is built over, (SLICE: that is hashed at once).
BLOCK = 3 << 20
SLICE = 1 << 18
#: Windows that are hashed at once, as their places have to fit into the low bits of a hash.
CHUNK = 1 << 20
PLACE = (1 << 22) - 1
#: Texts (or strings of names) up to this length are sorted by doubling.
SHORT = 1 << 17
#: Bits of each bitmap.
BITS = 1 << 28
#: Anchors of more pieces than this are split by their windows.
HOT = 2048
#: Digests of pieces that a task remembers, so as to send their text once.
SEEN = 200_000

# suffix arrays -------------------------------------------------------------------------------


def _types(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the end of the text is smaller than all."""
    n = len(t)
    differs = np.full(n, n - 1)
    at = np.flatnonzero(t[1:] != t[:-1])
    differs[at] = at
    differs = np.minimum.accumulate(differs[::-1])[::-1]
    out = np.zeros(n, bool)
    out[:-1] = t[differs[:-1]] < t[np.minimum(differs[:-1] + 1, n - 1)]
    return out


def _runs_left(t: np.ndarray) -> np.ndarray:
    """How many equal symbols stand directly before each position."""
    at = np.arange(len(t))
    first = np.where(np.concatenate([[True], t[1:] != t[:-1]]), at, 0)
    return (at - np.maximum.accumulate(first)).astype(np.int32)


def _place(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A stable order by symbol; the symbols that occur, how often, and each sorted entry's rank in its group."""
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    counts = np.diff(np.append(first, len(ranked)))
    return order, ranked[first].astype(np.int64), counts, np.arange(len(ranked)) - np.repeat(first, counts)


class _Text:
    """A text with what every induction over it needs. Symbols are below sigma, and all occur."""

    def __init__(self, t: np.ndarray, sigma: int):
        self.t, self.sigma, self.n = t, sigma, len(t)
        self.small = _types(t)
        left = _runs_left(t)
        self.left = left if left.any() else None
        sizes = np.bincount(t, minlength=sigma)
        self.end = np.cumsum(sizes)
        self.start = self.end - sizes
        is_lms = self.small.copy()
        is_lms[0] = False
        is_lms[1:] &= ~self.small[:-1]
        self.is_lms, self.lms = is_lms, np.flatnonzero(is_lms)
        # what each suffix induces: the symbol before it plus 2 if in another bucket, 1 if in its own, else 0
        kind = np.uint8 if sigma < 254 else np.uint16 if sigma < 65534 else np.int32
        before, after = t[:-1], t[1:]
        code = before.astype(kind) + kind(2)
        self.larger, self.smaller = np.zeros(self.n, kind), np.zeros(self.n, kind)
        falls, rises = before > after, before < after
        self.larger[1:] = np.where(falls, code, before == after)
        self.smaller[1:] = np.where(rises, code, (before == after) & self.small[1:])
        # symbols are handled in batches of which no member induces another
        if sigma < 256:
            pair = np.bincount(before.astype(np.int32) * sigma + after, minlength=sigma * sigma).reshape(sigma, sigma) > 0
            b, a = np.nonzero(pair)
        else:
            b, a = before, after
        a, b = a.astype(np.int64), b.astype(np.int64)
        least = np.full(sigma + 1, sigma)
        np.minimum.at(least, a[b > a], b[b > a])
        self.upto = np.minimum.accumulate(least[::-1])[::-1].tolist()
        most = np.full(sigma, -1)
        np.maximum.at(most, a[b < a], b[b < a])
        self.downto = (np.maximum.accumulate(most) + 1).tolist()

    def induce(self, seeds: np.ndarray) -> np.ndarray:
        """The order of all suffixes, from that of the leftmost smaller ones (in seeds)."""
        t = self.t
        sa = np.full(self.n, -1, np.int32)
        start, end = self.start.tolist(), self.end.tolist()
        # seeds at the ends of their symbols' buckets, in their order
        if len(seeds):
            order, symbols, counts, rank = _place(t[seeds])
            seed_at = np.repeat(self.end[symbols] - counts, counts) + rank
            sa[seed_at] = seeds[order]
        head = self.start.copy()
        sa[head[t[-1]]] = self.n - 1
        head[t[-1]] += 1
        lo = 0
        while lo < self.sigma:
            hi = self.upto[lo]
            self._step(sa, sa[start[lo] : end[hi - 1]], self.larger, head, 1)
            lo = hi
        # now the smaller ones from the right; the seeds made room
        if len(seeds):
            sa[seed_at] = -1
        tail = self.end.copy()
        hi = self.sigma
        while hi > 0:
            lo = self.downto[hi - 1]
            self._step(sa, sa[start[lo] : end[hi - 1]][::-1], self.smaller, tail, -1)
            hi = lo
        return sa

    def _step(self, sa: np.ndarray, region: np.ndarray, induces: np.ndarray, edge: np.ndarray, step: int) -> None:
        """Places what the suffixes of a region of the array induce, in their order; edge has each bucket's next place."""
        js = region[region >= 0]
        if not len(js):
            return
        codes = induces[js]
        if self.left is not None and (inner := codes == 1).any():
            first = js[inner]
            self._runs(sa, first, self.left[first], edge, step)
            js = region[region >= 0]
            codes = induces[js]
        live = np.flatnonzero(codes > 1)
        if not len(live):
            return
        js, codes = js[live], codes[live]
        order = np.argsort(codes, kind="stable")
        ranked = codes[order]
        js = js[order] - 1
        first = np.flatnonzero(ranked[1:] != ranked[:-1]) + 1
        if 128 * len(first) < len(js):
            # large parts of buckets are written as slices
            lo = 0
            for hi in [*first.tolist(), len(js)]:
                symbol = int(ranked[lo]) - 2
                at = int(edge[symbol])
                if step > 0:
                    sa[at : at + hi - lo] = js[lo:hi]
                else:
                    sa[at - hi + lo : at] = js[lo:hi][::-1]
                edge[symbol] = at + step * (hi - lo)
                lo = hi
            return
        first = np.concatenate([[0], first])
        counts = np.diff(np.concatenate([first, [len(js)]]))
        symbols = ranked[first].astype(np.int64) - 2
        if step > 0:
            sa[np.repeat(edge[symbols] - first, counts) + np.arange(len(js))] = js
        else:
            sa[np.repeat(edge[symbols] - 1 + first, counts) - np.arange(len(js))] = js
        edge[symbols] += step * counts

    def _runs(self, sa: np.ndarray, js: np.ndarray, runs: np.ndarray, edge: np.ndarray, step: int) -> None:
        """Places the suffixes that js induce inside their own buckets, by distance in the run, then by order."""
        total = int(runs.sum())
        which = np.repeat(np.arange(len(js)), runs)
        distance = np.arange(total) - np.repeat(np.cumsum(runs) - runs, runs) + 1
        new = js[which] - distance
        symbol = self.t[new]
        order = np.lexsort((which, distance, symbol))
        ranked = symbol[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        counts = np.diff(np.append(first, total))
        symbols = ranked[first].astype(np.int64)
        rank = np.arange(total) - np.repeat(first, counts)
        at = np.repeat(edge[symbols], counts) + rank if step > 0 else np.repeat(edge[symbols], counts) - 1 - rank
        sa[at] = new[order]
        edge[symbols] += step * counts


def _dense(t: np.ndarray, sigma: int) -> tuple[np.ndarray, int]:
    """The text over the symbols that occur, in their order."""
    occurs = np.bincount(t, minlength=sigma) > 0
    count = int(occurs.sum())
    if count == sigma:
        return t, sigma
    kind = np.uint8 if count < 256 else np.int32
    return (np.cumsum(occurs) - 1).astype(kind)[t], count


def _by_doubling(t: np.ndarray) -> np.ndarray:
    """The suffix array of a short text: ranks by 1, 2, 4 ... symbols."""
    n = len(t)
    rank, size = t.astype(np.int64) + 1, 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(n - size, 0)] = rank[size:]
        order = np.lexsort((after, rank))
        new = np.ones(n, np.int64)
        new[1:] = (rank[order[1:]] != rank[order[:-1]]) | (after[order[1:]] != after[order[:-1]])
        if new.all():
            return order.astype(np.int32)
        rank[order] = np.cumsum(new)
        size *= 2


def suffix_array(t: np.ndarray, sigma: int) -> np.ndarray:
    """The suffix array of t, symbols below sigma; a suffix that is another's prefix comes first.

    Induced sorting in linear passes: suffixes are classified, the leftmost smaller ones' substrings
    are sorted by one induction and named, the names sorted by this function itself where some are
    equal, and the whole order is induced from theirs. All entries of a batch of symbols are induced at once.
    """
    if len(t) <= max(SHORT, 1):
        return _by_doubling(t)
    text = _Text(*_dense(t, sigma))
    lms = text.lms
    if len(lms) < 2:
        return text.induce(lms)
    order = text.induce(lms)
    order = order[text.is_lms[order]]
    names, count = _named(text, order)
    if count < len(lms):
        order = lms[suffix_array(names, count)]
    return text.induce(order)


def _named(text: _Text, order: np.ndarray) -> tuple[np.ndarray, int]:
    """For the sorted leftmost smaller substrings their ranks in text order, and how many differ."""
    t, lms = text.t, text.lms
    size = np.zeros(text.n, np.int64)
    size[lms[:-1]] = np.diff(lms) + 1
    # the last one runs into the end, which is a symbol of its own
    size[lms[-1]] = -1
    a, b = order[:-1].astype(np.int64), order[1:].astype(np.int64)
    same = (size[a] == size[b]) & (size[a] > 0)
    # eight bytes at once
    width = t.itemsize
    step = 8 // width
    padded = np.concatenate([t, np.zeros(step, t.dtype)])
    eight = np.ndarray((text.n,), "<u8", padded, strides=(width,))
    masks = np.array([(1 << 8 * width * k) - 1 for k in range(step + 1)], np.uint64)
    live = np.flatnonzero(same)
    a, b, left = a[live], b[live], size[a[live]]
    while len(live):
        equal = (eight[a] ^ eight[b]) & masks[np.minimum(left, step)] == 0
        same[live[~equal]] = False
        equal &= left > step
        live, a, b, left = live[equal], a[equal] + step, b[equal] + step, left[equal] - step
    rank = np.concatenate([[0], np.cumsum(~same)])
    names = np.empty(text.n, np.int32)
    names[order] = rank
    return names[lms], int(rank[-1]) + 1


def permuted_lcp(t: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position the length that its suffix shares with the one before it in the array, and that one (-1: none).

    Only where the symbols before both differ is anything compared; elsewhere the length is that of
    the position before, less one. t has 8-bit symbols, and its last one occurs nowhere else in a suffix's way.
    """
    n = len(t)
    before = np.full(n, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    at = np.arange(n)
    own = np.ones(n, bool)
    inner = np.flatnonzero((before > 0) & (at > 0))
    own[inner] = t[inner - 1] != t[before[inner] - 1]
    padded = np.concatenate([t, np.full(16, 0xFE, np.uint8)])
    eight = np.ndarray((n + 8,), "<u8", padded, strides=(1,))
    lcp = np.zeros(n, np.int32)
    live = np.flatnonzero(own & (before >= 0))
    shared = np.zeros(len(live), np.int64)
    a, b = live.copy(), before[live].astype(np.int64)
    while len(live):
        x = eight[a] ^ eight[b]
        equal = x == 0
        equal &= np.maximum(a, b) + 8 <= n
        stop = ~equal
        if stop.any():
            y = x[stop]
            low = y & (~y + np.uint64(1))
            # index of the lowest byte that differs; eight if none does
            byte = np.where(y == 0, 8, np.floor(np.log2(np.maximum(low, 1).astype(np.float64))).astype(np.int64) // 8)
            room = n - np.maximum(a[stop], b[stop])
            lcp[live[stop]] = shared[stop] + np.minimum(byte, room)
        live, a, b, shared = live[equal], a[equal] + 8, b[equal] + 8, shared[equal] + 8
    last = np.maximum.accumulate(np.where(own, at, 0))
    return np.maximum(lcp[last] - (at - last), 0).astype(np.int32), before


def repeated_starts(pieces: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether the `length` bytes from each position occur again in the pieces, and where each piece is among the positions."""
    t = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8)
    sizes = np.array([len(p) for p in pieces], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    sa = suffix_array(t, 256)
    lcp, before = permuted_lcp(t, sa)
    left = np.repeat(starts + sizes, sizes + 1) - np.arange(len(t))
    hit = np.flatnonzero((lcp >= length) & (left >= length))
    out = np.zeros(len(t), bool)
    out[hit] = True
    out[before[hit]] = True
    return out, starts


def _spans_of(anchors: np.ndarray, pieces: list[bytes], counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, end, piece of the repeated spans of distinct pieces, which are in the order of their anchors.

    A piece that occurs more than once repeats itself, so anchors without any other piece need no array.
    """
    group = np.cumsum(np.concatenate([[False], anchors[1:] != anchors[:-1]]))
    compared = np.flatnonzero((np.bincount(group, counts == 1) > 0)[group])
    copied = np.flatnonzero(counts > 1)
    spans = [(np.zeros(len(copied), np.int64), np.array([len(pieces[i]) for i in copied], np.int64), copied)]
    if len(compared):
        mask, starts = repeated_starts([pieces[i] for i in compared], length)
        lo, hi = _runs_of(mask)
        owner = np.searchsorted(starts, lo, "right") - 1
        lone = counts[compared[owner]] == 1
        lo, hi, owner = lo[lone], hi[lone], owner[lone]
        spans.append((lo - starts[owner], hi - starts[owner] + length - 1, compared[owner]))
    lo, hi, owner = (np.concatenate(x) for x in zip(*spans, strict=True))
    order = np.argsort(owner, kind="stable")
    return lo[order], hi[order], owner[order]


# windows, anchors, pieces --------------------------------------------------------------------


def _anchor_runs(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: its hash, row, first window's byte in data, number of windows, whether it stands at several places."""
    sizes = np.diff(bounds)
    usable = np.flatnonzero(sizes >= length)
    found = []
    if len(usable):
        n = len(data) - length + 1
        edge = np.zeros(n + 1, np.int8)
        edge[bounds[usable]] = 1
        np.add.at(edge, bounds[usable + 1] - length + 1, -1)
        inside = np.cumsum(edge[:n], dtype=np.int8) > 0
        begins = np.zeros(n, bool)
        begins[bounds[usable]] = True
        for lo in range(0, n, CHUNK):
            hi = min(n, lo + CHUNK)
            found.append(_chunk_runs(data[lo : hi + length - 1], inside[lo:hi], begins[lo:hi], lo, length))
    if not found:
        empty = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), empty, empty, empty, np.zeros(0, bool)
    h, starts, count, moves = (np.concatenate(x) for x in zip(*found, strict=True))
    row = np.searchsorted(bounds, starts, "right") - 1
    if len(count) and count.max() > RUN:
        parts = -(-count // RUN)
        which = np.repeat(np.arange(len(starts)), parts)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
        h, row, moves = h[which], row[which], moves[which]
        starts, count = starts[which] + nth * RUN, np.minimum(RUN, count[which] - nth * RUN)
    return h, row, starts, count, moves


def _chunk_runs(data: np.ndarray, inside: np.ndarray, begins: np.ndarray, base: int, length: int):
    n, windows = len(data), len(inside)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((n,), "<u8", padded, strides=(1,)).copy()
    grams, width = n - GRAM + 1, length - GRAM + 1
    keys = eight[:grams] * np.uint64(0x9E3779B97F4A7C15)
    keys ^= keys >> np.uint64(29)
    keys += eight[8 : 8 + grams]
    keys *= np.uint64(0xBF58476D1CE4E5B9)
    keys ^= keys >> np.uint64(32)
    keys *= np.uint64(0x94D049BB133111EB)
    # a gram's hash in the high bits, its place in the low ones: the first of equal grams is the least
    keys &= np.uint64(~PLACE & 0xFFFFFFFFFFFFFFFF)
    keys |= np.arange(grams, dtype=np.uint64)
    # the least of each window's, from running minima of blocks both ways
    rows = -(-grams // width)
    blocks = np.full(rows * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    blocks[:grams] = keys
    blocks = blocks.reshape(rows, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[:windows], ahead[width - 1 : width - 1 + windows])
    first = begins | inside
    first[1:] &= ((least[1:] ^ least[:-1]) > np.uint64(PLACE)) | begins[1:] | ~inside[:-1]
    first &= inside
    starts = np.flatnonzero(first)
    # a run ends where the next one starts or the row has no more windows
    outside = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    ends = np.append(starts[1:], windows)
    if len(outside):
        stop = np.searchsorted(outside, starts, "right")
        ends = np.minimum(ends, np.append(outside, windows)[stop])
    # equal windows of one run have their first anchors at different places
    moves = least[starts] != least[ends - 1]
    return mix(least[starts] & np.uint64(~PLACE & 0xFFFFFFFFFFFFFFFF)), starts + base, ends - starts, moves


def _rows(batches):
    """Bytes and row bounds of the first column's texts, a few MB at once."""
    for batch in batches:
        data, bounds = flat(batch.column(0))
        for lo, hi in slices(bounds, SLICE):
            yield data[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]


def _anchors(docs: DataFrame, length: int) -> DataFrame:
    """h, n: how many pieces have each anchor; only of those that two windows can share."""

    def anchors(batches):
        for data, bounds in _rows(batches):
            h, _, _, _, moves = _anchor_runs(data, bounds, length)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(1 + moves.astype(np.int64))], names=["h", "n"])

    found = docs.select("text").mapInArrow(anchors, "h long, n long")
    return found.groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1")


def _bitmaps(anchors: DataFrame) -> tuple[bytes, bytes]:
    """Bitmaps of the anchors and of the hot ones, by the low bits of their hashes."""
    part = 1 << 18
    rows = anchors.select(F.expr(f"(h & {BITS - 1}L) div {part}").alias("part"), F.expr(f"cast(h & {part - 1}L as int)").alias("bit"), (F.col("n") > HOT).alias("hot"))
    parts = rows.groupBy("part").agg(F.collect_set("bit").alias("bits"), F.collect_set(F.when(F.col("hot"), F.col("bit"))).alias("hot"))

    def pack(batches):
        for batch in batches:
            out = []
            for column in ("bits", "hot"):
                packed = []
                for bits in batch.column(column):
                    mask = np.zeros(part, bool)
                    mask[bits.values.to_numpy()] = True
                    packed.append(np.packbits(mask, bitorder="little").tobytes() if len(bits.values) else None)
                out.append(pa.array(packed, pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column("part"), *out], names=["part", "bits", "hot"])

    maps = [bytearray(BITS // 8), bytearray(BITS // 8)]
    for row in parts.mapInArrow(pack, "part long, bits binary, hot binary").toLocalIterator():
        for m, bits in zip(maps, (row["bits"], row["hot"]), strict=True):
            if bits is not None:
                m[row["part"] * part // 8 : (row["part"] + 1) * part // 8] = bits
    return bytes(maps[0]), bytes(maps[1])


def _has(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    bit = h & np.uint64(BITS - 1)
    return (bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0


#: An occurrence of a piece: its anchor, digest of the bytes, digests of its text, first byte there; the bytes at least once a task.
_PIECE = "h long, c long, k1 long, k2 long, at long, size long, piece binary"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _pieces(docs: DataFrame, maps, length: int, hot: bool) -> DataFrame:
    """Occurrences of the pieces under repeated anchors: those under hot ones or the others."""
    second = docs.sparkSession.range(1).select(F.xxhash64(F.lit(1))).first()[0] % (1 << 64)

    def pieces(batches):
        bitmap, hot_map = (np.frombuffer(m, np.uint8) for m in maps.value)
        seen: set[tuple[int, int]] = set()
        for data, bounds in _rows(batches):
            h, row, start, count, _ = _anchor_runs(data, bounds, length)
            keep = _has(hot_map, h) if hot else _has(bitmap, h) & ~_has(hot_map, h)
            h, row, start, size = h[keep], row[keep], start[keep], count[keep] + length - 1
            raw, sent, digests = data.tobytes(), [], []
            for anchor, a, n in zip(h.tolist(), start.tolist(), size.tolist(), strict=True):
                piece = raw[a : a + n]
                digest = xxhash.xxh3_64_intdigest(piece, anchor)
                digests.append(digest)
                if (anchor, digest) in seen:
                    sent.append(None)
                else:
                    seen.add((anchor, digest))
                    sent.append(piece)
            if len(seen) > SEEN:
                seen.clear()
            rows, place = np.unique(row, return_inverse=True)
            texts = [raw[bounds[r] : bounds[r + 1]] for r in rows]
            k = [np.array([xxhash.xxh64_intdigest(t, seed) for t in texts], np.uint64)[place] for seed in (42, second)]
            columns = [x.view(np.int64) for x in (h, np.array(digests, np.uint64), *k, start - bounds[row], size)]
            yield pa.RecordBatch.from_arrays([*[pa.array(x) for x in columns], pa.array(sent, pa.binary())], names=[x.split()[0] for x in _PIECE.split(", ")])

    return docs.select("text").mapInArrow(pieces, _PIECE)


# shards --------------------------------------------------------------------------------------


def _runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


_SPAN = "k1 long, k2 long, start long, end long"


def _shard_spans(pieces: DataFrame, length: int) -> DataFrame:
    """k1, k2, start, end of repeated strings, from a suffix array for each block of the sorted pieces."""

    def solve(blocks: list[pa.Table]) -> pa.RecordBatch:
        table = pa.concat_tables(blocks)
        c = np.column_stack([table.column(x).to_numpy() for x in ("h", "c")])
        new = np.concatenate([[True], (c[1:] != c[:-1]).any(axis=1)])
        which = np.cumsum(new) - 1
        column = table.column("piece")
        have = np.flatnonzero(column.is_valid().to_numpy())
        # of each group of equal pieces one row has the bytes, wherever it came from
        _, at = np.unique(which[have], return_index=True)
        texts = column.take(pa.array(have[at])).to_pylist()
        counts = np.bincount(which)
        lo, hi, owner = _spans_of(c[new, 0], texts, counts, length)
        # spans of each distinct piece, then of each place it stands in
        k = np.column_stack([table.column(x).to_numpy() for x in ("k1", "k2", "at")])
        per = np.bincount(owner, minlength=len(texts))
        first = np.cumsum(per) - per
        order = np.lexsort((k[:, 2], k[:, 1], k[:, 0], which))
        lone = np.concatenate([[True], (k[order][1:] != k[order][:-1]).any(axis=1) | (which[order][1:] != which[order][:-1])])
        rows = order[lone]
        times = per[which[rows]]
        row = np.repeat(rows, times)
        span = np.repeat(first[which[rows]], times) + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
        at = k[row, 2]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (k[row, 0], k[row, 1], at + lo[span], at + hi[span])], names=["k1", "k2", "start", "end"])

    def shards(batches):
        waiting, size, last = [], 0, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            h = batch.column("h").to_numpy()
            while len(h):
                # the rows of the anchor that is open go with it
                same = int(np.searchsorted(h != last, True)) if last is not None and h[0] == last else 0
                if same == 0 and size >= BLOCK:
                    yield solve(waiting)
                    waiting, size = [], 0
                held = table.column("piece").combine_chunks()
                sizes = np.diff(np.frombuffer(held.buffers()[1], np.int32, len(held) + 1, held.offset * 4))
                room = int(np.searchsorted(np.cumsum(sizes), max(BLOCK - size, 1)))
                cut = min(len(h), max(same, room, 1))
                # on to the end of the anchor there
                cut += int(np.searchsorted(h[cut:] != h[cut - 1], True))
                waiting.append(table.slice(0, cut))
                size += int(sizes[:cut].sum())
                last = h[cut - 1]
                h, table = h[cut:], table.slice(cut)
        if waiting:
            yield solve(waiting)

    n = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pieces.drop("size").repartition(n, "h").sortWithinPartitions("h", "c")
    return dealt.mapInArrow(shards, _SPAN)


def _hot_spans(hot: DataFrame, length: int) -> DataFrame:
    """k1, k2, start, end of repeated strings under hot anchors, from stored occurrences of their pieces.

    A piece that occurs twice repeats itself; the windows of the others are counted one by one, with
    those of all pieces under the same anchors.
    """
    contents = stored(hot.groupBy("h", "c").agg(F.count("*").alias("n"), F.max("size").alias("size")), "contents")
    opened = contents.groupBy("h").agg(F.min("n").alias("least"), F.count("*").alias("n")).filter("least = 1")

    def windows(batches):
        for batch in batches:
            for h, c, piece in zip(batch.column("h").to_pylist(), batch.column("c").to_pylist(), batch.column("piece").to_pylist(), strict=True):
                digests = [xxhash.xxh3_128_digest(piece[i : i + length]) for i in range(len(piece) - length + 1)]
                d = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                columns = [np.full(len(d), h), np.full(len(d), c), np.arange(len(d)), d[:, 0], d[:, 1]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["h", "c", "i", "d1", "d2"])

    # tasks may have sent a piece's bytes more than once
    sent = hot.filter("piece is not null").select("h", "c", "piece").dropDuplicates(["h", "c"])
    sent = hot_lookup(sent, opened, "h", ["least"], "n", contents.count(), inner=True)
    cut = stored(sent.select("h", "c", "piece").mapInArrow(windows, "h long, c long, i long, d1 long, d2 long"), "windows")
    often = cut.groupBy("d1", "d2").agg(F.count("*").alias("n")).filter("n > 1")
    often = often.groupBy("d1").agg(F.collect_set("d2").alias("d2s"), F.sum("n").alias("n"))
    again = hot_lookup(cut, often, "d1", ["d2s"], "n", cut.count(), inner=True).filter(F.array_contains("d2s", F.col("d2")))
    again = again.groupBy("h", "c").agg(F.sort_array(F.collect_set("i")).alias("windows"))

    def spans(batches):
        for batch in batches:
            out = []
            for found in batch.column("windows").to_pylist():
                at = np.array(found)
                first = np.concatenate([[True], np.diff(at) > 1])
                lo = at[first]
                hi = at[np.concatenate([first[1:], [True]])] + length
                out.append([{"start": a, "end": z} for a, z in zip(lo.tolist(), hi.tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("c"), pa.array(out, _SPANS)], names=["h", "c", "spans"])

    lone = again.mapInArrow(spans, "h long, c long, spans array<struct<start: long, end: long>>").join(contents.filter("n = 1").select("h", "c", "n"), ["h", "c"])
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("size").alias("end")))
    marks = contents.filter("n > 1").select("h", "c", whole.alias("spans"), "n").unionByName(lone)
    marks = stored(marks.groupBy("c").agg(F.collect_list(F.struct("h", "spans")).alias("marks"), F.sum("n").alias("n")), "marks")
    placed = hot_lookup(hot.select("h", "c", "k1", "k2", "at").distinct(), marks, "c", ["marks"], "n", hot.count(), inner=True)
    each = placed.select("k1", "k2", "at", F.explode(F.flatten(F.transform(F.filter("marks", lambda m: m["h"] == F.col("h")), lambda m: m["spans"]))).alias("s"))
    return each.select("k1", "k2", (F.col("at") + F.col("s.start")).alias("start"), (F.col("at") + F.col("s.end")).alias("end"))


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """k1, k2, spans: for each text (known by two hashes) its repeated bytes as unmerged spans."""
    spark = docs.sparkSession
    bits = _bitmaps(_anchors(docs, length))
    maps = spark.sparkContext.broadcast(bits)
    found = _shard_spans(_pieces(docs, maps, length, hot=False), length)
    if any(bits[1]):
        found = found.unionByName(_hot_spans(stored(_pieces(docs, maps, length, hot=True), "hot"), length))
    return found.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, spans (start, end of each removed run), kept (bytes)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    spans = repeated_spans(rows, length).groupBy("k1").agg(F.collect_list(F.struct("k2", "spans")).alias("marks"))
    keyed = rows.withColumn("k1", F.xxhash64("text")).withColumn("k2", F.xxhash64(F.lit(1), F.col("text")))
    copies = rows.groupBy(F.xxhash64("text").alias("k1")).agg(F.count("*").alias("copies"))
    marked = hot_lookup(keyed, stored(spans.join(copies, "k1"), "spans"), "k1", ["marks"], "copies", rows.count())
    mine = F.flatten(F.transform(F.filter("marks", lambda m: m["k2"] == F.col("k2")), lambda m: m["spans"]))
    marked = marked.select("doc_id", "text", F.coalesce(mine, F.array().cast("array<struct<start: long, end: long>>")).alias("found"))

    def cut(batches):
        for batch in batches:
            data, bounds = flat(batch.column("text"))
            raw, n_bytes, spans, kept = data.tobytes(), np.diff(bounds), [], []
            found = batch.column("found")
            inner = found.flatten()
            at = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(found).to_numpy(zero_copy_only=False))]).astype(np.int64)
            lo, hi = inner.field("start").to_numpy(), inner.field("end").to_numpy()
            for i in range(len(batch)):
                text = raw[bounds[i] : bounds[i + 1]]
                order = np.argsort(lo[at[i] : at[i + 1]], kind="stable")
                a, z = lo[at[i] : at[i + 1]][order], hi[at[i] : at[i + 1]][order]
                z = np.maximum.accumulate(z) if len(z) else z
                first = np.concatenate([[True], a[1:] > z[:-1]]) if len(a) else np.zeros(0, bool)
                a, z = a[first].tolist(), z[np.concatenate([first[1:], [True]])].tolist() if len(first) else []
                spans.append([{"start": x, "end": y} for x, y in zip(a, z, strict=True)])
                kept.append(b"".join(text[x:y] for x, y in zip([0, *z], [*a, len(text)], strict=True)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_bytes), pa.array(spans, _SPANS), pa.array(kept, pa.large_binary()).cast(pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    id_type = marked.schema["doc_id"].dataType.simpleString()
    return marked.mapInArrow(cut, f"doc_id {id_type}, n_bytes long, spans array<struct<start: long, end: long>>, kept binary")
