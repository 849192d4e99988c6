"""Text quality by an interpolated modified Kneser-Ney n-gram model of trusted text.

The model is over characters (order 4): a text's perplexity is that of its code points, each given
the three before it. One pass over the documents counts the trusted rows' n-grams and notes
the n-grams that any row needs; all later steps are joins between count tables sharded by n-gram:
continuation counts of the lower orders, discounts from the counts of counts, context totals and
back-off weights, and so the log probability of every n-gram needed. The distinct texts are dealt
by their hash into lots of about `LOT_CHARS` characters. A lot's distinct n-grams are joined with
the table, and the lot's texts are summed with the rows that come back; so the table is
neither collected nor broadcast and may have any size, and a task holds one lot and its n-grams. A
task sends each text once, its texts of a lot as one Zstandard block, and rows get the perplexity of their text by its hash (128 bits). A single
text longer than a lot is a lot of its own.

A row is kept if its perplexity lies between two quantiles of the trusted rows of its language
(too high: noise; too low: repetition).

Defined cases: null and empty texts have no perplexity and are not kept; a language without
trusted rows takes the quantiles of all trusted rows; a null language is a language of its own; without
trusted rows nothing is kept; code points above U+FFFE count as U+FFFF; repeated rows are scored
alike; an empty table gives an empty result; columns other than those asked for are dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._spark import hot_lookup, stored

ORDER = 4
LOT_CHARS = 4_000_000
#: Text that a task holds (in bytes) before it packs and sends it.
PACK_BYTES = 1 << 25
#: Cuts of at most so many languages are broadcast.
BROADCAST_LANGUAGES = 10_000
SLICE_CHARS = 1 << 20
#: Trusted ids up to this many go to the documents as a broadcast; more are joined by shuffle.
BROADCAST_IDS = 4_000_000
QUANTILES = (0.005, 0.995)
SYMBOLS = 1 << 16


def gram_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The 4-gram ending at every code point, 16 bits a symbol, and the rows' bounds."""
    pad = "\0" * (ORDER - 1)
    points = np.frombuffer((pad + pad.join(texts)).encode("utf-32-le"), "<u4")
    points = np.minimum(points, SYMBOLS - 1).astype(np.uint64)
    codes = points.copy()
    for back in range(1, ORDER):
        codes[back:] |= points[: len(points) - back] << np.uint64(16 * back)
    n = np.array([len(t) for t in texts], np.int64)
    bounds = np.concatenate([[0], np.cumsum(n)])
    inside = np.arange(bounds[-1]) + np.repeat((ORDER - 1) * np.arange(1, len(n) + 1), n)
    return codes[inside], bounds


def _text_slices(batch: pa.RecordBatch) -> Iterator[tuple[int, list[str]]]:
    lo, held, chars = 0, [], 0
    for r, text in enumerate(batch.column("text")):
        held.append(text.as_py() or "")
        chars += len(held[-1])
        if chars >= SLICE_CHARS or r == batch.num_rows - 1:
            yield lo, held
            lo, held, chars = r + 1, [], 0


def _count(docs: DataFrame) -> DataFrame:
    """g, c: every 4-gram of the documents and how often trusted rows have it."""

    def run(batches):
        for batch in batches:
            trusted = batch.column("trusted").to_numpy(zero_copy_only=False)
            grams, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for lo, texts in _text_slices(batch):
                codes, bounds = gram_codes(texts)
                weight = np.repeat(trusted[lo : lo + len(texts)], np.diff(bounds))
                g, which = np.unique(codes, return_inverse=True)
                grams.append(g)
                counts.append(np.bincount(which, weight, len(g)).astype(np.int64))
            g, which = np.unique(np.concatenate(grams), return_inverse=True)
            n = np.bincount(which, np.concatenate(counts), len(g)).astype(np.int64)
            for lo in range(0, len(g), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(g[lo : lo + (1 << 17)].view(np.int64)), pa.array(n[lo : lo + (1 << 17)])], names=["g", "c"])

    return docs.select("text", "trusted").mapInArrow(run, "g long, c long").groupBy("g").agg(F.sum("c").alias("c"))


def _suffix(g: str, order: int) -> Column:
    """The last `order` symbols."""
    return F.col(g) if order == ORDER else F.col(g).bitwiseAND(F.lit((1 << (16 * order)) - 1))


def _context(code: Column) -> Column:
    return F.shiftrightunsigned(code, 16)


def _discounts(counts: DataFrame) -> tuple[float, float, float]:
    n = counts.agg(*[F.count(F.when(F.col("c") == k, 1)).alias(f"n{k}") for k in range(1, 5)]).first()
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    raw = [k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else k / 2 for k in (1, 2, 3)]
    return tuple(min(max(d, 0.1), k - 0.1) for k, d in zip((1, 2, 3), raw, strict=True))


def _level(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(g, own: discounted share of its context; h, total-normalised back-off weight) of one order."""
    d1, d2, d3 = _discounts(counts)
    discount = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
    rows = counts.withColumn("h", _context(F.col("g"))).withColumn("d", discount)
    contexts = rows.groupBy("h").agg(F.sum("c").alias("total"), F.sum("d").alias("taken")).select("h", "total", (F.col("taken") / F.col("total")).alias("back"))
    return rows.select("g", (F.col("c") - F.col("d")).alias("above")), contexts


def log_probabilities(counted: DataFrame) -> DataFrame:
    """g, lp: interpolated modified Kneser-Ney log probability of every 4-gram in counted."""
    counts = counted.filter("c > 0").select("g", "c")
    out = counted.select("g")
    p = None
    levels = []
    for order in range(ORDER, 0, -1):
        levels.append((order, *_level(counts)))
        if order > 1:  # continuation counts: in how many contexts a shorter gram is seen
            counts = stored(counts.groupBy(_suffix("g", order - 1).alias("g")).agg(F.count("*").alias("c")), f"order{order - 1}")
    for order, own, contexts in reversed(levels):
        code = _suffix("g", order)
        out = out.withColumn("code", code)
        own, contexts = own.withColumnRenamed("g", "code"), contexts.select("h", "total", "back")
        if order == 1:  # single symbols have one context, the empty one, and at most SYMBOLS rows
            only = contexts.first()
            total, back = (only["total"], only["back"]) if only else (None, None)
            out = out.withColumn("total", F.lit(total).cast("double")).withColumn("back", F.lit(back).cast("double"))
            own = F.broadcast(own)
        else:
            if order == 2:  # one row a symbol at most
                contexts = F.broadcast(contexts)
            out = out.withColumn("h", _context(F.col("code"))).join(contexts, "h", "left")
        out = out.join(own, "code", "left")
        lower = F.lit(1.0 / SYMBOLS) if p is None else F.col("p")
        seen = F.coalesce(F.col("above"), F.lit(0.0)) / F.col("total") + F.col("back") * lower
        out = out.select("g", F.when(F.col("total").isNull(), lower).otherwise(seen).alias("p"))
        p = True
    return out.select("g", F.ln("p").alias("lp"))


def _mark_trusted(docs: DataFrame, trusted_ids: DataFrame) -> DataFrame:
    ids = trusted_ids.select(F.col(trusted_ids.columns[0]).cast("long").alias("doc_id")).filter("doc_id is not null").distinct().withColumn("trusted", F.lit(1))
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.join(ids, "doc_id", "left").withColumn("trusted", F.coalesce("trusted", F.lit(0)).cast("double"))


def _packed(held: dict[int, list[tuple[int, int, bytes]]]) -> pa.RecordBatch:
    """A row a lot: its texts' keys and byte lengths, and the texts as one Zstandard block."""
    pack = zstandard.ZstdCompressor(level=3).compress
    keys = [np.array([(k1, k2, len(t)) for k1, k2, t in rows], "<i8").tobytes() for rows in held.values()]
    bodies = [pack(b"".join(t for _, _, t in rows)) for rows in held.values()]
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(keys, pa.binary()), pa.array(bodies, pa.binary())], names=["lot", "keys", "body"])


def _unpacked(packs: pa.Table) -> Iterator[tuple[list[tuple[int, int]], list[str]]]:
    """Keys and texts of a lot, in slices of about SLICE_CHARS bytes or one text."""
    for keys, body in zip(packs.column("keys"), packs.column("body"), strict=True):
        rows = np.frombuffer(keys.as_py(), "<i8").reshape(-1, 3)
        text = memoryview(zstandard.ZstdDecompressor().decompress(body.as_py()))
        names, held, at, sent = [], [], 0, 0
        for k1, k2, n in rows.tolist():
            names.append((k1, k2))
            held.append(str(text[at : at + n], "utf-8"))
            at += n
            if at - sent >= SLICE_CHARS or at == len(text):
                yield names, held
                names, held, sent = [], [], at


def _texts_by_lot(rows: DataFrame, lots: int) -> DataFrame:
    """lot, keys, body: the texts that are not empty, each once a task, packed by lot."""

    def run(batches):
        seen, held, size = set(), {}, 0
        for batch in batches:
            keys = zip(batch.column("k1").to_pylist(), batch.column("k2").to_pylist(), strict=True)
            for key, text in zip(keys, batch.column("text"), strict=True):
                if key in seen:
                    continue
                seen.add(key)
                body = text.as_buffer().to_pybytes()
                held.setdefault(key[1] % lots, []).append((*key, body))
                size += len(body)
                if size >= PACK_BYTES:
                    yield _packed(held)
                    held, size = {}, 0
        if held:
            yield _packed(held)

    return rows.filter(F.length("text") > 0).select("k1", "k2", "text").mapInArrow(run, "lot long, keys binary, body binary")


def _grams(packs: pa.Table) -> pa.Table:
    found = [np.zeros(0, np.uint64)] + [np.unique(gram_codes(held)[0]) for _, held in _unpacked(packs)]
    g = np.unique(np.concatenate(found))
    return pa.table({"lot": pa.array(np.full(len(g), packs.column("lot")[0].as_py(), np.int64)), "g": g.view(np.int64)})


def _sums(packs: pa.Table, probabilities: pa.Table) -> pa.Table:
    grams, lp = probabilities.column("g").to_numpy().view(np.uint64), probabilities.column("lp").to_numpy()
    order = np.argsort(grams)
    grams, lp = grams[order], lp[order]
    out: dict[tuple[int, int], tuple[int, float]] = {}
    for names, held in _unpacked(packs):
        codes, bounds = gram_codes(held)
        # each text has a character at least; its sum is of its own values only, whatever its lot
        sums = np.add.reduceat(lp[np.searchsorted(grams, codes)], bounds[:-1])
        out.update(zip(names, zip(np.diff(bounds).tolist(), sums.tolist(), strict=True), strict=True))
    columns = zip(*[(*key, *value) for key, value in out.items()], strict=True) if out else [[]] * 4
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["k1", "k2", "chars", "lp"])


def perplexities(docs: DataFrame, trusted_ids: DataFrame) -> DataFrame:
    """doc_id, lang, trusted, chars, perplexity of each row of docs (doc_id, text, lang)."""
    marked = _mark_trusted(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")), trusted_ids)
    table = stored(log_probabilities(stored(_count(marked), "grams")), "probabilities")
    rows = marked.withColumn("k1", F.xxhash64("text")).withColumn("k2", F.xxhash64(F.lit(1), "text"))
    size = rows.agg(F.sum(F.length("text")).alias("chars"), F.count("*").alias("rows")).first()
    texts = _texts_by_lot(rows, max(1, math.ceil((size["chars"] or 0) / LOT_CHARS)))
    # a lot has each of its n-grams once, so no n-gram is hot here
    found = texts.groupBy("lot").applyInArrow(_grams, "lot long, g long").join(table, "g").select("lot", "g", "lp")
    scored = stored(texts.groupBy("lot").cogroup(found.groupBy("lot")).applyInArrow(_sums, "k1 long, k2 long, chars long, lp double"), "scored")
    per_key = scored.groupBy("k1").agg(F.collect_list(F.struct("k2", "chars", "lp")).alias("texts"))
    per_key = rows.groupBy("k1").agg(F.count("*").alias("copies")).join(per_key, "k1", "left")
    named = hot_lookup(rows.select("doc_id", "lang", "trusted", "k1", "k2"), per_key, "k1", ["texts"], "copies", size["rows"])
    own = F.get(F.filter("texts", lambda t: t["k2"] == F.col("k2")), 0)
    out = named.select("doc_id", "lang", "trusted", F.coalesce(own["chars"], F.lit(0)).cast("long").alias("chars"), own["lp"].alias("lp"))
    return out.select("doc_id", "lang", "trusted", "chars", F.when(F.col("chars") > 0, F.exp(-F.col("lp") / F.col("chars"))).alias("perplexity"))


def classify(docs: DataFrame, trusted_ids: DataFrame, quantiles: tuple[float, float] = QUANTILES) -> DataFrame:
    """doc_id, lang, perplexity, low, high, keep."""
    scored = stored(perplexities(docs, trusted_ids), "perplexities").withColumn("key", F.coalesce("lang", F.lit("\0")))
    known = scored.filter("trusted > 0 and perplexity is not null")
    cut = F.percentile_approx("perplexity", F.array(*[F.lit(q) for q in quantiles]), F.lit(10_000))
    by_lang = stored(known.groupBy("key").agg(cut.alias("cuts")), "cuts")
    if by_lang.count() <= BROADCAST_LANGUAGES:  # beyond it a join by shuffle, where a hot language's stored rows are split
        by_lang = F.broadcast(by_lang)
    overall = known.agg(cut.alias("all_cuts")).first()["all_cuts"]
    fallback = F.array(*[F.lit(x) for x in overall]) if overall else F.lit(None).cast("array<double>")
    out = scored.join(by_lang, "key", "left").withColumn("cuts", F.coalesce("cuts", fallback))
    keep = F.coalesce((F.col("perplexity") >= F.col("cuts")[0]) & (F.col("perplexity") <= F.col("cuts")[1]), F.lit(False))
    return out.select("doc_id", "lang", "perplexity", F.col("cuts")[0].alias("low"), F.col("cuts")[1].alias("high"), keep.alias("keep"))
