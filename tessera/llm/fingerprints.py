"""Document fingerprints by one-permutation MinHash with optimal densification.

The 64-bit hashes of a text's five-word shingles are dealt once to `BINS` bins by their top
bits; each bin keeps the smallest rest. An empty bin takes the value of the first non-empty bin in
a pseudo-random probe order of its own (the order depends on the bin alone), which keeps the
estimate unbiased with the least variance. Of every value the low `BITS` bits are packed, and
`likeness` takes out the matches that so few bits give by chance.

`with_next` puts the following row in ascending id order beside each row without a window over the
table: rows go to ranges of ids, and the first row of each range also to the range before. Range
bounds are quantiles (one number a partition); one shuffle of the texts.

Defined cases: null text is empty; a text without words has the empty fingerprint, which is like
another empty one (1.0) and unlike any other (0.0); fewer than five words are one shingle; null ids
come first; rows with equal ids follow each other in the order of their texts' hashes and of two
equal rows each is the other's neighbour; a table of one row is its own neighbour; an empty table
gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._text import LOWER, NON_SPACE, flat, mix, shingle_hashes, slices, word_hashes, words

BINS = 512
BITS = 4
K = 5
SLICE_BYTES = 2 << 20
FIRST = -(1 << 63)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_PROBE: list[np.ndarray] = []


def _probe_order() -> np.ndarray:
    """Row j: the other bins in the order in which bin j asks them for a value."""
    if not _PROBE:
        j, t = np.meshgrid(np.arange(BINS, dtype=np.uint64), np.arange(BINS, dtype=np.uint64), indexing="ij")
        _PROBE.append(np.argsort(mix(j * np.uint64(1_000_003) + t + np.uint64(9)), axis=1, kind="stable"))
    return _PROBE[0]


def sketch(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Low bits of every bin of every row; rows without hashes are all zero."""
    n, shift = len(bounds) - 1, np.uint64(64 - (BINS - 1).bit_length())
    row = np.repeat(np.arange(n), np.diff(bounds))
    least = np.full(n * BINS, _EMPTY, np.uint64)
    np.minimum.at(least, row * BINS + (hashes >> shift).astype(np.int64), hashes & ((np.uint64(1) << shift) - np.uint64(1)))
    empty = least == _EMPTY
    todo = np.flatnonzero(empty & np.repeat(np.diff(bounds) > 0, BINS))
    order, t = _probe_order(), 0
    while len(todo):
        source = todo - todo % BINS + order[todo % BINS, t]
        found = ~empty[source]
        least[todo[found]] = least[source[found]]
        todo, t = todo[~found], t + 1
    least[least == _EMPTY] = 0
    return (mix(least) & np.uint64((1 << BITS) - 1)).astype(np.uint8).reshape(n, BINS)


def pack(bins: np.ndarray) -> np.ndarray:
    """BITS bits a bin, row by row, as bytes."""
    return np.packbits(np.unpackbits(bins[:, :, None], axis=2)[:, :, 8 - BITS :].reshape(len(bins), -1), axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of rows of low bits, with the chance matches taken out."""
    chance = 2.0**-BITS
    return np.clip(((a == b).mean(1) - chance) / (1 - chance), 0, 1)


def fingerprints(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Low bits of all texts, and which texts have words."""
    data, bounds = flat(texts)
    out, some = [np.zeros((0, BINS), np.uint8)], [np.zeros(0, bool)]
    for lo, hi in slices(bounds, SLICE_BYTES):
        part = LOWER[data[bounds[lo] : bounds[hi]]]
        starts, ends, at = words(part, bounds[lo : hi + 1] - bounds[lo], NON_SPACE)
        hashes, at = shingle_hashes(word_hashes(part, starts, ends), at, K)
        out.append(sketch(hashes, at))
        some.append(np.diff(at) > 0)
    return np.concatenate(out), np.concatenate(some)


def _ranges(docs: DataFrame) -> DataFrame:
    """Rows with the range they belong to; a range's first row also with the range before (ahead = true)."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = docs.select(F.col("key").cast("double").alias("k"))
    cuts = sorted(set(keys.approxQuantile("k", [i / n for i in range(1, n)], 0.1 / n))) if n > 1 else []
    splits = [float("-inf"), *cuts, float("inf")]
    if len(splits) > 2:
        cut = Bucketizer(splits=splits, inputCol="k", outputCol="range")
        dealt = cut.transform(docs.withColumn("k", F.col("key").cast("double"))).withColumn("range", F.col("range").cast("int")).drop("k")
    else:
        dealt = docs.withColumn("range", F.lit(0))
    firsts = sorted(dealt.groupBy("range").agg(F.min("key").alias("key")).collect())  # one row a range
    if not firsts:
        return dealt.withColumn("ahead", F.lit(False))
    before = {firsts[i]["key"]: firsts[i - 1]["range"] for i in range(len(firsts))}
    to = F.element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]), F.col("key"))
    own = F.struct(F.col("range"), F.lit(False).alias("ahead"))
    both = F.when(F.col("key").isin(list(before)), F.array(own, F.struct(to.alias("range"), F.lit(True).alias("ahead")))).otherwise(F.array(own))
    return dealt.withColumn("to", F.explode(both)).select(*docs.columns, "to.range", "to.ahead")


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str], list[int]]]:
    """Runs of rows in order: ids, texts, and the positions whose neighbour is the next position."""
    held: list[tuple] = []
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            part = batch.slice(lo, 512)
            rows = held + list(zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "range", "ahead")), strict=True))
            kept = [r for i, r in enumerate(rows) if not (i and r[3] and rows[i - 1][3] and r[2] == rows[i - 1][2])]
            own = [i for i in range(len(kept) - 1) if not kept[i][3] and kept[i][2] == kept[i + 1][2]]
            yield [r[0] for r in kept], [r[1] or "" for r in kept], own
            held = kept[-1:]


def fingerprint_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text (its last quarter replaced by the next text's start)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = _ranges(rows.withColumn("key", F.coalesce("doc_id", F.lit(FIRST).cast("long"))))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartition(n, "range").sortWithinPartitions("range", "ahead", "key", F.xxhash64("text"))

    def run(batches):
        for ids, texts, own in _pairs(batches):
            if not own:
                continue
            plain, some = fingerprints(pa.array(texts, pa.large_string()))
            sizes = [len(texts[i]) for i in own]
            edits = [texts[i][: n - n // 4] + texts[i + 1][: n // 4] for i, n in zip(own, sizes, strict=True)]
            edited, edited_some = fingerprints(pa.array(edits, pa.large_string()))
            i = np.array(own)

            def like(a, b, some_a, some_b):
                return np.where(some_a & some_b, likeness(a, b), (some_a == some_b).astype(float))

            packed, packed_edited = pack(plain[i]), pack(edited)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": pa.array([ids[x] for x in own], pa.int64()),
                    "n_chars": pa.array(sizes, pa.int64()),
                    "edited_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in edits],
                    "fingerprint": [p.tobytes().hex() if s else "" for p, s in zip(packed, some[i], strict=True)],
                    "edited_fingerprint": [p.tobytes().hex() if s else "" for p, s in zip(packed_edited, edited_some, strict=True)],
                    "near_edited": like(plain[i], edited, some[i], edited_some),
                    "near_next": like(plain[i], plain[i + 1], some[i], some[i + 1]),
                }
            )

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.mapInArrow(run, schema)
