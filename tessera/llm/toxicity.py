"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Fit. The learning rows are at most `MAX_EXAMPLES` labelled documents (those with the smallest hash
of their id; the bound is a parameter). Features of a text are its words and their beginnings of 4 to
6 bytes. Kept are those that tell the labels apart among the examples (chi-squared and odds ratio,
at most `MAX_TERMS`); their document frequencies are counted over all documents, not the
examples. The examples' vectors make an inverted index whose postings are grouped in blocks of
`BLOCK` examples, with the largest weight of each block.

Score. A document's terms give an upper bound of the cosine for every block from the block maxima;
blocks are evaluated exactly in the order of their bounds until no bound reaches the k-th best
cosine so far, so the neighbours are exact. Neighbours tied with the k-th share the places left.
Votes are weighted by 1 / (distance + `SOFT`); an isotonic curve through the examples' own
left-one-out votes turns them into a probability. The nearest examples are returned as evidence.

The index, bounded by the parameters, is broadcast; documents are scored where they are read.

Defined cases: a text without a kept term (null and empty ones too) is near to the examples
without one, and has their share of toxic ones as its vote; repeated label rows count once and a
document with differing labels as toxic; rows with a null label or id are left out of the fit; no
examples at all give score 0; examples of one label give that label's share; repeated rows are scored
alike; other columns pass through, but those named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.llm._spark import stored
from tessera.llm._text import ALNUM, LOWER, flat, mix, slices, word_hashes, words

MAX_EXAMPLES = 16_384
MAX_TERMS = 8_192
MIN_EXAMPLES = 4
CHI2 = 15.0
ODDS = 3.0
NEIGHBOURS = 15
BLOCK = 64
SOFT = 0.05
PREFIXES = (4, 5, 6)
EVIDENCE = 3
SLICE_BYTES = 2 << 20


def features(data: np.ndarray, bounds: np.ndarray, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature hash, count) of the rows' distinct features, sorted; only those in keep (sorted) if given."""
    low = LOWER[data]
    starts, ends, at = words(low, bounds, ALNUM)
    row_of = np.repeat(np.arange(len(bounds) - 1), np.diff(at))
    rows, hashes = [], []
    for size in (0, *PREFIXES):
        some = slice(None) if not size else ends - starts >= size
        h = word_hashes(low, starts[some], ends[some] if not size else starts[some] + size)
        h = mix(h + np.uint64(size))
        r = row_of[some]
        if keep is not None:
            at_keep = np.minimum(np.searchsorted(keep, h), max(len(keep) - 1, 0))
            known = keep[at_keep] == h if len(keep) else np.zeros(len(h), bool)
            h, r = h[known], r[known]
        rows.append(r)
        hashes.append(h)
    row, h = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    head = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (h[1:] != h[:-1]))) if len(row) else np.zeros(0, np.int64)
    return row[head], h[head], np.diff(np.append(head, len(row)))


def _each(batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        data, bounds = flat(batch.column(text_col))
        for lo, hi in slices(bounds, SLICE_BYTES):
            yield batch.slice(lo, hi - lo), data[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]


class Index:
    """Examples as an inverted index of unit TF-IDF vectors with block maxima."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, terms: np.ndarray, counts: np.ndarray, idf: np.ndarray):
        self.idf = idf
        n = len(ids)
        weight = (1 + np.log(counts)) * idf[terms]
        norm = np.sqrt(np.bincount(rows, weight**2, n))
        weight = weight / norm[rows] if len(rows) else weight
        # examples with the same strongest term come together, which makes the block maxima tight
        strongest = np.full(n, -1)
        by_weight = np.argsort(weight, kind="stable")
        strongest[rows[by_weight]] = terms[by_weight]
        order = np.lexsort((ids, strongest))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        self.ids, self.labels = ids[order], labels[order].astype(float)
        self.empty = norm[order] == 0
        self.empty_vote = float(self.labels[self.empty].mean()) if self.empty.any() else float(self.labels.mean()) if n else 0.0
        doc = place[rows]
        by_term = np.lexsort((doc, terms))
        self.doc, self.weight, terms = doc[by_term], weight[by_term], terms[by_term]
        # one entry for each (term, block): where its postings begin, and their largest weight
        block = self.doc // BLOCK
        head = np.flatnonzero(np.append(True, (terms[1:] != terms[:-1]) | (block[1:] != block[:-1]))) if len(terms) else np.zeros(0, np.int64)
        self.entry_block = block[head]
        self.entry_post = np.append(head, len(terms))
        self.entry_max = np.maximum.reduceat(self.weight, head) if len(head) else np.zeros(0)
        self.term_entries = np.searchsorted(terms[head], np.arange(len(idf) + 1))
        self.blocks = n // BLOCK + 1

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weight = (1 + np.log(counts)) * self.idf[terms]
        return weight / np.sqrt((weight**2).sum())

    def nearest(self, terms: np.ndarray, weight: np.ndarray, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the NEIGHBOURS nearest examples and of all tied with the last."""
        lo, hi = self.term_entries[terms], self.term_entries[terms + 1]
        n = hi - lo
        entry = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        factor = np.repeat(weight, n)
        bound = np.bincount(self.entry_block[entry], self.entry_max[entry] * factor, self.blocks)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        place, cosine, done, step = np.zeros(0, np.int64), np.zeros(0), 0, 4
        while done < len(order):
            best = np.partition(cosine, -NEIGHBOURS)[-NEIGHBOURS] if len(cosine) >= NEIGHBOURS else 0.0
            if bound[order[done]] < best - 1e-9:
                break
            some = order[done : done + step]
            slot = np.full(self.blocks, -1)
            slot[some] = np.arange(len(some))
            mine = slot[self.entry_block[entry]] >= 0
            e, f = entry[mine], factor[mine]
            m = self.entry_post[e + 1] - self.entry_post[e]
            post = np.repeat(self.entry_post[e] - np.cumsum(m) + m, m) + np.arange(m.sum())
            local = slot[self.doc[post] // BLOCK] * BLOCK + self.doc[post] % BLOCK
            sums = np.bincount(local, self.weight[post] * np.repeat(f, m), len(some) * BLOCK)
            found = np.flatnonzero(sums > 0)
            at = some[found // BLOCK] * BLOCK + found % BLOCK
            own = at != without
            place, cosine = np.append(place, at[own]), np.append(cosine, np.round(np.minimum(sums[found[own]], 1), 9))
            done, step = done + step, 2 * step
        if len(cosine) > NEIGHBOURS:
            last = np.partition(cosine, -NEIGHBOURS)[-NEIGHBOURS]
            place, cosine = place[cosine >= last], cosine[cosine >= last]
        order = np.lexsort((place, -cosine))
        return place[order], cosine[order]

    def vote(self, place: np.ndarray, cosine: np.ndarray) -> float:
        if not len(place):
            return self.empty_vote
        share = np.ones(len(place))
        if len(place) > NEIGHBOURS:
            tied = cosine == cosine[-1]
            share[tied] = (NEIGHBOURS - (~tied).sum()) / tied.sum()
        w = share / (1 - cosine + SOFT)
        return float((w * self.labels[place]).sum() / w.sum())


class Model(NamedTuple):
    terms: np.ndarray  # sorted hashes
    index: Index
    steps: np.ndarray  # votes and the calibrated scores at them
    scores: np.ndarray

    def score(self, votes: np.ndarray) -> np.ndarray:
        return np.interp(votes, self.steps, self.scores) if len(self.steps) else np.zeros(len(votes))


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising step means of y over x (pool adjacent violators), smoothed by one half example of either label."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # sum of y, n, sum of x
    values, first = np.unique(x[order], return_index=True)
    for a, z, v in zip(first, np.append(first[1:], len(x)), values, strict=True):
        pools.append([float(y[order][a:z].sum()), float(z - a), float(v * (z - a))])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last, strict=True)]
    return np.array([p[2] / p[1] for p in pools]), np.maximum.accumulate(np.array([(p[0] + 0.5) / (p[1] + 1) for p in pools])) if pools else np.zeros(0)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """A model from at most MAX_EXAMPLES labelled documents and the frequencies of all documents."""
    spark = docs.sparkSession
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(MAX_EXAMPLES)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # the examples' ids and labels are bounded by MAX_EXAMPLES, so they go to the documents
    examples = stored(texts.join(F.broadcast(chosen), "id").dropDuplicates(["id"]), "examples")

    def explode(batches):
        for rows, data, bounds in _each(batches, "text"):
            row, h, _ = features(data, bounds)
            label = rows.column("label").to_numpy(zero_copy_only=False)[row]
            uniq, which = np.unique(h, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(uniq.view(np.int64)), pa.array(np.bincount(which, minlength=len(uniq)).astype(np.int64)), pa.array(np.bincount(which, label, len(uniq)).astype(np.int64))], names=["h", "df", "hit"])

    # chi-squared grows with the count; fewer examples than MIN_EXAMPLES prove nothing
    stats = examples.mapInArrow(explode, "h long, df long, hit long").groupBy("h").agg(F.sum("df").alias("df"), F.sum("hit").alias("hit")).filter(F.col("hit") >= MIN_EXAMPLES)
    sizes = examples.agg(F.count("*").alias("n"), F.sum("label").alias("toxic")).first()
    n, toxic = sizes["n"], sizes["toxic"] or 0
    a, df = F.col("hit"), F.col("df")
    chi2 = n * F.pow(a * (n - df - toxic + a) - (df - a) * (toxic - a), F.lit(2)) / (df * (n - df) * F.lit(float(max(toxic, 1) * max(n - toxic, 1))))
    odds = (a + 0.5) * (n - df - toxic + a + 0.5) / ((df - a + 0.5) * (toxic - a + 0.5))
    best = stats.filter((df < n) & (odds >= ODDS) & (chi2 >= CHI2)).orderBy(chi2.desc(), "h").limit(MAX_TERMS)
    terms = np.sort(np.array([x["h"] for x in best.select("h").collect()], np.int64).view(np.uint64))
    shared = spark.sparkContext.broadcast(terms)

    def count(batches):
        total, rows_seen = np.zeros(len(shared.value), np.int64), 0
        for rows, data, bounds in _each(batches, "text"):
            _, h, _ = features(data, bounds, shared.value)
            total += np.bincount(np.searchsorted(shared.value, h), minlength=len(total))
            rows_seen += rows.num_rows
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(total[at], rows_seen))], names=["term", "df"])

    frequency = np.zeros(len(terms))
    all_rows = 0
    for term, df_ in texts.select("text").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df")).collect():
        if term < 0:
            all_rows = df_
        else:
            frequency[term] = df_
    idf = np.log((1 + all_rows) / (1 + frequency)) + 1

    def vectors(batches):
        for rows, data, bounds in _each(batches, "text"):
            row, h, counts = features(data, bounds, shared.value)
            at = np.searchsorted(row, np.arange(rows.num_rows + 1))
            lists = [pa.LargeListArray.from_arrays(at, x.astype(np.int32)).cast(pa.list_(pa.int32())) for x in (np.searchsorted(shared.value, h), counts)]
            yield pa.RecordBatch.from_arrays([rows.column("id"), rows.column("label"), *lists], names=["id", "label", "terms", "counts"])

    id_type = texts.schema["id"].dataType.simpleString()
    got = examples.mapInArrow(vectors, f"id {id_type}, label int, terms array<int>, counts array<int>").orderBy("id").collect()
    rows = np.repeat(np.arange(len(got)), [len(x["terms"]) for x in got]) if got else np.zeros(0, np.int64)
    at, counts = (np.array([v for x in got for v in x[c]], np.int64) for c in ("terms", "counts"))
    index = Index(np.array([x["id"] for x in got]), np.array([x["label"] for x in got], np.int64), rows, at, counts, idf)
    votes = _left_one_out(spark, index, got)
    steps, scores = isotonic(votes, np.array([x["label"] for x in got], float)) if got else (np.zeros(0), np.zeros(0))
    return Model(terms, index, steps, scores)


def _left_one_out(spark, index: Index, got: list) -> np.ndarray:
    """Each example's vote by the others, computed by tasks."""
    place = {x: i for i, x in enumerate(index.ids.tolist())}
    shared = spark.sparkContext.broadcast(index)
    rows = spark.createDataFrame([(i, place[x["id"]], x["terms"], x["counts"]) for i, x in enumerate(got)], "i int, place int, terms array<int>, counts array<int>") if got else None
    out = np.zeros(len(got))
    if rows is None:
        return out

    def run(batches):
        for batch in batches:
            votes = []
            for own, terms, counts in zip(*(batch.column(c).to_pylist() for c in ("place", "terms", "counts")), strict=True):
                t = np.array(terms, np.int64)
                votes.append(shared.value.vote(*shared.value.nearest(t, shared.value.vector(t, np.array(counts)), own)) if terms else shared.value.empty_vote)
            yield pa.RecordBatch.from_arrays([batch.column("i"), pa.array(votes, pa.float64())], names=["i", "vote"])

    for i, vote in rows.repartition(spark.sparkContext.defaultParallelism * 2).mapInArrow(run, "i int, vote double").collect():
        out[i] = vote
    return out


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with score, predicted and evidence (ids of the nearest examples)."""
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in ("score", "predicted", "evidence")])
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("evidence", T.ArrayType(T.StringType()))])
    arrow = to_arrow_schema(schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        index, seen = model.index, {}
        for rows, data, bounds in _each(batches, text_col):
            row, h, counts = features(data, bounds, model.terms)
            term = np.searchsorted(model.terms, h)
            at = np.searchsorted(row, np.arange(rows.num_rows + 1))
            votes, evidence = np.full(rows.num_rows, index.empty_vote), [[] for _ in range(rows.num_rows)]
            for r in np.flatnonzero(np.diff(at)).tolist():
                t, c = term[at[r] : at[r + 1]], counts[at[r] : at[r + 1]]
                key = t.tobytes() + c.tobytes()
                if key not in seen:
                    if len(seen) > 50_000:
                        seen.clear()
                    place, cosine = index.nearest(t, index.vector(t, c))
                    seen[key] = index.vote(place, cosine), [str(x) for x in index.ids[place[:EVIDENCE]]]
                votes[r], evidence[r] = seen[key]
            scores = np.clip(model.score(votes), 0, 1)
            columns = {n: rows.column(n) for n in rows.schema.names} | {"score": pa.array(scores), "predicted": pa.array((scores >= 0.5).astype(np.int32)), "evidence": pa.array(evidence, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in arrow], schema=arrow)

    return kept.mapInArrow(run, schema)
