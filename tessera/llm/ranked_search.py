"""Ranked lexical search of many queries at once, with the sums that queries share computed once.

Documents become postings: of each text the number of its terms, and frequencies of the terms that
some item has. Statistics (documents with a term, all terms) are aggregates over the postings. A
document's score for an item is the sum of its values for the item's terms, so items that have a set
of terms in common have a partial sum in common. Items are dealt to blocks of at most ITEMS by the least hash of
their terms, which brings similar items together. For each block `mine` finds the shared sets: the
pair of terms that most items have becomes a node, which replaces the pair in those items, and so
on, so sets contain smaller sets and form a DAG over all items of the block. Then `Plan.scores`
materialises, for a slice of documents, every node's accumulator over the documents once, level by level,
and each item is the sum of the few nodes that are left of it.

A document is scored where its postings are. Each task keeps the k best of every item, and only
those are shuffled: at most items x k rows a task. Vocabulary and plans are files in the shared
folder, written and read by tasks, one block in memory at a time; neither passes the driver. The
work is items' shared sums x documents, and no pair of item and document is ever a row.

Integer arithmetic as the formulas below have it; equal scores are ordered by id.

Defined cases: a null text has no terms; rows that repeat a doc_id are documents of their own; a null
doc_id comes before all others of its score; rows of one item_id, null too, are one item with the terms of all; an
item without a term that occurs has no rows; a document with no score above 0 is in no list; an empty table gives an
empty result; no other column is carried. Terms are known by 64-bit hashes. A very long text is one row of a
task; its postings are as long as the benchmark's vocabulary at most.
"""

from __future__ import annotations

import heapq
import math
import pickle
import uuid
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tessera.llm._spark import small_batches, stored
from tessera.llm._text import ALNUM, LOWER, flat, slices, word_hashes, words
from tessera.llm.token_files import new_folder, open_fs

BEST = 20
#: Items of a block at most.
ITEMS = 1024
#: Terms of a piece of the vocabulary at most.
TERMS = 1 << 20
#: Terms of an item that are looked at together when shared sets are mined.
TOGETHER = 64
#: Bytes of text that are cut into terms at once; documents that are scored at once.
SLICE = 2 << 20
DOCUMENTS = 256
#: Candidates that a task holds before it cuts them down to the best.
HELD = 1 << 20
NO_ID = -(1 << 63)


def text_terms(column: pa.Array):
    """Row range, term hashes and their bounds, a few MB of text at once."""
    data, bounds = flat(column)
    for lo, hi in slices(bounds, SLICE):
        low = LOWER[data[bounds[lo] : bounds[hi]]]
        starts, ends, at = words(low, bounds[lo : hi + 1] - bounds[lo], ALNUM)
        yield lo, hi, word_hashes(low, starts, ends).view(np.int64), at


def _row_counts(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, term) pairs in order, and how often each stands."""
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])])) if len(h) else np.zeros(0, np.int64)
    return row[first], h[first], np.diff(np.append(first, len(h)))


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, h, times: how often each item has each term."""
    rows = items.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["item_id"].dataType

    def run(batches):
        for batch in batches:
            for lo, hi, h, at in text_terms(batch.column("text")):
                row, h, n = _row_counts(h, np.repeat(np.arange(hi - lo), np.diff(at)))
                yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(lo + row)), pa.array(h), pa.array(n)], names=["item_id", "h", "times"])

    found = rows.mapInArrow(run, T.StructType([T.StructField("item_id", kind), T.StructField("h", T.LongType()), T.StructField("times", T.LongType())]))
    return found.groupBy("item_id", "h").agg(F.sum("times").alias("times"))


def _write(folder: str, name: str, value) -> str:
    """value in a file of its own; a task that runs again writes another file."""
    fs, place = open_fs(folder)
    path = f"{place}/{name}-{uuid.uuid4().hex}"
    with fs.open_output_stream(path) as out:
        out.write(pickle.dumps(value, protocol=5))
    return f"{folder}/{path.rsplit('/', 1)[1]}"


def _read(path: str):
    fs, place = open_fs(path)
    with fs.open_input_stream(place) as source:
        return pickle.loads(source.read())


def _new_place(spark, kind: str) -> str:
    folder = new_folder(spark, kind)
    fs, place = open_fs(folder)
    fs.create_dir(place, recursive=True)
    return folder


def _vocabulary(terms: DataFrame, folder: str) -> list[str]:
    """Files of sorted term hashes, at most TERMS in each; the driver sees their names."""

    def write(batches):
        held = [batch.column("h").to_numpy() for batch in batches]
        h = np.sort(np.concatenate(held)) if held else np.zeros(0, np.int64)
        for lo in range(0, len(h), TERMS):
            yield pa.RecordBatch.from_arrays([pa.array([_write(folder, "terms", h[lo : lo + TERMS])])], names=["path"])

    distinct = terms.select("h").distinct()
    parts = max(1, -(-terms.count() // TERMS))
    return [row["path"] for row in distinct.repartitionByRange(parts, "h").mapInArrow(write, "path string").collect()]


def postings(docs: DataFrame, vocabulary: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (terms of the text), h and tf (terms of the vocabulary and how often the text has them)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        pieces = [_read(path) for path in vocabulary] if len(vocabulary) == 1 else None
        for batch in batches:
            for lo, hi, h, at in text_terms(batch.column("text")):
                row = np.repeat(np.arange(hi - lo), np.diff(at))
                known = np.zeros(len(h), bool)
                for piece in pieces if pieces is not None else map(_read, vocabulary):
                    known |= piece[np.minimum(np.searchsorted(piece, h), len(piece) - 1)] == h
                row, term, tf = _row_counts(h[known], row[known])
                bounds = pa.array(np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(bounds, pa.array(x.astype(np.int64))) for x in (term, tf)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(np.diff(at).astype(np.int64)), *lists], names=["doc_id", "n", "h", "tf"])

    return rows.mapInArrow(run, "doc_id long, n long, h array<long>, tf array<long>")


# shared sums ---------------------------------------------------------------------------------


def mine(items: list[list[int]], leaves: int) -> tuple[list[list[int]], list[tuple[int, int]]]:
    """Items over leaves 0 .. leaves - 1, rewritten over leaves and nodes, and each node's two members.

    Node leaves + i has the i-th pair as members, whose numbers are smaller. The pair that most
    items share is taken first. Terms that more items have stand first in an item, and pairs
    are looked for among TOGETHER of them at a time, so a long item costs in proportion to its length.
    """
    spread = Counter(x for item in items for x in set(item))
    parts = []
    for i, item in enumerate(items):
        shared = sorted((x for x in item if spread[x] > 1), key=lambda x: (-spread[x], x))
        parts += [(i, set(shared[lo : lo + TOGETHER])) for lo in range(0, len(shared), TOGETHER)]
    where: dict[tuple[int, int], set[int]] = defaultdict(set)
    for k, (_, members) in enumerate(parts):
        ordered = sorted(members)
        for i, a in enumerate(ordered):
            for b in ordered[i + 1 :]:
                where[a, b].add(k)
    queue = [(-len(at), pair) for pair, at in where.items() if len(at) > 1]
    heapq.heapify(queue)
    nodes: list[tuple[int, int]] = []
    while queue:
        n, pair = heapq.heappop(queue)
        at = where.get(pair, ())
        if len(at) != -n:
            if len(at) > 1:
                heapq.heappush(queue, (-len(at), pair))
            continue
        a, b = pair
        node = leaves + len(nodes)
        nodes.append(pair)
        touched: Counter = Counter()
        for k in list(at):
            members = parts[k][1]
            members -= {a, b}
            for x in members:
                where[min(a, x), max(a, x)].discard(k)
                where[min(b, x), max(b, x)].discard(k)
                where[x, node].add(k)
                touched[x] += 1
            members.add(node)
        del where[pair]
        for x, times in touched.items():
            if times > 1:
                heapq.heappush(queue, (-times, (x, node)))
    out = [[x for x in item if spread[x] == 1] for item in items]
    for i, members in parts:
        out[i] += sorted(members)
    return out, nodes


class Plan:
    """A block of items: its terms with weights, shared sums in levels, and what each item adds up."""

    def __init__(self, ids: list, terms: list[dict[int, tuple[int, int]]]):
        """terms: for each item the weight and the number of occurrences by hash."""
        self.ids = ids
        leaf: dict[tuple[int, int], int] = {}
        weight = {}
        for item in terms:
            for h, (w, times) in item.items():
                weight[h] = w
                leaf.setdefault((h, times), len(leaf))
        self.h = np.array(sorted(weight), np.int64)
        self.weight = np.array([weight[h] for h in self.h.tolist()], np.int64)
        keys = list(leaf)
        self.leaf_term = np.searchsorted(self.h, np.array([h for h, _ in keys], np.int64))
        self.leaf_times = np.array([times for _, times in keys], np.int64)
        # two leaves of one term are in no item together, so leaves are as good as terms
        left, nodes = mine([[leaf[h, times] for h, (_, times) in item.items()] for item in terms], len(leaf))
        depth = [0] * len(leaf)
        for a, b in nodes:
            depth.append(max(depth[a], depth[b]) + 1)
        pairs = np.array(nodes, np.int64).reshape(-1, 2)
        level = np.array(depth[len(leaf) :], np.int64)
        self.levels = [(np.flatnonzero(level == d) + len(leaf), pairs[level == d]) for d in range(1, int(level.max(initial=0)) + 1)]
        self.size = len(depth)
        self.members = np.array([x for item in left for x in item], np.int64)
        self.first = np.cumsum([0, *map(len, left)])[:-1]

    def scores(self, doc: np.ndarray, h: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        """items x documents, from postings (document 0 .. len(m) - 1, term, frequency)."""
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        mine = self.h[at] == h
        at, doc, tf = at[mine], doc[mine], tf[mine]
        value = np.zeros((len(self.h), len(m)), np.int64)
        value[at, doc] = self.weight[at] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
        sums = np.empty((self.size, len(m)), np.int64)
        leaves = len(self.leaf_term)
        np.multiply(value[self.leaf_term], self.leaf_times[:, None], out=sums[:leaves])
        for nodes, pairs in self.levels:
            sums[nodes] = sums[pairs[:, 0]] + sums[pairs[:, 1]]
        return np.add.reduceat(sums[self.members], self.first, axis=0)


def _plans(terms: DataFrame, weights: DataFrame, folder: str) -> list[str]:
    """Files of the blocks' plans; the driver sees their names."""
    each = terms.join(weights, "h").groupBy("item_id").agg(F.collect_list(F.struct("h", "w", "times")).alias("terms"), F.min("h").alias("near"))
    each = stored(each, "items")

    def write(batches):
        ids, held = [], []

        def plan():
            path = _write(folder, "plan", Plan(ids, held))
            return pa.RecordBatch.from_arrays([pa.array([path])], names=["path"])

        for batch in batches:
            for item, found in zip(batch.column("item_id").to_pylist(), batch.column("terms").to_pylist(), strict=True):
                ids.append(item)
                held.append({t["h"]: (t["w"], t["times"]) for t in found})
                if len(ids) == ITEMS:
                    yield plan()
                    ids, held = [], []
        if ids:
            yield plan()

    blocks = max(1, -(-each.count() // ITEMS))
    dealt = each.repartitionByRange(blocks, "near", F.xxhash64("item_id")).sortWithinPartitions("near").drop("near")
    return [row["path"] for row in dealt.mapInArrow(write, "path string").collect()]


class _Best:
    """The k best (score, then least id) of each item of a plan among the candidates seen so far."""

    def __init__(self, items: int, k: int):
        self.k, self.item, self.doc, self.score, self.n = k, [], [], [], 0
        # what the k-th best has; worse ones need not be held
        self.least, self.last = np.zeros(items, np.int64), np.full(items, NO_ID, np.int64)

    def add(self, scores: np.ndarray, doc_ids: np.ndarray) -> None:
        item, doc = np.nonzero((scores > 0) & (scores >= self.least[:, None]))
        value, ids = scores[item, doc], doc_ids[doc]
        wanted = (value > self.least[item]) | (ids < self.last[item])
        self.item.append(item[wanted])
        self.doc.append(ids[wanted])
        self.score.append(value[wanted])
        self.n += int(wanted.sum())
        if self.n > max(HELD, 4 * self.k * len(self.least)):
            self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        item, doc, score = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (self.item, self.doc, self.score))
        order = np.lexsort((doc, -score, item))
        item, doc, score = item[order], doc[order], score[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        full = np.flatnonzero(rank == self.k - 1)
        self.least[item[full]], self.last[item[full]] = score[full], doc[full]
        keep = rank < self.k
        self.item, self.doc, self.score = [item[keep]], [doc[keep]], [score[keep]]
        self.n = int(keep.sum())
        return item[keep], doc[keep], score[keep]


def rank(docs: DataFrame, items: DataFrame, k: int = BEST, doc_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item."""
    spark = docs.sparkSession
    small_batches(spark)
    folder = _new_place(spark, "search")
    terms = stored(item_terms(items, item_col, text_col), "terms")
    kind = terms.schema["item_id"].dataType
    schema = T.StructType([T.StructField("item_id", kind), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    found = stored(postings(docs, _vocabulary(terms, folder), doc_col, text_col), "postings")
    totals = found.agg(F.sum((F.col("n") > 0).cast("long")).alias("N"), F.sum("n").alias("L")).first()
    n_docs, n_terms = totals["N"] or 0, totals["L"] or 0
    if not n_terms:
        return spark.createDataFrame([], T.StructType([schema["item_id"], T.StructField("rank", T.IntegerType()), schema["doc_id"], schema["score"]]))
    df = found.select(F.explode("h").alias("h")).groupBy("h").agg(F.count("*").alias("df"))
    weights = df.select("h", F.floor(1000 * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long").alias("w"))
    plans = _plans(terms, weights, folder)

    def score(batches):
        held = [_read(path) for path in plans] if len(plans) == 1 else None
        best: dict[int, _Best] = {}
        ids: dict[int, list] = {}
        for batch in batches:
            doc_ids = batch.column("doc_id").fill_null(NO_ID).to_numpy()
            n = batch.column("n").to_numpy()
            m = 75 + np.array([25 * x * n_docs // n_terms for x in n.tolist()], np.int64)
            lists = batch.column("h")
            at = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int64)
            h, tf = lists.flatten().to_numpy(), batch.column("tf").flatten().to_numpy()
            for p, path in enumerate(plans):
                plan = held[p] if held else _read(path)
                if p not in best:
                    best[p], ids[p] = _Best(len(plan.ids), k), plan.ids
                for lo in range(0, len(n), DOCUMENTS):
                    hi = min(len(n), lo + DOCUMENTS)
                    part = slice(at[lo], at[hi])
                    doc = np.repeat(np.arange(hi - lo), np.diff(at[lo : hi + 1]))
                    best[p].add(plan.scores(doc, h[part], tf[part], m[lo:hi]), doc_ids[lo:hi])
        for p, kept in best.items():
            item, doc, value = kept.cut()
            names = pa.array([ids[p][i] for i in item.tolist()], type=to_arrow_type(kind))
            yield pa.RecordBatch.from_arrays([names, pa.array(doc, mask=doc == NO_ID), pa.array(value)], names=["item_id", "doc_id", "score"])

    few = found.filter(F.size("h") > 0).mapInArrow(score, schema)
    place = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id")))
    return few.withColumn("rank", place).filter(F.col("rank") <= k).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")

