"""Exact n-gram Jaccard self-join by vertical partitioning, and its connected components.

Two documents link when their sets of 5-word shingles have a Jaccard similarity of at least 0.8.
Equal sets are one class; all steps after that work on one row a class.

1. Sieve. In any global order of the shingles, the first n - ceil(0.8 n) + l of a set of n hold at
   least l shingles of a linked set's own first part. With the order of the hashes and l = n / 20,
   a class whose first quarter has fewer than 0.04 n shingles in common with other classes links
   with nothing; common passages inside otherwise different texts fall through here.
2. Order. The sieved classes' shingles are counted; those of one class only can't overlap and go.
   The rest are ordered by (log2 of the count, hash), rare first.
3. Vertical partitioning. The global order is cut into `FRAGMENTS` fragments, each a run of it; a
   class's ordered set falls into segments, one a fragment.
4. Candidates. Classes that share a shingle of their prefixes meet in that shingle's group. A group
   emits no pairs of all its members: each round takes a few pivots of it from outside its largest
   component (the smallest by a hash that is the same in all groups) and pairs them with the
   members that are in another component so far and have enough shingles from there on. Pivots then leave the group, found links merge
   components, and groups within one component are done. Every pair is so either compared or known
   to be connected. A group whose m members don't link takes about m / `MOST_PIVOTS` rounds.
5. Partial overlaps. For each candidate pair the segments of a fragment are intersected separately
   and the counts are summed per pair; 100 * overlap >= 80 * union makes a link.

Hot shingles, pivots and copies are split by `hot_lookup`; no group is collected anywhere.

Defined cases: null or empty text has the empty set and links with nothing, itself being its
component; fewer than five words make one shingle; rows that repeat a row get the same component;
a row without doc_id takes part, and its component_id is the smallest known id it reaches (null
if none); rows that repeat an id with another text are compared like all others; an empty table
gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._spark import BROADCAST_ROWS, connected, hot_lookup, stored
from tessera.llm._text import LOWER, NON_SPACE, flat, row_sets, shingle_hashes, slices, word_hashes, words

K = 5
FRAGMENTS = 8
HOT_PIVOTS = 200
#: Segments of at most so many shingles (8 bytes each) are broadcast whatever their pivots' pairs.
BROADCAST_SHINGLES = 1_000_000
#: Pivots of a group in each round: one, then so many times more, up to a most.
MORE_PIVOTS, MOST_PIVOTS = 32, 512
SLICE_BYTES = 2 << 20


def _at_least(n):
    """ceil(0.8 n), exactly."""
    return (8 * n + 9) // 10


def _sets(docs: DataFrame, first_part: bool) -> DataFrame:
    """doc_id, n, set key (k1, k2) and the sorted hashes of the set (or the first part the sieve needs, or none)."""

    def run(batches):
        for batch in batches:
            data, bounds = flat(batch.column("text"))
            for lo, hi in slices(bounds, SLICE_BYTES):
                part = LOWER[data[bounds[lo] : bounds[hi]]]
                starts, ends, at = words(part, bounds[lo : hi + 1] - bounds[lo], NON_SPACE)
                h, at = row_sets(*shingle_hashes(word_hashes(part, starts, ends), at, K))
                n = np.diff(at)
                keys = np.frombuffer(b"".join(hashlib.blake2b(h[a:z].tobytes(), digest_size=16).digest() for a, z in zip(at[:-1], at[1:], strict=True)), np.int64).reshape(-1, 2)
                if first_part:
                    take = n - _at_least(n) + np.maximum(1, n // 20)
                    take = np.minimum(take, n)
                    keep = np.arange(len(h)) - np.repeat(at[:-1], n) < np.repeat(take, n)
                    h, at = h[keep], np.concatenate([[0], np.cumsum(take)])
                hashes = pa.LargeListArray.from_arrays(at, h.view(np.int64)).cast(pa.list_(pa.int64()))
                rows = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(n, pa.int64()), pa.array(keys[:, 0]), pa.array(keys[:, 1]), hashes], names=["doc_id", "n", "k1", "k2", "hashes"])

    return docs.mapInArrow(run, "doc_id long, n long, k1 long, k2 long, hashes array<long>")


def _sieve(docs: DataFrame, parts: DataFrame) -> DataFrame:
    """Classes that may link: k1, k2, n, id and a node number (fixed by storing the table); parts are the sets' first parts."""
    classes = parts.groupBy("k1", "k2").agg(F.first("n").alias("n"), F.min("doc_id").alias("id"), F.first("hashes").alias("hashes")).filter("n > 0")
    # classes are told apart by id where there is one: ids compress far better than keys in the shuffles
    tag = F.coalesce("id", F.col("k1"))
    tokens = classes.select(tag.alias("tag"), F.explode("hashes").alias("h"))
    # a class has each of its shingles once, so a count above one tells of another class; counting
    # the tag (never null) keeps it in the plan, so that both reads of the classes share one shuffle
    shared = tokens.groupBy("h").agg(F.count("tag").alias("df")).filter("df > 1").select("h", "df", F.lit(True).alias("shared"))
    # a word takes two bytes at least and a first part holds a quarter of a set and two more at most
    size = docs.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("rows")).first()
    total = (size["bytes"] or 0) // 8 + 2 * size["rows"]
    found = hot_lookup(tokens, shared, "h", ["shared"], "df", total, inner=True).groupBy("tag").agg(F.count("*").alias("found"))
    # a linked class has 0.8 n shingles at least, and its own part is so much smaller
    enough = F.col("found") >= F.greatest(F.lit(1), F.floor(F.floor(F.col("n") * 8 / 10) / 20))
    kept = classes.select("k1", "k2", "n", "id", tag.alias("tag")).join(found, "tag").filter(enough)
    return kept.select("k1", "k2", "n", "id").withColumn("node", F.monotonically_increasing_id())


def _checked(rows: DataFrame, n: int) -> DataFrame:
    """rows, to be broadcast if there are few enough; else the join is by shuffle."""
    return F.broadcast(rows) if n <= BROADCAST_ROWS else rows


def _ordered(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """node, n, set, bits: the shingles that another class has too, in the global order.

    bits is the parity, for 256 hash values, of how many of them have that value.
    """
    route = F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long"))
    wanted = kept.select(F.coalesce("id", F.lit(-(1 << 63)).cast("long")).alias("route")).distinct()
    size = kept.count()
    texts = docs.withColumn("route", route).join(_checked(wanted, size), "route", "left_semi").select("doc_id", "text")
    sets = _sets(texts, first_part=False).select("k1", "k2", "hashes").join(_checked(kept, size), ["k1", "k2"])
    # only where ids repeat (or are missing) can a class come from several rows
    again = docs.select(route.alias("route")).join(_checked(wanted, size), "route", "left_semi").groupBy("route").count().filter("count > 1")
    if again.limit(1).count():
        sets = sets.dropDuplicates(["node"])
    tokens = sets.select("node", F.explode("hashes").alias("h"))
    counted = tokens.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1")
    total = kept.agg(F.sum("n")).first()[0] or 0
    found = hot_lookup(tokens, counted, "h", ["df"], "df", total, inner=True)
    # the global order is (rarity, h)
    whole = found.select("node", F.struct(F.floor(F.log2("df")).cast("int").alias("rarity"), "h").alias("t"))
    parity = [F.expr(f"bit_xor(if((t.h & 3L) = {i}L, shiftleft(1L, cast(shiftright(t.h, 2) & 63L as int)), 0L))").alias(f"b{i}") for i in range(4)]
    # once a node, before anything is generated from the set
    ordered = whole.groupBy("node").agg(F.sort_array(F.collect_list("t")).alias("set"), *parity)
    bits = F.struct("b0", "b1", "b2", "b3").alias("bits")
    return stored(ordered.join(_checked(kept.select("node", "n"), size), "node").select("node", "n", "set", bits), "ordered")


def _segments(ordered: DataFrame) -> DataFrame:
    """node, fragment, hashes: the parts of each ordered set."""
    parts = [F.struct(F.lit(f).alias("fragment"), F.transform(F.filter("set", _in_fragment(f)), lambda t: t["h"]).alias("hashes")) for f in range(FRAGMENTS)]
    return ordered.select("node", F.explode(F.array(*parts)).alias("s")).select("node", "s.fragment", "s.hashes").filter(F.size("hashes") > 0)


def _in_fragment(fragment: int):
    """Each fragment is a run of the global order: two a rarity, the last two of all rarities from there on."""
    rarity = fragment // 2 + 1
    last = rarity == FRAGMENTS // 2

    def inside(t):
        mine = t["rarity"] >= rarity if last else t["rarity"] == rarity
        return mine & (t["h"] >= 0 if fragment % 2 else t["h"] < 0)

    return inside


def _prefix(ordered: DataFrame) -> DataFrame:
    """h, node, n, rest, lone, bits of the prefixes: rest counts the set's shingles from h on.

    lone counts those that no other class has.
    Shingles of one class only come first in the order and use the prefix up.
    """
    size = F.col("n") - F.floor((8 * F.col("n") + 9) / 10) + 1 - (F.col("n") - F.size("set"))
    rows = ordered.filter(size > 0).select("node", "n", F.size("set").alias("shared"), "bits", F.posexplode(F.slice("set", F.lit(1), size.cast("int"))).alias("at", "t"))
    return rows.select("t.h", "node", "n", (F.col("shared") - F.col("at")).cast("long").alias("rest"), (F.col("n") - F.col("shared")).alias("lone"), "bits")


def _linked(pairs: DataFrame, pivots: DataFrame, segments: DataFrame) -> DataFrame:
    """The labels (a, b) of the pairs (a, b, nb, lb) that link, by partial overlaps of each fragment; pivots has a, na, la.

    The pivots' segments are broadcast if they are few enough. Else those of pivots with more than one
    in HOT_PIVOTS of the pairs are, which are fewer than that, and the others are joined by shuffle.
    """
    n = pairs.count()
    mine = segments.select(F.col("node").alias("a"), "fragment", F.col("hashes").alias("mine"))
    theirs = segments.select(F.col("node").alias("b"), "fragment", F.col("hashes").alias("theirs"))
    overlap = F.size(F.array_intersect("mine", "theirs")).cast("long").alias("overlap")
    if n <= BROADCAST_ROWS and (pivots.agg(F.sum("na")).first()[0] or 0) <= BROADCAST_SHINGLES:
        pairs = pairs.join(F.broadcast(pivots), "a")
        hot, few = F.broadcast(pivots.select("a")), None
    else:
        per_pivot = pairs.groupBy("a").agg(F.count("*").alias("pairs")).join(pivots, "a")
        pairs = hot_lookup(pairs, per_pivot, "a", ["na", "la"], "pairs", n)
        share = max(1, n // HOT_PIVOTS)
        hot, rest = (F.broadcast(per_pivot.filter(F.col("pairs") > share).select("a")), per_pivot.filter(F.col("pairs") <= share).select("a"))
        few = theirs.join(_checked(pairs.join(hot, "a", "left_anti"), n), "b").join(mine.join(_checked(rest, n), "a", "left_semi"), ["a", "fragment"])
        pairs = pairs.join(hot, "a", "left_semi")
    many = theirs.join(_checked(pairs, n), "b").join(F.broadcast(mine.join(hot, "a", "left_semi")), ["a", "fragment"])
    pair = ["a", "na", "la", "b", "nb", "lb"]
    partial = many.select(*pair, overlap)
    if few is not None:
        partial = partial.unionByName(few.select(*pair, overlap))
    total = partial.groupBy(*pair).agg(F.sum("overlap").alias("overlap"))
    return total.filter(100 * F.col("overlap") >= 80 * (F.col("na") + F.col("nb") - F.col("overlap"))).select(F.col("la").alias("a"), F.col("lb").alias("b"))


def _may_link(p):
    """Whether a member of a group (node, n, rest, lone, bits, label, own) is to be compared with its pivot p.

    If h is the first shingle that both share, their overlap is at most the smaller rest; it has to
    be 4/9 of both sizes. A pair that links so passes in the group of its first shared shingle. Of
    two pivots, the larger node is compared with the smaller. The shingles that only one of both has
    may be a ninth of both sizes; they are at least the lone ones and the bits that differ.
    """
    sizes = (10 * F.least(p["n"], "n") >= 8 * F.greatest(p["n"], "n")) & (9 * F.least(p["rest"], "rest") >= 4 * (p["n"] + F.col("n")))
    differ = sum((F.bit_count(p["bits"][f"b{i}"].bitwiseXOR(F.col(f"bits.b{i}"))) for i in range(4)), p["lone"] + F.col("lone"))
    return (p["label"] != F.col("label")) & sizes & (9 * differ <= p["n"] + F.col("n")) & (~F.col("own") | (p["node"] < F.col("node")))


def _components(ordered: DataFrame) -> DataFrame | None:
    """node, label of the classes that link with another."""
    # done: up to which place the members outside a group's largest component have been pivots
    groups = stored(_prefix(ordered).withColumn("label", F.col("node")).withColumn("done", F.lit(0.0)), "groups")
    segments, labels, pivots = _segments(ordered), None, 1
    total = groups.count()
    while total:
        # at first each class is a component of its own
        per_label = groups.groupBy("h", "label").agg(F.count("*").alias("c"), F.max("done").alias("done")) if labels is not None else groups.select("h", "label", F.lit(1).cast("long").alias("c"), "done")
        sizes = per_label.groupBy("h").agg(F.sum("c").alias("size"), F.count("*").alias("labels"), F.max(F.struct("c", "label")).alias("top"), F.max("done").alias("done")).filter("labels > 1")
        # those left have places from done on, so this share of the rest has as many pivots as wanted;
        # 1 - done shrinks in each round, also in one that has no pivot in a group, so all get their turn
        upto = F.col("done") + (1 - F.col("done")) * F.least(F.lit(1.0), pivots / (F.col("size") - F.col("top.c")))
        sizes = sizes.select("h", "size", F.col("top.label").alias("major"), upto.alias("upto"))
        live = stored(hot_lookup(groups.drop("done"), sizes, "h", ["size", "major", "upto"], "size", total, inner=True), "live")
        total = live.count()
        if not total:
            break
        # every pair of two labels has a member outside the largest: only those are pivots, a few a round
        place = F.pmod(F.xxhash64("node"), F.lit(1 << 32)) / float(1 << 32)
        is_pivot = (F.col("label") != F.col("major")) & (place < F.col("upto"))
        members = live.withColumn("own", is_pivot).select("h", "node", "n", "rest", "lone", "bits", "label", "size", "own")
        chosen = members.filter("own").groupBy("h", "size").agg(F.collect_list(F.struct("node", "n", "rest", "lone", "bits", "label")).alias("p"))
        met = hot_lookup(members.drop("size"), chosen, "h", ["p"], "size", total, inner=True).select("node", "n", "label", F.transform(F.filter("p", _may_link), lambda p: p["node"]).alias("p"))
        met = met.filter(F.size("p") > 0).groupBy("node", "n", "label").agg(F.array_distinct(F.flatten(F.collect_list("p"))).alias("p"))
        pairs = stored(met.select(F.explode("p").alias("a"), F.col("node").alias("b"), F.col("n").alias("nb"), F.col("label").alias("lb")), "pairs")
        known = members.filter("own").select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("label").alias("la")).distinct()
        merged = connected(_linked(pairs, known, segments)).select(F.col("node").alias("label"), F.col("label").alias("new"))
        groups = stored(_relabel(live.filter(~is_pivot).select("h", "node", "n", "rest", "lone", "bits", "label", F.col("upto").alias("done")), merged), "groups")
        total = groups.count()
        # labels has the nodes that aren't labels themselves; merged those that no longer are
        fresh = merged.select(F.col("label").alias("node"), F.col("new").alias("label"))
        labels = stored(fresh if labels is None else fresh.unionByName(_relabel(labels, merged)), "labels")
        pivots = min(MOST_PIVOTS, MORE_PIVOTS * pivots)
    return labels if labels is None else labels.unionByName(labels.select(F.col("label").alias("node"), "label").distinct())


def _relabel(rows: DataFrame, merged: DataFrame) -> DataFrame:
    if merged.count() <= BROADCAST_ROWS:
        out = rows.join(F.broadcast(merged), "label", "left")
    else:
        per_label = rows.groupBy("label").agg(F.count("*").alias("rows"))
        out = hot_lookup(rows, merged.join(per_label, "label"), "label", ["new"], "rows", rows.count())
    return out.select(*[c for c in rows.columns if c != "label"], F.coalesce("new", "label").alias("label"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, class_id (the smallest id of the rows with the same set)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # read for the classes, their tokens and the result: the texts are hashed for it once
    parts = stored(_sets(rows, first_part=True), "parts")
    kept = stored(_sieve(rows, parts), "kept")
    labels = _components(_ordered(rows, kept))
    keys = parts.drop("hashes")
    classes = keys.groupBy("k1", "k2").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("copies"))
    if labels is not None:
        named = labels.join(kept.select("node", "k1", "k2", "id"), "node")
        least = named.groupBy("label").agg(F.min("id").alias("least"), F.count("*").alias("classes"))
        named = hot_lookup(named, least, "label", ["least"], "classes", kept.count()).select("k1", "k2", "least")
        classes = classes.join(named, ["k1", "k2"], "left")
    else:
        classes = classes.withColumn("least", F.lit(None).cast("long"))
    classes = classes.select("k1", "k2", "class_id", F.coalesce("least", "class_id").alias("component"), "copies")
    # one row a class goes to its copies; the empty set (no shingles) is no class
    keyed = keys.withColumn("key", F.xxhash64("k1", "k2"))
    share = max(1, keys.count() // 1000)
    hot = classes.filter(F.col("copies") > share)
    some = keyed.join(F.broadcast(hot.select("k1", "k2", F.col("class_id").alias("hot_class"), F.col("component").alias("hot_component"), F.lit(True).alias("is_hot"))), ["k1", "k2"], "left")
    some = some.withColumn("j1", F.when(F.col("is_hot"), F.xxhash64("doc_id")).otherwise(F.col("k1"))).withColumn("j2", F.when(F.col("is_hot"), F.lit(0)).otherwise(F.col("k2"))).withColumn("cold", F.col("is_hot").isNull())
    out = some.join(classes.filter(F.col("copies") <= share).select(F.col("k1").alias("j1"), F.col("k2").alias("j2"), F.lit(True).alias("cold"), "class_id", "component"), ["j1", "j2", "cold"], "left")
    empty = F.col("n") == 0
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(empty, F.col("doc_id")).when(F.col("is_hot"), F.col("hot_component")).otherwise(F.col("component")).alias("component_id"),
        F.when(empty, F.col("doc_id")).when(F.col("is_hot"), F.col("hot_class")).otherwise(F.col("class_id")).alias("class_id"),
    )
