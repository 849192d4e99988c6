"""Compression of vectors to codes: one codebook for each of PARTS consecutive parts, by Lloyd's rounds.

Members stay where they are. Every part of a vector is a member of a codebook entry, and members are partitioned by owner
(position, entry, salt); the salt is a hash of the row, so an entry that most vectors share has many
owners. The first assignment deals all members out. In each round the owners sum their resident members, one row an
entry and partition; the new codebooks (PARTS x entries) go out with the next task closures; each owner then assigns its
members anew, those that stay are kept in their partition, and only those whose entry changes
travel, to the partition of their new owner. Residents and arrivals are united partition by
partition, as both have one partitioner; a task holds its members as packed arrays.

Values become floor(SCALE * x) and everything is integer arithmetic, exact whatever the order of
sums: distances are 64-bit, sums and means are unbounded.

Losing an executor loses resident members; they come back from the table of kept vectors, which is
written to the shared folder first, through the rounds' assignments, whose codebooks are constants.

Defined cases: vectors that are null or empty or have null or non-finite components are dropped, as are those with a
component of 2^17 or more (whose distances can exceed 64 bits). The kept vector with the smallest
vec_id (a null one is largest) whose length is a multiple of the parts sets the length; others are dropped.
Rows that repeat a vec_id are vectors of their own, ordered by value where the first entries are
taken. With fewer vectors than entries there are as many entries as vectors. An empty table gives an
empty result. No other column is carried.
"""

from __future__ import annotations

import hashlib
import pickle

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._spark import hot_lookup, stored
from tessera.llm._text import mix

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
LIMIT = 1 << 17
#: Members of a partition, about.
MEMBERS = 1 << 19
#: Members whose distances are in memory at once.
AT_ONCE = 1 << 14


def keep_vectors(vectors: DataFrame, parts: int = PARTS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """row, vec_id, label, v of the vectors that are kept, as a stored table; row is a number of its own."""
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    # NaN is larger than any limit
    sound = rows.filter(F.col("v").isNotNull() & F.forall("v", lambda x: F.coalesce(F.abs(x) < LIMIT, F.lit(False))) & (F.size("v") > 0) & (F.size("v") % parts == 0))
    first = sound.orderBy(F.asc_nulls_last("vec_id"), "v").select(F.size("v").alias("n")).first()
    return stored(sound.filter(F.size("v") == (first["n"] if first else 0)).select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "v"), "vectors")


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of x the index of the nearest entry, the lower of equal ones, and its squared distance."""
    best, distance = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    for lo in range(0, len(x), AT_ONCE):
        part = x[lo : lo + AT_ONCE]
        d = np.zeros((len(part), len(entries)), np.int64)
        for j in range(x.shape[1]):
            d += (part[:, j, None] - entries[None, :, j]) ** 2
        best[lo : lo + AT_ONCE] = d.argmin(axis=1)
        distance[lo : lo + AT_ONCE] = d.min(axis=1)
    return best, distance


class Owners:
    """Where the members of (position, entry, salt) live."""

    def __init__(self, parts: int, entries: int, salts: int, partitions: int):
        self.parts, self.entries, self.salts, self.partitions = parts, entries, salts, partitions

    def __call__(self, row: np.ndarray, position: np.ndarray, entry: np.ndarray) -> np.ndarray:
        salt = mix(row.astype(np.uint64)) % np.uint64(self.salts)
        return ((position * self.entries + entry) * self.salts + salt.astype(np.int64)) % self.partitions


class Members:
    """Packed arrays: of each member its row, position, entry and values, sorted by position."""

    def __init__(self, row: np.ndarray, position: np.ndarray, entry: np.ndarray, x: np.ndarray):
        self.row, self.position, self.entry, self.x = row, position, entry, x

    def take(self, at: np.ndarray) -> Members:
        return Members(self.row[at], self.position[at], self.entry[at], self.x[at])

    def by_owner(self, owners: Owners):
        """(partition, members) of all, each partition once."""
        home = owners(self.row, self.position, self.entry)
        order = np.lexsort((self.position, home))
        bounds = np.flatnonzero(np.concatenate([[True], np.diff(home[order]) > 0, [True]])) if len(order) else []
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            yield int(home[order[lo]]), self.take(order[lo:hi])

    def assigned(self, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and distance of each member under new codebooks."""
        entry, distance = np.empty(len(self.row), np.int64), np.empty(len(self.row), np.int64)
        for p in np.unique(self.position):
            at = np.flatnonzero(self.position == p)
            entry[at], distance[at] = nearest(self.x[at].astype(np.int64), codebooks[p])
        return entry, distance


def together(members: list[Members]) -> Members:
    return Members(*(np.concatenate([getattr(m, a) for m in members]) for a in ("row", "position", "entry", "x")))


def _home(partition: int) -> int:
    return partition


def _first_members(kept: DataFrame, codebooks: np.ndarray, owners: Owners):
    """All members, dealt to their owners by the first codebooks."""
    parts = len(codebooks)

    def packed(batches):
        for batch in batches:
            column = batch.column("v")
            n = len(batch)
            x = np.floor(column.flatten().to_numpy().reshape(n * parts, -1) * SCALE).astype(np.int32)
            row = np.repeat(batch.column("row").to_numpy(), parts)
            position = np.tile(np.arange(parts), n)
            members = Members(row, position.astype(np.int8), np.zeros(n * parts, np.int8), x)
            members.entry = members.assigned(codebooks)[0].astype(np.int8)
            out = list(members.by_owner(owners))
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in out], pa.int64()), pa.array([pickle.dumps(m, protocol=5) for _, m in out], pa.binary())], names=["home", "members"])

    def unpack(row):
        return row["home"], pickle.loads(row["members"])

    dealt = kept.select("row", "v").mapInArrow(packed, "home long, members binary").rdd.map(unpack)
    return dealt.partitionBy(owners.partitions, _home)


def _sums(state, parts: int, entries: int) -> dict[tuple[int, int], tuple[list[int], int]]:
    """Component sums and numbers of members for each (position, entry); the driver gets one row each."""

    def of_owner(members):
        totals: dict[tuple[int, int], tuple[list[int], int]] = {}
        for _, m in members:
            key = m.position.astype(np.int64) * entries + m.entry
            order = np.argsort(key, kind="stable")
            first = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) > 0])) if len(key) else np.zeros(0, np.int64)
            sums = np.add.reduceat(m.x[order].astype(np.int64), first, axis=0) if len(key) else []
            for k, s, n in zip(key[order][first].tolist(), sums, np.diff(np.append(first, len(key))).tolist(), strict=True):
                old = totals.get(divmod(k, entries), ([0] * len(s), 0))
                totals[divmod(k, entries)] = ([a + b for a, b in zip(old[0], s.tolist(), strict=True)], old[1] + n)
        return iter(totals.items())

    def add(a, b):
        return [x + y for x, y in zip(a[0], b[0], strict=True)], a[1] + b[1]

    return dict(state.mapPartitions(of_owner).reduceByKey(add, parts).collect())


def _migrated(state, codebooks: np.ndarray, owners: Owners):
    """The state after an assignment: members that keep their entry stay, the others go to their new owners."""

    def split(members):
        for home, m in members:
            entry = m.assigned(codebooks)[0].astype(np.int8)
            stays = entry == m.entry
            if stays.any():
                yield home, m.take(np.flatnonzero(stays))
            if not stays.all():
                leaving = m.take(np.flatnonzero(~stays))
                leaving.entry = entry[~stays]
                yield -1, leaving

    def arrivals(pairs):
        left = [m for home, m in pairs if home < 0]
        return together(left).by_owner(owners) if left else iter(())

    def one(pairs):
        """A partition's residents and arrivals as one packed group."""
        pairs = list(pairs)
        if pairs:
            yield pairs[0][0], together([m for _, m in pairs])

    marked = state.mapPartitions(split, preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK)
    residents = marked.filter(lambda pair: pair[0] >= 0)
    # a filter keeps the partitioner only if told so
    residents = residents.mapPartitions(lambda pairs: pairs, preservesPartitioning=True)
    residents.partitioner = state.partitioner
    moved = marked.mapPartitions(arrivals).partitionBy(owners.partitions, _home)
    both = residents.union(moved)
    return both.mapPartitions(one, preservesPartitioning=True).persist(StorageLevel.MEMORY_AND_DISK), marked


def fit_codes(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """row, position, entry, distance of every part of the kept vectors, and the final codebooks (parts x entries x width).

    At most 127 entries and parts. The result is read from the state of the last round.
    """
    spark = kept.sparkSession
    first = kept.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()
    start = np.floor(np.array([row["v"] for row in first]) * SCALE).astype(np.int64)
    codebooks = np.stack(np.split(start, parts, axis=1))
    entries, count = len(first), kept.count()
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count * parts // MEMBERS))
    owners = Owners(parts, entries, max(32, 4 * -(-count // MEMBERS)), partitions)
    state = _first_members(kept, codebooks, owners).persist(StorageLevel.MEMORY_AND_DISK)
    for r in range(rounds):
        done = []
        if r:
            old = state
            state, marked = _migrated(old, codebooks, owners)
            done = [old, marked]
        codebooks = codebooks.copy()
        for (position, entry), (total, n) in _sums(state, parts, entries).items():
            codebooks[position, entry] = [s // n for s in total]
        for rdd in done:
            rdd.unpersist()

    def result(members):
        for _, m in members:
            entry, distance = m.assigned(codebooks)
            yield (np.concatenate([m.row, m.position.astype(np.int64), entry, distance]).astype("<i8").tobytes(),)

    def unpacked(batches):
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                columns = np.frombuffer(packed, "<i8").reshape(4, -1)
                for lo in range(0, columns.shape[1], AT_ONCE):
                    yield pa.RecordBatch.from_arrays([pa.array(c[lo : lo + AT_ONCE]) for c in columns], names=["row", "position", "entry", "distance"])

    final = spark.createDataFrame(state.mapPartitions(result), "packed binary")
    found = stored(final.mapInArrow(unpacked, "row long, position long, entry long, distance long"), "codes")
    state.unpersist()
    return found, codebooks


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, code (an array, one entry a part), error, label_error; and the codebooks."""
    kept = keep_vectors(vectors, parts, id_col, vector_col, label_col)
    spark = vectors.sparkSession
    if not kept.limit(1).count():
        nothing = kept.select("vec_id", "label", F.array().cast("array<long>").alias("code"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"))
        return spark.createDataFrame([], nothing.schema), np.zeros((parts, 0, 0), np.int64)
    found, codebooks = fit_codes(kept, parts, entries, rounds)
    # of each row the sum, and its entries at their positions in order: one byte each
    code = F.sort_array(F.collect_list(F.struct("position", "entry")))
    per_row = found.groupBy("row").agg(F.sum("distance").alias("error"), F.transform(code, lambda s: s["entry"]).alias("code"))
    rows = stored(kept.select("row", "vec_id", "label").join(per_row, "row").drop("row").withColumn("key", F.xxhash64(F.col("label").isNull(), F.col("label").cast("string"))), "rows")
    totals = rows.groupBy("key").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    return hot_lookup(rows, totals, "key", ["label_error"], "n", rows.count()).select("vec_id", "label", "code", "error", "label_error"), codebooks


def codebooks_digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()
