"""Rating models: bias baseline, biases of ids and of their attributes, factor fitting, factor scoring.

Scoring joins the fact table to user and item factor tables (size-checked
broadcast or shuffle join) and evaluates u.m + biases as array expressions;
no per-row Python.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import clip, dot
from tessera.operators.dictionary import dictionary
from tessera.operators.joins import lookup
from tessera.session import checkpoint_dir, cut_lineage

#: Ratings are dealt to so many parts at least, and to more where a part would have over PART_ROWS.
PARTS, PART_ROWS = 12, 10_000_000
#: MLlib's blocks of ratings, each of which a task sorts in its heap: so many at least (its default), and more where one would have over BLOCK_ROWS.
ALS_BLOCKS, BLOCK_ROWS = 10, 4_000_000


def parts_of(rows: int) -> int:
    """Parts to deal ``rows`` ratings to: few, so that sums by the other id combine where they are made, and of bounded size."""
    return max(PARTS, -(-rows // PART_ROWS))


def blocks_of(rows: int) -> int:
    """Blocks a side in which ALS stores ``rows`` ratings."""
    return max(ALS_BLOCKS, -(-rows // BLOCK_ROWS))


def deal(ratings: DataFrame, key: str, parts: int) -> DataFrame:
    """Ratings stored by an id, in its order: ``lookup_dealt`` by that id moves none of them.

    Planned without AQE, whose plans do not tell a checkpoint how its rows are partitioned and sorted.
    """
    conf, name = ratings.sparkSession.conf, "spark.sql.adaptive.enabled"
    before = conf.get(name)
    conf.set(name, "false")
    try:
        return cut_lineage(ratings.repartition(parts, key).sortWithinPartitions(key))
    finally:
        conf.set(name, before)


def lookup_dealt(ratings: DataFrame, dim: DataFrame, key: str, parts: int | None, how: str = "left") -> DataFrame:
    """``lookup`` on ratings dealt by ``key``: only the ids' table is shuffled, to the same parts. Without ``parts`` a plain lookup."""
    return lookup(ratings, dim.repartition(parts, key) if parts else dim, key, how)


def bias_baseline(ratings: DataFrame, user: str, item: str, rating: str, reg: float = 0.0):
    """Global mean, user bias and item bias (one pass each, partial aggregation)."""
    mu = ratings.agg(F.avg(rating)).first()[0]
    bu = ratings.groupBy(user).agg((F.sum(F.col(rating) - mu) / (F.count(F.lit(1)) + reg)).alias("b_user"))
    r2 = lookup(ratings, bu, user, "left")
    bi = r2.groupBy(item).agg((F.sum(F.col(rating) - mu - F.col("b_user")) / (F.count(F.lit(1)) + reg)).alias("b_item"))
    return mu, bu, bi


@dataclass
class Side:
    """One side of the ratings: its id and which biases it has.

    ``own``: a bias of the id itself; ``one``: columns of ``table`` whose value has a bias (gender,
    age, occupation, era); ``many``: array columns whose elements' biases are summed (genres).
    """

    key: str
    table: DataFrame
    one: list[str] = field(default_factory=list)
    many: list[str] = field(default_factory=list)
    own: bool = True


@dataclass
class Biases:
    """Fitted biases: the mean, per id ``offset`` (the sum of all its biases), per attribute (level, bias)."""

    mu: float
    user: DataFrame
    item: DataFrame
    blocks: dict[str, DataFrame]


def fit_biases(ratings: DataFrame, user: Side, item: Side, rating: str, epochs: int = 10, reg: float = 1.0,
               parts: int | None = None) -> Biases:
    """mean + id biases + attribute biases by block coordinate descent on squared error + reg |bias|^2.

    Every attribute belongs to an id, so all blocks of a side are fitted on one row per id: how many
    ratings it has and the sum of what they leave unexplained. Ratings are read twice an epoch (once a
    side: the other side's offsets summed per id), whatever the number of blocks. They are stored once by
    each id in few parts, so an epoch shuffles ids and their partial sums, no ratings. A level's
    step is (sum of residuals - reg * bias) / (weight + reg). With one level a row the weight is the number
    of ratings and the step solves the block's normal equations; with several (genres) each rating
    weighs as much as it has levels, which bounds the block's curvature, so no step raises the error.

    Ids that no rating has are not in the result; NULL ids of ratings are dropped; NULL levels and
    empty arrays have no bias; a level named twice in an array counts once; ids of any type.
    ``parts``: set where ``ratings`` were dealt by the user's id to so many parts (``deal``).
    """
    sound = ratings.filter(F.col(user.key).isNotNull() & F.col(item.key).isNotNull() & F.col(rating).isNotNull())
    mu, rows = sound.agg(F.avg(rating), F.count(F.lit(1))).first()
    if mu is None:
        mu = 0.0
    sides = {"user": user, "item": item}
    state = {name: cut_lineage(_start(sound, side, rating, mu)) for name, side in sides.items()}
    ids = sound.select(user.key, item.key)
    dealt = {"user": ids if parts else deal(ids, user.key, parts_of(rows))}
    parts = parts or parts_of(rows)
    dealt["item"] = deal(ids, item.key, parts)
    blocks: dict[str, DataFrame] = {}
    for _ in range(epochs):
        for name, other in (("user", "item"), ("item", "user")):
            side, seen = sides[name], sides[other].key
            carried = lookup_dealt(dealt[other], state[other].select(seen, "offset"), seen, parts, "inner") \
                .groupBy(side.key).agg(F.sum("offset").alias("__carried"))
            t = state[name].join(carried, side.key).withColumn(
                "__r", F.col("__s") - F.col("__carried") - F.col("__n") * F.col("offset")).drop("__carried")
            if side.own:
                t = _shift(t.withColumn("__d", (F.col("__r") - reg * F.col("own")) / (F.col("__n") + reg)), own=True)
            t = cut_lineage(t)
            for col in [*side.one, *side.many]:
                t, blocks[col] = _fit_block(t, side.key, col, col in side.many, blocks.get(col), reg)
                t = cut_lineage(t)
            state[name] = t.drop("__r")
    out = {name: state[name].select(sides[name].key, "offset", "own") for name in sides}
    return Biases(float(mu), out["user"], out["item"], blocks)


def _start(ratings: DataFrame, side: Side, rating: str, mu: float) -> DataFrame:
    """A row per id: its attributes, number of ratings (__n), their sum above the mean (__s), biases of 0."""
    sums = ratings.groupBy(side.key).agg(F.count(F.lit(1)).alias("__n"), F.sum(F.col(rating) - F.lit(mu)).alias("__s"))
    known = side.table.select(side.key, *side.one, *[F.array_compact(F.array_distinct(m)).alias(m) for m in side.many]).dropDuplicates([side.key])
    return sums.join(known, side.key, "left").withColumn("offset", F.lit(0.0)).withColumn("own", F.lit(0.0))


def _shift(t: DataFrame, own: bool = False) -> DataFrame:
    """Adds the step __d of each id to its offset."""
    t = t.withColumn("offset", F.col("offset") + F.col("__d")).withColumn("__r", F.col("__r") - F.col("__n") * F.col("__d"))
    return (t.withColumn("own", F.col("own") + F.col("__d")) if own else t).drop("__d")


def _fit_block(t: DataFrame, key: str, col: str, many: bool, old: DataFrame | None, reg: float):
    level = F.explode(col) if many else F.col(col)
    weight = F.col("__n") * F.size(col) if many else F.col("__n")
    rows = t.select(key, "__r", weight.alias("__w"), level.alias("level")).filter(F.col("level").isNotNull())
    sums = rows.groupBy("level").agg(F.sum("__r").alias("__r"), F.sum("__w").alias("__w"))
    sums = sums.join(old, "level") if old is not None else sums.withColumn("bias", F.lit(0.0))
    step = (F.col("__r") - reg * F.col("bias")) / (F.col("__w") + reg)
    steps = cut_lineage(sums.select("level", "bias", step.alias("__d")))
    d = steps.select("level", "__d")
    if many:
        moved = lookup(rows.select(key, "level"), d, "level", "inner").groupBy(key).agg(F.sum("__d").alias("__d"))
        t = t.join(moved, key, "left")
    else:
        t = lookup(t, d.withColumnRenamed("level", col), col, "left")
    t = _shift(t.withColumn("__d", F.coalesce("__d", F.lit(0.0))))
    return t, steps.select("level", (F.col("bias") + F.col("__d")).alias("bias"))


def predict_biases(fact: DataFrame, fit: Biases, user: Side, item: Side, lo: float = 1.0, hi: float = 5.0, out: str = "pred",
                   parts: int | None = None) -> DataFrame:
    """mean + offsets, clipped (C10). An id without ratings has the biases of its attributes. ``parts``: of a fact dealt by the user's id."""
    z = F.lit(fit.mu)
    for side, fitted, dealt in ((user, fit.user, parts), (item, fit.item, None)):
        name = f"__{side.key}"
        offsets = fitted.select(side.key, F.col("offset").alias(name))
        fact = lookup_dealt(fact, _with_cold(offsets, side, fit.blocks, name), side.key, dealt)
        z = z + F.coalesce(name, F.lit(0.0))
    return fact.withColumn(out, clip(z, lo, hi)).drop(f"__{user.key}", f"__{item.key}")


def _with_cold(offsets: DataFrame, side: Side, blocks: dict[str, DataFrame], name: str) -> DataFrame:
    """offsets and, for ids of the side's table that have none, the sums of their attributes' biases."""
    cold = side.table.join(offsets, side.key, "left_anti").select(side.key, *side.one, *side.many).dropDuplicates([side.key])
    total = F.lit(0.0)
    for col in side.one:
        cold = lookup(cold, blocks[col].select(F.col("level").alias(col), F.col("bias").alias(f"__b_{col}")), col, "left")
        total = total + F.coalesce(f"__b_{col}", F.lit(0.0))
    for col in side.many:
        levels = cold.select(side.key, F.explode(F.array_distinct(col)).alias("level"))
        sums = lookup(levels, blocks[col], "level", "inner").groupBy(side.key).agg(F.sum("bias").alias(f"__b_{col}"))
        cold = cold.join(sums, side.key, "left")
        total = total + F.coalesce(f"__b_{col}", F.lit(0.0))
    return offsets.unionByName(cold.select(side.key, total.alias(name)))


def fit_factors(ratings: DataFrame, user: str, item: str, rating: str, rank: int = 8, reg: float = 0.1,
                max_iter: int = 10, seed: int = 0, biases: Biases | None = None, parts: int | None = None):
    """Biases, then MLlib ALS on the residuals.

    ``biases``: fitted by ``fit_biases`` (ids and attributes); without them, of ids only. Ids may have
    any type; ALS gets their dense tokens, so only their number is bounded (2^31). ``parts``: of ratings
    dealt by the user's id, which then travel once, by item, as what the user's bias leaves.
    Returns (mu, user table (user, b_user, u_vec), item table (item, b_item, i_vec)).
    """
    from pyspark.ml.recommendation import ALS

    if biases is None:
        mu, bu, bi = bias_baseline(ratings, user, item, rating)
    else:
        mu = biases.mu
        bu, bi = biases.user.select(user, F.col("offset").alias("b_user")), biases.item.select(item, F.col("offset").alias("b_item"))
    tokens = {c: cut_lineage(dictionary(ratings, c, token="__token")) for c in (user, item)}
    sides = [tokens[c].join(bias, c, "left").select(c, F.col("__token").cast("int").alias(t), F.coalesce(b, F.lit(0.0)).alias(b))
             for c, bias, t, b in ((user, bu, "__u", "b_user"), (item, bi, "__i", "b_item"))]
    res = lookup_dealt(ratings, sides[0], user, parts, "inner").select(item, "__u", (F.col(rating) - mu - F.col("b_user")).alias("__r"))
    res = lookup(res, sides[1], item, "inner").select("__u", "__i", (F.col("__r") - F.col("b_item")).alias("__r"))
    checkpoint_dir(ratings.sparkSession)  # for ALS, which deletes an iteration's shuffles when its factors are checkpointed
    res = res.persist(StorageLevel.DISK_ONLY)  # MLlib runs its input's plan twice; the heap is for its blocks
    blocks = blocks_of(res.count())
    als = ALS(rank=rank, regParam=reg, maxIter=max_iter, seed=seed, userCol="__u", itemCol="__i", ratingCol="__r",
              numUserBlocks=blocks, numItemBlocks=blocks, checkpointInterval=1, coldStartStrategy="drop", nonnegative=False)
    model = als.fit(res)
    res.unpersist()
    tables = []
    for c, bias, factors, vec in ((user, bu, model.userFactors, "u_vec"), (item, bi, model.itemFactors, "i_vec")):
        named = factors.select(F.col("id").cast("long").alias("__token"), F.col("features").alias(vec))
        named = tokens[c].select(c, F.col("__token").cast("long").alias("__token")).join(named, "__token").select(c, vec)
        tables.append(bias.join(named, c, "left"))
    return mu, *tables


def score_factors(fact: DataFrame, users: DataFrame, items: DataFrame, user: str, item: str, mu: float,
                  lo: float = 1.0, hi: float = 5.0, extra_bias: list[str] | None = None,
                  out: str = "rating", parts: int | None = None) -> DataFrame:
    """mu + b_user + b_item + u.m (+ extra bias columns), clipped to [lo, hi] (M20, J2, F26, C10). ``parts``: of a fact dealt by user."""
    j = lookup(lookup_dealt(fact, users, user, parts), items, item, "left")
    z = (F.lit(float(mu)) + F.coalesce(F.col("b_user"), F.lit(0.0)) + F.coalesce(F.col("b_item"), F.lit(0.0))
         + F.coalesce(dot("u_vec", "i_vec"), F.lit(0.0)))
    for b in extra_bias or []:
        z = z + F.coalesce(F.col(b), F.lit(0.0))
    return j.withColumn(out, clip(z, lo, hi))


def score_genres(df: DataFrame, user_vec: str, multi_hot: str, W, out: str = "genre_score") -> DataFrame:
    """user_vec . (W' multi_hot) added to a score (M24); W is a small literal matrix (genres x rank)."""
    import numpy as np

    W = np.asarray(W, float)
    proj = F.array(*[
        F.aggregate(F.zip_with(F.col(multi_hot), F.array(*[F.lit(float(v)) for v in W[:, r]]),
                               lambda a, b: a.cast("double") * b), F.lit(0.0), lambda acc, v: acc + v)
        for r in range(W.shape[1])
    ])
    return df.withColumn(out, dot(user_vec, proj))
