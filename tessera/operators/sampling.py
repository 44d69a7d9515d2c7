"""Weighting, sampling, splitting and ordering, all by hashes of keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import h32
from tessera.operators.windows import with_offsets
from tessera.session import cut


def replicate(df: DataFrame, weight: Column, order: list[str]) -> DataFrame:
    """Each row ``max(1, floor(weight))`` times, with copy_no from 1 and a seq_id of its own."""
    copies = F.greatest(F.lit(1), F.floor(weight)).cast("int")
    many = df.withColumn("copy_no", F.explode(F.sequence(F.lit(1), copies)))
    return with_offsets(many, [*order, "copy_no"], F.lit(1), "seq_id")


def priority_weight(priority: Column) -> Column:
    return F.when(priority == "high", 3.0).when(priority == "low", 0.3).otherwise(1.0)


def age_weight(age_days: Column) -> Column:
    return F.when(F.coalesce(age_days, F.lit(1000.0)) < 60, 1.5).otherwise(1.0)


def difficulty_weight(difficulty: Column) -> Column:
    return F.when(difficulty == "easy", 0.7).when(difficulty == "hard", 1.2).otherwise(1.5)


def ranked(df: DataFrame, order: list[str]) -> DataFrame:
    """Adds rank_ from 0 in an order and n_, the number of rows, without a single-task window."""
    r = with_offsets(df, order, F.lit(1), "rank_")
    return r.crossJoin(F.broadcast(r.agg(F.count("*").alias("n_"))))


def shuffled(df: DataFrame, key: list[str], seed: int = 42) -> DataFrame:
    """Rows in a seeded order: rank_ is the place."""
    return ranked(df.withColumn("h_", h32(seed, *key)), ["h_", *key]).drop("h_")


def split_by_rank(df: DataFrame, shares: tuple[tuple[str, float], ...]) -> DataFrame:
    """Adds split: floor(cumulative share x n) rows each, the last one takes the rest; df must have rank_ and n_."""
    total, out = 0.0, None
    for name, share in shares[:-1]:
        total += share
        cond = F.col("rank_") < F.floor(F.col("n_") * F.lit(round(total, 10)))
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return df.withColumn("split", out.otherwise(shares[-1][0]))


def temporal_split(df: DataFrame, order: list[str], train: float = 0.7, val: float = 0.15) -> DataFrame:
    """Order-preserving split at floor(train n) and floor(train n) + floor(val n)."""
    r = ranked(df, order)
    a = F.floor(F.col("n_") * F.lit(train))
    b = a + F.floor(F.col("n_") * F.lit(val))
    return r.withColumn("split", F.when(F.col("rank_") < a, "train").when(F.col("rank_") < b, "val").otherwise("test"))


def tail_split(df: DataFrame, order: list[str], share: float) -> DataFrame:
    """The last max(1, floor(n share)) rows, but at most n - 1, validate."""
    r = ranked(df, order)
    size = F.least(F.greatest(F.lit(1).cast("bigint"), F.floor(F.col("n_") * F.lit(share))), F.col("n_") - 1)
    return r.withColumn("split", F.when(F.col("rank_") >= F.col("n_") - size, "val").otherwise("train"))


def leak_free_split(df: DataFrame, key: list[str], shares: tuple[tuple[str, float], ...], seed: int = 42) -> DataFrame:
    """Split by the hash of a key, so that equal keys stay together."""
    u = (h32(seed, *key) % 10000) / F.lit(10000.0)
    total, out = 0.0, None
    for name, share in shares[:-1]:
        total += share
        out = F.when(u < round(total, 10), name) if out is None else out.when(u < round(total, 10), name)
    return df.withColumn("split", out.otherwise(shares[-1][0]))


def upsample(df: DataFrame, order: list[str], target: int, seed: int = 42) -> DataFrame:
    """All rows, and copies of rows picked by hash until there are ``target``; copies have synthetic set."""
    r = cut(ranked(df, order))
    n = r.count()
    base = r.drop("n_").withColumn("synthetic", F.lit(False))
    if n == 0 or n >= target:
        return base.drop("rank_")
    picks = df.sparkSession.range(n, target).select((h32(seed, "id") % n).alias("rank_"))
    return base.unionByName(picks.join(r.drop("n_"), "rank_").withColumn("synthetic", F.lit(True))).drop("rank_")


def weighted_sample(df: DataFrame, key: list[str], weight: Column, n: int, seed: int = 42, buckets: int = 4096) -> DataFrame:
    """n draws with replacement, in proportion to the weight: (draw, row).

    Rows lie on the line of cumulative weights; each draw is a hashed point on it.  Points and rows meet in
    buckets of the line, so the join is an equi-join.
    """
    scale = 1_000_000
    rows = cut(with_offsets(df.withColumn("w_", F.round(weight * scale).cast("bigint")).where("w_ > 0"), key, F.col("w_"), "at_"))
    total = rows.agg(F.sum("w_")).first()[0] or 0
    if not total:
        return rows.limit(0).drop("w_", "at_").withColumn("draw", F.lit(0).cast("bigint"))
    width = max(1, -(-total // buckets))
    fine = (h32(seed, "id") * F.lit(2**21) + h32(seed + 1, "id") % F.lit(2**21)) % F.lit(total)
    points = df.sparkSession.range(n).select(F.col("id").alias("draw"), fine.alias("x_")).withColumn("b_", F.floor(F.col("x_") / width))
    spread_ = rows.withColumn("b_", F.explode(F.sequence(F.floor(F.col("at_") / width), F.floor((F.col("at_") + F.col("w_") - 1) / width))))
    return points.join(spread_, "b_").where("x_ >= at_ and x_ < at_ + w_").drop("b_", "x_", "at_", "w_")


def objective(seed: int, key: list[str], fim: float, span: float) -> Column:
    """Training objective of a row by its hash: fim, span or lm."""
    u = h32(seed, *key) % 10000
    return F.when(u < int(fim * 10000), "fim").when(u < int((fim + span) * 10000), "span").otherwise("lm")


def length_buckets(df: DataFrame, length: Column, key: list[str], batch: int, seed: int = 42) -> DataFrame:
    """Rows sorted by length, in seeded order within buckets of four batches: bucket_ and rank_ give the order."""
    r = ranked(df.withColumn("len_", length), ["len_", *key])
    return r.withColumn("bucket_", F.floor(F.col("rank_") / (4 * batch))).withColumn("mix_", h32(seed, *key)).drop("n_")


def trim_by_priority(df: DataFrame, priority: Column, order: list[str], limit: int) -> DataFrame:
    """The first ``limit`` rows by priority and then order."""
    return df.withColumn("prio_", priority).orderBy("prio_", *order).limit(limit).drop("prio_")


def staged_curriculum(df: DataFrame, difficulty: str, key: list[str], seed: int = 42) -> DataFrame:
    """Union of three stages: easy; easy and medium; hard, medium and the first fifth of easy.  Null difficulties are left out."""
    easy, medium, hard = (df.where(F.col(difficulty) == x) for x in ("easy", "medium", "hard"))
    few = ranked(easy, key).where(F.col("rank_") < F.floor(F.col("n_") / 5)).drop("rank_", "n_")
    stages = ((easy, "foundation"), (easy.unionByName(medium), "intermediate"), (hard.unionByName(medium).unionByName(few), "advanced"))
    out = None
    for rows, name in stages:
        s = rows.withColumn("stage", F.lit(name))
        out = s if out is None else out.unionByName(s)
    return out.withColumn("order_", h32(seed, "stage", *key))
