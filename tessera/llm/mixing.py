"""Problem 9: draw records so that each source has its share of the total size in tokens.

Sizes are token counts of a public tokenizer.  The total (by default all tokens of the listed sources) is
divided into blocks of equal tokens, and the blocks are apportioned to the sources by Sainte-Lague's
highest quotients; a source stops at its tokens times its cap of repeats, and its further blocks go to the next
highest quotients.  A source's blocks are apportioned to its shards the same way.  In a shard, records in seeded order are cut into blocks of equal tokens; each record is
used as often as the quota holds the whole shard, and seeded blocks are used once more for the rest.

Defined results: weights need not add up to 1; null or negative weights count as 0, null repeats as 1; sources without tokens get
nothing and their share is reported as 0; a source below one block counts as one block, of which it gives what it has; records of unlisted or null sources and records without tokens are not drawn;
rows are drawn row by row, so repeated rows count each; a source listed twice has the sum of its weights and the larger cap.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.tokenizer import token_counts
from tessera.operators.stats import rate
from tessera.session import cut

BLOCK_TOKENS = 2_048
#: Tokens of a shard, about: the driver holds one number per shard, a task sorts the keys of one shard's records.
SHARD_TOKENS = 100_000_000
SEED = 13


def sainte_lague(weights: list[float], seats: int, caps: list[int] | None = None) -> list[int]:
    """Seats by the highest quotients weight / (2 s + 1), each party up to its cap; ties go to the earlier one.

    All seats above a quotient are given at once, the quotient being found by bisection; only the last ones are
    given singly.  So the time does not depend on the number of seats.
    """
    caps = caps or [seats] * len(weights)
    exact = [Fraction(w) for w in weights]

    def above(q: Fraction) -> list[int]:
        return [min(c, max(0, math.ceil((w / q - 1) / 2))) for w, c in zip(exact, caps)]

    got, open_ = [0] * len(weights), [i for i, w in enumerate(exact) if w > 0 and caps[i] > 0]
    if open_:
        lo, hi = min(exact[i] for i in open_) / (2 * max(seats, 1) + 1) / 2, max(exact)
        if sum(above(lo)) <= seats:
            got = above(lo)
        else:
            while seats - sum(got) > len(open_) and hi - lo > hi / (1 << 80):
                mid = Fraction((lo + hi) / 2).limit_denominator(1 << 120)
                mid = mid if lo < mid < hi else (lo + hi) / 2
                trial = above(mid)
                if sum(trial) <= seats:
                    hi, got = mid, trial
                else:
                    lo = mid
    seats -= sum(got)
    heap = [(-exact[i] / (2 * got[i] + 1), i) for i in open_ if got[i] < caps[i]]
    heapq.heapify(heap)
    while seats and heap:
        _, i = heapq.heappop(heap)
        got[i] += 1
        seats -= 1
        if got[i] < caps[i]:
            heapq.heappush(heap, (-exact[i] / (2 * got[i] + 1), i))
    return got


def quotas(weights: list[float], tokens: list[int], most: list[int], total: int, block: int) -> list[int]:
    """Tokens to draw from each source: whole blocks, but for the last of a source that is drawn as often as allowed."""
    seats = sainte_lague([w if t else 0.0 for w, t in zip(weights, tokens)], total // block, [-(-t * m // block) for t, m in zip(tokens, most)])
    return [min(s * block, t * m) for s, t, m in zip(seats, tokens, most)]


def mix(docs: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = SEED, block_tokens: int = BLOCK_TOKENS, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, source, n_tokens, copies) of every record drawn."""
    spark = docs.sparkSession
    plan = targets.where("source is not null").groupBy("source").agg(F.sum(F.greatest(F.coalesce("target_weight", F.lit(0.0)), F.lit(0.0))).alias("w"), F.max(F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0))).alias("most"))
    plan = plan.orderBy("source").collect()  # one row per listed source
    listed = docs.join(F.broadcast(targets.select("source").where("source is not null").distinct()), "source", "left_semi")
    sized = cut(token_counts(listed, ["doc_id", "source"], "text", tokenizer).where("n_tokens > 0"))
    have = {r["source"]: r["t"] for r in sized.groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()}
    weights, most = [r["w"] for r in plan], [r["most"] for r in plan]
    tokens = [have.get(r["source"], 0) for r in plan]
    total = total_tokens if total_tokens is not None else sum(tokens)
    block = block_tokens
    wanted = quotas(weights, tokens, most, total, block)
    shards = [max(1, -(-t // SHARD_TOKENS)) for t in tokens]
    known = F.create_map(*(x for r, n in zip(plan, shards) for x in (F.lit(r["source"]), F.lit(n)))) if plan else None
    if known is None:
        return sized.limit(0).withColumn("copies", F.lit(0))
    key = F.xxhash64(F.lit(seed), "doc_id", "n_tokens")
    dealt = sized.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), known[F.col("source")]).cast("int")).withColumn("key", key)
    loads = {(r["source"], r["shard"]): r["t"] for r in dealt.groupBy("source", "shard").agg(F.sum("n_tokens").alias("t")).collect()}  # one row per source and SHARD_TOKENS
    parts = []
    for r, n, q, m in zip(plan, shards, wanted, most):
        load = [loads.get((r["source"], k), 0) for k in range(n)]
        parts += [(r["source"], k, x, y) for k, (x, y) in enumerate(zip(quotas(load, load, [m] * n, q + block - 1, block), load)) if x and y]
    quota = spark.createDataFrame(parts, "source string, shard int, quota bigint, load bigint")
    held = dealt.join(F.broadcast(quota), ["source", "shard"]).withColumn("full", F.floor(F.col("quota") / F.col("load"))).withColumn("rest", F.col("quota") % F.col("load"))
    start = F.sum("n_tokens").over(W.partitionBy("source", "shard").orderBy("key", "doc_id", "n_tokens").rowsBetween(W.unboundedPreceding, 0)) - F.col("n_tokens")
    cutting = cut(held.withColumn("block", F.floor(start / F.lit(block))))
    blocks = cutting.groupBy("source", "shard", "block", "rest").agg(F.sum("n_tokens").alias("t"))
    order = W.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed + 2), "block"), "block").rowsBetween(W.unboundedPreceding, 0)
    # a block is used once more if at least half of it lies within the rest
    again = blocks.withColumn("upto", F.sum("t").over(order)).where(F.col("upto") - F.col("t") / 2 <= F.col("rest")).where("rest > 0").select("source", "shard", "block", F.lit(1).alias("more"))
    drawn = cutting.join(again, ["source", "shard", "block"], "left").withColumn("copies", (F.col("full") + F.coalesce("more", F.lit(0))).cast("int"))
    caps = F.create_map(*(x for r in plan for x in (F.lit(r["source"]), F.lit(r["most"]))))
    return drawn.withColumn("copies", F.least("copies", caps[F.col("source")])).where("copies > 0").select("doc_id", "source", "n_tokens", "copies")


def mix_report(docs: DataFrame, targets: DataFrame, **options) -> DataFrame:
    """Per listed source: share wanted, tokens drawn, their share and how far it is off, records drawn and their most copies, cap."""
    drawn = mix(docs, targets, **options).groupBy("source").agg(F.sum(F.col("n_tokens").cast("bigint") * F.col("copies")).alias("tokens"), F.count("*").alias("records"), F.max("copies").alias("most_copies"))
    want = targets.where("source is not null").groupBy("source").agg(F.sum(F.greatest(F.coalesce("target_weight", F.lit(0.0)), F.lit(0.0))).alias("w"), F.max("max_repeats").alias("max_repeats"))
    every = W.partitionBy()  # over the listed sources only
    report = want.join(drawn, "source", "left").select(
        "source", rate(F.col("w"), F.sum("w").over(every)).alias("target_share"), F.coalesce("tokens", F.lit(0)).alias("tokens"),
        rate(F.coalesce("tokens", F.lit(0)), F.sum(F.coalesce("tokens", F.lit(0))).over(every)).alias("share"), F.coalesce("records", F.lit(0)).alias("records"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"), "max_repeats",
    )
    return report.withColumn("off", F.col("share") - F.col("target_share"))
