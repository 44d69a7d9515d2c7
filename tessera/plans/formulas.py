"""Planning formulas over parameter tables: lengths, schedules and formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def curriculum_length(epoch: Column, epochs: int, shortest: int, longest: int) -> Column:
    """Linear growth of the maximum length over epochs, rounded half to even."""
    share = F.lit(1.0) if epochs <= 1 else epoch / F.lit(float(epochs - 1))
    return F.bround(shortest + (longest - shortest) * share, 0).cast("int")


def context_stages(epochs: int, target: int) -> list[tuple[int, int, int]]:
    """(first epoch, last epoch, context): contexts doubling from 8192 to the target, later stages longer."""
    contexts = [8192 * 2**i for i in range(6) if 8192 * 2**i <= target]
    if target not in contexts:
        contexts = sorted({*contexts, target})
    weights = [1.0 + 0.2 * i for i in range(len(contexts))]
    out, at = [], 1
    for context, w in zip(contexts, weights):
        n = min(max(1, int(epochs * w / sum(weights))), epochs - at + 1)
        if n <= 0:
            break
        out.append((at, at + n - 1, context))
        at += n
    if out and out[-1][1] < epochs:
        out[-1] = (out[-1][0], epochs, out[-1][2])
    return out


def stage_table(spark: SparkSession, epochs: int, target: int) -> DataFrame:
    return spark.createDataFrame(context_stages(epochs, target), "first_epoch int, last_epoch int, context int")


def decay_projection(spark: SparkSession, epochs: int, first: float, last: float, rate: float) -> DataFrame:
    """(epoch, value): exponential approach from ``first`` to ``last``."""
    e = spark.range(1, epochs + 1).select(F.col("id").cast("int").alias("epoch"))
    return e.withColumn("value", F.lit(first) - (first - last) * (1 - F.pow(F.lit(rate), F.col("epoch"))))


def human_time(seconds: Column) -> Column:
    s = seconds.cast("double")
    return F.when(s < 60, F.format_string("%.0fs", s)).when(s < 3600, F.format_string("%.1fm", s / 60)).otherwise(F.format_string("%.1fh", s / 3600))


def steps(sequences: Column, batch: int, epochs: Column) -> Column:
    """Training steps: whole and broken batches of all epochs."""
    return (F.ceil(sequences / batch) * epochs).cast("bigint")


def attention_gb(context: Column, layers: int = 32, width: int = 2560, bytes_each: float = 2.0, kept: float = 0.25) -> Column:
    """GiB of the keys and values and of the activations that are kept, for a context."""
    return (context * (2.0 * layers * width * bytes_each) + context * (layers * width * bytes_each * kept)) / float(1 << 30)


def highest_fitting(tiers: DataFrame, tier: str, need: str, budgets: DataFrame, budget: str) -> DataFrame:
    """Budgets with the highest tier whose need fits, null where none does; both tables are parameters of a few rows."""
    fits = budgets.join(F.broadcast(tiers), F.col(need) <= F.col(budget), "left")
    return fits.groupBy(*budgets.columns).agg(F.max(tier).alias(tier))


def hours(sequences: Column, mean_length: Column, packed_length: Column, seconds_each: Column) -> Column:
    """Hours of a pass over sequences that are packed to a length, whole sequences per pack."""
    packed = F.greatest(F.lit(1), F.floor(sequences / F.greatest(F.lit(1), F.floor(packed_length / mean_length))))
    return packed * seconds_each / 3600.0
