"""Rolling signals over metric series, folds over ordered values, incremental slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_TINY = 1e-6


def training_signals(df: DataFrame, key: list[str], order: list[str], train: str, val: str, grad: str | None = None, window: int = 20) -> DataFrame:
    """Adds converged, reduce_lr, overfitting and advance_phase to each step of a series; false until enough steps are there.

    One window per key; series are long but each is one run.
    """
    w = W.partitionBy(*key).orderBy(*order)
    n = F.row_number().over(w)
    five = w.rowsBetween(-4, 0)
    gain = (F.lag(train, 4).over(w) - F.col(train)) / F.greatest(F.lit(_TINY), F.lag(train, 4).over(w))
    trend = (F.col(val) - F.lag(val, 2).over(w)) / F.greatest(F.lit(_TINY), F.lag(val, 2).over(w))
    flat = (F.least(n, F.lit(window)) >= 10) & (F.stddev_pop(val).over(w.rowsBetween(-2, 0)) < 0.001)
    val5 = (F.col(val) - F.lag(val, 4).over(w)) / F.greatest(F.lit(_TINY), F.lag(val, 4).over(w))
    out = df.withColumns({
        "converged": F.when(n < 5, False).otherwise(gain < 0.01),
        "reduce_lr": F.when(n < 3, False).otherwise((trend > 0.05) | flat),
        "overfitting": F.when(n < 5, False).otherwise((F.avg(train).over(five) < 0.5 * F.avg(val).over(five)) & (val5 > 0.02)),
    })
    return out.withColumn("advance_phase", F.col("converged") & (F.abs(F.col(grad) - 1.0) < 0.1)) if grad else out


def extend_context(df: DataFrame, key: list[str], order: list[str], coverage: str, limit: float = 0.7) -> DataFrame:
    w = W.partitionBy(*key).orderBy(*order)
    return df.withColumn("extend_context", F.coalesce(F.avg(coverage).over(w.rowsBetween(-4, 0)) > limit, F.lit(False)))


def spikes(df: DataFrame, key: list[str], order: list[str], value: str, width: int = 100, factor: float = 3.0) -> DataFrame:
    """Adds spike: above ``factor`` times the mean of the ``width`` steps before."""
    w = W.partitionBy(*key).orderBy(*order).rowsBetween(-width, -1)
    return df.withColumn("spike", F.coalesce(F.col(value) > factor * F.avg(value).over(w), F.lit(False)))


def rolling_variance(df: DataFrame, key: list[str], order: list[str], value: str, width: int = 50) -> DataFrame:
    return df.withColumn("variance", F.var_pop(value).over(W.partitionBy(*key).orderBy(*order).rowsBetween(1 - width, 0)))


def series(df: DataFrame, key: list[str], order: list[str], value: str) -> DataFrame:
    """(key, values): the ordered values of each series as one array."""
    return df.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("v_")))), lambda x: x["v_"]).alias("values"))


def ema(values: Column, decay: float) -> Column:
    """m = decay m + (1 - decay) x over an array, from its first value."""
    return F.aggregate(F.slice(values, 2, F.greatest(F.size(values) - 1, F.lit(0))), F.get(values, F.lit(0)).cast("double"), lambda m, x: decay * m + (1 - decay) * x)


def early_stop(values: Column, min_delta: float, patience: int) -> Column:
    """(best, stopped_at): a value is a new best if it is lower by more than ``min_delta``; stops after ``patience`` others, at -1 never."""
    start = F.struct(F.lit(float("inf")).alias("best"), F.lit(0).alias("wait"), F.lit(0).alias("i"), F.lit(-1).alias("stop"))

    def step(a: Column, x: Column) -> Column:
        better = x < a["best"] - min_delta
        wait = F.when(better, 0).otherwise(a["wait"] + 1)
        return F.when(a["stop"] >= 0, a).otherwise(
            F.struct(F.when(better, x).otherwise(a["best"]).alias("best"), wait.alias("wait"), (a["i"] + 1).alias("i"), F.when(wait >= patience, a["i"]).otherwise(F.lit(-1)).alias("stop"))
        )

    return F.aggregate(values.cast("array<double>"), start, step, lambda a: F.struct(a["best"].alias("best"), a["stop"].alias("stopped_at")))


def controls(signals: Column, seq: int, lr: float, batch: int, rank: int, longest: int) -> Column:
    """State after a run of (extend, reduce) signals: length up a quarter to a multiple of 512, rate halved, batch and rank adapted."""
    start = F.struct(F.lit(seq).alias("seq"), F.lit(lr).alias("lr"), F.lit(batch).alias("batch"), F.lit(rank).alias("rank"))

    def step(a: Column, x: Column) -> Column:
        longer = F.least(F.lit(longest), (F.floor((F.floor(a["seq"] * F.lit(1.25)) + 511) / 512) * 512).cast("int"))
        return F.struct(
            F.when(x["extend"], longer).otherwise(a["seq"]).alias("seq"),
            F.when(x["reduce"], a["lr"] * 0.5).otherwise(a["lr"]).alias("lr"),
            F.when(x["extend"] & (a["batch"] > 1), a["batch"] - 1).otherwise(a["batch"]).alias("batch"),
            F.when(x["extend"], F.least(F.lit(64), F.floor(a["rank"] * F.lit(1.2)).cast("int"))).otherwise(a["rank"]).alias("rank"),
        )

    return F.aggregate(signals, start, step)


def recency(df: DataFrame, index: str) -> DataFrame:
    """Adds recency = (index + 1) / (largest index + 1)."""
    top = df.agg(F.max(index).alias("top_"))
    return df.crossJoin(F.broadcast(top)).withColumn("recency", (F.col(index) + 1) / (F.col("top_") + 1)).drop("top_")


def incremental_slice(df: DataFrame, position: str, commit_idx: str, commit_hash: str, last_idx: int, last_hash: str | None, last_position: int, context: int) -> DataFrame:
    """Rows to train on: from the first row newer than the last run, less ``context`` rows before it; none if nothing is new."""
    newer = F.col(commit_idx) > last_idx
    if last_hash:
        newer = newer | ((F.col(commit_idx) == last_idx) & (F.col(commit_hash) != last_hash))
    state = df.agg(F.min(F.when(newer, F.col(position))).alias("first_"), F.max(position).alias("last_"))
    start = state.select(F.coalesce("first_", F.lit(last_position + 1)).alias("first_"), "last_")
    return df.crossJoin(F.broadcast(start)).where((F.col("first_") <= F.col("last_")) & (F.col(position) >= F.greatest(F.lit(0), F.col("first_") - context))).drop("first_", "last_")


def mean_and_perplexity(df: DataFrame, loss: str, tokens: str, key: list[str] | None = None) -> DataFrame:
    """Token-weighted loss and exp of it."""
    m = F.sum(F.col(loss) * F.col(tokens)) / F.sum(tokens)
    return df.groupBy(*(key or [])).agg(m.alias("loss"), F.exp(m).alias("perplexity"))
