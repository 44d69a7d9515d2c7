"""Aggregates that need care: index percentiles, guarded rates, entropy, filters with a fallback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quality_or_all(df: DataFrame, column: str, threshold: float) -> DataFrame:
    """Rows at or above a threshold, or all rows if none is."""
    best = df.agg(F.max(column).alias("best_"))  # one row
    return df.crossJoin(F.broadcast(best)).where((F.col(column) >= threshold) | (F.coalesce("best_", F.lit(float("-inf"))) < threshold)).drop("best_")


def rate(part: Column, whole: Column) -> Column:
    """A ratio that is 0 if there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def picked(df: DataFrame, column: str, fractions: dict[str, float], keys: list[str] | None = None) -> DataFrame:
    """Values at index ``int(f n)`` of the sorted column (upper median for 0.5), per key or overall.

    Values are counted first; the cumulative counts locate the index, so repeated values never meet in one task.
    """
    from pyspark.sql import Window as W

    keys = keys or []
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, F.col(column).alias("v_")).agg(F.count("*").alias("c_"))
    w = W.partitionBy(*keys)
    cumulated = counts.withColumn("upto_", F.sum("c_").over(w.orderBy("v_"))).withColumn("all_", F.sum("c_").over(w))
    aggs = []
    for name, f in fractions.items():
        at = F.least(F.floor(F.col("all_") * F.lit(f)), F.col("all_") - 1)
        aggs.append(F.min(F.when(F.col("upto_") > at, F.col("v_"))).alias(name))
    return cumulated.groupBy(*keys).agg(*aggs)


def median_of(values: Column) -> Column:
    """Upper median of an array."""
    return F.element_at(F.array_sort(values), (F.floor(F.size(values) / 2) + 1).cast("int"))
