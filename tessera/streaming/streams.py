"""Structured Streaming: metrics with rolling signals, event-time windows, and a token stream cut across micro-batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def event_windows(events: DataFrame, time: str = "ts", late: str = "10 minutes", width: str = "1 hour", slide: str | None = None, keys: tuple[str, ...] = ("event_type",)) -> DataFrame:
    """Counts and sums in tumbling or sliding event-time windows, with late rows up to a limit."""
    w = F.window(time, width, slide) if slide else F.window(time, width)
    g = events.withWatermark(time, late) if events.isStreaming else events
    return g.groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n", "total")


def sessions(events: DataFrame, time: str = "ts", gap: str = "30 minutes", late: str = "1 hour", keys: tuple[str, ...] = ("user_id",)) -> DataFrame:
    g = events.withWatermark(time, late) if events.isStreaming else events
    return g.groupBy(F.session_window(time, gap).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")


def token_windows(sequences: DataFrame, key: str, tokens: str, length: int, overlap: int) -> DataFrame:
    """Overlapping windows of each key's token stream across micro-batches; state is fewer than ``length`` tokens.

    Rows of a batch are taken in the order of the column ``pos``.
    """
    if not 0 <= overlap < length:
        raise ValueError("the overlap must be smaller than the length")
    stride = length - overlap
    kind = dict(sequences.dtypes)[key]

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rest, no = (list(state.get[0]), state.get[1]) if state.exists else ([], 0)
        rows = pd.concat(list(batches)).sort_values("pos")
        out = []
        for t in rows[tokens]:
            rest += [int(x) for x in t]
            while len(rest) >= length:
                out.append((k[0], no, np.array(rest[:length], np.int32)))
                rest, no = rest[stride:], no + 1
        state.update((rest, no))
        if out:
            yield pd.DataFrame(out, columns=[key, "window_no", "window"])

    return sequences.select(key, "pos", tokens).groupBy(key).applyInPandasWithState(step, f"{key} {kind}, window_no bigint, window array<int>", "rest array<int>, no bigint", "append", GroupStateTimeout.NoTimeout)


def follow_metrics(metrics: DataFrame, path: str, checkpoint: str, keys: list[str], order: list[str], train: str, val: str, window: int = 20):
    """A query that writes the signals of each micro-batch; the last ``window`` rows of each key written before go on counting, so
    the signals are those of the whole series as long as micro-batches follow each other in ``order``.  A micro-batch that is
    repeated after a loss replaces what it wrote."""
    from tessera.operators.signals import training_signals

    given = metrics.columns

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("new_", F.lit(True))
        if number:
            last = W.partitionBy(*keys).orderBy(*(F.desc(c) for c in order))
            before = spark.read.parquet(path).where(F.col("batch") < number).join(batch.select(*keys).distinct(), keys, "left_semi")
            rows = rows.unionByName(before.withColumn("back_", F.row_number().over(last)).where(F.col("back_") <= window).select(*given, F.lit(False).alias("new_")))
        out = training_signals(rows, keys, order, train, val).where("new_").drop("new_").withColumn("batch", F.lit(number))
        out.write.partitionBy("batch").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)

    return metrics.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
