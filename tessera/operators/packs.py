"""Order-dependent packing of token lists: next fit, and by entropy into one budget."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def next_fit(df: DataFrame, tokens: str, order: list[str], shard: Column, length: int, pad: int = 0, eos: int = 2) -> DataFrame:
    """(shard, pack_no, tokens, mask): lists in order, joined by ``eos`` while they fit, longer ones cut to ``length``.

    The fold is sequential within a shard, so the shard is explicit and its size is what one task holds; rows
    stream through in batches and only the open pack is kept.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.where(F.size(tokens) > 0).select(shard.cast("bigint").alias("shard"), *order, F.col(tokens).alias("t_"))
    placed = rows.repartition(parts, "shard").sortWithinPartitions("shard", *order).select("shard", "t_")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, no, open_ = None, 0, []

        def closed(t: list[int]) -> tuple:
            return (now, no, np.array(t[:length] + [pad] * (length - len(t)), np.int32), np.array([1] * min(len(t), length) + [0] * (length - len(t)), np.int32))

        for b in batches:
            out = []
            for s, t in zip(b["shard"], b["t_"]):
                if s != now:
                    if open_:
                        out.append(closed(open_))
                    now, no, open_ = s, 0, []
                t = [int(x) for x in t[:length]]
                if open_ and (len(t) >= length or len(open_) + len(t) + 1 > length):
                    out.append(closed(open_))
                    no, open_ = no + 1, []
                if len(t) >= length:
                    out.append(closed(t))
                    no += 1
                    continue
                open_ = open_ + [eos] + t if open_ else t
            if out:
                yield pd.DataFrame(out, columns=["shard", "pack_no", "tokens", "mask"])
        if open_:
            yield pd.DataFrame([closed(open_)], columns=["shard", "pack_no", "tokens", "mask"])

    return placed.mapInPandas(run, "shard bigint, pack_no bigint, tokens array<int>, mask array<int>")


def by_entropy(df: DataFrame, key: list[str], name: str, tokens: str, entropy: str, points: str, budget: int) -> DataFrame:
    """Per key: lists by falling entropy into one budget; the first that does not fit is cut at its last break
    point below the room, or ends the pack.  (key, tokens, files, quality_score, efficiency).

    Candidates that cannot be reached any more are dropped before the fold: a pack holds at most the lists whose
    sizes first add up to the budget.
    """
    from pyspark.sql import Window as W

    w = W.partitionBy(*key).orderBy(F.desc(entropy), name)
    before = F.coalesce(F.sum(F.size(tokens)).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = df.where(F.size(tokens) > 0).withColumn("before_", before).where(F.col("before_") < budget)
    kinds = dict(df.dtypes)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([entropy, name], ascending=[False, True])
        out, files, scores, useful = [], [], [], 0
        for f, t, e, p in zip(pdf[name], pdf[tokens], pdf[entropy], pdf[points]):
            room = budget - len(out)
            t = list(t)
            if len(t) > room:
                fit = [int(x) for x in (p if p is not None else []) if x < room]
                if not fit:
                    break
                t = t[: max(fit)]
            if not t:
                continue
            out += t
            files.append(f)
            scores.append(float(e))
            useful += len(t)
            if len(out) >= budget:
                break
        head = {k: [pdf[k].iloc[0]] for k in key}
        return pd.DataFrame({**head, "tokens": [np.array(out[:budget], np.int32)], "files": [files], "quality_score": [float(np.mean(scores)) if scores else 0.5], "efficiency": [useful / budget]})

    schema = ", ".join(f"{k} {kinds[k]}" for k in key) + f", tokens array<int>, files array<{kinds[name]}>, quality_score double, efficiency double"
    return rows.groupBy(*key).applyInPandas(run, schema)
