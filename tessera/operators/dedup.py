"""Exact and signature-based removal of repeated sequences and texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.tokens import words
from tessera.session import spread


def keep_first(df: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """The first row of each key; one aggregation, so a key of any size is reduced map-side."""
    return df.groupBy(key.alias("key_")).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("r_")).select("r_.*")


def prefix_key(tokens: Column, n: int = 256) -> Column:
    """Digest of the first n tokens as a list prints."""
    return F.md5(F.concat(F.lit("["), F.array_join(F.slice(tokens, 1, n), ", "), F.lit("]")).cast("binary"))


def dedup_prefix(df: DataFrame, tokens: str, order: list[str], n: int = 256) -> DataFrame:
    return keep_first(df, prefix_key(F.col(tokens), n), order)


def ngram_signatures(df: DataFrame, key: str, text: str, n: int = 5, top: int = 100) -> DataFrame:
    """(key, signature): digest of the sorted ``top`` most frequent word n-grams of each text, ties by first occurrence.

    The n-grams of a text are sorted and their runs measured where the text is: none of them is ever shuffled, and equal keys
    stay rows of their own.
    """
    grams = F.when(F.size("w_") >= n, F.transform(F.sequence(F.lit(1), F.size("w_") - n + 1), lambda i: F.struct(F.array_join(F.slice("w_", i, n), " ").alias("gram"), i.alias("pos")))).otherwise(F.array().cast("array<struct<gram:string,pos:int>>"))
    rows = spread(df.select(key, F.coalesce(text, F.lit("")).alias("t_"))).select(key, words(F.col("t_")).alias("w_"))
    runs = rows.select(key, F.array_sort(grams).alias("g_"), F.greatest(F.size("w_") - n + 1, F.lit(0)).alias("n_"))
    new = lambda i: (i == 0) | (F.get("g_", i)["gram"] != F.get("g_", i - 1)["gram"])
    runs = runs.withColumn("at_", F.when(F.col("n_") > 0, F.filter(F.sequence(F.lit(0), F.col("n_") - 1), new)).otherwise(F.array().cast("array<int>")))
    first = lambda i: F.get("g_", i)
    each = F.transform("at_", lambda i, k: F.struct((i - F.coalesce(F.get("at_", k + 1), F.col("n_"))).alias("less"), first(i)["pos"].alias("pos"), first(i)["gram"].alias("gram")))
    best = F.slice(F.array_sort(each), 1, top)
    return runs.select(key, F.md5(F.array_join(F.array_sort(F.transform(best, lambda x: x["gram"])), "").cast("binary")).alias("signature"))


def keep_best(df: DataFrame, key: str, signatures: DataFrame, score: str) -> DataFrame:
    """Of each signature the row of the highest score, the first on ties; only keys and scores are aggregated, texts are not moved for it."""
    best = df.select(key, score).join(signatures, key).groupBy("signature").agg(F.max_by(key, F.struct(F.coalesce(score, F.lit(0)), -F.col(key))).alias(key))
    return df.join(best.select(key), key, "left_semi")
