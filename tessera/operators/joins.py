"""Joins to a table with one row per key where a few keys may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import cut

#: Rows of one key that one task joins without ado; keys with more, and with more than ``1 / HOT_KEYS`` of all rows, are hot.
HOT_ROWS = 1_000_000
HOT_KEYS = 1_000


def lookup(rows: DataFrame, table: DataFrame, key: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined on ``key`` with the one row per key of ``table``; ``total``: number of rows, about.

    Rows of hot keys, of which there are at most ``HOT_KEYS``, stay where they are and meet their row of the table by broadcast;
    all others are shuffled.  Null keys match nothing.
    """
    if total <= HOT_ROWS:
        return rows.join(table, key, how)
    hot = cut(rows.groupBy(key).agg(F.count("*").alias("n_")).where(F.col(key).isNotNull() & (F.col("n_") > max(HOT_ROWS, total // HOT_KEYS))).select(key))
    few = cut(table.join(F.broadcast(hot), key, "left_semi"))
    at_home = rows.join(F.broadcast(hot), key, "left_semi").join(F.broadcast(few), key, how)
    return at_home.unionByName(rows.join(F.broadcast(hot), key, "left_anti").join(table, key, how))
