"""Deterministic pseudo-random numbers from keys, equal in every engine that has md5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def h32(seed: int | str, *keys: Column | str) -> Column:
    """First eight hex digits of md5('seed:key:...') as a number."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def gate(p: float, seed: int | str, *keys: Column | str) -> Column:
    """True for a share ``p`` of keys, independent of partitioning."""
    return (h32(seed, *keys) % 10000) < int(round(p * 10000))
