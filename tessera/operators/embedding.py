"""Text for embeddings, deterministic hashed vectors, payloads and points."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def commit_text(subject: str = "subject", body: str = "body", author: str = "author_name", files: Column | None = None) -> Column:
    parts = [F.coalesce(subject, F.lit("")), F.substring(F.coalesce(body, F.lit("")), 1, 512), F.coalesce(author, F.lit(""))]
    if files is not None:
        parts.append(F.array_join(F.slice(files, 1, 10), " "))
    return F.array_join(F.filter(F.array(*parts), lambda x: x != ""), "\n")


def snapshot_text(path: str = "path", text: str = "text") -> Column:
    return F.concat_ws("\n", F.coalesce(path, F.lit("")), F.substring(F.coalesce(text, F.lit("")), 1, 2048))


def commit_payload() -> Column:
    return F.struct(
        F.lit("commit").alias("type"), F.col("hash"), F.col("abbrev_hash"), F.col("author_name").alias("author"), F.col("commit_timestamp").alias("timestamp"), F.col("subject"),
        F.col("complexity_score").alias("complexity"), F.col("files_changed"),
    )


def l2_normalised(v: Column) -> Column:
    """Vector of length 1; zero vectors stay as they are."""
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    return F.transform(v, lambda x: F.when(norm > 0, x / norm).otherwise(x.cast("double")))


def hashed_vectors(df: DataFrame, key: str, text: str, size: int = 64, model: Callable[[pd.Series], np.ndarray] | None = None) -> DataFrame:
    """(key, vector): a model's vectors, or signed word counts by hash without one; normalised to length 1."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zlib

        for b in batches:
            if model is not None:
                m = np.asarray(model(b[text]), float)
            else:
                m = np.zeros((len(b), size))
                for i, t in enumerate(b[text]):
                    for w in (t or "").lower().split():
                        h = zlib.crc32(w.encode())
                        m[i, h % size] += 1.0 if h & 0x10000 else -1.0
            norm = np.linalg.norm(m, axis=1, keepdims=True)
            m = np.divide(m, norm, out=m, where=norm > 0)
            yield pd.DataFrame({key: b[key], "vector": list(m.astype(np.float32))})

    kind = dict(df.dtypes)[key]
    return df.select(key, text).mapInPandas(run, f"{key} {kind}, vector array<float>")


def points(vectors: DataFrame, payloads: DataFrame, key: str) -> DataFrame:
    """(id, vector, payload) in the shape vector stores take."""
    return vectors.join(payloads, key).select(F.col(key).cast("string").alias("id"), "vector", "payload")
