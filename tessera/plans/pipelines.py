"""Composed pipelines: history to packed sequences, chunks to examples, files to a weighted corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import code as C
from tessera.functions import paths as P
from tessera.functions import tokens as T
from tessera.operators import dedup, history, sampling, serialise, vocabulary, windows


def history_sequences(commits: DataFrame, length: int = 512, overlap: int = 128, vocab_size: int = 50_000) -> DataFrame:
    """Commits as text blocks in time order, encoded by a vocabulary of their own and cut from one stream."""
    c = history.latest(commits, ["hash"])
    rows = c.select("commit_timestamp", "hash", T.code_tokens(serialise.commit_block()).alias("t"))
    vocab = vocabulary.vocabulary(vocabulary.frequencies(rows, "hash", F.col("t")), vocab_size)
    ids = vocabulary.encode(rows, "hash", F.col("t"), vocab).join(rows.select("hash", "commit_timestamp"), "hash")
    return windows.stream_windows(ids.where("commit_timestamp is not null"), "ids", ["commit_timestamp", "hash"], length, overlap, pad=0)


def chunk_examples(chunks: DataFrame, context: int = 2048, target: int = 256, vocab_size: int = 50_000) -> DataFrame:
    """Chunks as structural tokens, encoded, joined by commit into context and target, split in order of commits."""
    rows = chunks.select("chunk_id", "commit_hash", serialise.chunk_tokens().alias("t"))
    vocab = vocabulary.vocabulary(vocabulary.frequencies(rows, "chunk_id", F.col("t")), vocab_size)
    ids = vocabulary.encode(rows, "chunk_id", F.col("t"), vocab).join(rows.select("chunk_id", "commit_hash"), "chunk_id")
    pairs = windows.grouped_examples(ids, "commit_hash", ["chunk_id"], "ids", context, target)
    padded = pairs.select("commit_hash", "num_chunks", T.fit(F.col("context"), context).alias("context"), T.fit(F.col("target"), target).alias("target"), T.fit_mask(F.col("context"), context).alias("context_mask"), T.fit_mask(F.col("target"), target).alias("target_mask"))
    return sampling.temporal_split(padded, ["commit_hash"]).drop("rank_", "n_")


def file_corpus(docs: DataFrame, width: int = 512, least_chars: int = 100, leak_free: bool = True) -> DataFrame:
    """Files to windows of word tokens: scored, deduplicated by prefix, weighted by priority, ordered and split."""
    p, t = F.col("path"), F.col("text")
    files = docs.where(F.length("text") >= least_chars).select("doc_id", "path", C.weighted_score(t, C.SCAN_WEIGHTS, 2000).alias("complexity"), F.when(P.is_core(p), "high").when(P.marked(p, P.TEST_MARKS), "low").otherwise("medium").alias("priority"), T.words(t).alias("w"))
    hashed = files.where("size(w) >= 128").withColumn("w", F.transform("w", lambda x: F.pmod(F.xxhash64(x), F.lit(2**31 - 1)).cast("int")))
    w = windows.counted_windows(hashed, "w", width, width // 4).drop("w")
    once = dedup.dedup_prefix(w, "window", ["doc_id", "window_no"])
    many = sampling.replicate(once, sampling.priority_weight(F.col("priority")), ["doc_id", "window_no"])
    shares = (("train", 0.85), ("val", 0.10), ("test", 0.05))
    if leak_free:
        return sampling.leak_free_split(many, ["doc_id"], shares)
    return sampling.split_by_rank(sampling.shuffled(many, ["seq_id"]), shares).drop("rank_", "n_")
