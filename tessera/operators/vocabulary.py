"""Token frequencies, vocabularies and id encoding."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.ragged import int_list_array
from tessera.session import cut

# The head of the id space.
SPECIALS = (
    "<PAD> <UNK> <COMMIT_START> <COMMIT_END> <FILE_START> <FILE_END> <CHANGE_START> <CHANGE_END> <CODE_START> <CODE_END> <OLD_CODE_START> <OLD_CODE_END> <NEW_CODE_START> <NEW_CODE_END> <TEST_START> <TEST_END> "
    "<CONTEXT_START> <CONTEXT_END> <IMPORTS_START> <IMPORTS_END> <TRAITS_START> <TRAITS_END> <STRUCTS_START> <STRUCTS_END> <IMPLS_START> <IMPLS_END> <NEWLINE> <INDENT> <DEDENT>"
).split()
RESERVED = 5_000
KEYWORDS = (
    "fn struct impl trait enum mod pub async await use let const static mut unsafe loop while for if else match return break continue type where as move dyn ref extern crate self super in Box Vec String Result Option"
).split()
MACROS = "println! eprintln! format! vec! assert! panic! unwrap! expect! try! macro_rules! derive cfg test tokio serde async_trait".split()
FIRST_LEARNED = len(SPECIALS) + RESERVED + len(KEYWORDS) + len(MACROS)
UNKNOWN = SPECIALS.index("<UNK>")


def frequencies(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """(token, freq, first): counts and the first place (key, position) of each token."""
    each = df.select(F.col(key).alias("key_"), F.posexplode(tokens).alias("pos_", "token"))
    return each.groupBy("token").agg(F.count("*").alias("freq"), F.min(F.struct("key_", "pos_")).alias("first"))


def vocabulary(counts: DataFrame, size: int = 50_000, first_id: int = FIRST_LEARNED, reserved: list[str] | None = None) -> DataFrame:
    """(token, id, freq): the most frequent tokens get ids in order, ties by first occurrence, up to ``size``.

    The limit keeps what is numbered in one task bounded by the size of the vocabulary.
    """
    from pyspark.sql import Window as W

    free = counts.where(~F.col("token").isin(*(reserved or []))) if reserved else counts
    top = free.orderBy(F.desc("freq"), "first").limit(max(0, size - first_id))
    return top.select("token", (F.row_number().over(W.orderBy(F.desc("freq"), "first")) - 1 + first_id).cast("int").alias("id"), "freq")


def fixed_ids(spark) -> DataFrame:
    """(token, id) of special tokens, keywords and macros."""
    rows = [(t, i) for i, t in enumerate(SPECIALS)] + [(f"<KW:{t}>", len(SPECIALS) + RESERVED + i) for i, t in enumerate(KEYWORDS)] + [(f"<MACRO:{t}>", len(SPECIALS) + RESERVED + len(KEYWORDS) + i) for i, t in enumerate(MACROS)]
    return spark.createDataFrame(rows, "token string, id int")


def encode(df: DataFrame, key: str, tokens: Column, vocab: DataFrame, unknown: int = UNKNOWN, most: int = 1_000_000) -> DataFrame:
    """(key, ids): ids of each row's tokens in order, unknown ones as ``unknown``; rows without tokens get an empty list.

    A vocabulary of at most ``most`` entries is looked up within Arrow batches, without a shuffle; a larger one is joined by shuffle.
    Rows stay rows, also those of equal keys.
    """
    known = vocab.select("token", "id").limit(most + 1).toPandas()  # at most ``most`` entries are used here
    rows = df.select(F.col(key), tokens.alias("t_"))
    if len(known) > most:
        rows = cut(rows.withColumn("row_", F.monotonically_increasing_id()))
        each = rows.select("row_", F.posexplode("t_").alias("pos", "token")).join(vocab.select("token", "id"), "token", "left")
        coded = each.groupBy("row_").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("id", F.lit(unknown)).alias("id")))), lambda x: x["id"]).alias("ids"))
        return rows.join(coded, "row_", "left").select(key, F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    shared = df.sparkSession.sparkContext.broadcast((known["token"].tolist(), known["id"].to_numpy(np.int32)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, ids = shared.value
        words, ids = pa.array(words, pa.string()), np.append(ids, np.int32(unknown))
        for b in batches:
            lists = b.column(1)
            at = pc.index_in(lists.flatten(), words).fill_null(len(ids) - 1).to_numpy(zero_copy_only=False)
            lengths = np.asarray(lists.value_lengths().fill_null(0))
            yield pa.RecordBatch.from_arrays([b.column(0), int_list_array(ids[at], lengths)], names=[key, "ids"])

    return rows.mapInArrow(run, rows.select(key).schema.add("ids", T.ArrayType(T.IntegerType())))
