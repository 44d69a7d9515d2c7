"""Queries of the operators of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import credentials, mixing, names, overlap, packing, pieces, spam_pages, splits, tokenizer, truncation

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@_query
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return splits.related_groups(_table(spark, d, "examples"), _table(spark, d, "commits"))


@_query
def p1_split(spark: SparkSession, d: str) -> DataFrame:
    return splits.split_rows(_table(spark, d, "examples"), _table(spark, d, "commits"))


@_query
def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return splits.split_report(_table(spark, d, "examples"), _table(spark, d, "commits"))


@_query
def p2_pack(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(_table(spark, d, "packed_sequences"), _table(spark, d, "pack_budgets"))


@_query
def p2_report(spark: SparkSession, d: str) -> DataFrame:
    return packing.packing_report(_table(spark, d, "packed_sequences"), _table(spark, d, "pack_budgets"))


@_query
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return credentials.credential_lines(_table(spark, d, "file_diffs"), _table(spark, d, "code_chunks"))


@_query
def p3_redacted(spark: SparkSession, d: str) -> DataFrame:
    return credentials.redacted(_table(spark, d, "file_diffs"), _table(spark, d, "code_chunks"))


@_query
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return overlap.cross_split_pairs(_table(spark, d, "examples"))


@_query
def p4_classes(spark: SparkSession, d: str) -> DataFrame:
    return overlap.overlap_classes(_table(spark, d, "examples"))


@_query
def p4_members(spark: SparkSession, d: str) -> DataFrame:
    return overlap.class_members(_table(spark, d, "examples"))


@_query
def p4_coverage(spark: SparkSession, d: str) -> DataFrame:
    return overlap.coverage(_table(spark, d, "examples"))


@_query
def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return overlap.overlap_report(_table(spark, d, "examples"))


@_query
def p5_pieces(spark: SparkSession, d: str) -> DataFrame:
    return pieces.oversized_pieces(_table(spark, d, "code_chunks"), _table(spark, d, "examples"))


@_query
def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncated_values(_table(spark, d, "code_chunks"))


@_query
def p6_report(spark: SparkSession, d: str) -> DataFrame:
    return truncation.truncation_report(_table(spark, d, "code_chunks"))


@_query
def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return names.same_person_pairs(_table(spark, d, "authors"))


@_query
def p7_members(spark: SparkSession, d: str) -> DataFrame:
    return names.members(_table(spark, d, "authors"))


@_query
def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return names.person_report(_table(spark, d, "authors"))


@_query
def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenizer.encode_corpus(_table(spark, d, "documents"), "doc_id", "text")


@_query
def p8_counts(spark: SparkSession, d: str) -> DataFrame:
    return tokenizer.token_counts(_table(spark, d, "documents"), ["doc_id"], "text")


@_query
def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(_table(spark, d, "documents"), _table(spark, d, "mix_targets"))


@_query
def p9_report(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_report(_table(spark, d, "documents"), _table(spark, d, "mix_targets"))


@_query
def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return spam_pages.stuffed_pages(_table(spark, d, "documents"))


@_query
def p10_labels(spark: SparkSession, d: str) -> DataFrame:
    return spam_pages.labelled_pages(_table(spark, d, "documents"))


@_query
def p10_report(spark: SparkSession, d: str) -> DataFrame:
    return spam_pages.spam_report(_table(spark, d, "documents"))
