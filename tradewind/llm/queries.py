"""The registered query of each operator, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import (
    alignment,
    collocations,
    fuzzy_hashes,
    languages,
    line_quality,
    mixing,
    near_duplicates,
    packing,
    piece_counts,
    repeated_spans,
    sharding,
    token_files,
    word_table,
)
from tradewind.llm.tables import documents


def op1_line_quality(spark: SparkSession, root: str) -> DataFrame:
    docs = documents(spark, root)
    return line_quality.judge(docs, line_quality.fit(docs, spark.read.parquet(f"{root}/labels.parquet"))).drop("line_labels")


def op2_minhash_near_dedup(spark: SparkSession, root: str) -> DataFrame:
    return near_duplicates.near_duplicates(documents(spark, root), words=3, percent=85)


def op3_packing(spark: SparkSession, root: str) -> DataFrame:
    return packing.pack(documents(spark, root))


def op4_sharding(spark: SparkSession, root: str) -> DataFrame:
    return sharding.shard(documents(spark, root))


def op5_suffix_array_dedup(spark: SparkSession, root: str) -> DataFrame:
    return repeated_spans.remove_repeated(documents(spark, root)).drop("kept_text")


def op6_token_counts(spark: SparkSession, root: str) -> DataFrame:
    return piece_counts.piece_counts(documents(spark, root))


def op7_mixing(spark: SparkSession, root: str) -> DataFrame:
    return mixing.mix(documents(spark, root))


def op8_token_files(spark: SparkSession, root: str) -> DataFrame:
    return token_files.round_trip(documents(spark, root))


def op9_fingerprints(spark: SparkSession, root: str) -> DataFrame:
    return fuzzy_hashes.fingerprint_documents(documents(spark, root))


def op10_language_id(spark: SparkSession, root: str) -> DataFrame:
    told = languages.identify(documents(spark, root))
    return told.select("doc_id", languages.held_out().alias("held_out"), "lang_pred", F.round("score", 6).alias("score"))


def op11_collocations(spark: SparkSession, root: str) -> DataFrame:
    return collocations.collocations(documents(spark, root))


def op12_alignment(spark: SparkSession, root: str) -> DataFrame:
    return alignment.align(documents(spark, root))


def op13_word_table(spark: SparkSession, root: str) -> DataFrame:
    return word_table.round_trip(documents(spark, root))


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_quality, op2_minhash_near_dedup, op3_packing, op4_sharding, op5_suffix_array_dedup, op6_token_counts, op7_mixing, op8_token_files,
        op9_fingerprints, op10_language_id, op11_collocations, op12_alignment, op13_word_table,
    )
}
