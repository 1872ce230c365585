"""From raw documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

import functools
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.llm import languages, mixing, near_duplicates, packing, repeated_spans
from tradewind.llm.tables import DOCUMENT, documents, id_key
from tradewind.sources.stages import materialize

#: A document is rejected if its language holds less than this part of its letter n-grams.
LEAST_KNOWN = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents in a language that was learned: no ``und``, and enough known n-grams."""
    told = languages.identify(docs, tuple(DOCUMENT))
    return told.where((F.col("lang_pred") != "und") & (F.col("known") >= LEAST_KNOWN)).select(*DOCUMENT)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies: the one with the smallest id (null below all), of several with
    one id the one with the least hash of its other columns. Rows without near copies stay, whatever their ids are."""
    # Numbered and written, as a row keeps its number only then.
    rows = materialize(docs.select(*DOCUMENT, F.monotonically_increasing_id().alias("row")))
    groups = near_duplicates.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text"))
    order = F.struct(id_key().alias("d"), F.xxhash64("text", "lang", "source", "n_chars").alias("h"), "row")
    ranked = rows.select("row", order.alias("rank")).join(groups.select(F.col("doc_id").alias("row"), "component_id"), "row")
    kept = ranked.groupBy("component_id").agg(F.min("rank").alias("rank")).select("rank.row")
    return rows.join(kept, "row").select(*DOCUMENT)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut every passage that already stands earlier in the corpus; documents stay, with what is left of them."""
    cut = repeated_spans.remove_repeated(docs, carry=("doc_id", "lang", "source"))
    return cut.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Give out the documents by tempered source weights: a row for every time a document is used."""
    return mixing.mixed_documents(docs.select(*DOCUMENT))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: a row per piece with its ids."""
    return packing.pack(docs, with_ids=True)


def _with_folder(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage in a session that names a folder for intermediate results: only a local session without one gets one."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, *args) -> DataFrame:
        context = spark.sparkContext
        if context.master.split("[")[0] == "local" and not (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
        return stage(spark, *args)

    return run_stage


STAGES = [
    ("language_id", _with_folder(language_id)),
    ("minhash_near_dedup", _with_folder(near_dedup)),
    ("suffix_array_dedup", _with_folder(suffix_array_dedup)),
    ("mix_sources", _with_folder(mix_sources)),
    ("pack_sequences", _with_folder(pack_sequences)),
]

#: SQL expresses neither the trained language model nor the tokenizer; tests compare with a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result but the last is written and read again."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        # Written and read again, as each stage's output is the next one's table.
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
