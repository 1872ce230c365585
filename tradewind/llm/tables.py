"""Reading the documents table and keeping operator columns apart from the caller's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]
#: Stands for a null doc_id inside an operator: below every other id.
NO_ID = -(2**63)


def documents(spark, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/documents.parquet")


def id_key() -> Column:
    """The document id as a key that joins and sorts, nulls first."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))


def id_back(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(NO_ID))


def keyed(docs: DataFrame) -> DataFrame:
    """[d, text]: the key and the text (null: empty) only, so no other column can clash."""
    return docs.select(id_key().alias("d"), F.coalesce("text", F.lit("")).alias("text"))


def drawn_ids(rows: DataFrame, by: str, most: int, parts: int = 4) -> DataFrame:
    """At most ``most`` rows of each ``by``, by hash of doc_id: an equal number from each of ``parts`` parts of the hashes,
    so that a hot value is ranked in several tasks, and each task of a scan passes on no more rows than are drawn."""
    order = Window.partitionBy(by, "_part").orderBy(F.xxhash64("doc_id"), "doc_id")
    ranked = rows.withColumn("_part", F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(parts))).withColumn("_rank", F.row_number().over(order))
    return ranked.where(F.col("_rank") <= -(-most // parts)).drop("_part", "_rank")


def by_id(docs: DataFrame) -> DataFrame:
    """``keyed`` rows in ascending order of key and text, in ranges of keys; rows of one key are divided by how their texts begin."""
    return keyed(docs).repartitionByRange("d", F.substring("text", 1, 64)).sortWithinPartitions("d", "text")
