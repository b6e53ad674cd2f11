"""From raw documents to packed training sequences: five stages, each on what the one before kept.

Edge cases, in every stage: a NULL text counts as empty (quality rejects it, the
others treat it like any empty text); texts of any length are read whole; rows that
repeat are told apart by a row number and repeat in results where the stage keeps
them; a NULL doc_id loses against any other when one of a group stays; ties go to
the smaller doc_id; NULL source is a source of its own; further columns, whatever
their names, are carried along unread; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from harborline.llm import common, exact_dedup, mixing, packing, quality_rules, simhash_trie


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    common.settings(spark)
    return quality_rules.quality_cascade(docs).where("kept").select(*docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest doc_id stays."""
    common.settings(spark)
    return exact_dedup.exact_dedup(docs).where("kept").select(*docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts whose five-word shingle sets are similar (0.8), found by SimHash, the one with the smallest doc_id stays."""
    common.settings(spark)
    return simhash_trie.keep_one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; n_chars follows the drawn text."""
    common.settings(spark)
    return mixing.mixed_documents(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 2048 ids."""
    common.settings(spark)
    return packing.pack(docs).selectExpr(
        "key AS doc_id", "start", "length", "crc32(ids) AS ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality), ("exact_dedup", exact), ("simhash_near_dedup", near), ("source_mixing", mix), ("packing", pack),
]

# The tokenizer and the XXH64 fingerprints have no SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
