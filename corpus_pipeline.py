"""From raw documents to packed training sequences, as stages that each take the last one's rows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ratingloom.llm import coordinate_join, curriculum, digest_index, sum_of_squares, target_ratio
from ratingloom.llm.shared import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules or score below the threshold go."""
    return target_ratio.kept_rows(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id stays."""
    return digest_index.keep_rows(docs, digest_index.exact_duplicates(docs))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by four fifths of their five-word shingles the smallest doc_id stays."""
    return digest_index.keep_rows(docs, coordinate_join.near_duplicates(docs, words=5, percent=80))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often, and in the order, in which the curriculum reads it."""
    return curriculum.readings(docs, curriculum.written_plan(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document, with its sequence and place there."""
    return sum_of_squares.pack(sum_of_squares.encoded(
        docs, public_tokenizers.path("byte_bpe_50k.json"), end=2))


STAGES = [("quality rules", quality), ("exact dedup", exact), ("near dedup", near), ("mixing", mix),
          ("packing", packed)]

#: Scores, signatures and hash orders have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
