"""Cleaning of the documents table in stages; each stage works on all that the one before it kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All but the last
return the columns of ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import bpe, decontaminate, near, quality, repeats
from tokenloom.llm.common import table
from tokenloom.llm.queries import VOCABULARY


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or fall under the likelihood-ratio threshold go."""
    return quality.filter_documents(docs, quality.trusted_ids(table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five-word shingles, similarity 0.8 and more."""
    return near.keep_one(docs, width=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of 200 bytes that occur more than once are cut out; n_chars follows."""
    return repeats.without_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left and the bytes they decode to."""
    return bpe.encode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE encoding and decoding", encoding),
]

#: Several stages cannot be written in SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
