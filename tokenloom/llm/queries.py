"""The operators applied to their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import bpe, chat, collocations, decontaminate, embeddings, language, licences, near, pitman_yor, quality, repeats, sharding, spelling
from tokenloom.llm.common import table

SHARDS = [f"shard-{i:04d}" for i in range(256)]
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text statistics and the verdict of the n-gram likelihood ratio for every document."""
    return quality.score(table(spark, sf_dir, "documents"), quality.trusted_ids(table(spark, sf_dir, "labels")))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by cross-parsing entropy."""
    return language.identify(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document, over 256 shards."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return sharding.place(docs, ["doc_id"], SHARDS)


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from the perspective of each of its participants, turn by turn."""
    return chat.perspectives(table(spark, sf_dir, "conversations"))


def op5_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability of every document under the hierarchical Pitman-Yor model of words."""
    return pitman_yor.score(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of a benchmark item in a document, up to a fifth of the item's words edited."""
    return decontaminate.findings(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the bytes they decode to, as digests."""
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the byte strings of 200 bytes that occur more than once, as a digest."""
    return repeats.spans(table(spark, sf_dir, "documents"))


def op9_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group of every document: 2-word shingles, similarity 0.8 and more."""
    return near.groups(table(spark, sf_dir, "documents"), width=2, percent=80)


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, its own or that of its directory.

    Documents have no paths, so one is derived: source, language and a folder of 1,000 ids; a document that begins with a
    line about a licence stands for a licence file of its folder.
    """
    folder = F.floor(F.col("doc_id") / 1000).cast("string")
    starts = F.regexp_extract(F.coalesce("text", F.lit("")), "^[^\n]*", 0).rlike(licences.MARKERS)
    name = F.concat(F.when(starts, "LICENSE.").otherwise("text."), F.col("doc_id").cast("string"))
    path = F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), folder, name)
    return licences.scan(table(spark, sf_dir, "documents").select("doc_id", path.alias("path"), "text"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants of the words of all documents and the form each is led to.

    By the query's contract a run whose checksum with the document's id is divisible by 31 loses one letter.
    """
    found = spelling.runs(table(spark, sf_dir, "documents"))
    name = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "run")
    check, length = F.crc32(name.cast("binary")), F.char_length("run")
    place = (check % length).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), place), F.substring("run", place + 2, length))
    return spelling.group(spelling.counts(F.when(check % 31 == 0, cut).otherwise(F.col("run")), found))


def op12_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group of every vector: cosine 0.95 and more."""
    return embeddings.groups(table(spark, sf_dir, "embeddings"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of two and three words of each language."""
    return collocations.mine(table(spark, sf_dir, "documents"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
