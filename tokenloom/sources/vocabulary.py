"""Vocabulary and merges on disk (S4, S5): parquet tables, or the public vocab.json and merges.txt forms."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.operators.vocab import Vocabulary

MERGES_HEADER = "#version: 0.2"


def write_tables(spark: SparkSession, vocabulary: Vocabulary, path: str) -> None:
    """``vocab`` and ``merges`` parquet tables under ``path``."""
    vocab, merges = vocabulary.tables(spark)
    vocab.write.mode("overwrite").parquet(f"{path}/vocab")
    merges.write.mode("overwrite").parquet(f"{path}/merges")


def read_tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    return spark.read.parquet(f"{path}/vocab"), spark.read.parquet(f"{path}/merges")


def write_json(spark: SparkSession, vocabulary: Vocabulary, path: str) -> None:
    """The files ``vocab.json`` (one object) and ``merges.txt`` below ``path``, as public tools read them."""
    vocab, merges = vocabulary.tables(spark)
    entry = F.struct("token", "token_id")
    whole = vocab.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))).alias("value"))
    _write_file(whole, f"{path}/vocab.json")
    rules = merges.select("rank", F.concat_ws(" ", "left", "right").alias("value"))
    header = spark.createDataFrame([(-1, MERGES_HEADER)], "rank int, value string")
    _write_file(header.union(rules).coalesce(1).sortWithinPartitions("rank").select("value"), f"{path}/merges.txt")


def _write_file(lines: DataFrame, path: str) -> None:
    """One text file in place of a folder of parts; what is written is no larger than a vocabulary."""
    spark = lines.sparkSession
    parts = f"{path}-{uuid.uuid4().hex}"
    lines.coalesce(1).write.text(parts)
    hadoop = spark._jvm.org.apache.hadoop.fs
    target, folder = hadoop.Path(path), hadoop.Path(parts)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    (part,) = [s.getPath() for s in system.listStatus(folder) if s.getPath().getName().startswith("part-")]
    if system.exists(target):
        system.delete(target, True)
    system.rename(part, target)
    system.delete(folder, True)


def read_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A learned or ready-made vocabulary as (vocab, merges) tables."""
    whole = spark.read.text(f"{path}/vocab.json", wholetext=True)
    entries = F.explode(F.from_json("value", "map<string,int>"))
    vocab = whole.select(entries.alias("token", "token_id")).select("token_id", "token")
    # The file order of merges is their rank; the file is a single one, read whole.
    text = spark.read.text(f"{path}/merges.txt", wholetext=True)
    lines = text.select(F.posexplode(F.filter(F.split("value", "\n"), _is_rule)).alias("rank", "line"))
    parts = F.split("line", " ")
    return vocab, lines.select("rank", parts[0].alias("left"), parts[1].alias("right"))


def read_tokenizer_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A ready-made vocabulary in one file: (vocab, merges, specials), the specials as (token_id, token)."""
    schema = "model struct<vocab:map<string,int>,merges:array<string>>, added_tokens array<struct<id:int,content:string,special:boolean>>"
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", schema).alias("t"))
    vocab = whole.select(F.explode("t.model.vocab").alias("token", "token_id")).select("token_id", "token")
    # A rule is written as a pair or as a line with one blank.
    rules = whole.select(F.posexplode("t.model.merges").alias("rank", "rule"))
    pair = F.from_json("rule", "array<string>")
    parts = F.when(F.col("rule").startswith("[") & (F.size(pair) == 2), pair).otherwise(F.split("rule", " "))
    added = whole.select(F.explode("t.added_tokens").alias("a")).where("a.special")
    return vocab, rules.select("rank", parts[0].alias("left"), parts[1].alias("right")), added.select(F.col("a.id").alias("token_id"), F.col("a.content").alias("token"))


def _is_rule(line):
    return (line != "") & ~line.startswith("#version")
