"""Encoding, decoding and token statistics."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions import alphabet, kernels
from tokenloom.functions.text import as_column, byte_codes, code_ids, whole_div, words
from tokenloom.operators.ngram import counts
from tokenloom.operators.vocab import Vocabulary


def bytes_(df: DataFrame, text: str = "text", eos: bool = True, out: str = "input_ids") -> DataFrame:
    """One id per UTF-8 byte, literals as their single id, and end-of-text after every row."""
    return df.where(F.col(text).isNotNull()).withColumn(out, code_ids(byte_codes(text, eos))).drop(text)


def bpe(df: DataFrame, vocabulary: Vocabulary, text: str = "text", out: str = "input_ids") -> DataFrame:
    """Pre-tokenised words with merges applied in rank order; nothing is added at row ends.

    The vocabulary's special literals are set apart first, leftmost and longest first, and nothing runs into one; any other
    literal is ordinary text. Map-only: the merge table, whose size the vocabulary bounds, travels with the job, and each
    distinct word of an Arrow batch is merged once.
    """
    split = F.arrow_udf(kernels.literal_splitter(kernels.Literals(vocabulary.specials)), "struct<pieces:array<string>,marks:array<int>>")
    encode = F.arrow_udf(kernels.word_encoder(vocabulary.byte_ids(), vocabulary.merge_table()), "array<int>")
    parts = df.where(F.col(text).isNotNull()).withColumn("__parts", split(F.make_valid_utf8(F.col(text))))
    worded = F.transform("__parts.pieces", lambda piece: words(piece))
    return parts.withColumn(out, encode(worded, F.col("__parts.marks"))).drop("__parts", text)


def chunk(df: DataFrame, ids: str = "input_ids", max_length: int = 512, out: str = "chunk_no") -> DataFrame:
    """A long row becomes ceil(n / max_length) rows and nothing is lost; an empty row stays one empty row."""
    last = F.greatest(whole_div(F.size(ids) - 1, max_length), F.lit(0)).cast("int")
    parts = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.slice(ids, i * max_length + 1, F.lit(max_length))
    )
    others = [c for c in df.columns if c != ids]
    return df.select(*others, F.posexplode(parts).alias(out, ids))


def chunk_sizes(df: DataFrame, ids: str = "input_ids", max_length: int = 512, out: str = "chunk_no", size: str = "n_ids") -> DataFrame:
    """The rows of ``chunk`` with the number of ids in place of the ids, so that no list is cut."""
    last = F.greatest(whole_div(F.size(ids) - 1, max_length), F.lit(0)).cast("int")
    size_of = lambda i: F.when(F.size(ids) >= 0, F.least(F.size(ids) - i * max_length, F.lit(max_length)))
    parts = F.transform(F.sequence(F.lit(0), last), size_of)
    others = [c for c in df.columns if c != ids]
    return df.select(*others, F.posexplode(parts).alias(out, size))


def decoded_bytes(ids: Column | str, vocabulary: Vocabulary | None = None, skip_special: bool = False) -> Column:
    """E5: ids -> the bytes they stand for."""
    vocabulary = vocabulary or Vocabulary()
    skip = tuple(vocabulary.specials.values()) if skip_special else ()
    return F.arrow_udf(kernels.id_bytes(vocabulary.byte_strings(), skip), "binary")(as_column(ids))


def decode(ids: Column | str, vocabulary: Vocabulary | None = None, skip_special: bool = False) -> Column:
    """E5: ids -> bytes -> text; partial characters become U+FFFD."""
    return F.make_valid_utf8(decoded_bytes(ids, vocabulary, skip_special).cast("string"))


def coverage(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows whose decoded encoding differs from the text (none, for a byte vocabulary)."""
    back = decode(code_ids(byte_codes(text, eos=False)))
    return df.where(F.col(text).isNotNull()).withColumn("decoded", back).where(F.col("decoded") != F.col(text))


def coverage_by(df: DataFrame, by: Sequence[str], text: str = "text") -> DataFrame:
    """E6 per group: rows, and rows that don't come back from encoding, in one aggregate."""
    back = decode(code_ids(byte_codes(text, eos=False)))
    checked = df.select(*by, F.col(text).alias("text"), back.alias("back"))
    return checked.groupBy(*by).agg(F.count("text").alias("n_rows"), F.count_if(F.col("back") != F.col("text")).alias("n_broken"))


def stats(df: DataFrame, by: Sequence[str], text: str = "text") -> DataFrame:
    """Rows, tokens and characters per group, with subtotals. Needs byte codes only, no ids."""
    tokens = F.octet_length(byte_codes(text, eos=False)).cast("long")
    return df.rollup(*by).agg(
        F.count(text).alias("n_rows"),
        F.sum(tokens).alias("n_tokens"),
        F.sum(F.char_length(text)).alias("n_chars"),
        F.max(tokens).alias("max_tokens"),
    )


def id_frequency(df: DataFrame, by: str | None = None, ids: str = "input_ids") -> DataFrame:
    """How often each token id occurs, per value of ``by``; summed per Arrow batch before the shuffle."""
    key = None if by is None else F.col(by)
    found = counts(df, (1,), key, ids, 2**31 - 1)
    total = found.select("nxt", "n") if by is None else found.select(F.col("key").alias(by), "nxt", "n")
    return total.withColumnRenamed("nxt", "token_id")
