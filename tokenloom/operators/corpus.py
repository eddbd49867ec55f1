"""Corpus compilation (C1-C6) and line tables."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.functions.text import file_lines, unix_newlines
from tokenloom.operators.ordering import prefix_sum, range_segment

SEPARATOR = "\n\n"


def lines(df: DataFrame, key: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """S1 on a table: one row per line of each text, keyed by ``key`` and ``line_no``."""
    return df.select(*key, F.posexplode(file_lines(unix_newlines(text))).alias("line_no", "text"))


def compile_corpus(
    df: DataFrame, group: Sequence[str], order: str, text: str = "text", separator: str = SEPARATOR
) -> DataFrame:
    """The pieces of one corpus per group, each with its character offset in that corpus.

    A corpus stays a table of pieces: written in ``order`` with the separator between them they are the compiled
    text, and no group is ever built up as one string. ``order`` is a number, unique within its group.
    """
    pieces = df.where(F.col(text).isNotNull()).select(
        *group, F.col(order).alias("ord"), unix_newlines(text).alias("text")
    )
    step = F.char_length("text") + F.lit(len(separator))
    return prefix_sum(pieces, step, ["ord"], range_segment(pieces, "ord"), group, out="char_offset")


def compile_files(files: DataFrame, separator: str = SEPARATOR) -> DataFrame:
    """C1-C4 on files: readable files of each folder in name order, as pieces with offsets."""
    # Spark's own file index already holds the full listing on the driver, so ranking the names is bounded by it.
    names = files.where("readable").select("folder", "name")
    ranked = names.withColumn("ord", F.row_number().over(Window.partitionBy("folder").orderBy("name")).cast("long"))
    kept = files.where("readable").join(ranked, ["folder", "name"])
    return compile_corpus(kept, ["folder"], "ord", separator=separator)


def summary(
    df: DataFrame,
    group: Sequence[str],
    text: str = "text",
    readable: Column | None = None,
    separator: str = SEPARATOR,
) -> DataFrame:
    """Pieces kept and rejected, and the bytes of each compiled corpus."""
    ok = F.col(text).isNotNull() if readable is None else readable
    joints = F.greatest(F.count_if(ok) - 1, F.lit(0)) * len(separator.encode())
    size = F.sum(F.when(ok, F.octet_length(unix_newlines(text))))
    return df.groupBy(*group).agg(
        F.count_if(ok).alias("kept"),
        F.count_if(~ok).alias("rejected"),
        (F.coalesce(size, F.lit(0)) + joints).alias("bytes"),
    )
