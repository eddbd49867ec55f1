"""Batching, packing into fixed-length blocks, and collation (K1-K9).

Token columns are either BINARY byte codes (one byte per token) or ARRAY<INT> ids; both pack the same way. Ids are packed
as BINARY of four bytes per token, which a caller may do earlier, where the table is written or shuffled.
"""

from collections.abc import Callable, Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenloom.functions.alphabet import EOS_ID
from tokenloom.functions.text import code_ids, hash_number, packed_ids, unpacked_ids, whole_div
from tokenloom.operators.ordering import hash_segment, prefix_sum, row_rank

BATCH_ROWS = 1000
BYTE_BLOCK = 256
WORD_BLOCK = 512
# Bytes of an id in BINARY of ``packed_ids``.
ID_BYTES = 4


def is_codes(df: DataFrame, ids: str) -> bool:
    return isinstance(df.schema[ids].dataType, T.BinaryType)


def token_count(df: DataFrame, ids: str) -> Column:
    """Tokens of a row; a numeric column is taken as that count itself."""
    if isinstance(df.schema[ids].dataType, T.NumericType):
        return F.col(ids).cast("long")
    return (F.octet_length(ids) if is_codes(df, ids) else F.size(ids)).cast("long")


def by_rows(
    df: DataFrame,
    order: Sequence[str],
    by: Sequence[str] = ("split",),
    batch_rows: int = BATCH_ROWS,
    segment: Column | None = None,
) -> DataFrame:
    """K1: runs of ``batch_rows`` consecutive rows, exactly as a batched map sees them.

    ``order`` starts with a shuffle key; for another order give its ``segment`` (see ``ordering``).
    """
    segment = hash_segment(order[0]) if segment is None else segment
    ranked = row_rank(df, order, segment, by)
    return ranked.withColumn("batch_id", whole_div(F.col("rn"), batch_rows)).drop("rn")


def by_hash(
    df: DataFrame, n_batches: int | None = None, key: str = "shuffle_key", batch_rows: int = BATCH_ROWS
) -> DataFrame:
    """K1 at scale: a row's batch follows from its key, so no row number and one shuffle less.

    Unless ``n_batches`` is given, rows are counted so that a batch holds about ``batch_rows``.
    """
    if n_batches is None:
        n_batches = max(1, -(-df.count() // batch_rows))
    return df.withColumn("batch_id", F.pmod(hash_number(key, 12), F.lit(n_batches)))


def map_batches(
    df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str, keys: Sequence[str] = ("split", "batch_id")
) -> DataFrame:
    """K1 for user functions: ``fn`` gets one batch and may return any number of rows."""
    return df.groupBy(*keys).applyInPandas(fn, schema)


def blocks(
    df: DataFrame,
    ids: str,
    order: Sequence[str],
    block_size: int,
    keys: Sequence[str] = ("split", "batch_id"),
    segment: Column | None = None,
    width: int = 1,
) -> DataFrame:
    """K2-K6: join the tokens of each batch in order and cut them into blocks of exactly ``block_size``.

    Each row gives one fragment per block it touches, so no batch is ever held whole. The remainder of a batch, and
    a batch smaller than one block, give nothing. With ``segment`` a batch may be of any size (one per source, say):
    its offsets are then computed segment by segment. Without it a batch is scanned in one task, and assembling the
    blocks needs no further shuffle. ``width`` is the number of bytes of a token in a BINARY column.
    """
    if df.schema[ids].dataType.simpleString() == "array<int>":
        compact = blocks(df.withColumn(ids, packed_ids(ids)), ids, order, block_size, keys, segment, ID_BYTES)
        return compact.withColumn(ids, unpacked_ids(ids))
    codes = is_codes(df, ids)
    size = whole_div(token_count(df, ids), width) if codes else token_count(df, ids)
    rows = df.select(*{*keys, *order, ids}).where(size > 0)
    if segment is None:
        run = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        placed = rows.withColumn("upto", F.sum(size).over(run)).withColumn("start", F.col("upto") - size)
    else:
        placed = prefix_sum(rows, size, order, segment, keys).withColumn("upto", F.col("start") + size)
    return _assemble(placed, ids, codes, block_size, keys, width)


def _assemble(placed: DataFrame, ids: str, codes: bool, block_size: int, keys: Sequence[str], width: int) -> DataFrame:
    step = F.lit(block_size)
    first, last = whole_div(F.col("start"), block_size), whole_div(F.col("upto") - 1, block_size)
    touched = placed.select(*keys, "start", "upto", ids, F.explode(F.sequence(first, last)).alias("block_no"))
    left_edge = F.col("block_no") * step
    skip = F.greatest(left_edge - F.col("start"), F.lit(0))
    length = F.least(F.col("upto"), left_edge + step) - F.greatest(F.col("start"), left_edge)
    piece = (F.substring if codes else F.slice)(F.col(ids), (skip * width + 1).cast("int"), (length * width).cast("int"))
    pieces = touched.select(*keys, "block_no", "start", piece.alias("piece")).groupBy(*keys, "block_no")
    if codes:
        joined = pieces.agg(F.expr("listagg(piece) within group (order by start)").alias(ids))
        full = joined.where(F.octet_length(ids) == block_size * width)
    else:
        parts = F.array_sort(F.collect_list(F.struct("start", "piece")))
        joined = pieces.agg(F.flatten(F.transform(parts, lambda p: p["piece"])).alias(ids))
        full = joined.where(F.size(ids) == block_size)
    return full


def with_labels(packed: DataFrame, ids: str) -> DataFrame:
    """K5: ``input_ids`` and ``labels`` columns; byte codes become ids here, at the very end."""
    values = code_ids(ids) if is_codes(packed, ids) else F.col(ids)
    others = [c for c in packed.columns if c != ids]
    return packed.select(*others, values.alias("input_ids")).withColumn("labels", F.col("input_ids"))


def report(df: DataFrame, ids: str, block_size: int, keys: Sequence[str] = ("split", "batch_id")) -> DataFrame:
    """K9: tokens, full blocks, and kept and dropped tokens per batch, from lengths alone.

    ``ids`` may be a column of lengths, so that no tokens need to move.
    """
    sized = df.groupBy(*keys).agg(F.sum(token_count(df, ids)).alias("n_tokens"))
    n_blocks = whole_div(F.col("n_tokens"), block_size)
    return (
        sized.withColumn("n_blocks", n_blocks)
        .withColumn("kept", F.col("n_blocks") * block_size)
        .withColumn("dropped", F.col("n_tokens") - F.col("kept"))
    )


def block_keys(batch_report: DataFrame, keys: Sequence[str] = ("split", "batch_id")) -> DataFrame:
    """The keys of all blocks that packing will give, from a report and without packing."""
    full = batch_report.where("n_blocks > 0")
    return full.select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("block_no"))


def collate(
    df: DataFrame, keys: Sequence[str], ids: str = "input_ids", pad_id: int = EOS_ID
) -> DataFrame:
    """K7: pad every row to the longest of its micro-batch; labels at pad ids become -100.

    A micro-batch is a handful of rows. End-of-text is the pad id by default, so its labels are masked too.
    """
    longest = F.max(F.size(ids)).over(Window.partitionBy(*keys))
    sized = df.withColumn("missing", longest - F.size(ids))
    padded = F.concat(ids, F.array_repeat(F.lit(pad_id), F.col("missing")))
    mask = F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), F.col("missing")))
    return (
        sized.withColumn("attention_mask", mask)
        .withColumn(ids, padded)
        .withColumn("labels", F.transform(ids, lambda i: F.when(i == pad_id, F.lit(-100)).otherwise(i)))
        .drop("missing")
    )


def next_token(df: DataFrame, n: int, ids: str = "input_ids") -> DataFrame:
    """K8: every (context of n-1 ids, next id) of a row."""
    others = [c for c in df.columns if c not in (ids, "labels")]
    at = F.when(F.size(ids) >= n, F.sequence(F.lit(1), F.size(ids) - (n - 1))).otherwise(F.array().cast("array<int>"))
    pairs = F.transform(
        at, lambda i: F.struct(F.slice(ids, i, F.lit(n - 1)).alias("context"), F.get(ids, i + (n - 2)).alias("target"))
    )
    return df.select(*others, F.posexplode(pairs).alias("place", "pair")).select(
        *others, "place", "pair.context", "pair.target"
    )
