"""A count-based next-token model fit by aggregation.

A context is one LONG: its ids as digits in base ``n_ids``, oldest first. ``gram`` is the n of an n-gram, so unigrams
have gram 1 and context 0. Where that does not fit, ``wide_counts`` writes contexts as BINARY, four bytes for each id; all
other functions take either. Counts can also be packed: a row of ``PACKED`` holds many n-grams, and all of a context.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.functions import kernels
from tokenloom.functions.alphabet import BYTE_VOCAB_SIZE, code_ids
from tokenloom.operators.lookup import is_small, left_lookup

ADD_K = 0.01
# Packed n-grams are dealt out to so many buckets, or as many as there are shuffle partitions.
BUCKETS = 512
PACKED = "gram int, keys array<{key}>, size int, ids binary, key_no binary, n binary"


def counts(
    df: DataFrame,
    grams: Sequence[int],
    by: Column | None = None,
    ids: str = "input_ids",
    n_ids: int = BYTE_VOCAB_SIZE,
) -> DataFrame:
    """L1: (gram, ctx, nxt, n), per value of ``by`` (as ``key``) if given.

    ``ids`` holds id lists or byte codes. Each Arrow batch is summed before the shuffle.
    """
    if n_ids ** max(grams) >= 2**63:
        raise ValueError(f"{max(grams)}-grams over {n_ids} ids do not fit a LONG; use wide_counts")
    source = df.select((F.lit(0) if by is None else by).alias("key"), F.col(ids).alias("ids"))
    key_type = source.schema["key"].dataType.simpleString()
    counter = kernels.ngram_counter(tuple(grams), n_ids, code_ids())
    partial = source.mapInArrow(counter, f"key {key_type}, gram int, ctx long, nxt int, n long")
    total = partial.groupBy("key", "gram", "ctx", "nxt").agg(F.sum("n").alias("n"))
    return total.drop("key") if by is None else total


def wide_counts(df: DataFrame, grams: Sequence[int], by: Column | None = None, ids: str = "input_ids", packed: bool = False) -> DataFrame:
    """L1 for n-grams of any order over any vocabulary: (gram, ctx binary, nxt, n), per value of ``by`` (as ``key``).

    ``packed`` gives the same counts as ``PACKED`` rows. A place of the text then goes through the shuffle once for all orders
    above 1, dealt by the lowest order's context, in compressed blocks; n-grams are sorted and summed as flat numbers, a few buckets at a time.
    """
    source = df.select((F.lit(0) if by is None else by).alias("key"), F.col(ids).alias("ids"))
    key_type = source.schema["key"].dataType.simpleString()
    if packed:
        buckets = max(BUCKETS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        packer, summer = kernels.ngram_packer(tuple(grams), code_ids(), buckets), kernels.ngram_summer(tuple(grams))
        partial = source.mapInArrow(packer, f"bucket int, keys array<{key_type}>, size int, contexts int, width int, block binary")
        return partial.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(summer, PACKED.format(key=key_type))
    counter = kernels.wide_ngram_counter(tuple(grams), code_ids())
    partial = source.mapInArrow(counter, f"key {key_type}, gram int, ctx binary, nxt int, n long")
    total = partial.groupBy("key", "gram", "ctx", "nxt").agg(F.sum("n").alias("n"))
    return total.drop("key") if by is None else total


def add_k(n: Column, ctx_n: Column, n_ids: int = BYTE_VOCAB_SIZE, k: float = ADD_K) -> Column:
    """L2: smoothed probability; an unseen context gives 1 / n_ids."""
    seen, total = F.coalesce(n, F.lit(0)), F.coalesce(ctx_n, F.lit(0))
    return (seen + F.lit(k)) / (total + F.lit(k * n_ids))


def probabilities(model: DataFrame, n_ids: int = BYTE_VOCAB_SIZE, k: float = ADD_K) -> DataFrame:
    """L2: counts with their context total, relative frequency and smoothed probability.

    Counts are summed already, so a context holds at most ``n_ids`` rows.
    """
    whole = Window.partitionBy("gram", "ctx")
    return (
        model.withColumn("ctx_n", F.sum("n").over(whole))
        .withColumn("share", F.col("n") / F.col("ctx_n"))
        .withColumn("p", add_k(F.col("n"), F.col("ctx_n"), n_ids, k))
    )


def loss(weight: Column, p: Column) -> list[Column]:
    """L3: pairs, mean negative log-probability and perplexity."""
    mean = F.sum(-weight * F.ln(p)) / F.sum(weight)
    return [F.sum(weight).alias("n_pairs"), mean.alias("loss"), F.exp(mean).alias("perplexity")]


def evaluate(sides: DataFrame, n_ids: int = BYTE_VOCAB_SIZE, k: float = ADD_K) -> DataFrame:
    """L3: held-out loss from counts of one gram whose ``key`` is ``train`` or ``test``; of packed counts, for each ``gram``.

    Both sides are summed together, so the data is read once and nothing is joined.
    """
    if "keys" in sides.columns:
        losses = sides.mapInArrow(kernels.count_losses(n_ids, k), "gram int, n_pairs long, loss double")
        summed = losses.groupBy("gram").agg(F.sum("n_pairs").alias("n_pairs"), F.sum("loss").alias("loss")).where("n_pairs > 0")
        mean = F.col("loss") / F.col("n_pairs")
        return summed.select("gram", "n_pairs", mean.alias("loss"), F.exp(mean).alias("perplexity"))
    return _curve(sides, [F.col("key") == "train"], F.col("key") == "test", n_ids, k).drop("part")


def learning_curve(sides: DataFrame, parts: int, n_ids: int = BYTE_VOCAB_SIZE, k: float = ADD_K) -> DataFrame:
    """L4: held-out loss of the models fit on the first 1, 2, ... ``parts`` parts.

    The ``key`` of the counts is the part of train rows, and -1 for test rows.
    """
    key = F.col("key")
    return _curve(sides, [(key >= 0) & (key <= j) for j in range(parts)], key == -1, n_ids, k)


def _curve(sides: DataFrame, fits: list[Column], held_out: Column, n_ids: int, k: float) -> DataFrame:
    def total(which: Column) -> Column:
        return F.sum(F.when(which, F.col("n")).otherwise(0))

    columns = [total(fit).alias(f"c{j}") for j, fit in enumerate(fits)]
    pairs = sides.groupBy("ctx", "nxt").agg(total(held_out).alias("n"), *columns)
    # A context has at most one row per vocabulary id by now.
    whole = Window.partitionBy("ctx")
    rates = [add_k(F.col(f"c{j}"), F.sum(f"c{j}").over(whole), n_ids, k) for j in range(len(fits))]
    held = pairs.select("n", F.array(*rates).alias("p")).where("n > 0")
    each = held.select("n", F.posexplode("p").alias("part", "p"))
    return each.groupBy("part").agg(*loss(F.col("n"), F.col("p")))


def score(
    docs: DataFrame, model: DataFrame, key: str = "key", n_ids: int = BYTE_VOCAB_SIZE, k: float = ADD_K
) -> DataFrame:
    """Loss per document. ``docs`` has counts per ``key``, ``model`` is a written table of counts of one gram."""
    seen = model.select("ctx", "nxt", F.col("n").alias("c"))
    totals = model.groupBy("ctx").agg(F.sum("n").alias("ctx_n"))
    small = is_small(model)
    joined = left_lookup(docs, seen, ["ctx", "nxt"], [key], small)
    joined = left_lookup(joined, totals, ["ctx"], [key, "nxt"], small)
    return joined.groupBy(key).agg(*loss(F.col("n"), add_k(F.col("c"), F.col("ctx_n"), n_ids, k)))


def followers(model: DataFrame) -> DataFrame:
    """The model by context, for generation: one row per (gram, ctx) with its next ids and their shares.

    A context has at most one entry per vocabulary id, so a row is bounded.
    """
    rows = model.withColumn("whole", F.sum("n").over(Window.partitionBy("gram", "ctx")))
    entry = F.struct(F.col("nxt"), (F.col("n") / F.col("whole")).alias("share"))
    listed = rows.groupBy("gram", "ctx").agg(F.array_sort(F.collect_list(entry)).alias("next"))
    return listed.select("gram", "ctx", F.col("next.nxt").alias("ids"), F.col("next.share").alias("shares"))
