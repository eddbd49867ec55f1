"""Reproducible train/test splits."""

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.text import hash_number, shuffle_key
from tokenloom.session import cut

SEED = 42
TEST_SIZE = 0.1
# Rows of the segment the border falls in that are sorted at last, and hex digits of a pass.
BORDER_ROWS = 10_000
DIGITS = 3


def with_shuffle_key(df: DataFrame, key: Sequence[str], seed: int = SEED, out: str = "shuffle_key") -> DataFrame:
    """The key that puts rows in shuffled order."""
    return df.withColumn(out, shuffle_key(seed, *key))


def exact(df: DataFrame, key: Sequence[str], test_size: float = TEST_SIZE, seed: int = SEED) -> DataFrame:
    """Exactly ceil(test_size * n) rows are ``test``: the first ones in shuffled order.

    The keys are written once. Then the last test row is sought digit by digit: each pass counts the rows by their next
    digits inside the segment that holds it, until that segment has at most ``BORDER_ROWS`` rows, which are sorted.
    Labelling is a comparison with the row found, so the table itself is never shuffled and nothing is ranked as a whole.
    ``key`` must identify a row.
    """
    keyed = with_shuffle_key(df, key, seed)
    keys = cut(keyed.select("shuffle_key", *key))
    total = keys.count()
    if not total:
        return keyed.withColumn("split", F.lit("train"))
    wanted = math.ceil(test_size * total)
    if wanted >= total:
        raise ValueError(f"no train rows left: {total} rows, test_size {test_size}")
    if not wanted:
        return keyed.withColumn("split", F.lit("train"))
    # A null key has no digits and comes first, as in a sort.
    named = F.coalesce("shuffle_key", F.lit(""))
    prefix, nth, inside = "", wanted, total
    while inside > BORDER_ROWS and len(prefix) < 32:
        digits = F.substring(named, len(prefix) + 1, DIGITS)
        # At most 16 ** DIGITS rows, and one of null keys.
        for r in keys.where(named.startswith(prefix)).groupBy(digits.alias("digits")).count().orderBy("digits").collect():
            if nth <= r["count"]:
                prefix, inside = prefix + r.digits, r["count"]
                break
            nth -= r["count"]
        if not r.digits:
            break
    order = ["shuffle_key", *key]
    last = keys.where(named.startswith(prefix) if prefix else F.lit(True)).orderBy(*order).limit(nth).collect()[-1]
    edge = F.struct(*[F.lit(last[c]).cast(keys.schema[c].dataType).alias(c) for c in order])
    return keyed.withColumn("split", F.when(F.struct(*order) <= edge, "test").otherwise("train"))


def hashed(df: DataFrame, key: Sequence[str], test_size: float = TEST_SIZE, seed: int = SEED) -> DataFrame:
    """P2, and P3 with a coarser key: a row's side depends on its key alone and never changes as the table grows."""
    limit = math.ceil(test_size * 2**32)
    keyed = with_shuffle_key(df, key, seed)
    return keyed.withColumn("split", F.when(hash_number("shuffle_key") < limit, "test").otherwise("train"))


def grouped(
    df: DataFrame, group: Sequence[str], key: Sequence[str], test_size: float = TEST_SIZE, seed: int = SEED
) -> DataFrame:
    """All rows of a group stay on one side; rows are still shuffled by their own key."""
    sided = hashed(df, group, test_size, seed).drop("shuffle_key")
    return with_shuffle_key(sided, key, seed)
