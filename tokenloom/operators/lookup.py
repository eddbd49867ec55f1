"""Joining a large table with a model table whose keys may be hot."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000
SALTS = 16


def is_small(table: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a table has been counted to hold at most ``rows`` rows. Needs a pass, so hand in a written table."""
    return table.limit(rows + 1).count() <= rows


def left_lookup(df: DataFrame, table: DataFrame, keys: Sequence[str], spread: Sequence[str], small: bool) -> DataFrame:
    """Left join ``df`` with ``table`` (one row per key).

    A small table is broadcast. A larger one is copied once per salt, and the rows of a hot key in ``df`` are spread
    over the salts by ``spread``.
    """
    if small:
        return df.join(F.broadcast(table), list(keys), "left")
    salt = F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")
    copies = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return df.withColumn("__salt", salt).join(copies, [*keys, "__salt"], "left").drop("__salt")
