"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a prime-sized table (offset and skip from hashes of its
name). The shards take turns, each claiming the first slot of its order that is still free, until the table is full. So
slots are split evenly, and a shard that comes or goes moves few other slots. A row's key is hashed to a slot; the table
has a fixed number of slots, set by a parameter, and is broadcast, so placing a row is one lookup and no shuffle.

Edge cases: a null key is hashed like any value, so all rows with it share a shard; repeated rows share a shard; an empty
table gives no rows; extra columns are kept by ``place`` (its own columns are named by parameters). Names of shards must
be distinct and there must be one at least. With several key columns a hot key can be spread over shards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 65_537
MOST_SLOTS = 5_000_000


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def preference(name: str, slots: int) -> tuple[int, int]:
    """First slot and step of a shard's order; a step below a prime size visits every slot."""
    code = hashlib.sha256(name.encode()).digest()
    return int.from_bytes(code[:8], "big") % slots, int.from_bytes(code[8:16], "big") % (slots - 1) + 1


def fill(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """Number of the shard that owns each slot."""
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards need distinct names, and one at least")
    if not is_prime(slots) or not len(shards) <= slots <= MOST_SLOTS:
        raise ValueError(f"the table needs a prime number of slots, no fewer than shards and at most {MOST_SLOTS}")
    orders = [preference(name, slots) for name in shards]
    at = [offset for offset, _ in orders]
    owner, free = [-1] * slots, slots
    while True:
        for shard, (_, step) in enumerate(orders):
            slot = at[shard]
            while owner[slot] >= 0:
                slot = (slot + step) % slots
            owner[slot] = shard
            at[shard] = (slot + step) % slots
            free -= 1
            if not free:
                return owner


def lookup(spark: SparkSession, shards: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """The table as rows (slot, shard)."""
    owner = fill(shards, slots)
    return spark.createDataFrame(pd.DataFrame({"slot": range(slots), "shard": [shards[i] for i in owner]}), "slot int, shard string")


def place(df: DataFrame, keys: Sequence[str], shards: Sequence[str], slots: int = SLOTS, slot: str = "slot", shard: str = "shard") -> DataFrame:
    """Every row with its slot and shard."""
    table = lookup(df.sparkSession, shards, slots).select(F.col("slot").alias(slot), F.col("shard").alias(shard))
    hashed = df.withColumn(slot, F.pmod(F.xxhash64(*[df[k] for k in keys]), F.lit(slots)).cast("int"))
    return hashed.join(F.broadcast(table), slot)
