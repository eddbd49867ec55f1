"""Batch planning over epochs."""

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.permute import places
from tokenloom.functions.text import shuffle_key, whole_div
from tokenloom.operators.ordering import hash_segment, row_rank
from tokenloom.session import cut


@dataclass(frozen=True)
class Plan:
    """Batch sizes and cadence of the two training set-ups."""

    epochs: int
    micro: int
    accum: int
    log_every: int
    eval_every: int
    save_every: int
    log_first: bool = False
    peak_rate: float = 3e-4
    warmup: float = 0.1
    seed: int = 42

    def steps(self, n_blocks: int) -> int:
        """Optimiser steps of the whole run; the last, partial step of an epoch counts."""
        return self.epochs * math.ceil(math.ceil(n_blocks / self.micro) / self.accum)


BYTE_PLAN = Plan(epochs=30, micro=8, accum=4, log_every=10, eval_every=200, save_every=200)
WORD_PLAN = Plan(epochs=15, micro=4, accum=8, log_every=1, eval_every=50, save_every=100, log_first=True)


def manifest(blocks: DataFrame, key: Sequence[str], plan: Plan = BYTE_PLAN) -> DataFrame:
    """B1, B2: every epoch visits every block once in its own order, cut into micro-batches and optimiser steps.

    Only block keys take part, no tokens. Blocks are numbered once; a block's place in an epoch is then computed from its
    number by a keyed permutation, so epochs cost no shuffle. The numbers are written, as they are read for the count too.
    """
    keyed = blocks.select(*key).withColumn("visit_key", shuffle_key(plan.seed, *key))
    ranked = row_rank(keyed, ["visit_key", *key], hash_segment("visit_key"), out="number")
    numbered = cut(ranked.select(*key, "number"))
    place = F.arrow_udf(places(numbered.count(), plan.seed), "long")
    visits = numbered.select(*key, "number", F.explode(F.sequence(F.lit(0), F.lit(plan.epochs - 1))).alias("epoch"))
    micro = whole_div(F.col("place"), plan.micro)
    placed = visits.withColumn("place", place("number", "epoch")).drop("number")
    return placed.withColumn("micro_batch", micro).withColumn("step", whole_div(micro, plan.accum))


def cadence(step: Column, plan: Plan) -> list[Column]:
    """Which steps (from 1) log, evaluate and save."""
    log = step % plan.log_every == 0
    return [
        (log | (step == 1) if plan.log_first else log).alias("logs"),
        (step % plan.eval_every == 0).alias("evaluates"),
        (step % plan.save_every == 0).alias("saves"),
    ]


def learning_rate(step: Column, total: int, plan: Plan) -> Column:
    """Linear warm-up, then half a cosine down to zero; ``step`` counts from 0."""
    warm = math.ceil(plan.warmup * total)
    progress = (step - warm) / F.lit(max(1, total - warm))
    falling = F.greatest(F.lit(0.0), 0.5 * (1.0 + F.cos(F.lit(math.pi) * progress)))
    return plan.peak_rate * F.when(step < warm, step / F.lit(max(1, warm))).otherwise(falling)


def schedule(spark: SparkSession, n_blocks: int, plan: Plan = BYTE_PLAN) -> DataFrame:
    """One row per optimiser step with the rate it uses and its cadence flags."""
    total = plan.steps(n_blocks)
    steps = spark.range(1, total + 1).withColumnRenamed("id", "step")
    return steps.select("step", learning_rate(F.col("step") - 1, total, plan).alias("rate"), *cadence(F.col("step"), plan))
