"""Positions and prefix sums over very large ordered tables, without one task ever seeing the whole order.

Rows are grouped into segments that follow the wanted order. Segment totals are summed up first (a small table), and
each segment is then scanned on its own, so a hot group is spread over as many tasks as it has segments.
"""

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenloom.functions import kernels
from tokenloom.functions.text import hash_number

HASH_DIGITS = 4
QUANTILES = 1000


def hash_segment(key: Column | str) -> Column:
    """Segment of a shuffle key: its leading digits, so segments are of even size and follow the key order."""
    return F.coalesce(hash_number(key, HASH_DIGITS), F.lit(0))


def range_segment(df: DataFrame, order: str, rows: int = 65_536) -> Column:
    """Segment of a whole-number order column: ranges between quantiles, so an outlier or a dense stretch changes nothing.

    One aggregate over a single column finds the quantiles. A segment holds about ``rows`` rows. Of a table of more than
    ``QUANTILES`` times as many, the ranges between quantiles are cut into equal widths, and a segment holds at most
    1 / ``QUANTILES`` of the table. Rows without an order value come first, as in a sort.
    """
    value = F.col(order).cast("long")
    marks = F.percentile_approx(value, [i / QUANTILES for i in range(1, QUANTILES)], 10 * QUANTILES)
    low, high, n, found = df.agg(F.min(value), F.max(value), F.count(value), marks).first()
    parts = -(-n // rows)
    if parts < 2:
        return F.when(value.isNull(), -1).otherwise(0).cast("long")
    picked = found if parts >= QUANTILES else [found[max(0, i * QUANTILES // parts - 1)] for i in range(1, parts)]
    bounds = np.unique(np.array(picked, np.int64))
    bounds = bounds[bounds > low]
    edges = np.r_[low, bounds]
    inner = max(1, -(-parts // QUANTILES))
    widths = [max(1, -(-(int(end) - int(start) + 1) // inner)) for start, end in zip(edges, [*bounds, high])]
    return F.arrow_udf(kernels.segments(edges, np.array(widths, np.int64), inner), "long")(value)


def prefix_sum(
    df: DataFrame,
    value: Column,
    order: Sequence[str],
    segment: Column,
    group: Sequence[str] = (),
    out: str = "start",
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all earlier rows of the group in ``order``."""
    keys = ["__group", "__segment"] if group else ["__segment"]
    tagged = df.withColumn("__segment", segment).withColumn("__value", value.cast("long"))
    if group:
        # One struct key, so that rows whose group is null form a group too.
        tagged = tagged.withColumn("__group", F.struct(*group))
    totals = tagged.groupBy(*keys).agg(F.sum("__value").alias("__total"))
    earlier = Window.partitionBy(*keys[:-1]).orderBy("__segment").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, F.coalesce(F.sum("__total").over(earlier), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = tagged.withColumn("__upto", F.sum("__value").over(inside))
    return scanned.join(offsets, keys).withColumn(out, F.col("__before") + F.col("__upto") - F.col("__value")).drop(
        "__group", "__segment", "__value", "__upto", "__before"
    )


def row_rank(
    df: DataFrame, order: Sequence[str], segment: Column, group: Sequence[str] = (), out: str = "rn"
) -> DataFrame:
    """Add ``out``: the zero-based position of a row in its group."""
    return prefix_sum(df, F.lit(1), order, segment, group, out)
