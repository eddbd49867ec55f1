import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import ordering, split
from tokenloom.operators.ordering import hash_segment, prefix_sum, range_segment, row_rank


@pytest.mark.parametrize("n", [2, 10, 11, 997, 30_000])
def test_exact_sizes_and_order(spark, n):
    df = spark.range(n).withColumnRenamed("id", "doc_id")
    rows = split.exact(df, ["doc_id"]).collect()
    test = sorted(r.shuffle_key for r in rows if r.split == "test")
    train = sorted(r.shuffle_key for r in rows if r.split == "train")
    assert (len(test), len(test) + len(train)) == (math.ceil(0.1 * n), n)
    assert test[-1] < train[0]


def test_exact_needs_train_rows(spark):
    with pytest.raises(ValueError):
        split.exact(spark.range(1), ["id"])
    assert split.exact(spark.range(0), ["id"]).count() == 0


def test_hash_split_is_stable_as_the_table_grows(spark):
    small = {r.id: r.split for r in split.hashed(spark.range(500), ["id"]).collect()}
    large = {r.id: r.split for r in split.hashed(spark.range(5000).repartition(7), ["id"]).collect()}
    assert all(large[k] == v for k, v in small.items())
    assert 0.08 < sum(v == "test" for v in large.values()) / 5000 < 0.12


def test_grouped_split_keeps_groups_whole(spark):
    df = spark.range(2000).select((F.col("id") % 50).alias("doc_id"), F.col("id").alias("line_no"))
    sides = split.grouped(df, ["doc_id"], ["doc_id", "line_no"]).groupBy("doc_id").agg(F.count_distinct("split").alias("n"))
    assert sides.where("n > 1").count() == 0


def test_prefix_sums_over_hot_and_null_groups(spark):
    # One group holds most rows, another has a null key.
    rows = [("hot", None, 3)] + [("hot", i, i % 7) for i in range(3000)] + [(None, i, 2) for i in range(40)] + [("b", 5, 9)]
    df = spark.createDataFrame(rows, "g string, ord long, v int").repartition(6)
    wanted, sums = {}, {}
    for g, o, v in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0)):
        wanted[g, o] = sums.get(g, 0)
        sums[g] = wanted[g, o] + v
    segment = range_segment(df, "ord", rows=100)
    out = prefix_sum(df, F.col("v"), ["ord"], segment, ["g"]).collect()
    assert {(r.g, r.ord): r.start for r in out} == wanted
    assert df.select(segment.alias("s")).distinct().count() > 20


def test_row_rank_without_group(spark):
    df = split.with_shuffle_key(spark.range(5000), ["id"])
    ranked = row_rank(df, ["shuffle_key", "id"], hash_segment("shuffle_key")).orderBy("shuffle_key").collect()
    assert [r.rn for r in ranked] == list(range(5000))


@pytest.mark.parametrize("border,digits", [(1, 1), (7, 2), (10_000, 3)])
def test_the_border_is_found_digit_by_digit(spark, monkeypatch, border, digits):
    monkeypatch.setattr(split, "BORDER_ROWS", border)
    monkeypatch.setattr(split, "DIGITS", digits)
    df = spark.range(501).withColumnRenamed("id", "n")
    rows = split.exact(df, ["n"]).collect()
    order = sorted((hashlib.md5(f"42:{n}".encode()).hexdigest(), n) for n in range(501))
    assert {r.n for r in rows if r.split == "test"} == {n for _, n in order[:51]}
    # Equal keys have all digits in common and are told apart by the key.
    twice = split.exact(df.withColumn("n", F.col("n") % 3), ["n"])
    assert twice.where("split = 'test'").select("n").distinct().count() == 1


def test_border_of_tiny_tables(spark):
    assert [r.split for r in split.exact(spark.range(0).withColumnRenamed("id", "n"), ["n"]).collect()] == []
    assert sorted(r.split for r in split.exact(spark.range(2).withColumnRenamed("id", "n"), ["n"]).collect()) == ["test", "train"]
    with pytest.raises(ValueError):
        split.exact(spark.range(1).withColumnRenamed("id", "n"), ["n"])


def test_outliers_and_dense_stretches_leave_no_large_segment(spark, monkeypatch):
    monkeypatch.setattr(ordering, "QUANTILES", 20)
    ids = [*range(4000), *range(10**9, 10**9 + 4000, 2), 10**15, -(10**12)]
    df = spark.createDataFrame([(i,) for i in ids] + [(None,)], "ord long")
    for rows, most in ((1000, 1500), (10, 8003 // 20 * 2)):
        cut = df.select("ord", range_segment(df, "ord", rows).alias("s")).collect()
        sizes = Counter(r.s for r in cut)
        assert max(sizes.values()) <= most and sizes[-1] == 1
        inside = sorted((r.ord, r.s) for r in cut if r.ord is not None)
        assert [s for _, s in inside] == sorted(s for _, s in inside)
    assert {r.s for r in df.select(range_segment(df, "ord").alias("s")).collect()} == {-1, 0}
    assert df.where("false").select(range_segment(df.where("false"), "ord").alias("s")).collect() == []
