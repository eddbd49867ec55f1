"""Packed n-gram counts: the same counts as rows, in few rows, with all of a context in one."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tokenloom.functions import alphabet, kernels
from tokenloom.operators import ngram

ORDERS = (1, 4, 6)


def drawn_rows(seed, keys, most=70_000):
    draw = random.Random(seed)
    pool = [0, 3, 4, draw.randrange(most), most]
    return [(draw.choice(keys), [draw.choice(pool) for _ in range(draw.choice([0, 1, 3, 4, 6, 40]))]) for _ in range(80)]


def brute_force(rows, orders):
    return Counter((key, n, tuple(ids[i : i + n])) for key, ids in rows for n in orders for i in range(len(ids) - n + 1))


def unpacked(packed):
    """Counts of packed rows; no context may stand in two of them, nor twice in one."""
    found, contexts = Counter(), set()
    for r in packed:
        ids = kernels.read_numbers(r["ids"], r["size"] * r["gram"]).reshape(r["gram"], -1).T.tolist()
        runs = [(r["gram"], *i[:-1]) for i, before in zip(ids, [None, *ids]) if before is None or i[:-1] != before[:-1]]
        assert len(set(runs)) == len(runs) and not contexts & set(runs)
        contexts |= set(runs)
        for i, key, n in zip(ids, kernels.read_numbers(r["key_no"], r["size"]).tolist(), kernels.read_numbers(r["n"], r["size"]).tolist()):
            assert (r["keys"][key], r["gram"], tuple(i)) not in found
            found[r["keys"][key], r["gram"], tuple(i)] = n
    return found


def batches_of(rows, size):
    kind = pa.string() if isinstance(rows[0][0], str) else pa.int64()
    parts = [rows[i : i + size] for i in range(0, len(rows), size)]
    return [pa.record_batch({"key": pa.array([k for k, _ in p], kind), "ids": pa.array([i for _, i in p], pa.list_(pa.int32()))}) for p in parts]


@pytest.mark.parametrize("tokens, span, ngrams, buckets", [(1 << 21, 1 << 19, 1 << 17, 512), (50, 5, 20, 8), (4, 5, 1, 1)])
@pytest.mark.parametrize("orders", [ORDERS, (1,), (2,), (6, 2), (3, 4, 9)])
@pytest.mark.parametrize("most", [4, 70_000, 2**31 - 1])
def test_packed_counts_equal_brute_force(monkeypatch, tokens, span, ngrams, buckets, orders, most):
    for name, value in (("PACKED_TOKENS", tokens), ("SLICE", span), ("SUMMED_NGRAMS", ngrams)):
        monkeypatch.setattr(kernels, name, value)
    for keys in (["train", "test", "", "x"], [7, None, *range(20)]):
        rows = drawn_rows(buckets, keys, most)
        packer = kernels.ngram_packer(orders, alphabet.code_ids(), buckets)
        tasks = [batches_of(rows[:30], 9), batches_of(rows[30:], 9)]
        partial = pa.Table.from_batches([b for task in tasks for b in packer(task)]).sort_by("bucket").combine_chunks()
        packed = [r for b in kernels.ngram_summer(orders)(partial.to_batches(max_chunksize=7)) for r in b.to_pylist()]
        assert unpacked(packed) == brute_force(rows, orders)


def test_packed_counts_in_spark(spark):
    rows = [*drawn_rows(1, ["train", "test", None]), ("test", [3, 4] * 30), ("train", [3, 4] * 30)]
    df = spark.createDataFrame(rows, "split string, input_ids array<int>").repartition(5)
    packed = ngram.wide_counts(df, ORDERS, F.col("split"), packed=True)
    assert unpacked(packed.collect()) == brute_force(rows, ORDERS)
    got = {r.gram: r for r in ngram.evaluate(packed, 70_001).collect()}
    for gram in ORDERS:
        want = ngram.evaluate(ngram.wide_counts(df, (gram,), F.col("split")), 70_001).first()
        assert got[gram].n_pairs == want.n_pairs
        assert got[gram].loss == pytest.approx(want.loss) and got[gram].perplexity == pytest.approx(want.perplexity)


def test_no_held_out_pairs_give_no_loss(spark):
    df = spark.createDataFrame([("train", [5, 6, 7, 5, 6, 7]), ("test", [5, 6, 7])], "split string, input_ids array<int>")
    assert [r.gram for r in ngram.evaluate(ngram.wide_counts(df, ORDERS, F.col("split"), packed=True), 10).collect()] == [1]
    empty = ngram.wide_counts(df.where("false"), ORDERS, F.col("split"), packed=True)
    assert empty.collect() == [] and ngram.evaluate(empty, 10).collect() == []


def test_a_place_takes_few_bytes_in_few_rows():
    """Every n-gram of each order was a row of the shuffle, some 17 bytes and as many microseconds of the JVM."""
    draw = np.random.default_rng(1)
    ids = (draw.zipf(1.3, 400_000) % 50_000).astype(np.int32)
    batch = pa.record_batch({"key": pa.array(["train", "test"] * 200), "ids": pa.ListArray.from_arrays(pa.array(np.arange(401, dtype=np.int32) * 1000), pa.array(ids))})
    partial = pa.Table.from_batches(kernels.ngram_packer(ORDERS, alphabet.code_ids(), 512)([batch]))
    assert len(partial) <= 513
    assert partial["block"].nbytes < 8 * len(ids)


def test_the_query_counts_packed(spark):
    """Rows of n-grams were written, and read once for each order."""
    from conftest import SMALL
    from tokenloom.plans import queries

    seen, one = [], queries.cut

    def cut(df):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString())
        return one(df)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(queries, "cut", cut)
        found = queries.registry()["heldout_loss_ready"](spark, SMALL)
    assert sorted(r.gram for r in found.collect()) == [1, 4, 6] and found.columns == ["gram", "n_pairs", "loss", "perplexity"]
    (plan,) = seen
    assert plan.count("Scan") + plan.count("Relation") == 1 and "ctx" not in plan and "block" in plan
