import pandas as pd
import pytest
from pyspark.sql import functions as F

from tokenloom.functions.text import byte_codes
from tokenloom.operators import corpus, encode, pack, split

from conftest import SMALL


def rows_of(spark, lists):
    rows = [("train", 0, i, ids) for i, ids in enumerate(lists)]
    return spark.createDataFrame(rows, "split string, batch_id long, pos int, input_ids array<int>")


def test_remainder_is_dropped_and_small_batches_give_nothing(spark):
    rows = [("a", 0, 0, [1, 2, 3]), ("a", 0, 1, []), ("a", 0, 2, [4, 5, 6, 7, 8, 9, 10]), ("a", 1, 0, [1, 2])]
    df = spark.createDataFrame(rows, "split string, batch_id long, pos int, input_ids array<int>")
    got = pack.with_labels(pack.blocks(df, "input_ids", ["pos"], 4), "input_ids").orderBy("block_no").collect()
    assert [(r.batch_id, r.block_no, r.input_ids) for r in got] == [(0, 0, [1, 2, 3, 4]), (0, 1, [5, 6, 7, 8])]
    assert all(r.labels == r.input_ids for r in got)
    report = {r.batch_id: (r.n_tokens, r.kept, r.dropped) for r in pack.report(df, "input_ids", 4).collect()}
    assert report == {0: (10, 8, 2), 1: (2, 0, 2)}


def test_codes_and_ids_pack_alike(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(40)
    lines = split.with_shuffle_key(corpus.lines(docs), ["doc_id", "line_no"])
    lines = lines.withColumn("split", F.lit("train"))
    order = ["shuffle_key", "doc_id", "line_no"]
    batches = pack.by_rows(lines, order, batch_rows=50)
    codes = batches.withColumn("codes", byte_codes("text"))
    by_codes = pack.with_labels(pack.blocks(codes, "codes", order, 64), "codes")
    by_ids = pack.with_labels(pack.blocks(encode.bytes_(batches), "input_ids", order, 64), "input_ids")
    key = lambda r: (r.batch_id, r.block_no)
    assert sorted(by_codes.collect(), key=key) == sorted(by_ids.collect(), key=key)
    assert by_codes.where("size(input_ids) <> 64").count() == 0


@pytest.mark.parametrize("partitions", [1, 8])
def test_blocks_equal_brute_force(spark, partitions):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    sided = split.exact(corpus.lines(docs), ["doc_id", "line_no"]).repartition(partitions)
    order = ["shuffle_key", "doc_id", "line_no"]
    rows = pack.by_rows(sided.withColumn("codes", byte_codes("text")), order, batch_rows=30)
    got = {(r.split, r.batch_id, r.block_no): bytes(r.codes) for r in pack.blocks(rows, "codes", order, 128).collect()}
    wanted = {}
    for side in ("train", "test"):
        lines = sided.where(F.col("split") == side).orderBy(*order).collect()
        for at in range(0, len(lines), 30):
            joined = b"".join(r.text.encode() + b"\xff" for r in lines[at : at + 30])
            for b in range(len(joined) // 128):
                wanted[side, at // 30, b] = joined[b * 128 : b * 128 + 128]
    assert got == wanted


def test_hot_group_is_packed_by_segments(spark):
    rows = [("hot", i, [i % 250] * (i % 5)) for i in range(4000)] + [("cold", i, [1, 2, 3]) for i in range(3)]
    df = spark.createDataFrame(rows, "source string, pos long, input_ids array<int>").repartition(5)
    keyed = split.with_shuffle_key(df, ["source", "pos"])
    order = ["shuffle_key", "pos"]
    got = pack.blocks(keyed, "input_ids", order, 16, ["source"], pack.hash_segment("shuffle_key"))
    found = {(r.source, r.block_no): r.input_ids for r in got.collect()}
    for source in ("hot", "cold"):
        joined = [i for r in keyed.where(F.col("source") == source).orderBy(*order).collect() for i in r.input_ids]
        blocks = [joined[b : b + 16] for b in range(0, len(joined) - 15, 16)]
        assert [found[source, b] for b in range(len(blocks))] == blocks
        assert (source, len(blocks)) not in found


def test_row_larger_than_many_blocks(spark):
    df = rows_of(spark, [[1], list(range(1000)), [2]])
    got = pack.blocks(df, "input_ids", ["pos"], 7).orderBy("block_no").collect()
    joined = [1, *range(1000), 2]
    assert [i for r in got for i in r.input_ids] == joined[: len(joined) // 7 * 7]


def test_user_function_over_batches(spark):
    df = spark.range(25).select(F.lit("train").alias("split"), F.floor(F.col("id") / 10).alias("batch_id"), "id")

    def two_rows(batch):
        return pd.DataFrame({"batch_id": [batch.batch_id.iloc[0]] * 2, "n": [len(batch), -1]})

    out = pack.map_batches(df, two_rows, "batch_id long, n long")
    assert sorted((r.batch_id, r.n) for r in out.collect()) == [(0, -1), (0, 10), (1, -1), (1, 10), (2, -1), (2, 5)]


def test_collation_masks_pad_labels(spark):
    df = rows_of(spark, [[5, 1], [7, 8, 9, 1]])
    short, full = pack.collate(df, ["batch_id"]).orderBy("pos").collect()
    assert (short.input_ids, short.attention_mask, short.labels) == ([5, 1, 1, 1], [1, 1, 0, 0], [5, -100, -100, -100])
    assert (full.input_ids, full.attention_mask, full.labels) == ([7, 8, 9, 1], [1, 1, 1, 1], [7, 8, 9, -100])
    assert pack.collate(df, ["batch_id"], pad_id=0).orderBy("pos").first().labels == [5, 1, -100, -100]


def test_next_token_pairs(spark):
    out = pack.next_token(rows_of(spark, [[1, 2, 3, 4], [9, 9]]), 3).orderBy("pos", "place").collect()
    assert [(r.pos, r.context, r.target) for r in out] == [(0, [1, 2], 3), (0, [2, 3], 4)]
