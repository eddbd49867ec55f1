"""Arrow-batch helpers: working memory follows the slice, not the batch, and slices give what whole batches give."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tokenloom.functions import alphabet, kernels
from tokenloom.operators import encode, pack

MERGES = kernels.Merges([(5, 6), (300, 7), (5, 5)], [300, 301, 302], 400)


def peak_mb(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_memory_of_coding_stays_near_its_result():
    codes = pa.array([bytes([65 + i % 20]) * 4000 for i in range(2000)])
    ids = kernels.code_lookup(alphabet.code_ids())(codes)
    pieces = [bytes([i % 256]) for i in range(258)]
    # 8 MB of codes are 32 MB of ids.
    assert peak_mb(lambda: kernels.code_lookup(alphabet.code_ids())(codes)) < 60
    assert peak_mb(lambda: kernels.id_bytes(pieces, (0, 1))(ids)) < 60


def test_memory_of_ngrams_and_words_follows_the_slice():
    draw = np.random.default_rng(1)
    ids = pa.ListArray.from_arrays(pa.array(np.arange(0, 2_000_001, 1000, dtype=np.int32)), pa.array(draw.integers(0, 50, 2_000_000).astype(np.int32)))
    batch = pa.record_batch({"key": pa.array(["train"] * len(ids)), "ids": ids})

    def grams():
        for _ in kernels.wide_ngram_counter((1, 4, 6), alphabet.code_ids())([batch]):
            pass

    assert peak_mb(grams) < 90
    words = pa.array([[[" abc", " de"] * 500]] * 2000)
    marks = pa.array([[-1]] * 2000, pa.list_(pa.int32()))
    assert peak_mb(lambda: kernels.word_encoder(np.arange(256) + 2, MERGES)(words, marks)) < 130


@pytest.mark.parametrize("kept", [1 << 17, 3])
def test_slices_give_what_the_whole_batch_gives(monkeypatch, kept):
    draw = random.Random(4)
    texts = ["".join(draw.choice(["<|pad|>", "ab", "é", "\x03\x04\x05", " ", "<|", "x"]) for _ in range(draw.choice([0, 1, 9, 60]))) for _ in range(80)]
    literals = kernels.Literals({"<|pad|>": 0})
    words = [[[f"{w} " for w in piece.split()] for piece in t.split("<|pad|>")] for t in texts]
    offsets = np.full(256, 399)
    offsets[:128] = np.arange(128) + 2

    def everything():
        split = kernels.literal_splitter(literals)(pa.array(texts))
        encoded = kernels.word_encoder(offsets, MERGES)(pa.array(words), split.field("marks"))
        codes = kernels.code_lookup(alphabet.code_ids())(pa.array([None, *(t.encode() for t in texts)]))
        back = kernels.id_bytes([bytes([i % 256] * (i % 3)) for i in range(400)], (1,))
        return [x.to_pylist() for x in (split, encoded, codes, back(encoded), back(codes))]

    monkeypatch.setattr(kernels, "SLICE", 1 << 19)
    whole = everything()
    assert [p["pieces"] for p in whole[0]] == [t.split("<|pad|>") for t in texts]
    monkeypatch.setattr(kernels, "SLICE", 7)
    monkeypatch.setattr(kernels, "CACHED_WORDS", kept)
    assert everything() == whole


def test_words_are_merged_once(monkeypatch):
    """Each batch merged its words anew."""
    merged = []
    one = kernels.merge_words
    monkeypatch.setattr(kernels, "merge_words", lambda at, ids, m: merged.append(len(at) - 1) or one(at, ids, m))
    encoder = kernels.word_encoder(np.arange(256) + 2, MERGES)
    marks = pa.array([[-1]], pa.list_(pa.int32()))
    first, second = (encoder(pa.array([[[" ab", " cd", " ab"]]]), marks) for _ in range(2))
    assert first == second and sum(merged) == 2


def test_packed_lists_come_back():
    rows = [[1, 2, 3], None, [], [7, None], [2**31 - 1]]
    values = pa.array(rows, pa.list_(pa.int32()))
    assert kernels.list_unpacker(kernels.list_packer(values)).to_pylist() == rows
    assert kernels.list_unpacker(kernels.list_packer(values)[2:]).to_pylist() == rows[2:]


def test_chunk_sizes_are_those_of_chunks_and_ids_pack_in_order(spark):
    rows = [(i, list(range(100 * i, 100 * i + n))) for i, n in enumerate([0, 1, 4, 5, 17])]
    df = spark.createDataFrame([*rows, (9, None)], "k long, input_ids array<int>")
    cut = encode.chunk(df, max_length=4).selectExpr("k", "chunk_no", "size(input_ids) n_ids").collect()
    assert sorted(cut) == sorted(encode.chunk_sizes(df, max_length=4).collect())
    blocks = pack.blocks(df.selectExpr("k", "input_ids", "0 AS batch_id"), "input_ids", ["k"], 5, ["batch_id"])
    assert dict(blocks.dtypes)["input_ids"] == "array<int>"
    joined = [i for _, ids in rows for i in ids]
    assert [r.input_ids for r in blocks.orderBy("block_no").collect()] == [joined[i : i + 5] for i in range(0, 25, 5)]


def test_rows_of_blocks_are_encoded_once(spark, tmp_path):
    """Batching read its rows twice, and with them everything before it."""
    from conftest import SMALL
    from tokenloom.plans import queries

    for name in ("word_manifest", "bpe_blocks"):
        plan = queries.registry()[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert "regexp_extract_all" not in plan, name


def test_wide_ngrams_get_small_batches(spark, monkeypatch):
    """Each of three Python workers held batches of up to 64 MB."""
    from conftest import SMALL
    from tokenloom.plans import queries

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    rows = spark.range(4000, numPartitions=1).selectExpr("id", "repeat('x', 5000) text")
    sizes = lambda: rows.mapInArrow(lambda batches: (pa.record_batch({"n": [b.nbytes]}) for b in batches), "n long").collect()
    seen, one = [], queries.cut

    def cut(df):
        seen.append(max(r.n for r in sizes()))
        return one(df)

    monkeypatch.setattr(queries, "cut", cut)
    before = spark.conf.get(name)
    queries.registry()["heldout_loss_ready"](spark, SMALL)
    assert seen[0] < 4 << 20
    assert spark.conf.get(name) == before and max(r.n for r in sizes()) > 4 << 20
