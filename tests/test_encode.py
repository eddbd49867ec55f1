import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import ByteLevelBPETokenizer

from tokenloom.functions import alphabet
from tokenloom.functions.text import byte_codes, code_ids, words
from tokenloom.operators import encode
from tokenloom.operators.vocab import Vocabulary

from conftest import SMALL

HARD_TEXTS = [
    "", "a", " ", "\n", "é", "🙂", "<|endoftext|>", "x<|endoftext|>y", "a  <|pad|> b", "!<|endoftext|>", "<|pad",
    "a\x00b\x7f\xa0\xad", "a　　b !\xa0\xa0c", "l'été 12'3's we're", "\t\t x  \n\n y", "日本語 テキスト", "þÿ",
]


def byte_tokenizer():
    tokens, merges = {t: i for i, t in enumerate(Vocabulary().tokens)}, []
    tok = ByteLevelBPETokenizer(vocab=tokens, merges=merges)
    tok.add_special_tokens([alphabet.PAD, alphabet.EOS])
    return tok


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "n int, text string")


def test_alphabet_values(spark):
    rows = {r.token: r.token_id for r in alphabet.byte_vocab(spark).collect()}
    assert len(rows) == 258
    ids = alphabet.byte_ids()
    assert [int(ids[b]) for b in (33, 0, 32, 127, 160, 161, 173, 174, 255)] == [2, 190, 222, 223, 256, 96, 257, 108, 189]


@pytest.mark.parametrize(
    "text,ids",
    [
        ("a", [66]), (" ", [222]), ("\n", [200]), ("é", [129, 104]), ("🙂", [174, 255, 249, 226]),
        ("<|endoftext|>", [1]), ("x<|endoftext|>y", [89, 1, 90]), ("", []),
    ],
)
def test_byte_ids(spark, text, ids):
    assert encode.bytes_(texts(spark, [text]), eos=False).first().input_ids == ids
    assert encode.bytes_(texts(spark, [text])).first().input_ids == [*ids, 1]


def test_bytes_equal_the_public_tokenizer(spark):
    tok = byte_tokenizer()
    rows = encode.bytes_(texts(spark, HARD_TEXTS), eos=False).orderBy("n").collect()
    assert [r.input_ids for r in rows] == [tok.encode(t).ids for t in HARD_TEXTS]


def test_no_merges_equals_bytes(spark):
    df = texts(spark, HARD_TEXTS)
    plain = {r.n: r.input_ids for r in encode.bytes_(df, eos=False).collect()}
    assert {r.n: r.input_ids for r in encode.bpe(df, Vocabulary()).collect()} == plain


def test_null_text_is_dropped(spark):
    df = spark.createDataFrame([(1, None), (2, "b")], "n int, text string")
    assert [r.n for r in encode.bytes_(df).collect()] == [2]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8"), max_size=60), min_size=20, max_size=40))
def test_round_trip_of_any_text(spark, values):
    df = texts(spark, values).withColumn("back", encode.decode(code_ids(byte_codes("text", eos=False))))
    assert all(r.text == r.back for r in df.collect())
    assert encode.coverage(texts(spark, values)).count() == 0


def test_broken_sequence_and_special_ids(spark):
    df = spark.createDataFrame([([97, 129], [66, 1, 0, 67])], "broken array<int>, special array<int>")
    row = df.select(
        encode.decode("broken").alias("broken"),
        encode.decode("special").alias("shown"),
        encode.decode("special", skip_special=True).alias("hidden"),
    ).first()
    assert row.broken.endswith("�")
    assert (row.shown, row.hidden) == ("a<|endoftext|><|pad|>b", "ab")


def test_special_ids_are_those_of_the_vocabulary(spark):
    """In a ready-made vocabulary the first ids are real tokens and the end-of-text literal stands last."""
    ready = Vocabulary(["a", "b", "<|endoftext|>"])
    df = spark.createDataFrame([([0, 2, 1],)], "ids array<int>")
    row = df.select(encode.decode("ids", ready).alias("shown"), encode.decode("ids", ready, skip_special=True).alias("hidden")).first()
    assert (row.shown, row.hidden) == ("a<|endoftext|>b", "ab")


def test_unicode_spaces_split_words(spark):
    df = texts(spark, ["a　　b !\xa0\xa0c"])
    assert df.select(words("text").alias("w")).first().w == ["a", "　", "　", "b", " !", "\xa0", "\xa0", "c"]


def test_chunks(spark):
    df = spark.createDataFrame([(0, [1, 2, 3, 4]), (1, [1, 2, 3]), (2, [])], "n int, input_ids array<int>")
    rows = encode.chunk(df, max_length=3).orderBy("n", "chunk_no").collect()
    assert [(r.n, r.chunk_no, r.input_ids) for r in rows] == [(0, 0, [1, 2, 3]), (0, 1, [4]), (1, 0, [1, 2, 3]), (2, 0, [])]


def test_statistics_agree_with_ids(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    total = encode.stats(docs, ["lang"]).where("lang is null").first()
    by_id = encode.id_frequency(encode.bytes_(docs.select("text"), eos=False)).agg(F.sum("n")).first()[0]
    assert total.n_tokens == by_id == docs.agg(F.sum(F.octet_length("text"))).first()[0]


def test_coverage_of_all_groups_in_one_pass(spark):
    df = spark.createDataFrame([("en", "a"), (None, "b"), (None, None), ("x", None)], "lang string, text string")
    got = {r.lang: (r.n_rows, r.n_broken) for r in encode.coverage_by(df, ["lang"]).collect()}
    assert got == {"en": (1, 0), None: (1, 0), "x": (0, 0)}
