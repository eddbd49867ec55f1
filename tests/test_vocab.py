from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import ByteLevelBPETokenizer, Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from tokenloom.functions import alphabet, kernels
from tokenloom.operators import encode, vocab
from tokenloom.session import ensure_checkpoint_dir
from tokenloom.sources import vocabulary as disk

from conftest import SMALL

LINES = ["aaaa aaa aa a\n", "low lower lowest  low\n", "\n", "\n", " new newer\twidest \xa0 é é é\n", "abab abab <|endoftext|>\n", "aaaaa"]


def trained(path, size, min_frequency=1):
    tok = ByteLevelBPETokenizer()
    tok.train([str(path)], vocab_size=size, min_frequency=min_frequency, special_tokens=[alphabet.PAD, alphabet.EOS])
    return tok


def saved(tok, folder):
    tok.save_model(str(folder))
    merges = (folder / "merges.txt").read_text(encoding="utf-8").split("\n")[1:]
    return [tuple(line.split(" ")) for line in merges if line]


def corpus(spark, tmp_path, lines):
    path = tmp_path / "corpus.txt"
    path.write_bytes("".join(lines).encode())
    return path, spark.createDataFrame([("".join(lines),)], "text string")


def own_merges(learnt):
    return [(learnt.tokens[a], learnt.tokens[b]) for a, b, _ in learnt.merges]


def test_word_counts_equal_the_public_pre_tokenizer(spark):
    text = "".join(LINES)
    split = ByteLevel(add_prefix_space=False)
    wanted = Counter()
    for line in text.splitlines(keepends=True):
        wanted.update(line[a:b] for _, (a, b) in split.pre_tokenize_str(line))
    rows = vocab.word_counts(spark.createDataFrame([(text,)], "text string")).collect()
    assert {r.word: r.n for r in rows} == wanted


def test_shipped_size_learns_no_merge(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    learnt = vocab.learn_merges(vocab.word_counts(docs))
    assert (len(learnt.tokens), learnt.merges) == (258, [])


@pytest.mark.parametrize("size,least", [(270, 1), (400, 1), (300, 3)])
def test_merges_equal_the_public_trainer(spark, tmp_path, size, least):
    path, df = corpus(spark, tmp_path, LINES)
    learnt = vocab.learn_merges(vocab.word_counts(df), size, least)
    assert own_merges(learnt) == saved(trained(path, size, least), tmp_path)


def test_merges_and_ids_on_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    texts = {r.doc_id: r.text for r in docs.collect()}
    path, df = corpus(spark, tmp_path, [texts[k] + "\n" for k in sorted(texts)])
    tok = trained(path, 400)
    learnt = vocab.learn_merges(vocab.word_counts(df), 400)
    assert own_merges(learnt) == saved(tok, tmp_path)
    ids = {r.doc_id: r.input_ids for r in encode.bpe(docs, learnt).collect()}
    assert ids == {k: tok.encode(t).ids for k, t in texts.items()}
    back = encode.bpe(docs, learnt).select("doc_id", encode.decode("input_ids", learnt).alias("text"))
    assert {r.doc_id: r.text for r in back.collect()} == texts


def test_independent_merges_stop_at_changed_pairs():
    names = vocab.Vocabulary()
    known = {t: i for i, t in enumerate(names.tokens)}
    vocab.take_independent([(10, 11, 9), (20, 21, 8), (11, 30, 7), (40, 41, 6)], names, known, 400)
    assert [m[:2] for m in names.merges] == [(10, 11), (20, 21)]
    vocab.take_independent([(50, 50, 9), (60, 61, 8)], names, known, 400)
    assert [m[:2] for m in names.merges][2:] == [(50, 50)]


def test_long_word_without_spaces(spark):
    learnt = vocab.learn_merges(vocab.word_counts(spark.createDataFrame([("ab" * 50 + " abc",)], "text string")), 262)
    text = "ab" * 200_000 + "c"
    df = spark.createDataFrame([(text,)], "text string")
    row = encode.bpe(df, learnt).select(encode.decode("input_ids", learnt).alias("text"), "input_ids").first()
    assert row.text == text and len(row.input_ids) < len(text) / 3


def test_vocabulary_on_disk(spark, tmp_path):
    df = spark.createDataFrame([("".join(LINES),)], "text string")
    learnt = vocab.learn_merges(vocab.word_counts(df), 280)
    disk.write_tables(spark, learnt, str(tmp_path / "tables"))
    disk.write_json(spark, learnt, str(tmp_path / "json"))
    for read, where in ((disk.read_tables, "tables"), (disk.read_json, "json")):
        again = vocab.Vocabulary.from_tables(*read(spark, str(tmp_path / where)))
        assert (again.tokens, again.merges) == (learnt.tokens, learnt.merges)


def test_public_files_can_be_read(spark, tmp_path):
    path, df = corpus(spark, tmp_path, LINES)
    tok = trained(path, 290)
    saved(tok, tmp_path)
    read = vocab.Vocabulary.from_tables(*disk.read_json(spark, str(tmp_path)))
    lines = spark.createDataFrame([(line,) for line in LINES], "text string")
    got = encode.bpe(lines.withColumn("shown", lines.text), read).collect()
    tok.add_special_tokens([alphabet.PAD, alphabet.EOS])
    assert {r.shown: r.input_ids for r in got} == {line: tok.encode(line).ids for line in LINES}


def ready(spark):
    return vocab.Vocabulary.from_tables(*disk.read_tokenizer_json(spark, public_tokenizers.path("byte_bpe_50k.json")))


def test_ready_made_vocabulary_equals_the_public_tokenizer(spark):
    words = ready(spark)
    assert (len(words.tokens), words.specials) == (50257, {alphabet.EOS: 50256})
    assert words.role_id("pad") == words.role_id("eos") == words.role_id("bos") == 50256
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [*LINES, "", "a<|pad|>b  <|endoftext|>  c", "<|endoftext|><|endoftext|>", "<|endoftext", "x" * 5000, "日本語 🙂"]
    texts += [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("text").collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    got = encode.bpe(df, words)
    assert {r.n: r.input_ids for r in got.collect()} == {n: tok.encode(t, add_special_tokens=False).ids for n, t in enumerate(texts)}
    shown = got.select("n", encode.decode("input_ids", words).alias("all"), encode.decode("input_ids", words, True).alias("plain"))
    assert {r.n: (r.all, r.plain) for r in shown.collect()} == {n: (t, t.replace(alphabet.EOS, "")) for n, t in enumerate(texts)}


def test_rules_may_be_lines_or_pairs(spark, tmp_path):
    for merges in ('[["a", "b"], ["[", "]"]]', '["a b", "[ ]"]'):
        path = tmp_path / "tokenizer.json"
        tokens = '{"a": 5, "b": 2, "[": 7, "]": 8, "ab": 4, "[]": 9}'
        path.write_text(f'{{"model": {{"vocab": {tokens}, "merges": {merges}}}, "added_tokens": [{{"id": 12, "content": "<x>", "special": true}}]}}')
        words = vocab.Vocabulary.from_tables(*disk.read_tokenizer_json(spark, str(path)))
        assert words.merges == [(5, 2, 4), (7, 8, 9)] and words.specials == {"<x>": 12} and len(words.tokens) == 13
        # Bytes without a token give nothing, ids may have gaps.
        df = spark.createDataFrame([("ab[]?<x>ba",)], "text string")
        assert encode.bpe(df, words).first().input_ids == [4, 9, 12, 2, 5]


def test_special_literals_leftmost_and_longest():
    names = {"<a>": 1, "<a><b>": 2, "a><b>c": 3, "<": 4, "é": 5, "zz": 6}
    rows = ["<a><b>c", "x<a><", "", "zzz é<a", "<<a", "z", "z", "a><b>c"]
    data = "".join(rows).encode()
    offsets = np.cumsum([0, *(len(r.encode()) for r in rows)])
    start, end, found = kernels.Literals(names).find(offsets, np.frombuffer(data, np.uint8))
    got = [(int(np.searchsorted(offsets, s, "right")) - 1, data[s:e].decode(), i) for s, e, i in zip(start, end, found.tolist())]
    want = []
    for n, row in enumerate(rows):
        at = 0
        while at < len(row):
            best = max((t for t in names if row.startswith(t, at)), key=len, default=None)
            if best:
                want.append((n, best, names[best]))
            at += len(best) if best else 1
    # Rows of no bytes begin where the next one does, so only the texts are compared.
    assert [(t, i) for _, t, i in got] == [(t, i) for _, t, i in want]


def test_thousands_of_literals(spark):
    names = {f"<extra_{i}>": 300 + i for i in range(5000)}
    words = vocab.Vocabulary(vocab.Vocabulary().tokens + [None] * 42 + list(names), [], {alphabet.EOS: 1, **names})
    df = spark.createDataFrame([("a<extra_4999><extra_1>b<extra_5000><|pad|>",)], "text string")
    plain = [int(i) for i in alphabet.byte_ids()[list(b"b<extra_5000><|pad|>")]]
    assert encode.bpe(df, words).first().input_ids == [int(alphabet.byte_ids()[ord("a")]), 5299, 301, *plain]


def test_two_thousand_ids_equal_the_public_trainer(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("text")
    path, df = corpus(spark, tmp_path, [r.text + "\n" for r in docs.collect()])
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    learnt = vocab.learn_merges(vocab.word_counts(df), 2000)
    assert own_merges(learnt) == saved(trained(path, 2000), tmp_path)
    # Every written copy is deleted once a newer one stands.
    assert set(folder.iterdir()) == before


@pytest.mark.parametrize("rewrite,candidates", [(1, 512), (3, 5), (10_000, 512)])
def test_copies_do_not_change_the_merges(spark, tmp_path, monkeypatch, rewrite, candidates):
    monkeypatch.setattr(vocab, "REWRITE", rewrite)
    monkeypatch.setattr(vocab, "CANDIDATES", candidates)
    # Many ways to the same token, so that merges make ids that exist already.
    lines = ["abcabc abc bcabc aabc abcc cab\n", "aaaa aaa bbbb abab baba ababab\n", *LINES]
    path, df = corpus(spark, tmp_path, lines)
    learnt = vocab.learn_merges(vocab.word_counts(df), 330)
    assert own_merges(learnt) == saved(trained(path, 330), tmp_path)


def test_changes_are_counted_in_touched_words_only():
    words = pa.array([[1, 2, 3, 1, 2], [4, 5], [2, 1]], pa.list_(pa.int32()))
    at, ids = kernels.flat_lists(words)
    batch = pa.RecordBatch.from_arrays([kernels.packed_lists(at, ids), pa.array([10, 100, 1000])], names=["ids", "n"])
    merges = kernels.Merges([(1, 2)], [9], 10)
    (changes,) = kernels.pair_changes(merges)([batch])
    assert {(r["left_id"], r["right_id"]): r["n"] for r in changes.to_pylist()} == {(1, 2): -20, (2, 3): -10, (3, 1): -10, (9, 3): 10, (3, 9): 10}
    assert kernels.touched(at, ids, merges).tolist() == [True, False, False]
    (after,) = kernels.merged_words(merges)([batch])
    assert [kernels.unpacked_lists(after.column(0))[1].tolist()] == [[9, 3, 9, 4, 5, 2, 1]]


def test_written_files_are_read_by_the_public_library(spark, tmp_path):
    df = spark.createDataFrame([("".join(LINES),)], "text string")
    learnt = vocab.learn_merges(vocab.word_counts(df), 300)
    for _ in range(2):  # written again in place
        disk.write_json(spark, learnt, str(tmp_path / "out"))
    files = {p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")}
    assert files == {"vocab.json", "merges.txt"} and (tmp_path / "out/vocab.json").is_file()
    tok = ByteLevelBPETokenizer.from_file(str(tmp_path / "out/vocab.json"), str(tmp_path / "out/merges.txt"))
    lines = spark.createDataFrame([(line,) for line in LINES if "<|" not in line], "text string")
    got = encode.bpe(lines.withColumn("shown", lines.text), learnt).collect()
    assert {r.shown: r.input_ids for r in got} == {r.text: tok.encode(r.text).ids for r in lines.collect()}
