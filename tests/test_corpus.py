import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tokenloom.functions.text import run_name
from tokenloom.operators import corpus
from tokenloom.sources import files


@pytest.fixture
def folder(tmp_path):
    where = tmp_path / "notes"
    (where / "sub").mkdir(parents=True)
    (where / "10.txt").write_bytes("ten\r\nlines".encode())
    (where / "1.txt").write_bytes("é\rb".encode())
    (where / "2.txt").write_bytes(b"bad\xff")
    (where / "3 é%20.txt").write_bytes(b"")
    for name in (".h.txt", "U.TXT", "sub/s.txt", "n.md"):
        (where / name).write_text("no")
    return where


def test_files_of_a_folder(spark, folder):
    rows = {r.name: (r.text, r.readable) for r in files.read_files(spark, str(folder)).collect()}
    assert rows == {
        "1.txt": ("é\rb", True), "10.txt": ("ten\r\nlines", True), "2.txt": (None, False), "3 é%20.txt": ("", True)
    }
    with pytest.raises(AnalysisException):
        files.read_files(spark, str(folder / "missing"))
    assert files.read_files(spark, str(folder), "*.rst").isEmpty()


def test_compiled_folder_and_summary(spark, folder):
    found = files.read_files(spark, str(folder))
    pieces = corpus.compile_files(found).orderBy("ord").select("ord", "char_offset", "text").collect()
    joined = "é\nb" + "\n\n" + "ten\nlines" + "\n\n" + ""
    assert [p.text for p in pieces] == ["é\nb", "ten\nlines", ""]
    assert all(joined[p.char_offset :].startswith(p.text) for p in pieces)
    row = corpus.summary(found, ["folder"], readable=F.col("readable")).first()
    assert (row.kept, row.rejected, row.bytes) == (3, 1, len(joined.encode()))


@pytest.mark.parametrize("separator", ["\n\n", "\n", "\n--- new\n", " / ", "x\ny"])
def test_written_corpus_reads_back(spark, tmp_path, separator):
    texts = [f"line {i}\nsecond {i}" if i % 3 else f"only {i}" for i in range(40)]
    df = spark.createDataFrame([("s", i, t) for i, t in enumerate(texts)], "source string, doc_id long, text string")
    pieces = corpus.compile_corpus(df, ["source"], "doc_id", separator=separator)
    files.write_corpus(pieces, str(tmp_path / "out"), separator)
    shards = sorted((tmp_path / "out").glob("part-*"))
    written = "".join(s.read_text(encoding="utf-8") for s in shards)
    assert written == separator.join(texts) + ("\n" if "\n" in separator else separator)


def test_lines_follow_the_line_reader(spark, tmp_path):
    text = "a\r\nb\rc\n\nd\n"
    (tmp_path / "one.txt").write_bytes(text.encode())
    (tmp_path / "none.txt").write_bytes(b"")
    read = [r.text for r in files.read_lines(spark, str(tmp_path / "one.txt")).collect()]
    df = spark.createDataFrame([(1, text), (2, ""), (3, None), (4, "\n")], "doc_id long, text string")
    rows = corpus.lines(df).orderBy("doc_id", "line_no").collect()
    assert read == [r.text for r in rows if r.doc_id == 1] == ["a", "b", "c", "", "d"]
    assert [(r.doc_id, r.text) for r in rows if r.doc_id > 1] == [(4, "")]


def test_hot_and_small_groups_get_offsets(spark):
    rows = [(0, t, "x" * (t % 9)) for t in range(3000)] + [(c, t, f"{c}-{t}") for c in range(1, 30) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string").repartition(5)
    out = corpus.compile_corpus(df, ["conv_id"], "turn", separator="--").collect()
    assert len(out) == len(rows)
    for conv in (0, 7):
        joined = "--".join(t for c, _, t in sorted(rows) if c == conv)
        mine = [r for r in out if r.conv_id == conv]
        assert all(joined[r.char_offset : r.char_offset + len(r.text)] == r.text for r in mine)
        assert max(r.char_offset + len(r.text) for r in mine) == len(joined)


def test_run_names(spark):
    df = spark.createDataFrame([("data/sample.txt", None), ("x/y.tar.gz", ""), ("a.txt", "mine"), ("d/.rc", None)], "path string, tag string")
    names = [r[0] for r in df.select(run_name("path", F.col("tag"), "byte-")).collect()]
    assert names == ["byte-sample", "byte-y.tar", "byte-mine", "byte-.rc"]


def test_blocks_are_written_by_split(spark, tmp_path):
    df = spark.createDataFrame([("train", [1]), ("test", [2])], "split string, input_ids array<int>")
    files.write_blocks(df, str(tmp_path / "blocks"))
    assert {p.name for p in (tmp_path / "blocks").glob("split=*")} == {"split=train", "split=test"}


@pytest.mark.parametrize("separator", ["\n\n", "\n--- new\n", " / "])
def test_all_corpora_are_written_by_one_call(spark, tmp_path, separator):
    rows = [("hot", i, f"line {i}\nsecond {i}") for i in range(300)] + [(g, i, f"{g}{i}") for g in "abc" for i in range(3)] + [(None, 0, "none")]
    df = spark.createDataFrame(rows, "source string, doc_id long, text string").repartition(5)
    pieces = corpus.compile_corpus(df, ["source"], "doc_id", separator=separator)
    files.write_corpora(pieces, "source", str(tmp_path / "out"), separator)
    folders = {p.name.split("=")[1]: p for p in (tmp_path / "out").glob("source=*")}
    assert len(list(folders["hot"].glob("part-*"))) > 1
    for name, folder in folders.items():
        source = None if name.startswith("__HIVE") else name
        texts = [t for g, _, t in rows if g == source]
        written = "".join(s.read_text(encoding="utf-8") for s in sorted(folder.glob("part-*")))
        assert written == separator.join(texts) + ("\n" if "\n" in separator else separator)
    assert len(folders) == 5
