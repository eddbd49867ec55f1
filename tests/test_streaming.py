from collections import Counter

from pyspark.sql import functions as F

from tokenloom.operators import encode, split
from tokenloom.sources import files
from tokenloom.streaming import rows


def test_stream_equals_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("first line\n\nthird é\n" + "x" * 1200 + "\n", encoding="utf-8")
    stream = rows.encoded_stream(rows.line_stream(spark, str(folder)))
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    rows.write_stream(stream, out, state).awaitTermination()
    (folder / "b.txt").write_text("late <|endoftext|>\n")
    rows.write_stream(stream, out, state).awaitTermination()
    streamed = spark.read.parquet(out)
    sided = split.hashed(files.read_lines(spark, str(folder)), ["text"])
    batch = encode.chunk(encode.bytes_(sided.select("split", "text")))
    key = lambda df: Counter((r.split, r.chunk_no, tuple(r.input_ids)) for r in df.collect())
    assert key(streamed) == key(batch)
    assert streamed.agg(F.sum(F.size("input_ids"))).first()[0] == 11 + 1 + 9 + 1201 + 7
