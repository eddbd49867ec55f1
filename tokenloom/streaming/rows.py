"""The stateless row functions on a stream of text files: line scan, newline rule, hash split, encode, chunk.

Nothing here keeps state, so there is no watermark: a row's result depends on that row alone.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tokenloom.functions.text import byte_codes, code_ids
from tokenloom.operators import encode, split


def line_stream(spark: SparkSession, folder: str) -> DataFrame:
    """S1 on files as they arrive."""
    return spark.readStream.text(folder).withColumnRenamed("value", "text")


def encoded_stream(lines: DataFrame, test_size: float = split.TEST_SIZE, max_length: int = 512) -> DataFrame:
    """(split, chunk_no, input_ids). A line's side follows from its text."""
    sided = split.hashed(lines.where("text is not null"), ["text"], test_size)
    ids = sided.select("split", code_ids(byte_codes(F.col("text"))).alias("input_ids"))
    return encode.chunk(ids, max_length=max_length)


def write_stream(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append to one folder per split; all files there now, then stop."""
    writer = rows.writeStream.format("parquet").partitionBy("split").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(out)
