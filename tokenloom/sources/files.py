"""Text sources and corpus, block and listing files."""

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.operators.corpus import SEPARATOR


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of text files; blank lines are kept."""
    return spark.read.text(path).withColumnRenamed("value", "text")


def read_files(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """Whole files of one folder, not its subfolders, with a flag for valid UTF-8.

    ``text`` is null where the file is not readable as text. A missing folder is an error, an empty match no rows.
    """
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    empty = _empty_files(found)
    files = found.select("path", "length", F.col("content").cast("string").alias("text")).unionByName(
        empty.select("path", F.lit(0).cast("long").alias("length"), F.lit("").alias("text"))
    )
    return files.select(
        F.regexp_extract("path", "^(.*)/[^/]+$", 1).alias("folder"),
        F.regexp_extract("path", "([^/]+)$", 1).alias("name"),
        "length",
        F.when(F.is_valid_utf8("text"), F.col("text")).alias("text"),
        F.is_valid_utf8("text").alias("readable"),
    )


def _empty_files(found: DataFrame) -> DataFrame:
    """Paths of files of length 0: the reader gives no row for them; the file index, which Spark keeps on the driver, does."""
    names = [(unquote(p).replace("file:///", "file:/", 1),) for p in found.inputFiles()]
    listed = found.sparkSession.createDataFrame(names, "path string").withColumn("place", _place(F.col("path")))
    return listed.join(found.select(_place(F.col("path")).alias("place")), "place", "left_anti").select("path")


def _place(path: Column) -> Column:
    """A path without its scheme, whose slashes differ between Spark's listings."""
    return F.regexp_replace(path, "^[a-zA-Z0-9]+:/+", "/")


def read_listing(spark: SparkSession, root: str) -> DataFrame:
    """Every file below ``root/<bundle>/`` as (bundle, rel_path, length); contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    inner = F.regexp_extract("path", "^(?:[a-z0-9]+:)?/*" + "\\Q" + root.strip("/") + "\\E" + "/+(.*)$", 1)
    files = found.select("path", "length").unionByName(_empty_files(found).select("path", F.lit(0).cast("long").alias("length")))
    return files.select(
        F.substring_index(inner, "/", 1).alias("bundle"),
        F.regexp_replace(inner, "^[^/]*/", "").alias("rel_path"),
        "length",
    )


def read_bundles(spark: SparkSession, root: str) -> DataFrame:
    """The folders below ``root`` as (bundle), those without files included; their names are listed by the driver."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return spark.createDataFrame([(s.getPath().getName(),) for s in found if s.isDirectory()], "bundle string")


def write_corpus(pieces: DataFrame, path: str, separator: str = SEPARATOR) -> None:
    """S3: text shards that, read in name order, hold the lines of the compiled file.

    ``pieces`` is one compiled corpus. Where the separator has a newline, the lines of all pieces and separators are
    written. Otherwise the separator is written after every piece, so also after the last.
    """
    _write_ordered(pieces, [], path, separator)


def write_corpora(pieces: DataFrame, group: str, path: str, separator: str = SEPARATOR) -> None:
    """S3: all corpora of a compiled table in one job, each as ``write_corpus`` would, in a folder ``<group>=<value>``.

    Rows are dealt by ranges of (group, order), so a large corpus is written by many tasks and small ones share a task.
    """
    _write_ordered(pieces, [group], path, separator)


def _write_ordered(pieces: DataFrame, group: list[str], path: str, separator: str) -> None:
    n = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if "\n" in separator:
        head, *middle, tail = separator.split("\n")
        if group:
            end = pieces.groupBy(*group).agg(F.max("ord").alias("__last"))
            joined = pieces.join(end.withColumnRenamed(group[0], "__group"), F.col(group[0]).eqNullSafe(F.col("__group")))
            last = F.col("ord") == F.col("__last")
        else:
            joined, last = pieces, F.col("ord") == F.lit(pieces.agg(F.max("ord")).first()[0])
        first = F.col("char_offset") == 0
        between = F.when(first, F.array().cast("array<string>")).otherwise(F.array(*[F.lit(m) for m in middle]))
        own = F.concat(F.when(first, "").otherwise(tail), F.col("text"), F.when(last, "").otherwise(head))
        body, ends = joined.select(*group, "ord", F.concat(between, F.split(own, "\n")).alias("value")), "\n"
        shown = F.explode("value").alias("value")
    else:
        body, ends, shown = pieces.select(*group, "ord", F.col("text").alias("value")), separator, F.col("value")
    ordered = body.repartitionByRange(n, *group, "ord").sortWithinPartitions(*group, "ord").select(*group, shown)
    ordered.write.mode("overwrite").partitionBy(*group).option("lineSep", ends).text(path)


def write_blocks(blocks: DataFrame, path: str) -> None:
    """One folder per split, for trainers."""
    blocks.write.mode("overwrite").partitionBy("split").parquet(path)
