"""Quality rules: plain text statistics, and a log-likelihood ratio of hashed n-grams against the raw corpus.

Word 1-grams and 2-grams are hashed into a fixed number of buckets. Two smoothed multinomials over the buckets are
counted, one from trusted documents (the target) and one from the whole corpus. A document's score is the mean over its
n-grams of log(target / raw), and a fixed threshold decides. Only DataFrame functions are used; words never leave the
row they are in, so no key is hot, and what is shuffled is one count for each bucket and task.

Trusted documents are the labelled ones with quality 1. Their ids are a bounded sample (``TRUSTED_ROWS``, smallest hash of
the id first), small enough to broadcast; raw counts cover every document.

Edge cases: a null or empty text has no words, zero everywhere, score 0 and fails the base rule (fewer than 50 words);
without any trusted document every score is 0, so only the base rule decides; repeated rows are judged each on their own;
an id that is null is never trusted; extra columns are ignored by ``score`` and kept by ``with_rules``, whatever their
names; only ``__rules`` is taken.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 10_000
THRESHOLD = -0.04
TRUSTED_ROWS = 20_000
SPACE = "[\\x20\\x09-\\x0D]+"
SOLID = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "[^#*$%&|<>]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def chained(left: Column, right: Column) -> Column:
    """Hash of each value of ``left`` with the value of ``right`` one place further, as far as there is one."""
    n = F.least(F.size(left), F.size(right) - 1)
    short = F.array().cast("array<long>")
    joined = F.zip_with(F.slice(left, 1, n), F.slice(right, 2, n), lambda a, b: F.xxhash64(a, b))
    return F.when(n > 0, joined).otherwise(short)


def bucket_of(gram: Column, buckets: int) -> Column:
    return F.pmod(gram, F.lit(buckets)).cast("int")


def weights(docs: DataFrame, trusted: DataFrame, key: str, text: str, buckets: int = BUCKETS) -> DataFrame:
    """One row with an array: log(target / raw) of each bucket. The array's length is the parameter ``buckets``."""
    good = trusted.select(F.col(trusted.columns[0]).alias("__key"), F.lit(1).alias("__trusted")).distinct()
    hashed = docs.select(F.col(key).alias("__key"), hashes(words_of(F.col(text))).alias("__ones"))
    counted = (
        hashed.join(F.broadcast(good), "__key", "left")
        .select("__trusted", F.explode(F.concat("__ones", chained(F.col("__ones"), F.col("__ones")))).alias("gram"))
        .groupBy(bucket_of(F.col("gram"), buckets).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("raw"), F.count("__trusted").alias("target"))
    )
    all_buckets = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    filled = all_buckets.join(counted, "bucket", "left").fillna(0, ["raw", "target"])
    rows = filled.agg(
        F.sort_array(F.collect_list(F.struct("bucket", "raw", "target"))).alias("rows"),
        F.sum("raw").alias("raws"),
        F.sum("target").alias("targets"),
    )
    ratio = lambda r: F.log((r["target"] + 1) / (F.col("targets") + buckets)) - F.log((r["raw"] + 1) / (F.col("raws") + buckets))
    return rows.select(
        F.when(F.col("targets") > 0, F.transform("rows", ratio)).otherwise(F.transform("rows", lambda r: F.lit(0.0))).alias("weights")
    )


def trusted_ids(labels: DataFrame, key: str = "doc_id", rows: int = TRUSTED_ROWS) -> DataFrame:
    """Ids of documents labelled as good: at most ``rows`` of them, smallest hash first."""
    good = labels.where((F.col("quality") == 1) & F.col(key).isNotNull()).select(key)
    return good.orderBy(F.xxhash64(key), key).limit(rows)


def repeated_words(threes: Column, ordered: Column, places: Column) -> tuple[Column, Column, Column]:
    """Steps to count the words inside 3-word windows that occur at least twice, each step on the last one's column.

    A document without a repeated window, the usual case, is done after the distinct count.
    """
    pairs = F.when(
        F.size(F.array_distinct(threes)) < F.size(threes),
        F.array_sort(F.transform(threes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    ).otherwise(F.array().cast("array<struct<h:long,i:int>>"))
    twice = F.array_sort(
        F.transform(
            F.filter(
                ordered,
                lambda p, j: (F.get(ordered, j + 1)["h"].eqNullSafe(p["h"])) | (F.get(ordered, j - 1)["h"].eqNullSafe(p["h"])),
            ),
            lambda p: p["i"],
        )
    )
    covered = F.aggregate(
        F.transform(places, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(places, j + 1) - p, F.lit(3)))),
        F.lit(0).cast("long"),
        lambda total, n: total + n,
    )
    return pairs, twice, covered


def with_rules(
    docs: DataFrame,
    trusted: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    buckets: int = BUCKETS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Add the struct ``__rules`` to every row: the statistics, ``llr``, ``base_failed`` and ``kept``.

    The last step stands behind a generator of one row, below which the optimizer moves no filter. A filter moved into the
    chain of steps would repeat each step's expression wherever the next one uses it.
    """
    # As many doubles as there are buckets, a parameter, so they may pass through the driver as one literal.
    table = F.lit(np.array(weights(docs, trusted, key, text, buckets).first()["weights"]))
    ordered, places, covered = repeated_words(F.col("threes"), F.col("ordered"), F.col("places"))
    lines = F.filter(F.split("body", "\n"), lambda line: line.rlike(SOLID))
    add = lambda total, gram: total + F.get(table, bucket_of(gram, buckets))
    total = F.aggregate("twos", F.aggregate("ones", F.lit(0.0), add), add)
    n_grams = F.size("ones") + F.size("twos")
    # The caller's columns travel as one struct, so that none can clash with a step's name.
    base = (
        docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("own"), F.coalesce(F.col(text), F.lit("")).alias("body"))
        .withColumns({"words": words_of(F.col("body")), "lines": lines})
        .withColumn("ones", hashes(F.col("words")))
        .withColumn("twos", chained(F.col("ones"), F.col("ones")))
        .withColumn("threes", chained(F.col("twos"), F.slice("ones", 2, F.greatest(F.size("ones"), F.lit(1)))))
        .withColumn("ordered", ordered)
        .withColumn("places", places)
    )
    rules = base.withColumn(
        "rules",
        F.struct(
            F.size("words").cast("long").alias("n_words"),
            F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace("body", SYMBOLS, "")).cast("long").alias("n_symbols"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            covered.alias("n_repeat_words"),
            F.when(n_grams > 0, total / n_grams).otherwise(0.0).alias("llr"),
        ),
    )
    counted = rules.select("own", F.explode(F.array("rules")).alias("rules"))
    failed = (F.col("rules.n_words") < 50) | (100 * F.col("rules.n_repeat_words") > 50 * F.col("rules.n_words"))
    kept = ~failed & (F.col("rules.llr") >= F.lit(threshold))
    return counted.select("own.*", F.struct("rules.*", failed.alias("base_failed"), kept.alias("kept")).alias("__rules"))


def score(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """doc_id and the statistics of every document."""
    judged = with_rules(docs.select(key, text), trusted, key, text, **options)
    return judged.select(F.col(key).alias("doc_id"), "__rules.*")


def filter_documents(docs: DataFrame, trusted: DataFrame, **options) -> DataFrame:
    """The documents that pass, with their own columns."""
    return with_rules(docs, trusted, **options).where("__rules.kept").drop("__rules")
