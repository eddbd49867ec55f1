"""Bundle checks over a listing table (bundle, rel_path)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Files a bundle must hold, its two vocabulary files, patterns left out of it, and files copied into it.
REQUIRED = (
    "config.json",
    "tokenizer.json",
    "tokenizer_config.json",
    "special_tokens_map.json",
    "onnx/model.onnx",
)
VOCAB_FILE = "vocab.json"
MERGES_FILE = "merges.txt"
IGNORED = ("*.pt", "*.bin", "__pycache__/*", "runs/*")
KEPT = (
    "config.json",
    "tokenizer.json",
    "tokenizer_config.json",
    "special_tokens_map.json",
    "merges.txt",
    "vocab.json",
)
MODEL_FOLDER = "onnx/"
MODEL_NAME = "model.onnx"


def matches(path: Column, patterns: tuple[str, ...]) -> Column:
    """Shell-style patterns on the whole path, where ``*`` also crosses folders."""
    hit = F.lit(False)
    for pattern in patterns:
        # In SQL patterns "_" is a wildcard and must be escaped.
        like = pattern.replace("_", "\\_").replace("*", "%")
        hit = hit | path.like(like)
    return hit


def upload_set(listing: DataFrame) -> DataFrame:
    """The listing without ignored paths."""
    return listing.where(~matches(F.col("rel_path"), IGNORED))


def keep_list(listing: DataFrame) -> DataFrame:
    """Files of an exported bundle: the named ones, and of the model folder, at any depth, only files named as the model."""
    path = F.col("rel_path")
    inside = path.startswith(MODEL_FOLDER)
    return listing.where(F.when(inside, F.substring_index(path, "/", -1) == MODEL_NAME).otherwise(path.isin(*KEPT)))


def with_empty(listing: DataFrame, bundles: DataFrame | None) -> DataFrame:
    """The listing and, for every name in ``bundles(bundle)`` it lacks, one row without a path."""
    if bundles is None:
        return listing
    lacking = bundles.select("bundle").distinct().join(listing, "bundle", "left_anti")
    return listing.unionByName(lacking, allowMissingColumns=True)


def missing(listing: DataFrame, bundles: DataFrame | None = None) -> DataFrame:
    """Every (bundle, required path) that is not listed; one pass, since a bundle's findings fit one row.

    A bundle that holds no file at all is known only from ``bundles``.
    """
    has = with_empty(listing, bundles).groupBy("bundle").agg(
        F.collect_set(F.when(F.col("rel_path").isin(*REQUIRED), F.col("rel_path"))).alias("found")
    )
    required = F.array(*[F.lit(p) for p in REQUIRED])
    return has.select("bundle", F.explode(F.array_except(required, "found")).alias("missing"))


def check(listing: DataFrame, bundles: DataFrame | None = None) -> DataFrame:
    """One verdict per bundle. Merges without a vocabulary is an error, having neither is a warning."""

    def has(path: str) -> Column:
        return F.coalesce(F.bool_or(F.col("rel_path") == path), F.lit(False))

    absent = F.concat_ws(",", *[F.when(~has(p), F.lit(p)) for p in REQUIRED])
    found = with_empty(listing, bundles).groupBy("bundle").agg(
        absent.alias("missing"), has(VOCAB_FILE).alias("has_vocab"), has(MERGES_FILE).alias("has_merges")
    )
    status = (
        F.when((F.col("missing") != "") | (F.col("has_merges") & ~F.col("has_vocab")), "error")
        .when(~F.col("has_merges") & ~F.col("has_vocab"), "warning")
        .otherwise("ok")
    )
    return found.withColumn("status", status)
