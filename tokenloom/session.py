"""Session helpers: settings this package relies on, and lineage cuts that survive lost executors."""

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators are designed for; all are public Spark options.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(app: str, cpus: int | str = "*", **extra: str) -> SparkSession:
    """A local session for tests and the bench; on a cluster the caller brings its own session."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    settings = {
        **RECOMMENDED,
        "spark.ui.enabled": "false",
        "spark.driver.memory": "16g",
        "spark.sql.shuffle.partitions": "8",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the shared folder named in ``spark.checkpoint.dir``; make one only in local mode."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if configured:
        context.setCheckpointDir(configured)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tokenloom-checkpoint-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the written copy."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` to a folder of its own below the shared checkpoint folder and read it back."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, size: str = "2m") -> Iterator[None]:
    """Rows go to Python about ``size`` bytes at a time in what is run inside.

    A step that passes several Python workers holds a batch or two in each of them, and as much outside the heap for Arrow.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def discard(df: DataFrame) -> None:
    """Delete the folder of a table that ``written`` gave and nothing reads any more."""
    files = df.inputFiles()
    if files:
        folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        if re.fullmatch("[0-9a-f]{32}", folder.getName()):
            folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give a table read as fewer partitions than there are cores one per core.

    A small file is often a single row group, so one task would do all the row-local work. Large tables have more
    partitions than cores already and are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df
