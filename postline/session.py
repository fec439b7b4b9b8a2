"""Session settings and the shared folder for intermediate tables."""

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from postline import fixed_values as fixed

SHARED_DIR = "spark.checkpoint.dir"
PARTITION_BYTES = 256 << 20


def partitions_for(input_bytes: int, cores: int) -> int:
    """Shuffle partitions that keep one partition near 256 MB, two per core at least.

    Adaptive execution merges what turns out smaller, so this errs to the high side.
    """
    return max(2 * cores, math.ceil(input_bytes / PARTITION_BYTES))


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Shuffles of plans that are run meanwhile have the partitions that the input asks for.

    Partitions are numbered before a plan runs; adaptive execution merges small ones and does not split large ones.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(partitions_for(input_bytes, spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def require_utc(spark: SparkSession) -> None:
    """Refuse a session whose days are not those of the stored dates."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "+00:00", "Z", "GMT"):
        raise ValueError(f"dates are those of UTC; the session is in {zone}")


def build_session(app: str = "postline", **conf: object) -> SparkSession:
    """A session with the settings the operators count on; `conf` keys use `__` for dots."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        "spark.sql.parquet.compression.codec": fixed.CODEC,
    }
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a local session without one gets a temporary folder."""
    named = spark.conf.get(SHARED_DIR, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SHARED_DIR} to a folder that all executors share")
    spark.conf.set(SHARED_DIR, tempfile.mkdtemp(prefix="postline-"))
    return spark.conf.get(SHARED_DIR)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, in one folder per application."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark).rstrip('/')}/{app}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    This cuts the lineage in a way that survives lost executors, evaluates the
    frame once for all later uses, and gives the planner the true size, from
    which it decides whether the frame may be broadcast.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", fixed.CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
