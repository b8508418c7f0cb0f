"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What the reports rely on. Adaptive execution splits hot join partitions; small
# compact partitions are kept apart because expansion multiplies their rows.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with `SETTINGS`; `extra` holds further settings by dotted name."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a local one only where none is set.

    A cluster must name one: executors do not see each other's local folders.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="loanbook-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below the scratch root."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoints(spark: SparkSession) -> None:
    """Make `DataFrame.checkpoint()` usable."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(scratch_root(spark))


def checkpointed(frame: DataFrame) -> DataFrame:
    """`frame` written once to the shared folder, for what is read more than once."""
    ensure_checkpoints(frame.sparkSession)
    return frame.checkpoint()


def written(frame: DataFrame, label: str) -> DataFrame:
    """`frame` as a table in the shared folder, until the program ends.

    Unlike a checkpoint it is read by column, has a known size, and plans that read it
    in several places share what they have in common.
    """
    spark, path = frame.sparkSession, scratch_folder(frame.sparkSession, label)
    frame.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(frame.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is None:  # the session has ended
        return
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
