"""Session settings and the shared folders that long jobs need."""

from __future__ import annotations

import atexit
import shutil
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job of this package relies on. The first one makes
# timestamps mean the same on every machine; the others are Spark defaults that
# must not be switched off: the adaptive planner splits hot join keys and merges
# small partitions.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings, and send the few Python helpers along with the tasks, so
    that executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[__package__])
    for key, value in SESSION_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, named by ``spark.checkpoint.dir``.

    Only a local session may go without it and gets a temporary folder, which goes
    when the session's program ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="marketlake-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared folder; nothing is created yet."""
    return f"{shared_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """``df`` as a table written once to the shared folder.

    Lost executors cost no recomputation, every later use sees the same rows and
    reads only the columns it needs, and Spark knows the size of the table.
    """
    path = work_dir(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_summary(
    left: DataFrame, summary: DataFrame, on: list[str], how: str = "inner"
) -> DataFrame:
    """Join with a summary of the left side, say one narrow row per symbol.

    The summary is written first. Its size is then known, and Spark broadcasts it
    below ``spark.sql.autoBroadcastJoinThreshold``: the left side is not shuffled
    at all. A larger summary is joined by shuffle, where hot keys are split.
    """
    return left.join(durable(summary), on, how)
