"""Writing an intermediate result once when several later steps read it, and letting go of shuffled rows."""

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster.

    Only a local session may fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="wattframe-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return os.path.join(shared_folder(spark), f"{purpose}-{uuid.uuid4().hex}")


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside delete their shuffled rows when they end.

    Otherwise these stay on the executors' disks until the driver happens to
    collect garbage, beside those of the next step. For writes that nothing runs
    a second time; a frame that is run again has to shuffle its rows again.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def staged(df: DataFrame) -> DataFrame:
    """Runs the plan once and stores its rows reliably.

    Used on aggregated rows that several passes read. The stored rows outlive
    lost executors, so no pass repeats the scan below.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
