"""Session settings, shared work folder and size checks."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Results are defined in UTC and rely on errors instead of silent overflow.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings results depend on to an existing session."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str | int = "*", name: str = "lakestay") -> SparkSession:
    """A local session for tests and benchmarks."""
    partitions = os.cpu_count() if cores == "*" else int(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LAKESTAY_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder under the shared folder the cluster names for intermediate tables.

    Only a local session may fall back to a folder of its own machine.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="lakestay-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store, if it is there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def work_folders(spark: SparkSession, *labels: str) -> Iterator[list[str]]:
    """Work folders that are deleted at the end, also after a failure."""
    folders = [work_folder(spark, label) for label in labels]
    try:
        yield folders
    finally:
        for folder in folders:
            delete_folder(spark, folder)


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of a frame, without running it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    """True when the estimated size is within the session's broadcast threshold; -1 turns it off."""
    settings = df.sparkSession._jsparkSession.sessionState().conf()
    return 0 < plan_bytes(df) <= settings.autoBroadcastJoinThreshold()
