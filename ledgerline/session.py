"""Spark session defaults and the shared working folder.

Everything that must survive executor loss (published bronze batches, streaming checkpoints,
lineage cuts) goes below ``spark.checkpoint.dir``, which names a shared file system and is read from
the session.
"""

from __future__ import annotations

import gc
import time
import uuid

from pyspark.sql import SparkSession

DEFAULTS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # bronze batch directories carry string ids that must not be parsed as numbers
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


RELEASE_S = 4
_released = float("-inf")


def get_session(
    master: str | None = None,
    app_name: str = "ledgerline",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    The launcher names the master (spark-submit, or the cluster's configuration); ``master`` is for
    tests and single-machine runs that have no launcher.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a session without it is an error.

    A folder of one machine is not visible to executors and does not survive their loss, so none is
    made up here. Tests and single-machine runs set their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    return root.rstrip("/")


def release(spark: SparkSession) -> None:
    """Asks for the disk of finished jobs: their shuffle files go once the driver has collected the plans
    that made them, which a driver with room in its heap would not do for a long time. Not more often than
    every ``RELEASE_S`` seconds: steps shorter than that leave little."""
    global _released
    if time.monotonic() - _released > RELEASE_S:
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        _released = time.monotonic()


def shared_dir(spark: SparkSession, name: str, unique: bool = True) -> str:
    """A fresh sub folder of the shared folder for one job (``unique``) or a fixed one."""
    suffix = f"{name}-{uuid.uuid4().hex[:12]}" if unique else name
    return f"{checkpoint_root(spark)}/{suffix}"
