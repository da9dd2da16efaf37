"""Spark session defaults for the mart.

All settings are plain Spark configuration.  On a cluster the deployment
supplies ``spark.checkpoint.dir`` (a shared, fault-tolerant folder); the
helpers read it from the running session and only fall back to a scratch
folder when it is unset, as in local tests.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # Dimension tables (calendar, rates, branch maps) are broadcast; facts
    # never are.  Keep the automatic threshold at Spark's default size.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "ledgerline", driver_memory: str | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    if driver_memory:  # local mode: the driver JVM is the executor
        b = b.config("spark.driver.memory", driver_memory)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    Only a local master may run without ``spark.checkpoint.dir``: on a cluster
    a folder of the driver's own disk would be invisible to the executors.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}"
