"""Session settings the pipeline relies on, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that hold at any scale: AQE re-plans joins and partition counts from real
# sizes, splits skewed join partitions, and keeps timestamps in UTC so that documents
# parse the same everywhere.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "orderlake") -> SparkSession:
    """A session with ``SCALE_CONF``; settings given by spark-submit or the cluster win.

    Without a submitted master the session is local, with 8 shuffle partitions."""
    from pyspark import SparkConf
    given = SparkConf()
    wanted = {**SCALE_CONF, "spark.app.name": app_name, "spark.ui.enabled": "false",
              "spark.ui.showConsoleProgress": "false"}
    if master or not given.contains("spark.master"):
        wanted |= {"spark.master": master or "local[*]",
                   "spark.sql.shuffle.partitions": str(shuffle_partitions or 8),
                   "spark.driver.memory": os.environ.get("ORDERLAKE_DRIVER_MEM", "8g")}
    elif shuffle_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    builder = SparkSession.builder
    for key, value in wanted.items():
        if not given.contains(key):
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting a scratch one only if none is set.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is; the
    scratch folder is for local runs and tests only.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    scratch = tempfile.mkdtemp(prefix="orderlake-ckpt-")
    sc.setCheckpointDir(scratch)
    return scratch
