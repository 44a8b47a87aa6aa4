"""Session construction and cluster-facing settings.

Nothing here is required by the operators themselves (they are plain
``DataFrame -> DataFrame`` functions); this module only gives tests, the bench
and the entry point one consistent session.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session gets.  They are the ones a cluster job would set too:
# UTC session time (the reference stores UTC timestamps), AQE for runtime
# partition coalescing / skew-join splitting / broadcast conversion, and Arrow
# for the few pandas UDFs.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Broadcast only what the planner can prove small: the static estimate
    # and AQE's runtime shuffle statistics both check against this bound.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "pricelens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:  # else the cluster's own setting
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/S3/...) folder
    and is used as is.  Only when it is unset (local tests) do we create a
    private scratch folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="pricelens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def shared_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    return os.path.join(ensure_checkpoint_dir(spark), name)
