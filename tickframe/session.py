"""SparkSession helpers.

Cluster settings win: nothing here overrides a value the session already
has, except in ``get_spark`` which is only a convenience for tests, the
bench and local runs.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "tickframe", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with sane defaults for local runs."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(LOCAL_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    A session on one machine (tests, the bench) that names none gets a folder of
    its own; on a cluster that is an error, as executors would not share it.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tickframe-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default
