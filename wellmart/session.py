"""SparkSession construction for tests, the bench and local runs.

On a cluster the session comes from the platform; the jobs only read two
settings from it: ``spark.checkpoint.dir`` (shared storage used to cut lineage)
and the SQL confs below, which they never override when already set.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# SQL settings the jobs rely on (all runtime-settable, applied by configure()).
# * AQE re-plans joins from measured shuffle sizes, coalesces small shuffle
#   partitions and splits skewed join partitions (a hot well key).
# * No broadcast from plan-time size estimates (-1): a side is broadcast only
#   when AQE has measured its shuffle output below 32 MB; beyond that the
#   join stays a sort-merge join.
JOB_SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.exchange.reuse": "true",
    "spark.sql.session.timeZone": "UTC",
}

DEFAULT_CONF = {
    **JOB_SQL_CONF,
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # PySpark captures the Python call site of every DataFrame/Column call for
    # error messages (a JVM round trip each); building the jobs' large plans
    # does not need it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession, overrides: dict | None = None) -> SparkSession:
    """Set what the session leaves unset of JOB_SQL_CONF, and ``overrides`` in any case."""
    given = spark.conf.getAll
    for k, v in JOB_SQL_CONF.items():
        if k not in given:
            spark.conf.set(k, v)
    for k, v in (overrides or {}).items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "wellmart", extra: dict | None = None) -> SparkSession:
    """A local[N] session for tests and the bench (Spark UI off)."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    for kv in filter(None, os.environ.get("WELLMART_CONF", "").split(";")):
        k, v = kv.split("=", 1)
        conf[k.strip()] = v.strip()
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("WELLMART_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory.

    A cluster names shared storage in ``spark.checkpoint.dir``; that value is
    used as is. When it is unset, a ``local`` master (one machine, as in tests)
    gets a fresh scratch folder under /tmp; any other master is an error, as
    executors would write to disks that others do not see.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="wellmart-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return path
