"""SparkSession construction and the shared scratch folder.

Everything that must outlive a task (materialised stage outputs, the layout
used by sequential ids) is written under ``spark.checkpoint.dir``.  On a
cluster that folder is named by the cluster configuration and must be a
shared filesystem; we only pick our own folder when running in local mode
(tests, the local bench) and the setting is absent.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # size post-shuffle partitions by bytes, not by core count: on a large
    # cluster every reducer gets ~128 MB; small results collapse to few tasks
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # generated code for wide projections can exceed HotSpot's 8 KB JIT limit;
    # let the JIT compile it instead of interpreting it (applies at JVM launch)
    "spark.driver.extraJavaOptions": "-XX:-DontCompileHugeMethods",
    "spark.executor.extraJavaOptions": "-XX:-DontCompileHugeMethods",
}


def get_spark(master: str | None = None, *, shuffle_partitions: int | None = None,
              app_name: str = "pitchside", extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a shared folder for this cluster "
            "(stage outputs and id layouts are written there)")
    local = tempfile.mkdtemp(prefix="pitchside-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder for one materialised table."""
    base = checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "pitchside", *parts, uuid.uuid4().hex[:12]])
