"""Session helpers.

The library never sets a master or cluster sizing: those belong to the
deployment. It only pins what the semantics depend on (UTC session zone) and
turns on adaptive execution, which lets Spark re-plan joins and coalesce or
split shuffle partitions from the sizes it actually observes.
"""

from __future__ import annotations

import logging
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

# Settings the results depend on, or that make the plans scale-safe.
SESSION_DEFAULTS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


# Suggested settings for ~100 TB of readings on ~1000 executors (passed as
# ``build_session(conf=LARGE_CLUSTER_CONF)`` or through spark-submit):
# 256 MB input splits and shuffle targets keep a task's data well inside an
# executor's memory while giving ~400k scan tasks. Batch shuffles start at
# 8000 partitions that AQE coalesces for small aggregated stages and splits
# when skewed above 512 MB. Streaming does not use AQE: its stateful
# operators take ``spark.sql.shuffle.partitions`` as the number of state
# partitions, fixed in the checkpoint at first start, so that stays at 2000
# (two per executor), with state in RocksDB rather than on the JVM heap.
LARGE_CLUSTER_CONF: dict[str, str] = {
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "2000",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# Tables that outlive the application: the catalog is the cluster's Hive
# metastore (its address comes from hive-site.xml or spark.hadoop.* settings).
HIVE_CONF: dict[str, str] = {"spark.sql.catalogImplementation": "hive"}


def build_session(app_name: str = "meterlake", conf: dict[str, str] | None = None) -> SparkSession:
    """Return (or reuse) a session with the library defaults applied.

    ``conf`` overrides or extends the defaults; a master is only set when the
    caller passes ``spark.master`` (tests do, deployments use spark-submit).
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    pin_semantics(spark)
    return spark


def pin_semantics(spark: SparkSession) -> None:
    """Settings that results depend on; safe to call on a shared session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder, registered with the context.

    Taken from ``spark.checkpoint.dir`` (session or launch configuration),
    else from a directory already set with ``setCheckpointDir``. Only when
    neither exists and the master is local (tests) is a temporary folder
    created; on a cluster that is an error, since a machine-local folder is
    invisible to the other executors. The result is also set as the
    context's checkpoint directory, so ``DataFrame.checkpoint()`` writes
    there.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if not root and current.isDefined():
        return current.get()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder every executor can reach "
                "(stream state, spools and written tables go below it)"
            )
        root = tempfile.mkdtemp(prefix="meterlake-ckpt-")
        log.warning("spark.checkpoint.dir is unset; using local %s (local mode only)", root)
        spark.conf.set("spark.checkpoint.dir", root)
    if not current.isDefined():
        sc.setCheckpointDir(root)
    return root


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh directory below the cluster's shared checkpoint folder
    (``checkpoint_root``), for stream state, spools and written tables."""
    root = checkpoint_root(spark)
    name = "-".join(parts) if parts else "work"
    return os.path.join(root.rstrip("/"), f"{name}-{uuid.uuid4().hex[:12]}")
