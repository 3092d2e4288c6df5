"""Session construction and the shared scratch / checkpoint / store location.

On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS, object
store); lineage cuts, scratch tables and stored models go there. Only a local
session without one (tests, trials) gets a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of dropped DataFrames are removed by the context cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Broadcast only what the planner has measured as small.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def build_session(master: str | None = None, app: str = "wattline",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def _configured(spark: SparkSession) -> str | None:
    return spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)


def checkpoint_root(spark: SparkSession) -> str:
    """This application's checkpoint folder, under the shared one."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = _configured(spark)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="wattline-ckpt-")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    return f"{checkpoint_root(spark)}/wattline-scratch/{name}-{uuid.uuid4().hex}"


def store_root(spark: SparkSession) -> str:
    """Folder of what outlives an application: the shared one itself, while
    `checkpoint_root` is a folder in it that Spark makes for each application."""
    shared = _configured(spark) or checkpoint_root(spark).rsplit("/", 1)[0]
    return f"{shared.rstrip('/')}/wattline-store"
