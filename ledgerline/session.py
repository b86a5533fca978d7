"""Session settings and the shared folder that jobs write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Starting point for a cluster of about a thousand executors. AQE shrinks the shuffle width to
# the advisory size, so the initial number only has to be large enough for the biggest stage.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(app: str = "ledgerline", cores: int | str = 8, memory: str = "8g", **conf) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_root(spark: SparkSession, label: str = "work") -> str:
    """A fresh folder below the cluster's shared checkpoint folder.

    Only a local master may fall back to a folder of this machine: on a cluster, executors
    could neither see it nor survive the loss of its host.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/ledgerline/{label}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix=f"run-{label}-")
