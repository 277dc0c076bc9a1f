"""Session construction and lineage control."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults that matter at scale: AQE re-plans joins on measured stage sizes,
# splits skewed shuffle partitions and coalesces small ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "stackyard",
                  conf: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the cluster, if any."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    return None


def set_default_checkpoint_dir(spark: SparkSession, path: str) -> str:
    """Set a checkpoint folder only when the session names none (tests)."""
    existing = checkpoint_dir(spark)
    if existing:
        return existing
    os.makedirs(path, exist_ok=True)
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir()


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared checkpoint folder, for files that one
    job writes and another reads. A session on a local master that names none
    (tests) gets a folder of its own."""
    root = checkpoint_dir(spark)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = set_default_checkpoint_dir(spark, tempfile.mkdtemp(prefix="stackyard-shared-"))
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into ``spark.checkpoint.dir``.

    Used between stacking levels and fold loops so a lost executor
    recomputes from the checkpoint, not from the raw scan. Without a
    configured folder the plan is returned unchanged.
    """
    if checkpoint_dir(df.sparkSession):
        return df.checkpoint(eager=True)
    return df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
