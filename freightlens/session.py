"""Session settings and the shared folder for checkpoints and stream output."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "freightlens", master: str | None = None, cores: int | None = None) -> SparkSession:
    """A session with the settings every job assumes.

    Cluster sizing (executors, memory, shuffle partitions, spark.checkpoint.dir) is left to
    spark-submit. Only semantics and adaptive execution are fixed here.
    """
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        b = b.master(master).config("spark.ui.enabled", "false")
        if master.startswith("local"):
            b = b.config("spark.driver.memory", "8g")
    if cores:
        b = b.config("spark.sql.shuffle.partitions", str(cores))
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in spark.checkpoint.dir."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if d:
        return d.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    d = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/freightlens-work"
    spark.conf.set("spark.checkpoint.dir", d)
    return d


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
