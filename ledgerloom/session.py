"""Session helpers: a local session for tests, and the shared folder for checkpoints and scratch."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # A fact with a large share of all readings: split its join even where that costs an exchange.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        # Small local inputs: keep a reduce partition per core instead of merging them into one.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LEDGERLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: the cluster's own setting, or a local one in tests.

    A machine-local folder is used only where the session names none, which is the case in local
    mode. On a cluster ``spark.checkpoint.dir`` has to be set.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
    folder = getattr(spark, "_ledgerloom_scratch", None)
    if folder is None:
        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark._ledgerloom_scratch = folder
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str = "cut") -> DataFrame:
    """Materialise ``df`` as a table in the shared folder, so a lost executor replays from there."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
