"""Session settings for local runs (tests, bench). Library functions never build a
session; on a cluster the caller's settings apply."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: An action's shuffle files go when it ends, not when the driver happens to collect its
#: garbage; files are written in the smaller codec.
SPARE_DISK = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, driver_memory: str = "8g") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName("lastmile")
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


@contextmanager
def sparing_disk(spark: SparkSession) -> Iterator[None]:
    """``SPARE_DISK`` for a run of many actions in a row; then the caller's settings again."""
    before = {k: spark.conf.get(k, None) for k in SPARE_DISK}
    try:
        for k, v in SPARE_DISK.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder: the session's ``spark.checkpoint.dir`` when set
    (a cluster names one). Only a local-mode session (tests, bench) may fall back to
    a scratch folder on this machine; on a cluster an unset folder is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and fallback is None and sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or an object store)")
    path = configured or fallback or tempfile.mkdtemp(prefix="lastmile-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
