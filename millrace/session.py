"""Session helpers: the settings the library relies on and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Read back partition folders as text: an inferred integer would turn month=01 into 1.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

# On one machine even a small shuffle is worth all cores; a cluster keeps Spark's default.
LOCAL_SETTINGS = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k"}


def local_session(cores: str = "*", **extra: str) -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("millrace")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "localhost")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**SETTINGS, **LOCAL_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_settings(spark: SparkSession) -> SparkSession:
    local = spark.sparkContext.master.startswith("local")
    for key, value in {**SETTINGS, **(LOCAL_SETTINGS if local else {})}.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name below :func:`shared_dir`."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
