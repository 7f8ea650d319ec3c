"""Session helpers: a builder with the settings the jobs expect, and scratch space."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "strataflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and one time zone for text and epoch values."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sized_for(input_bytes: int, cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a batch over ``input_bytes``: partitions that fit in executor memory.

    The shuffle starts with enough partitions for the whole input, at least three per core, and
    adaptive execution merges the small ones; a partition well over its size counts as skewed.
    """
    partitions = max(-(-input_bytes // partition_bytes), 3 * cores)
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
    }


def use_utc(spark: SparkSession) -> SparkSession:
    """Day and window bounds are text in the session zone, so every job pins it to UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


@contextmanager
def session_conf(spark: SparkSession, **conf: str):
    """Set SQL settings (``__`` for dots) and put the former values back afterwards."""
    keys = {key.replace("__", "."): value for key, value in conf.items()}
    before = {key: spark.conf.get(key, None) for key in keys}
    try:
        for key, value in keys.items():
            spark.conf.set(key, value)
        yield spark
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def without_shuffle_files(spark: SparkSession):
    """Writes in this block remove their shuffle files as they end; else these stay until the driver happens to collect its garbage."""
    return session_conf(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared checkpoint folder of the session.

    A cluster names a shared folder in ``spark.checkpoint.dir``. Only a session inside one process
    (tests, local mode) may leave it unset, and then gets a local temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="strataflow-")
        os.chmod(shared, 0o755)
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
