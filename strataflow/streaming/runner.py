"""Reading files as streams and running queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from strataflow.session import ROCKSDB, scratch_path, session_conf


def state_settings(spark: SparkSession) -> dict[str, str]:
    """Settings a stateful query fixes at its first start.

    State partitions cannot be merged later, so one per core replaces the batch default; set
    ``strataflow.state.partitions`` for another number.
    """
    cores = spark.sparkContext.defaultParallelism
    return {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.shuffle.partitions": spark.conf.get("strataflow.state.partitions", str(cores)),
        # State is written to each executor and again to the checkpoint.
        "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    }


def start(
    stream: DataFrame,
    checkpoint: str,
    table: str | None = None,
    each_batch: Callable[[DataFrame, int], None] | None = None,
    trigger: dict | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Start a query into a parquet folder (exactly once) or a per-batch function.

    The default trigger is every three seconds; each job needs a checkpoint
    folder of its own.
    """
    with session_conf(stream.sparkSession, **state_settings(stream.sparkSession)):
        writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        writer = writer.trigger(**(trigger or {"processingTime": "3 seconds"}))
        if each_batch is not None:
            return writer.foreachBatch(each_batch).start()
        return writer.format("parquet").option("path", table).start()


def run_available(stream: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Run a query over all input present and return its output table."""
    spark = stream.sparkSession
    folder = folder or scratch_path(spark, label)
    query = start(stream, f"{folder}/checkpoint", table=f"{folder}/table", trigger={"availableNow": True})
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/table")
