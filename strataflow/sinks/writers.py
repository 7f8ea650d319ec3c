"""Sinks without own state: message topics, JDBC, console."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strataflow.functions import processed_at_millis, snake_case

# Batch size of the summary sink (fixed value).
JDBC_ROWS = "1024"


def json_messages(rows: DataFrame, topic: str | None = None) -> DataFrame:
    """Rows as JSON text in ``value``, optionally with their topic."""
    message = F.to_json(F.struct(*rows.columns)).alias("value")
    return rows.select(message) if topic is None else rows.select(F.lit(topic).alias("topic"), message)


def keyed_messages(rows: DataFrame, keys: Sequence[str], deleted: str | None = None) -> DataFrame:
    """Upsert messages: JSON ``key`` and ``value``; where ``deleted`` is true the value is NULL."""
    fields = [name for name in rows.columns if name != deleted]
    value = F.to_json(F.struct(*fields))
    if deleted is not None:
        value = F.when(~F.col(deleted), value)
    return rows.select(F.to_json(F.struct(*keys)).alias("key"), value.alias("value"))


def branch_messages(messages: DataFrame, topics: Mapping[str, str]) -> DataFrame:
    """Messages of a split with the topic of their branch, for one query that writes all topics."""
    pairs = [F.lit(text) for pair in topics.items() for text in pair]
    return messages.select(F.create_map(*pairs)[F.col("branch")].alias("topic"), "value")


def to_kafka(messages: DataFrame, servers: str, checkpoint: str, topic: str | None = None, **options: str) -> StreamingQuery:
    """Write messages to their topics, at least once. Needs the Kafka connector on the class path."""
    writer = (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
        .options(**options)
        .trigger(processingTime="3 seconds")
    )
    return (writer if topic is None else writer.option("topic", topic)).start()


def to_console(rows: DataFrame) -> StreamingQuery:
    return rows.writeStream.format("console").outputMode("append").start()


def without_columns(rows: DataFrame, helpers: Sequence[str]) -> DataFrame:
    """Leave helper columns out and name the others as the table does."""
    kept = rows.drop(*helpers)
    return kept.toDF(*[snake_case(name) for name in kept.columns])


def jdbc_batch(url: str, table: str, **properties: str) -> Callable[[DataFrame, int], None]:
    """Per-batch writer of summary rows into a JDBC table, with the processing time ``ts``.

    A retried batch appends its rows again; the table should replace rows by window and key.
    """

    def write(rows: DataFrame, batch: int) -> None:
        stamped = rows.withColumn("ts", processed_at_millis())
        stamped.write.jdbc(url, table, mode="append", properties={"batchsize": JDBC_ROWS, **properties})

    return write
