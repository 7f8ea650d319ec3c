"""Sources: topics, text and CSV streams, JDBC tables, JSON topic rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def kafka_text(
    spark: SparkSession, servers: str, *topics: str, group: str | None = None, from_start: bool = False, **options: str
) -> DataFrame:
    """Messages of one or more topics as text rows with their ``topic``; empty messages are dropped.

    Only committed messages are read. Needs the Kafka connector on the class path. ``options`` go to
    the reader; ``maxOffsetsPerTrigger`` bounds a micro-batch.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("kafka.isolation.level", "read_committed")
        .option("startingOffsets", "earliest" if from_start else "latest")
    )
    if group:
        reader = reader.option("groupIdPrefix", group)
    rows = reader.options(**options).load()
    return rows.where(F.col("value").isNotNull()).select("topic", F.col("value").cast("string").alias("value"))


def topic_frames(messages: DataFrame, *topics: str) -> dict[str, DataFrame]:
    """One DataFrame per topic out of a multi-topic stream."""
    return {topic: messages.where(F.col("topic") == topic).select("value") for topic in topics}


def text_files(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A folder of text files as a stream, one row per line."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)


def json_rows(messages: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Typed rows of a topic that an upstream job wrote as JSON; delete markers carry no row."""
    parsed = messages.where(F.col(value).isNotNull()).select(F.from_json(value, schema).alias("_r"))
    return parsed.select("_r.*")


def csv_stream(messages: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Typed rows of a topic of CSV lines."""
    ddl = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in schema.fields)
    return messages.select(F.from_csv(value, ddl).alias("_r")).select("_r.*")


def jdbc_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """A reference table over JDBC. Pass partitionColumn, lowerBound, upperBound and numPartitions for
    a table too large for one reading task."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
