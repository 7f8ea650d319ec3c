"""Streaming dimension layer: each micro-batch of change rows is routed and upserted."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strataflow.operators.routing import dimension_table
from strataflow.plans.dim import WRITE_ORDER, dim_rows
from strataflow.schemas import dimension_schema
from strataflow.sinks.upsert import UpsertTable
from strataflow.streaming.runner import start

STORED = T.StructType(
    [
        T.StructField("sink_table", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("data", T.MapType(T.StringType(), T.StringType())),
        T.StructField("operate_type", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("position", T.LongType()),
    ]
)


class DimensionStore:
    """All dimension tables below one path, partitioned by table.

    One write serves all tables of a micro-batch, and reading a table prunes the others.
    """

    def __init__(self, spark: SparkSession, path: str):
        self._spark = spark
        self._rows = UpsertTable(spark, path, STORED, ["sink_table", "id"], WRITE_ORDER, "sink_table", batch_first=False)

    def upsert(self, changes: DataFrame, config: DataFrame, batch: int, database: str | None = None) -> None:
        self._rows.write_batch(dim_rows(changes, config, database), batch)

    def rows(self) -> DataFrame:
        return self._rows.read()

    def table(self, sink_table: str, sink_columns: str) -> DataFrame:
        """A dimension table with its configured columns; empty when nothing was written yet."""
        wanted = dimension_schema(sink_columns)
        return dimension_table(self.rows(), sink_table, sink_columns).select(*wanted.fieldNames())

    def compact(self, upto: int) -> None:
        self._rows.compact(upto)


def run_dimensions(
    changes: DataFrame,
    config: Callable[[], DataFrame],
    store: DimensionStore,
    checkpoint: str,
    database: str | None = None,
    trigger: dict | None = None,
):
    """Keep the store up to date. ``config`` is called per micro-batch, so a changed configuration
    holds from the next batch on, complete before its rows arrive."""

    def apply(batch_rows: DataFrame, batch: int) -> None:
        store.upsert(batch_rows, config(), batch, database)

    return start(changes, checkpoint, each_batch=apply, trigger=trigger)
