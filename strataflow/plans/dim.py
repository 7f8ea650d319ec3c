"""Dimension layer: change rows routed to dimension tables by a configuration table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataflow.operators.changes import upsert_rows
from strataflow.operators.latest import keep_latest
from strataflow.operators.routing import dimension_table, route_changes
from strataflow.schemas import DIMENSION_COLUMNS, ROUTE_CONFIG

#: What decides between writes of one row, in batch and on streams alike: the time in whole seconds, then the place
#: in the feed, and without one an update comes after an insert.
WRITE_ORDER = ("ts", "position", "operate_type")


def default_config(spark: SparkSession) -> DataFrame:
    """The seed routing table as a local relation, so its size is known to the optimizer."""
    rows = ", ".join(
        f"('{source}', 'dim_{source}', '{columns}', 'id', CAST(NULL AS STRING))"
        for source, columns in DIMENSION_COLUMNS.items()
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS config({', '.join(ROUTE_CONFIG.fieldNames())})")


def dim_rows(changes: DataFrame, config: DataFrame, database: str | None = None) -> DataFrame:
    """All dimension writes contained in the change rows."""
    return route_changes(upsert_rows(changes, database), config)


def dim_snapshot(
    changes: DataFrame, config: DataFrame, database: str | None = None, order: tuple[str, ...] = WRITE_ORDER
) -> DataFrame:
    """State of all dimension tables after the change rows: the latest write per table and id."""
    return keep_latest(dim_rows(changes, config, database), ["sink_table", "id"], list(order))


def dim_table(snapshot: DataFrame, source_table: str) -> DataFrame:
    return dimension_table(snapshot, f"dim_{source_table}", DIMENSION_COLUMNS[source_table])
