"""Filters and projections over database change rows (database, table, type, ts, data, old)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions import int_of

# Change kinds a dimension accepts.
UPSERT_TYPES = ("insert", "update", "bootstrap-insert")


def upsert_rows(changes: DataFrame, database: str | None = None) -> DataFrame:
    """Change rows that write a dimension row; a row without ``data`` is malformed and dropped."""
    rows = changes.where(F.col("type").isin(*UPSERT_TYPES) & F.col("data").isNotNull())
    return rows if database is None else rows.where(F.col("database") == database)


def table_rows(changes: DataFrame, table: str, *types: str, database: str | None = None) -> DataFrame:
    """Change rows of one source table, optionally of some change types only."""
    rows = changes.where(F.col("table") == table)
    if database is not None:
        rows = rows.where(F.col("database") == database)
    if types:
        rows = rows.where(F.col("type").isin(*types))
    return rows


def changed_to(column: str, value: str) -> Column:
    """The column was part of this change and now holds ``value``."""
    return F.col("old")[column].isNotNull() & (F.col("data")[column] == value)


def data_columns(*names: str, **renamed: str) -> list[Column]:
    """Columns read from the ``data`` map; keywords give ``output=source`` names."""
    plain = [F.col("data")[name].alias(name) for name in names]
    return plain + [F.col("data")[source].alias(output) for output, source in renamed.items()]


def added_quantity(column: str = "sku_num") -> Column:
    """Quantity a change adds: all of it for an insert, the growth for an update, else NULL."""
    now, before = int_of(F.col("data")[column]), int_of(F.col("old")[column])
    return (
        F.when(F.col("type") == "insert", F.col("data")[column])
        .when((F.col("type") == "update") & (now > before), (now - before).cast("string"))
    )
