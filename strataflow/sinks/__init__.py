"""Outputs of the jobs: topics, JDBC tables, upserted tables, console."""

from strataflow.sinks.upsert import UpsertTable  # noqa: F401
from strataflow.sinks.writers import (  # noqa: F401
    branch_messages,
    jdbc_batch,
    json_messages,
    keyed_messages,
    to_console,
    to_kafka,
    without_columns,
)
