"""All registered queries and their SQL forms."""

from __future__ import annotations

from strataflow.catalog.batch import QUERIES as BATCH
from strataflow.catalog.batch import Query
from strataflow.catalog.sql import ORACLE
from strataflow.catalog.streams import STREAMS


def queries() -> dict[str, Query]:
    return {**BATCH, **STREAMS}


def oracle_sql() -> dict[str, str]:
    """A streaming query has the result, and so the SQL, of its batch form, unless it has its own."""
    keys = {name: name if name in ORACLE else name.removeprefix("stream_") for name in queries()}
    return {name: ORACLE[key] for name, key in keys.items() if key in ORACLE}
