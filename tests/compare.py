"""Compare a registered query with its SQL form in DuckDB, as bags of rows with types."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

ALIASES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    return repr(value) if isinstance(value, float) and not math.isnan(value) else str(value)


def bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(frame, con, sql: str) -> list[str]:
    """Empty when both sides have the same column names, types and rows."""
    answer = con.execute(sql)
    duck_types = {d[0]: str(d[1]) for d in answer.description}
    spark_types = {f.name: ALIASES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in frame.schema.fields}
    found = []
    if duck_types != spark_types:
        found.append(f"types differ: {sorted(set(spark_types.items()) ^ set(duck_types.items()))}")
    expected = bag([d[0] for d in answer.description], answer.fetchall())
    actual = bag(frame.columns, frame.collect())
    if expected != actual:
        found.append(
            f"rows: spark {actual.total()} sql {expected.total()}; only spark {list((actual - expected).items())[:3]}; "
            f"only sql {list((expected - actual).items())[:3]}"
        )
    if not actual:
        found.append("empty result")
    return found
