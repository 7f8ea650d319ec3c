"""Parsing of the two raw feeds: log text and change-row text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.schemas import CHANGE_ROW, LOG_TEXT

_BROKEN = "_broken_text"


def _objects(text: DataFrame, schema: T.StructType, value: str) -> DataFrame:
    """Parse JSON objects; text that is no well-formed JSON object is dropped.

    One pass: the parser itself reports unreadable text in an extra field. A filter on a projected parse would be pushed
    below it and parse again for each condition, and write the text again where that is derived; one on a generated row is not.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    watched = T.StructType([*schema.fields, T.StructField(_BROKEN, T.StringType())])
    read = F.when(F.ltrim(F.col(value)).startswith("{"), F.from_json(value, watched, options))
    parsed = text.select("*", F.explode_outer(F.array(read)).alias("_r"))
    return parsed.where(F.col("_r").isNotNull() & F.col("_r")[_BROKEN].isNull())


def parse_log(
    text: DataFrame, value: str = "value", schema: T.StructType = LOG_TEXT, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Log text -> records with nested objects, ``ts`` as epoch milliseconds."""
    parsed = _objects(text, schema, value)
    names = [name for name in schema.fieldNames() if name != "ts"]
    return parsed.select(
        *[F.col("_r")[name].alias(name) for name in names], F.col("_r.ts").try_cast("long").alias("ts"), *carry
    )


def parse_changes(text: DataFrame, value: str = "value", carry: tuple[str, ...] = ()) -> DataFrame:
    """Change-row text -> database, table, type, ts (epoch seconds), data and old maps.

    ``carry`` names further columns to keep, such as ``position``, the place of a row in its feed.
    """
    # A time that comes as text is read as a number too, and does not make its row unreadable.
    as_text = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "ts" else f for f in CHANGE_ROW.fields])
    parsed = _objects(text, as_text, value)
    return parsed.select(*[F.expr("try_cast(_r.ts AS BIGINT)").alias(n) if n == "ts" else F.col("_r")[n].alias(n) for n in CHANGE_ROW.fieldNames()], *carry)


def is_json_object(value: str = "value"):
    """Well-formed JSON with an object at the top."""
    return F.coalesce(F.ltrim(F.col(value)).startswith("{") & F.try_parse_json(value).isNotNull(), F.lit(False))
