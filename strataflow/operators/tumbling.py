"""Tumbling event-time windows. The same code runs in batch and, in append mode, on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions import second_text

DEFAULT_SIZE = "5 seconds"
_SPAN = "_span"


def window_totals(
    rows: DataFrame, moment: str, keys: Sequence[str], totals: Sequence[Column], size: str = DEFAULT_SIZE
) -> DataFrame:
    """Totals per window and key, with the window bounds as text columns ``stt`` and ``edt``.

    Without keys each window is one row; partial aggregation leaves one row per map task and
    window to merge, so the unkeyed form needs no single reading task.
    """
    grouped = rows.groupBy(F.window(moment, size).alias(_SPAN), *keys).agg(*totals)
    return with_bounds(grouped)


def window_totals_per_member(
    rows: DataFrame,
    moment: str,
    keys: Sequence[str],
    member: str,
    count_as: str,
    sums: Sequence[str] = (),
    size: str = DEFAULT_SIZE,
) -> DataFrame:
    """Per window and key: number of distinct ``member`` values, and sums of ``sums``.

    Counts in two steps, first per member and then per key. No set of members is ever held in one
    row, the first shuffle is spread over the members, and streams accept it, where a distinct
    count is refused.
    """
    per_member = rows.groupBy(F.window(moment, size).alias(_SPAN), *keys, member).agg(
        F.count("*").alias("_rows"), *[F.sum(name).alias(name) for name in sums]
    )
    again = F.window(F.window_time(_SPAN), size) if rows.isStreaming else F.col(_SPAN)
    # A NULL member joins no count, but its amounts do count.
    per_key = per_member.groupBy(again.alias("_span2"), *keys).agg(
        F.count(member).alias(count_as), *[F.sum(name).alias(name) for name in sums]
    )
    return with_bounds(per_key.withColumnRenamed("_span2", _SPAN))


def with_bounds(grouped: DataFrame, span: str = _SPAN) -> DataFrame:
    others = [name for name in grouped.columns if name != span]
    return grouped.select(
        second_text(F.col(span)["start"]).alias("stt"), second_text(F.col(span)["end"]).alias("edt"), *others
    )
