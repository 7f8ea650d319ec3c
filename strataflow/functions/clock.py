"""Time expressions. Log records carry epoch milliseconds, change rows epoch seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed output formats.
DAY_FORMAT = "yyyy-MM-dd"
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"


def from_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def from_seconds(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def day_of(moment: Column) -> Column:
    return F.date_format(moment, DAY_FORMAT)


def second_text(moment: Column) -> Column:
    return F.date_format(moment, SECOND_FORMAT)


def day_of_text(text: Column) -> Column:
    """Day of a time given as text; unreadable text gives NULL instead of failing the job."""
    return F.date_format(F.try_to_timestamp(text), DAY_FORMAT)


def millis_of_text(text: Column) -> Column:
    """Epoch milliseconds of ``yyyy-MM-dd`` or ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.unix_millis(F.try_to_timestamp(text))


def day_gap(later: Column, earlier: Column) -> Column:
    """Whole days between two day texts."""
    return F.datediff(F.to_date(later), F.to_date(earlier))


def processed_at_millis() -> Column:
    """Processing time in milliseconds, to be added right before a sink only."""
    return F.unix_millis(F.current_timestamp())
