"""Batch forms of the per-device and per-user sequence operators.

Each is written so that no task needs all rows of one device or user: per-day reduction first, a time
split with look-ahead, or a lookup that deals out hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.functions import day_of, from_millis
from strataflow.operators.latest import keep_earliest
from strataflow.operators.lookup import attach_per_key


def first_claims(flag: str, millis: str) -> list[Column]:
    """Aggregates for the first row of a device: its time if it claims to be new, and if it does not.

    Two plain minima instead of a row picked by time, so the aggregate hashes and needs no sort.
    """
    claims = F.coalesce(F.col(flag) == "1", F.lit(False))
    return [
        F.min(F.when(claims, F.col(millis))).alias("_new_at"),
        F.min(F.when(~claims, F.col(millis))).alias("_old_at"),
    ]


def first_day() -> Column:
    """First day out of :func:`first_claims`; at equal time the row that claims to be new is first."""
    is_new = F.col("_old_at").isNull() | (F.col("_new_at") <= F.col("_old_at"))
    return F.when(is_new, day_of(from_millis(F.col("_new_at")))).otherwise(
        day_of(from_millis(F.col("_old_at")) - F.expr("INTERVAL 1 DAY"))
    )


def repair_visitor_flag(rows: DataFrame, device: str = "mid", flag: str = "is_new", millis: str = "ts") -> DataFrame:
    """Set ``flag`` to '0' where a device claims to be new on a day that is not its first.

    The first day of a device is the day of its first row if that row claims '1', else the day
    before it. Flags other than '1' stay as they are. Rows without a device pass unchanged.
    """
    first = (
        rows.where(F.col(device).isNotNull())
        .groupBy(device)
        .agg(*first_claims(flag, millis), F.count("*").alias("_rows"))
        .select(device, first_day().alias("_first_day"), "_rows")
    )
    known = attach_per_key(rows, first, [device], ["_first_day"], weight="_rows")
    wrong = (F.col(flag) == "1") & (day_of(from_millis(F.col(millis))) != F.col("_first_day"))
    return known.withColumn(flag, F.when(wrong, F.lit("0")).otherwise(F.col(flag))).select(*rows.columns)


def daily_first_rows(
    rows: DataFrame, keys: Sequence[str], millis: str = "ts", tie: Sequence[str] = ()
) -> DataFrame:
    """The earliest row of each key and day; rows without a key are dropped."""
    for key in keys:
        rows = rows.where(F.col(key).isNotNull())
    dated = rows.withColumn("_day", day_of(from_millis(F.col(millis))))
    return keep_earliest(dated, [*keys, "_day"], [millis, *tie]).drop("_day")


def active_days(rows: DataFrame, keys: Sequence[str], millis: str, previous: bool = False) -> DataFrame:
    """One row per key and day with the first time of that day.

    With ``previous`` the row also carries the last earlier day of the key. That step sees at most
    one row per calendar day and key.
    """
    for key in keys:
        rows = rows.where(F.col(key).isNotNull())
    days = rows.groupBy(*keys, day_of(from_millis(F.col(millis))).alias("day")).agg(F.min(millis).alias(millis))
    if not previous:
        return days
    return days.withColumn("previous_day", F.lag("day").over(Window.partitionBy(*keys).orderBy("day")))


def bounces(
    rows: DataFrame,
    entry: Column,
    within_ms: int,
    device: str = "mid",
    millis: str = "ts",
    tie: Sequence[str] = (),
    entry_follows: bool = True,
    slice_ms: int | None = None,
) -> DataFrame:
    """Entry rows a visitor did not continue from.

    An entry is a bounce if the device has no next row within ``within_ms``, and with
    ``entry_follows`` also if the next row is another entry.

    A device is cut into time slices of ``slice_ms`` (20 bounds by default). Rows near the start of a
    slice are also sent, without their payload, to the slice before as look-ahead. A next row further
    away does not matter, so the slices decide alone and a hot device spreads over many tasks.
    """
    slice_ms = slice_ms or 20 * within_ms
    into_slice = F.pmod(F.col(millis), F.lit(slice_ms))
    own = F.call_function("div", F.col(millis) - into_slice, F.lit(slice_ms))
    near_start = into_slice < within_ms
    order = [millis, *tie]
    slim = rows.where(F.col(device).isNotNull()).select(
        F.col(device).alias("_device"),
        *[F.col(name).alias(f"_o{i}") for i, name in enumerate(order)],
        entry.alias("_entry"),
        F.when(entry, F.struct(*rows.columns)).alias("_row"),
        F.explode(F.when(near_start, F.array(own, own - 1)).otherwise(F.array(own))).alias("_slice"),
        own.alias("_own"),
    )
    mine = F.col("_own") == F.col("_slice")
    in_order = Window.partitionBy("_device", "_slice").orderBy(*[f"_o{i}" for i in range(len(order))])
    seen = slim.withColumn("_row", F.when(mine, F.col("_row"))).select(
        "_row",
        (F.lead("_o0").over(in_order) - F.col("_o0")).alias("_wait"),
        F.lead("_entry").over(in_order).alias("_next_entry"),
    )
    left = F.col("_wait").isNull() | (F.col("_wait") >= within_ms)
    if entry_follows:
        left = left | F.col("_next_entry")
    return seen.where(F.col("_row").isNotNull() & left).select("_row.*")
