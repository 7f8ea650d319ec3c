"""Report layer: summary rows of a time range, added up again at read time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.functions import second_text

#: Counts of distinct members of a window, which never add up, and of a day, which add up within it only.
DISTINCT_IN_WINDOW = ("order_count", "refund_count")
DISTINCT_IN_DAY = (
    "uv_ct", "uu_ct", "home_uv_ct", "good_detail_uv_ct", "cart_add_uu_ct", "order_unique_user_count", "payment_suc_unique_user_count",
)


def _in_range(summary: DataFrame, since: str | None, until: str | None) -> DataFrame:
    rows = summary
    if since is not None:
        rows = rows.where(F.col("stt") >= since)
    if until is not None:
        rows = rows.where(F.col("edt") <= until)
    return rows


def rollup(
    summary: DataFrame,
    keys: Sequence[str],
    sums: Sequence[str],
    since: str | None = None,
    until: str | None = None,
    by_day: bool = False,
) -> DataFrame:
    """Add up summary rows with ``stt >= since`` and ``edt <= until``, per key and optionally day.

    Sums add up. Distinct counts do not: one of a window is refused, and one of a day is, unless the
    result is by day. ``members`` and ``distinct_from`` give those.
    """
    refused = [name for name in sums if name in DISTINCT_IN_WINDOW or (name in DISTINCT_IN_DAY and not by_day)]
    if refused:
        raise ValueError(f"distinct counts do not add up: {', '.join(refused)}")
    groups = [*([F.substring("stt", 1, 10).alias("day")] if by_day else []), *keys]
    return _in_range(summary, since, until).groupBy(*groups).agg(*[F.sum(name).alias(name) for name in sums])


#: Members that a row of ``members`` stands for: a bitmap of so many bits, or the bits of one long.
BITMAP, MASK = 32_768, 64


def members(rows: DataFrame, keys: Sequence[str], member: str, size: str, at: str = "_at", width: int = BITMAP) -> DataFrame:
    """Summary rows that keep who was counted: ``stt, edt``, keys, ``bucket`` and a bitmap of ``members``.

    A bucket holds the members of ``width`` neighbouring numbers as bits, so a row has a fixed size, and
    a group with many members has many rows. Groups that hold few of the members want ``MASK``: a bitmap takes 4 KB
    however few bits are set, in sorts too, and a long is added up by hash. Bitmaps of any rows can be joined later, and a member
    counts once. Members are whole numbers, also as text; other text is an error. NULL members do not count. Works on streams as well.
    """
    if width not in (BITMAP, MASK):
        raise ValueError(f"width must be {BITMAP} or {MASK}, not {width}")
    number = F.col(member).cast("long")
    held = rows.where(F.col(member).isNotNull())
    if width == MASK:
        bucket = F.shiftright(number, 6)
        bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(F.lit(MASK - 1)).cast("int")))
    else:
        bucket, bits = F.bitmap_bucket_number(number), F.bitmap_construct_agg(F.bitmap_bit_position(number))
    grouped = held.groupBy(F.window(at, size).alias("_span"), *keys, bucket.alias("bucket")).agg(bits.alias("members"))
    return grouped.select(second_text(F.col("_span.start")).alias("stt"), second_text(F.col("_span.end")).alias("edt"), *keys, "bucket", "members")


def distinct_from(
    summary: DataFrame, keys: Sequence[str], name: str, since: str | None = None, until: str | None = None, by_day: bool = False
) -> DataFrame:
    """Distinct members per key over a time range, from rows of ``members`` alone, with their keys or coarser ones."""
    groups = [*([F.substring("stt", 1, 10).alias("day")] if by_day else []), *keys]
    masks = summary.schema["members"].dataType.typeName() == "long"
    both, count = (F.bit_or, F.bit_count) if masks else (F.bitmap_or_agg, F.bitmap_count)
    joined = _in_range(summary, since, until).groupBy(*groups, "bucket").agg(both("members").alias("_members"))
    return joined.groupBy(*[g if isinstance(g, str) else "day" for g in groups]).agg(F.sum(count("_members").cast("long")).alias(name))
