"""Detail layer of the page log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.functions import is_blank
from strataflow.operators.routing import split_log
from strataflow.operators.visits import bounces, daily_first_rows, repair_visitor_flag

# Fixed bounds of the two bounce patterns, in milliseconds.
ENTRY_TWICE_MS = 3000
ENTRY_THEN_PAGE_MS = 5000


def with_keys(records: DataFrame) -> DataFrame:
    """Lift the fields the jobs partition by out of the nested objects."""
    return records.withColumn("_mid", F.col("common.mid")).withColumn("_uid", F.col("common.uid"))


def is_entry(previous: str = "page.last_page_id"):
    return is_blank(F.col(previous))


def repaired(records: DataFrame) -> DataFrame:
    """Log records with a repaired new-visitor flag in ``common``."""
    lifted = with_keys(records).withColumn("_flag", F.col("common.is_new"))
    fixed = repair_visitor_flag(lifted, device="_mid", flag="_flag")
    return fixed.withColumn("common", F.col("common").withField("is_new", F.col("_flag"))).select(*records.columns)


def log_branches(records: DataFrame, carry: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Repair the flag, then split: err, start, display, action, page."""
    return split_log(repaired(records), carry)


def unique_visitors(pages: DataFrame, tie: tuple[str, ...] = ()) -> DataFrame:
    """First page of every user and day."""
    return daily_first_rows(with_keys(pages), ["_uid"], tie=tie).select(*pages.columns)


def bounced_pages(
    pages: DataFrame, within_ms: int = ENTRY_TWICE_MS, tie: tuple[str, ...] = (), slice_ms: int | None = None
) -> DataFrame:
    """Entry pages that no other page of the visit follows in time."""
    found = bounces(with_keys(pages), is_entry(), within_ms, device="_mid", tie=tie, slice_ms=slice_ms)
    return found.select(*pages.columns)


def bounced_pages_timeout_only(
    pages: DataFrame, within_ms: int = ENTRY_THEN_PAGE_MS, tie: tuple[str, ...] = (), slice_ms: int | None = None
) -> DataFrame:
    """The stricter pattern: an entry followed by another entry in time is no bounce."""
    found = bounces(
        with_keys(pages), is_entry(), within_ms, device="_mid", tie=tie, entry_follows=False, slice_ms=slice_ms
    )
    return found.select(*pages.columns)
