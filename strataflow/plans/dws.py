"""Summary layer: eleven short-window aggregates.

All take detail-layer rows and a window size and return ``stt``, ``edt`` and the result columns of
the table, without processing time. Amounts are added as decimals and shown as doubles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions import decimal_of, day_gap, distinct_words, from_millis, from_seconds
from strataflow.operators.latest import keep_latest
from strataflow.operators.lookup import join_dimension
from strataflow.operators.tumbling import DEFAULT_SIZE, window_totals, window_totals_per_member
from strataflow.operators.visits import active_days
from strataflow.plans.dwd_log import is_entry, with_keys
from strataflow.schemas import columns_of

# A user who was away for more days than this counts as returned (fixed value).
RETURN_AFTER_DAYS = 7


def _long_sum(column: Column) -> Column:
    return F.sum(column.cast("long"))


def _timed(rows: DataFrame, millis: str = "ts") -> DataFrame:
    """Event time ``_at``; a stream brings its own, which carries the watermark."""
    return rows if "_at" in rows.columns else rows.withColumn("_at", from_millis(F.col(millis)))


def _ordered(frame: DataFrame, table: str) -> DataFrame:
    return frame.select(*columns_of(table))


# --- traffic ---------------------------------------------------------------------------------


def word_searches(pages: DataFrame, words=distinct_words) -> DataFrame:
    """One row per search: its time and its distinct ``words``."""
    searches = pages.where(
        (F.col("page.last_page_id") == "search")
        & (F.col("page.item_type") == "keyword")
        & F.col("page.item").isNotNull()
    )
    return _timed(searches).select("_at", words(F.col("page.item")).alias("words"))


def searched_words(pages: DataFrame, words=distinct_words) -> DataFrame:
    """One row per search and distinct word: ``keyword`` and the time of the search."""
    return word_searches(pages, words).select("_at", F.explode("words").alias("keyword"))


def keyword(pages: DataFrame, size: str = DEFAULT_SIZE, words=distinct_words) -> DataFrame:
    """Searches per word."""
    counted = window_totals(
        searched_words(pages, words), "_at", ["keyword"], [F.count("*").alias("keyword_count")], size
    )
    return _ordered(
        counted.withColumn("source", F.lit("search")), "dws_traffic_source_keyword_page_view_window"
    )


def traffic_counters(pages: DataFrame, visitors: DataFrame, bounced: DataFrame) -> DataFrame:
    """Pages, unique visitors and bounces in one shape, each with only its own counter set."""

    def shaped(rows: DataFrame, **counters: Column) -> DataFrame:
        zero = F.lit(0).cast("long")
        return rows.select(
            F.col("common.vc").alias("vc"),
            F.col("common.ch").alias("ch"),
            F.col("common.ar").alias("ar"),
            F.col("common.is_new").alias("is_new"),
            *[
                counters.get(name, zero).cast("long").alias(name)
                for name in ("uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct")
            ],
            from_millis(F.col("ts")).alias("_at"),
        )

    one = F.lit(1)
    viewed = shaped(
        pages,
        pv_ct=one,
        sv_ct=F.when(is_entry(), 1).otherwise(0),
        dur_sum=F.coalesce(F.col("page.during_time").try_cast("long"), F.lit(0)),
    )
    return viewed.unionByName(shaped(visitors, uv_ct=one)).unionByName(shaped(bounced, uj_ct=one))


def traffic(pages: DataFrame, visitors: DataFrame, bounced: DataFrame, size: str = DEFAULT_SIZE) -> DataFrame:
    """Visitors, visits, views, dwell time and bounces per version, channel, area and novelty."""
    return traffic_totals(traffic_counters(pages, visitors, bounced), size)


def traffic_totals(counters: DataFrame, size: str = DEFAULT_SIZE) -> DataFrame:
    names = ("uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct")
    summed = window_totals(
        counters, "_at", ["vc", "ch", "ar", "is_new"], [F.sum(name).alias(name) for name in names], size
    )
    return _ordered(summed, "dws_traffic_vc_ch_ar_is_new_page_view_window")


def home_detail_rows(pages: DataFrame) -> DataFrame:
    """Home and article pages with the fields the visitor count needs."""
    shown = pages.where(F.col("page.page_id").isin("home", "good_detail"))
    return shown.select(F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "ts")


def home_detail_totals(firsts: DataFrame, size: str = DEFAULT_SIZE) -> DataFrame:
    counted = window_totals(
        firsts,
        "_at",
        [],
        [
            _long_sum(F.col("page_id") == "home").alias("home_uv_ct"),
            _long_sum(F.col("page_id") == "good_detail").alias("good_detail_uv_ct"),
        ],
        size,
    )
    return _ordered(counted, "dws_traffic_page_view_window")


def home_detail(pages: DataFrame, size: str = DEFAULT_SIZE) -> DataFrame:
    """Daily first visitors of the home page and of article pages."""
    return home_detail_totals(_timed(active_days(home_detail_rows(pages), ["mid", "page_id"], "ts")), size)


# --- users -----------------------------------------------------------------------------------


def login_rows(pages: DataFrame) -> DataFrame:
    """Pages that log a user in: the opening page of a visit, or the page after the login page."""
    previous = F.col("page.last_page_id")
    logins = with_keys(pages).where(F.col("_uid").isNotNull() & (previous.isNull() | (previous == "login")))
    return logins.select(F.col("_uid").alias("uid"), "ts")


def login_totals(firsts: DataFrame, size: str = DEFAULT_SIZE, away_days: int = RETURN_AFTER_DAYS) -> DataFrame:
    returned = F.coalesce(day_gap(F.col("day"), F.col("previous_day")) > away_days, F.lit(False))
    counted = window_totals(
        firsts,
        "_at",
        [],
        [_long_sum(returned).alias("back_ct"), F.count("*").alias("uu_ct")],
        size,
    )
    return _ordered(counted, "dws_user_user_login_window")


def user_login(pages: DataFrame, size: str = DEFAULT_SIZE, away_days: int = RETURN_AFTER_DAYS) -> DataFrame:
    """Users on their first login of the day, and those who come back after a long time."""
    return login_totals(_timed(active_days(login_rows(pages), ["uid"], "ts", previous=True)), size, away_days)


def _second_rows(rows: DataFrame, *keep: str) -> DataFrame:
    """Detail rows with ``ts`` in milliseconds and an event time."""
    millis = (F.col("ts").try_cast("long") * 1000).alias("ts")
    return _timed(rows.select(*keep, millis))


def user_register(registered: DataFrame, size: str = DEFAULT_SIZE, delay: str = "3 seconds") -> DataFrame:
    """Users who signed up."""
    counted = window_totals(_second_rows(registered).withWatermark("_at", delay), "_at", [], [F.count("*").alias("register_ct")], size)
    return _ordered(counted, "dws_user_user_register_window")


def user_seconds(rows: DataFrame) -> DataFrame:
    """user_id and ``ts`` in milliseconds, the input of the daily-first steps."""
    return _second_rows(rows, "user_id").drop("_at")


def cart_add_totals(firsts: DataFrame, size: str = DEFAULT_SIZE) -> DataFrame:
    counted = window_totals(firsts, "_at", [], [F.count("*").alias("cart_add_uu_ct")], size)
    return _ordered(counted, "dws_trade_cart_add_uu_window")


def cart_add_uu(added: DataFrame, size: str = DEFAULT_SIZE) -> DataFrame:
    """Users on their first cart addition of the day."""
    return cart_add_totals(_timed(active_days(user_seconds(added), ["user_id"], "ts")), size)


def first_ever_totals(firsts: DataFrame, table: str, size: str = DEFAULT_SIZE) -> DataFrame:
    unique, new = columns_of(table)[2:]
    counted = window_totals(
        firsts, "_at", [], [F.count("*").alias(unique), _long_sum(F.col("previous_day").isNull()).alias(new)], size
    )
    return _ordered(counted, table)


def payment_suc(paid: DataFrame, size: str = DEFAULT_SIZE) -> DataFrame:
    """Users on their first payment of the day, and on their first payment at all."""
    firsts = _timed(active_days(user_seconds(paid), ["user_id"], "ts", previous=True))
    return first_ever_totals(firsts, "dws_trade_payment_suc_window", size)


def trade_order(details: DataFrame, size: str = DEFAULT_SIZE) -> DataFrame:
    """Users on their first order of the day, and on their first order at all."""
    firsts = _timed(active_days(user_seconds(details), ["user_id"], "ts", previous=True))
    return first_ever_totals(firsts, "dws_trade_order_window", size)


# --- trade -----------------------------------------------------------------------------------

_AMOUNTS = {
    "split_original_amount": "original_amount",
    "split_activity_amount": "activity_amount",
    "split_coupon_amount": "coupon_amount",
    "split_total_amount": "order_amount",
}


def order_lines(details: DataFrame, *extra: str, key: str, amounts: Sequence[str] = tuple(_AMOUNTS)) -> DataFrame:
    """Order lines with event time, the column they are summed by, and amounts as decimals; a
    missing amount counts as zero."""
    decimals = [
        F.coalesce(decimal_of(F.col(source)), F.lit(0).cast("decimal(16,2)")).alias(_AMOUNTS[source])
        for source in amounts
    ]
    moment = from_seconds(F.col("ts").try_cast("long")).alias("_at")
    return details.select("id", "order_id", key, *decimals, "row_op_ts", *extra, moment)


def sku_lines(details: DataFrame, *extra: str) -> DataFrame:
    return order_lines(details, *extra, key="sku_id")


def province_lines(details: DataFrame, *extra: str) -> DataFrame:
    return order_lines(details, *extra, key="province_id", amounts=["split_total_amount"])


def _doubles(frame: DataFrame, *names: str) -> DataFrame:
    return frame.withColumns({name: F.round(F.col(name).cast("double"), 2) for name in names})


def with_categories(rows: DataFrame, dims: dict[str, DataFrame], missing: str = "null") -> DataFrame:
    """Trademark name and the three category levels, from trademark_id and category3_id."""
    rows = join_dimension(rows, dims["base_trademark"], "trademark_id", {"tm_name": "trademark_name"}, missing)
    rows = join_dimension(
        rows, dims["base_category3"], "category3_id", {"name": "category3_name", "category2_id": "category2_id"}, missing
    )
    rows = join_dimension(
        rows, dims["base_category2"], "category2_id", {"name": "category2_name", "category1_id": "category1_id"}, missing
    )
    return join_dimension(rows, dims["base_category1"], "category1_id", {"name": "category1_name"}, missing)


def sku_totals(lines: DataFrame, size: str = DEFAULT_SIZE) -> DataFrame:
    return window_totals_per_member(lines, "_at", ["sku_id"], "order_id", "order_count", list(_AMOUNTS.values()), size)


def sku_named(totals: DataFrame, dims: dict[str, DataFrame], missing: str = "null") -> DataFrame:
    rows = join_dimension(
        totals,
        dims["sku_info"],
        "sku_id",
        {"sku_name": "sku_name", "spu_id": "spu_id", "tm_id": "trademark_id", "category3_id": "category3_id"},
        missing,
    )
    rows = join_dimension(rows, dims["spu_info"], "spu_id", {"spu_name": "spu_name"}, missing)
    rows = with_categories(rows, dims, missing)
    return _ordered(_doubles(rows, *_AMOUNTS.values()), "dws_trade_sku_order_window")


def sku_order(
    details: DataFrame,
    dims: dict[str, DataFrame],
    size: str = DEFAULT_SIZE,
    tie: tuple[str, ...] = (),
    missing: str = "null",
    versions: bool = True,
) -> DataFrame:
    """Orders and amounts per article, on the latest version of each line, with all names. Without ``versions`` the details hold no other."""
    lines = keep_latest(sku_lines(details, *tie), ["id"], ["row_op_ts", *tie]) if versions else sku_lines(details)
    return sku_named(sku_totals(lines, size), dims, missing)


def province_totals(lines: DataFrame, size: str = DEFAULT_SIZE) -> DataFrame:
    return window_totals_per_member(lines, "_at", ["province_id"], "order_id", "order_count", ["order_amount"], size)


def province_named(totals: DataFrame, provinces: DataFrame, missing: str = "null") -> DataFrame:
    rows = join_dimension(totals, provinces, "province_id", {"name": "province_name"}, missing)
    return _ordered(_doubles(rows, "order_amount"), "dws_trade_province_order_window")


def province_order(
    details: DataFrame,
    provinces: DataFrame,
    size: str = DEFAULT_SIZE,
    tie: tuple[str, ...] = (),
    missing: str = "null",
    versions: bool = True,
) -> DataFrame:
    """Orders and amounts per province, on the latest version of each line. Without ``versions`` the details hold no other."""
    lines = keep_latest(province_lines(details, *tie), ["id"], ["row_op_ts", *tie]) if versions else province_lines(details)
    return province_named(province_totals(lines, size), provinces, missing)


def refund_lines(refunds: DataFrame, skus: DataFrame) -> DataFrame:
    """Refunds with the trademark and category that make up the key."""
    rows = refunds.select("user_id", "order_id", "sku_id", from_seconds(F.col("ts").try_cast("long")).alias("_at"))
    return join_dimension(rows, skus, "sku_id", {"tm_id": "trademark_id", "category3_id": "category3_id"})


def refund_totals(lines: DataFrame, size: str = DEFAULT_SIZE) -> DataFrame:
    keys = ["trademark_id", "category3_id", "user_id"]
    return window_totals_per_member(lines, "_at", keys, "order_id", "refund_count", size=size)


def trademark_category_user_refund(
    refunds: DataFrame, dims: dict[str, DataFrame], size: str = DEFAULT_SIZE, missing: str = "null"
) -> DataFrame:
    """Refunded orders per trademark, category and user."""
    return refund_result(refund_totals(refund_lines(refunds, dims["sku_info"]), size), dims, missing)


def refund_result(totals: DataFrame, dims: dict[str, DataFrame], missing: str = "null") -> DataFrame:
    return _ordered(with_categories(totals, dims, missing), "dws_trade_trademark_category_user_refund_window")
