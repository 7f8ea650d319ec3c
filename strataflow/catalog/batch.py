"""Registered batch queries: each runs jobs over whole tables of a folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.catalog import views as v
from strataflow.functions import camel_case, dictionary_words, distinct_words, register_word_function, second_text, word_list
from strataflow.operators.changes import added_quantity, changed_to, table_rows, upsert_rows
from strataflow.operators.latest import latest_in_session
from strataflow.operators.lookup import count_missing, join_dimension
from strataflow.operators.routing import split_messages
from strataflow.operators.timed_join import bounded_join
from strataflow.plans import ads, dim, dwd_db, dwd_log, dws, ods
from strataflow.session import scratch_path
from strataflow.sinks.landing import land, landed

HOUR, WEEK = "1 hour", "7 days"
# The events of one user lie hours apart, so the bounce bound and the absence are wider here.
BOUNCE_MS = 3 * 60 * 60 * 1000
AWAY_DAYS = 2
TIE = ("log_id",)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(job: Callable[[v.Tables], DataFrame]) -> Callable[[v.Tables], DataFrame]:
    QUERIES[job.__name__] = lambda spark, folder: job(v.Tables(spark, folder))
    return job


def _words(text):
    return distinct_words(text)


# --- ODS -------------------------------------------------------------------------------------


@query
def json_wellformed(t):
    texts = v.log_text(t)
    return texts.select("log_id", ods.is_json_object().alias("is_object"))


@query
def json_fields(t):
    rows = ods.parse_log(v.log_text(t), carry=TIE)
    return rows.select(
        "log_id", "common.mid", "common.is_new", "page.page_id", "page.last_page_id",
        F.col("page.during_time").try_cast("long").alias("during_time"), F.size("displays").alias("displays"), "ts",
    )


@query
def cdc_table_filter(t):
    feed = ods.parse_changes(v.change_text(t, "order_info", "order_detail"))
    rows = table_rows(feed, "order_info", "insert", database=v.DATABASE)
    return rows.select(F.col("data")["id"].alias("id"), F.col("data")["user_id"].alias("user_id"), "ts")


@query
def cdc_upsert_filter(t):
    feed = ods.parse_changes(v.change_text(t, "order_info", "base_province", "sku_info"))
    return upsert_rows(feed, v.DATABASE).groupBy("table", "type").agg(F.count("*").alias("n"))


@query
def cdc_changed_column(t):
    feed = ods.parse_changes(v.change_text(t, "order_info"))
    rows = table_rows(feed, "order_info", "update").where(changed_to("order_status", "1003"))
    return rows.select(
        F.col("data")["id"].alias("id"), F.col("data")["operate_time"].alias("cancel_time"),
        F.col("old")["order_status"].alias("old_status"), "ts",
    )


@query
def cdc_cart_delta(t):
    rows = table_rows(v.changes(t, "cart_info"), "cart_info", "insert", "update").withColumn("added", added_quantity())
    kept = rows.where(F.col("added").isNotNull())
    return kept.select(F.col("data")["id"].alias("id"), "type", "added", "ts")


# --- DWD log ---------------------------------------------------------------------------------


@query
def log_split_counts(t):
    messages = split_messages(ods.parse_log(v.log_text(t)))
    return messages.groupBy("branch").agg(F.count("*").alias("n"))


@query
def log_split_messages(t):
    """The messages of all five branches, with fields that no schema names."""
    text = v.log_text_with_more(t).withColumn("_whole", F.col("value"))
    messages = split_messages(dwd_log.repaired(ods.parse_log(text, carry=("_whole",))), whole="_whole")

    # One parse a message, not one for each field.
    own = "mid, is_new, os, page_id, refer, item, rank, ts, displays, actions".replace(",", " string,") + " string"
    shape = f"""{own}, common struct<mid:string,is_new:string,os:string>, page struct<page_id:string,refer:string,item:string>,
        extra struct<n:string>, sdk array<string>, err struct<error_code:string>, start struct<loading_time:string>"""
    read = messages.select("branch", F.explode_outer(F.array(F.from_json("value", shape))).alias("_m"))

    def field(name, *paths):
        return F.coalesce(*[F.col(f"_m.{p}") for p in paths or (name,)]).alias(name)

    return read.select(
        "branch", field("mid", "mid", "common.mid"), field("is_new", "is_new", "common.is_new"), field("os", "os", "common.os"),
        field("page_id", "page_id", "page.page_id"), field("refer", "refer", "page.refer"), field("item", "item", "page.item"), field("rank"),
        field("extra", "extra.n"), F.get(F.col("_m.sdk"), F.lit(1)).alias("sdk"), field("error_code", "err.error_code"),
        field("loading_time", "start.loading_time"), field("ts"),
        (F.col("_m.displays").isNotNull() | F.col("_m.actions").isNotNull()).alias("has_arrays"),
    )


def _branch(t, name):
    return dwd_log.log_branches(v.log_records(t.events), carry=TIE)[name]


@query
def log_display_explode(t):
    return _branch(t, "display").select("log_id", "mid", "is_new", "page_id", "display_type", "item", "order", "ts")


@query
def log_action_explode(t):
    return _branch(t, "action").select("log_id", "mid", "is_new", "page_id", "action_id", "item", "ts")


@query
def log_err_rows(t):
    rows = _branch(t, "err")
    return rows.select(
        "log_id", "common.mid", "common.is_new", "err.error_code", "page.page_id",
        F.col("start").isNotNull().alias("is_start"), "ts",
    )


@query
def log_start_rows(t):
    return _branch(t, "start").select("log_id", "common.mid", "common.is_new", "start.loading_time", "ts")


@query
def log_page_rows(t):
    return _branch(t, "page").select("log_id", "common.mid", "common.is_new", "page.page_id", "page.item", "ts")


@query
def visitor_flag_repair(t):
    rows = dwd_log.repaired(v.log_records(t.events))
    return rows.select("log_id", "common.mid", "common.is_new")


def _page_fields(rows):
    return rows.select("log_id", "common.mid", "common.uid", "page.page_id", "ts")


@query
def unique_visitor_detail(t):
    return _page_fields(dwd_log.unique_visitors(v.page_log(t.events), TIE))


@query
def bounce_detail(t):
    return _page_fields(dwd_log.bounced_pages(v.page_log(t.events), BOUNCE_MS, TIE))


@query
def bounce_detail_entry_normal(t):
    return _page_fields(dwd_log.bounced_pages_timeout_only(v.page_log(t.events), BOUNCE_MS, TIE))


# --- DWD business ----------------------------------------------------------------------------


@query
def cart_add(t):
    return dwd_db.cart_add(v.changes(t, "cart_info"), v.dictionary(t.spark), v.DATABASE)


def _landed(t):
    """The whole change feed, as text that is parsed once, landed and read again."""
    path = scratch_path(t.spark, "landing")
    land(v.change_text(t), path, "year")
    return landed(t.spark, path, "year")


@query
def landed_order_pre_process(t):
    rows = dwd_db.order_pre_process(_landed(t), v.dictionary(t.spark), v.DATABASE)
    return rows.withColumn("old_status", F.col("old")["order_status"]).drop("old", "row_op_ts")


@query
def landed_cart_add(t):
    return dwd_db.cart_add(_landed(t), v.dictionary(t.spark), v.DATABASE)


def _pre_process(t):
    feed = v.changes(t, "order_detail", "order_info", "order_detail_activity", "order_detail_coupon")
    return dwd_db.order_pre_process(feed, v.dictionary(t.spark), v.DATABASE)


@query
def order_pre_process(t):
    return _pre_process(t).withColumn("old_status", F.col("old")["order_status"]).drop("old", "row_op_ts")


@query
def order_detail(t):
    return dwd_db.order_detail(_pre_process(t)).drop("row_op_ts")


@query
def order_cancel(t):
    return dwd_db.order_cancel(_pre_process(t)).drop("row_op_ts")


@query
def pay_detail(t):
    details = dwd_db.order_detail(_pre_process(t))
    return dwd_db.pay_detail(v.changes(t, "payment_info"), details, v.dictionary(t.spark), v.DATABASE).drop("row_op_ts")


@query
def order_refund(t):
    return dwd_db.order_refund(v.changes(t, "order_refund_info", "order_info"), v.dictionary(t.spark), v.DATABASE).drop("row_op_ts")


@query
def refund_pay(t):
    return dwd_db.refund_pay(v.changes(t, "refund_payment", "order_refund_info", "order_info"), v.dictionary(t.spark), v.DATABASE).drop("row_op_ts")


@query
def coupon_get(t):
    return dwd_db.coupon_get(v.changes(t, "coupon_use"), v.DATABASE)


@query
def coupon_order(t):
    return dwd_db.coupon_order(v.changes(t, "coupon_use"), v.DATABASE)


@query
def coupon_pay(t):
    return dwd_db.coupon_pay(v.changes(t, "coupon_use"), v.DATABASE)


@query
def coupon_pay_compat(t):
    return dwd_db.coupon_pay(v.changes(t, "coupon_use"), v.DATABASE, compat=True)


@query
def favor_add(t):
    return dwd_db.favor_add(v.changes(t, "favor_info"), v.DATABASE)


@query
def comment_lookup(t):
    return dwd_db.comment(v.changes(t, "comment_info"), v.dictionary(t.spark), v.DATABASE)


@query
def user_register(t):
    return dwd_db.user_register(v.changes(t, "user_info"), v.DATABASE)


@query
def payment_within_hold(t):
    """Payments and their orders at most thirty minutes apart, the time-bounded join by itself."""
    orders = t.orders.select(F.col("o_orderkey").alias("order_key"), F.col("o_orderdate").alias("ordered_at"))
    paid = t.orders.select(
        F.col("o_orderkey").alias("paid_key"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.pmod("o_orderkey", F.lit(45)).cast("int"))).alias("paid_at"),
    )
    joined = bounded_join(
        paid, orders, [("paid_key", "order_key")], "paid_at", "ordered_at", "-30 minutes", "0 seconds"
    )
    return joined.select("order_key", second_text(F.col("paid_at")).alias("paid_at"))


# --- DIM -------------------------------------------------------------------------------------


def _snapshot(t, *names):
    return dim.dim_snapshot(v.changes(t, *names), dim.default_config(t.spark), v.DATABASE)


@query
def dim_route_counts(t):
    rows = dim.dim_rows(v.changes(t), dim.default_config(t.spark), v.DATABASE)
    return rows.groupBy("sink_table", "operate_type").agg(F.count("*").alias("n"))


@query
def dim_route_sku(t):
    return dim.dim_table(_snapshot(t, "sku_info", "base_province"), "sku_info")


@query
def dim_column_select(t):
    rows = dim.dim_rows(v.changes(t, "base_province", "base_region", "sku_info", "user_info"), dim.default_config(t.spark))
    kept = rows.select("sink_table", "id", "operate_type", F.explode("data").alias("name", "value"))
    return kept.where(F.col("value").isNotNull())


@query
def dim_upsert_latest(t):
    rows = _snapshot(t, "sku_info", "user_info", "base_province", "base_region")
    return rows.select(
        "sink_table", "id", F.coalesce(F.col("data")["sku_name"], F.col("data")["name"]).alias("name"), "operate_type"
    )


@query
def dim_missing_rows(t):
    lines = t.lineitem.select(F.col("l_partkey").cast("string").alias("sku_id"))
    return count_missing(lines, v.dimensions(t)["sku_info"], "sku_id")


# --- DWS -------------------------------------------------------------------------------------


@query
def keyword_window_count(t):
    return dws.keyword(v.search_log(t.documents), HOUR, _words)


@query
def keyword_dictionary_count(t):
    """The keyword report over texts without blanks, cut by the words of the benchmark items."""
    words = word_list(t.benchmark.select(F.explode(distinct_words(F.col("text"))).alias("word")), "word")
    searches = v.search_log(t.documents.withColumn("text", F.replace("text", F.lit(" "), F.lit(""))))
    return dws.keyword(searches, HOUR, dictionary_words(words))


@query
def keyword_unicode_totals(t):
    """Searches per word of any script, all windows together."""
    words = dws.searched_words(v.search_log(t.documents), _words)
    return words.groupBy("keyword").agg(F.count("*").alias("searches"))


@query
def keyword_sql_lateral(t):
    """The keyword report as SQL text with the word table function."""
    register_word_function(t.spark, "report_words")
    return t.spark.sql(
        f"""
        SELECT date_format(span.start, 'yyyy-MM-dd HH:mm:ss') AS stt, date_format(span.end, 'yyyy-MM-dd HH:mm:ss') AS edt,
          'search' AS source, keyword, count(*) AS keyword_count
        FROM (SELECT window(timestamp_millis(ts), '{HOUR}') AS span, page.item AS item FROM {{searches}}
              WHERE page.last_page_id = 'search' AND page.item_type = 'keyword' AND page.item IS NOT NULL) AS t,
          LATERAL report_words(t.item)
        GROUP BY span, keyword""",
        searches=v.search_log(t.documents),
    )


def _traffic(t):
    pages = v.page_log(t.events)
    visitors = dwd_log.unique_visitors(pages, TIE)
    return dws.traffic(pages, visitors, dwd_log.bounced_pages(pages, BOUNCE_MS, TIE), HOUR)


@query
def traffic_window(t):
    return _traffic(t)


@query
def home_detail_uv(t):
    return dws.home_detail(v.page_log(t.events), HOUR)


@query
def login_back(t):
    return dws.user_login(v.page_log(t.events), HOUR, AWAY_DAYS)


@query
def register_window(t):
    return dws.user_register(v.registrations(t), HOUR)


@query
def cart_add_uu(t):
    return dws.cart_add_uu(v.cart_additions(t), HOUR)


@query
def payment_uu(t):
    return dws.payment_suc(v.paid_orders(t), HOUR)


@query
def order_uu(t):
    return dws.trade_order(v.placed_orders(t), HOUR)


@query
def sku_order_window(t):
    return dws.sku_order(v.latest_order_lines(t), v.dimensions(t), WEEK, versions=False)


@query
def province_order_window(t):
    return dws.province_order(v.latest_order_lines(t), v.dimensions(t)["base_province"], WEEK, versions=False)


@query
def brand_category_user_refund(t):
    return dws.trademark_category_user_refund(v.refund_lines(t), v.dimensions(t), WEEK)


@query
def latest_in_burst(t):
    """Latest version of each order line inside its burst of copies."""
    lines = v.order_lines(t).withColumn("at", F.timestamp_seconds(F.col("ts").cast("long")))
    rows = latest_in_session(lines, ["id"], "at", ["row_op_ts", *v.LINE_TIE], "5 seconds")
    return rows.select("id", "sku_id", v.text(F.col("split_total_amount")).alias("split_total_amount"), second_text(F.col("row_op_ts")).alias("row_op_ts"))


@query
def dws_sink_columns(t):
    """Summary rows renamed for a store with camel-case columns."""
    rows = dws.user_register(v.registrations(t), WEEK)
    return rows.toDF(*[camel_case(name) for name in rows.columns])


# --- ADS -------------------------------------------------------------------------------------


@query
def ads_daily_rollup(t):
    return ads.rollup(_traffic(t), ["ch"], ["uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct"], by_day=True)


def _stored(frame, name):
    """A summary as the report layer finds it: written out, its sources out of sight."""
    path = scratch_path(frame.sparkSession, name)
    frame.write.parquet(path, compression="zstd")
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _order_members(t):
    """Who ordered what, per week and trademark: the summary that distinct orders are counted from."""
    lines = dws.sku_lines(v.latest_order_lines(t))
    branded = join_dimension(lines, v.dimensions(t)["sku_info"], "sku_id", {"tm_id": "trademark_id"})
    # A week and trademark hold a few of every 32,768 neighbouring orders.
    return _stored(ads.members(branded, ["trademark_id"], "order_id", WEEK, width=ads.MASK), "order-members")


SPAN = {"since": "1996-01-01 00:00:00", "until": "1999-01-01 00:00:00"}


@query
def ads_range_rollup(t):
    summary = dws.sku_order(v.latest_order_lines(t), v.dimensions(t), WEEK, versions=False)
    totals = ads.rollup(_stored(summary, "sku-orders"), ["trademark_id"], ["order_amount"], **SPAN)
    orders = ads.distinct_from(_order_members(t), ["trademark_id"], "order_count", **SPAN)
    totals = totals.join(orders.withColumnRenamed("trademark_id", "_of"), F.col("trademark_id").eqNullSafe(F.col("_of"))).drop("_of")
    return totals.withColumn("order_amount", F.round("order_amount", 2))


@query
def ads_distinct_orders(t):
    """Distinct orders of the whole range over all trademarks, and per day of the week's start: coarser keys than the summary's."""
    summary = _order_members(t)
    whole = ads.distinct_from(summary, [], "order_count", **SPAN).select(F.lit("all").alias("day"), "order_count")
    return whole.unionByName(ads.distinct_from(summary, [], "order_count", **SPAN, by_day=True))
