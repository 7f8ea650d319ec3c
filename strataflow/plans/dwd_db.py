"""Detail layer of the business database: thirteen fact tables out of the change rows.

In batch the joins are plain equi-joins. On streams pass ``hold`` (and ``delay``): the joins are then
bounded in event time, which lets Spark drop old join state.

Change feeds deliver at least once. In batch, rows that feed a join are first reduced to the latest
version per id; streams drop exact copies that come within the watermark's delay. So copies cannot
multiply in a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions import day_of_text, decimal_of, from_seconds
from strataflow.operators.changes import added_quantity, changed_to, data_columns, table_rows
from strataflow.operators.latest import keep_latest, latest_in_window
from strataflow.operators.lookup import join_dictionary
from strataflow.operators.timed_join import bounded_join
from strataflow.schemas import columns_of

# Status codes of the source system (fixed values).
ORDER_CANCELLED = "1003"
ORDER_REFUND_ASKED = "1005"
ORDER_REFUND_DONE = "1006"
PAYMENT_DONE = "1602"
COUPON_IN_USE = "1402"
COUPON_USED = "1403"

# How long two sides of a join may lie apart (fixed values).
ORDER_HOLD = "10 seconds"
PAYMENT_HOLD = "30 minutes"
# How long after a line changes of its order still count, and within which versions of a line settle.
ORDER_CHANGES = "7 days"
SETTLE = "1 second"


def _seconds_text(name: str = "ts") -> Column:
    return F.col(name).cast("string")


def _join(left, right, on, times, hold, how="inner", ahead="0 seconds"):
    """Equi-join, bounded in event time when ``hold`` is given; drops the right key and time columns."""
    if hold is None:
        condition = F.lit(True)
        for left_key, right_key in on:
            condition = condition & (F.col(left_key) == F.col(right_key))
        joined = left.join(right, condition, how)
    else:
        joined = bounded_join(left, right, on, *times, f"-{hold}", ahead, how)
    return joined.drop(times[1], *[right_key for _, right_key in on])


def _once(timed: DataFrame, at: str, delay: str) -> DataFrame:
    """A watermark on ``at``, and exact copies within its delay dropped; stamps of writing do not tell copies apart.

    State and shuffle know a row by a digest of 32 bytes: the whole row as a key would be kept once more there.
    """
    version = [f.name for f in timed.schema.fields if f.dataType.typeName() != "map" and f.name not in (at, "row_op_ts")]
    digest = F.unhex(F.sha2(F.to_json(F.struct(*version)), 256))
    return timed.withColumn("_version", digest).withWatermark(at, delay).dropDuplicatesWithinWatermark(["_version"]).drop("_version")


def _joinable(
    rows: DataFrame, keys: list[str], seconds: str, at: str, hold: str | None, delay: str, settle: str | None = None
) -> DataFrame:
    """Ready rows for a join: an event time ``at``, and one version per key.

    In batch that is the latest version. A stream drops exact copies and leaves versions to the
    summary layer, or with ``settle`` gives the latest version within each window of that size. Where the other side of the join may be skewed, ``keys`` holds more than the join
    key: the join then shuffles this side anew, and adaptive execution can split a hot key only
    between two fresh shuffles.
    """
    timed = rows.withColumn(at, from_seconds(F.col(seconds).try_cast("long")))
    if hold is not None and not settle:
        return _once(timed, at, delay)
    rest = [name for name in rows.columns if name not in keys and name not in (seconds, "old")]
    if settle:
        return latest_in_window(timed.withWatermark(at, delay), keys, at, [seconds, *rest], settle)
    return keep_latest(timed, keys, [seconds, *rest])


def cart_add(changes: DataFrame, dictionary: DataFrame, database: str | None = None) -> DataFrame:
    """Articles put in the cart: inserts, and the growth of an increased quantity."""
    rows = table_rows(changes, "cart_info", "insert", "update", database=database)
    added = rows.withColumn("sku_num", added_quantity()).where(
        F.col("sku_num").isNotNull() | (F.col("type") == "insert")
    )
    facts = added.select(*data_columns("id", "user_id", "sku_id", "source_type"), "sku_num", "ts")
    named = join_dictionary(facts, dictionary, "source_type", "source_type_name")
    return named.select(*columns_of("dwd_trade_cart_add"))


def order_details(changes: DataFrame, database: str | None = None) -> DataFrame:
    rows = table_rows(changes, "order_detail", "insert", database=database)
    price, count = decimal_of(F.col("data")["order_price"]), decimal_of(F.col("data")["sku_num"])
    return rows.select(
        *data_columns(
            "id", "order_id", "sku_id", "sku_name", "sku_num", "create_time", "source_type", "source_id",
            "split_total_amount", "split_activity_amount", "split_coupon_amount",
        ),
        (price * count).cast("string").alias("split_original_amount"),
        F.col("ts").alias("od_ts"),
    )


def order_changes(changes: DataFrame, database: str | None = None) -> DataFrame:
    rows = table_rows(changes, "order_info", "insert", "update", database=database)
    return rows.select(
        *data_columns("user_id", "province_id", "order_status", "operate_time", _order_key="id"),
        "type",
        "old",
        F.col("ts").alias("oi_ts"),
    )


def order_pre_process(
    changes: DataFrame,
    dictionary: DataFrame,
    database: str | None = None,
    hold: str | None = None,
    delay: str = "10 seconds",
    changes_within: str = ORDER_CHANGES,
    settle: str | None = None,
) -> DataFrame:
    """Order lines with their order, activity and coupon: one row per line and order change.

    On streams the two sides of the order join are held for times of their own: lines for
    ``changes_within``, as their order may change that much later; order changes for ``hold``. Versions of a line,
    its activity and its coupon settle in windows of ``settle``, if given, and are then given out once these close.
    """
    settle = settle if hold is not None else None
    details = _joinable(order_details(changes, database), ["id"], "od_ts", "_od_at", hold, delay, settle)
    # Only exact copies of a change count once: two changes of an order within one second are two.
    orders = order_changes(changes, database).withColumn("_old_text", F.to_json("old"))
    version = [name for name in orders.columns if name != "old"]
    orders = _joinable(orders, version, "oi_ts", "_oi_at", hold, delay).drop("_old_text")
    activities = table_rows(changes, "order_detail_activity", "insert", database=database).select(
        *data_columns("activity_id", "activity_rule_id", _act_key="order_detail_id"), F.col("ts").alias("_act_ts")
    )
    coupons = table_rows(changes, "order_detail_coupon", "insert", database=database).select(
        *data_columns("coupon_id", _cou_key="order_detail_id"), F.col("ts").alias("_cou_ts")
    )
    activities = _joinable(activities, ["_act_key"], "_act_ts", "_act_at", hold, delay, settle).drop("_act_ts")
    coupons = _joinable(coupons, ["_cou_key"], "_cou_ts", "_cou_at", hold, delay, settle).drop("_cou_ts")

    if hold is None and not dictionary.isStreaming:
        # The last lookup drops lines with an unknown code; they need not go to the orders first.
        details = details.join(dictionary.select(F.col("dic_code").alias("source_type")), "source_type", "left_semi")
    # The two joins on the line id come first: with the versions step they share one partitioning.
    joined = _join(details, activities, [("id", "_act_key")], ("_od_at", "_act_at"), hold, "left", hold)
    joined = _join(joined, coupons, [("id", "_cou_key")], ("_od_at", "_cou_at"), hold, "left", hold)
    joined = _join(joined, orders, [("order_id", "_order_key")], ("_od_at", "_oi_at"), hold, "inner", changes_within)
    joined = join_dictionary(joined, dictionary, "source_type", "source_type_name")
    return joined.select(
        "id", "order_id", "user_id", "order_status", "sku_id", "sku_name", "province_id", "activity_id",
        "activity_rule_id", "coupon_id",
        day_of_text(F.col("create_time")).alias("date_id"),
        "create_time",
        day_of_text(F.col("operate_time")).alias("operate_date_id"),
        "operate_time", "source_id", "source_type", "source_type_name", "sku_num", "split_original_amount",
        "split_activity_amount", "split_coupon_amount", "split_total_amount", "type", "old",
        _seconds_text("od_ts").alias("od_ts"),
        _seconds_text("oi_ts").alias("oi_ts"),
        F.current_timestamp().alias("row_op_ts"),
        *(["_od_at"] if hold is not None else []),
    )


def order_detail(pre_process: DataFrame) -> DataFrame:
    """Order lines as placed."""
    rows = pre_process.where(F.col("type") == "insert")
    rows = rows.withColumnsRenamed({"source_type": "source_type_code", "od_ts": "ts"})
    return rows.select(*columns_of("dwd_trade_order_detail"))


def order_cancel(pre_process: DataFrame) -> DataFrame:
    """Order lines of cancelled orders."""
    rows = pre_process.where(
        (F.col("type") == "update")
        & F.col("old")["order_status"].isNotNull()
        & (F.col("order_status") == ORDER_CANCELLED)
    )
    rows = rows.drop("date_id").withColumnsRenamed(
        {
            "operate_date_id": "date_id", "operate_time": "cancel_time", "source_type": "source_type_code",
            "oi_ts": "ts",
        }
    )
    return rows.select(*columns_of("dwd_trade_cancel_detail"))


def pay_detail(
    changes: DataFrame,
    details: DataFrame,
    dictionary: DataFrame,
    database: str | None = None,
    hold: str | None = None,
    delay: str = "10 seconds",
) -> DataFrame:
    """Paid order lines: a payment meets the lines of its order, placed up to ``hold`` before it."""
    payments = (
        table_rows(changes, "payment_info", "update", database=database)
        .where(changed_to("payment_status", PAYMENT_DONE))
        .select(
            *data_columns(
                "callback_time", payment_type_code="payment_type", _pay_order="order_id", _status="payment_status", _pay_id="id"
            ),
            F.col("ts").alias("_pay_ts"),
        )
    )
    # Each payment of an order counts; without an id only exact copies are one payment.
    own = F.concat_ws("|", "payment_type_code", "callback_time", "_pay_ts")
    payments = payments.withColumn("_pay_id", F.coalesce("_pay_id", own))
    payments = _joinable(payments, ["_pay_order", "_status", "_pay_id"], "_pay_ts", "_pay_at", hold, delay)
    lines = details.withColumnsRenamed(
        {"id": "order_detail_id", "split_total_amount": "split_payment_amount", "ts": "_line_ts"}
    ).withColumn("_line_at", from_seconds(F.col("_line_ts").try_cast("long")))
    if hold is not None:
        lines = _once(lines, "_line_at", delay)
    joined = _join(payments, lines, [("_pay_order", "order_id")], ("_pay_at", "_line_at"), hold)
    # The helper drops the right key; it equals the payment's order.
    joined = joined.withColumnRenamed("_pay_order", "order_id")
    named = join_dictionary(joined, dictionary, "payment_type_code", "payment_type_name")
    return named.withColumn("ts", _seconds_text("_pay_ts")).select(
        *columns_of("dwd_trade_pay_detail_suc"), *(["_pay_at"] if hold is not None else [])
    )


def _orders_that_became(changes: DataFrame, status: str, database: str | None, hold: str | None, delay: str):
    rows = table_rows(changes, "order_info", database=database).where(changed_to("order_status", status))
    orders = rows.select(
        *data_columns("province_id", _order_key="id", _order_user="user_id", _status="order_status"),
        F.col("ts").alias("_oi_ts"),
    )
    return _joinable(orders, ["_order_key", "_status"], "_oi_ts", "_oi_at", hold, delay).drop("_oi_ts", "_status")


def order_refund(
    changes: DataFrame,
    dictionary: DataFrame,
    database: str | None = None,
    hold: str | None = None,
    delay: str = "10 seconds",
) -> DataFrame:
    """Refunds asked for, with the province of the order and both code texts."""
    refunds = table_rows(changes, "order_refund_info", "insert", database=database).select(
        *data_columns(
            "id", "user_id", "order_id", "sku_id", "refund_num", "refund_amount", "refund_reason_txt", "create_time",
            refund_type_code="refund_type", refund_reason_type_code="refund_reason_type",
        ),
        "ts",
    )
    refunds = _joinable(refunds, ["id"], "ts", "_ri_at", hold, delay)
    orders = _orders_that_became(changes, ORDER_REFUND_ASKED, database, hold, delay).drop("_order_user")
    joined = _join(refunds, orders, [("order_id", "_order_key")], ("_ri_at", "_oi_at"), hold, "inner", hold)
    joined = join_dictionary(joined, dictionary, "refund_type_code", "refund_type_name")
    joined = join_dictionary(joined, dictionary, "refund_reason_type_code", "refund_reason_type_name")
    return joined.select(
        "id", "user_id", "order_id", "sku_id", "province_id",
        day_of_text(F.col("create_time")).alias("date_id"),
        "create_time", "refund_type_code", "refund_type_name", "refund_reason_type_code", "refund_reason_type_name",
        "refund_reason_txt", "refund_num", "refund_amount",
        _seconds_text().alias("ts"),
        F.current_timestamp().alias("row_op_ts"),
        *(["_ri_at"] if hold is not None else []),
    )


def refund_pay(
    changes: DataFrame,
    dictionary: DataFrame,
    database: str | None = None,
    require_status: str | None = None,
    hold: str | None = None,
    delay: str = "10 seconds",
) -> DataFrame:
    """Refunds paid back. ``require_status`` keeps only rows that changed to that refund status."""

    def of(table: str) -> DataFrame:
        rows = table_rows(changes, table, database=database)
        return rows if require_status is None else rows.where(
            (F.col("type") == "update") & changed_to("refund_status", require_status)
        )

    paid = of("refund_payment").select(
        *data_columns(
            "id", "order_id", "sku_id", "callback_time", payment_type_code="payment_type", refund_amount="total_amount"
        ),
        "ts",
    )
    paid = _joinable(paid, ["id"], "ts", "_rp_at", hold, delay)
    asked = of("order_refund_info").select(
        *data_columns("refund_num", _ri_id="id", _ri_order="order_id", _ri_sku="sku_id"), F.col("ts").alias("_ri_ts")
    )
    asked = _joinable(asked, ["_ri_id"], "_ri_ts", "_ri_at", hold, delay).drop("_ri_id", "_ri_ts")
    orders = _orders_that_became(changes, ORDER_REFUND_DONE, database, hold, delay)
    orders = orders.withColumnRenamed("_order_user", "user_id")
    joined = _join(paid, orders, [("order_id", "_order_key")], ("_rp_at", "_oi_at"), hold, "inner", hold)
    pairs = [("order_id", "_ri_order"), ("sku_id", "_ri_sku")]
    joined = _join(joined, asked, pairs, ("_rp_at", "_ri_at"), hold, "inner", hold)
    named = join_dictionary(joined, dictionary, "payment_type_code", "payment_type_name")
    return named.select(
        "id", "user_id", "order_id", "sku_id", "province_id", "payment_type_code", "payment_type_name",
        day_of_text(F.col("callback_time")).alias("date_id"),
        "callback_time", "refund_num", "refund_amount",
        _seconds_text().alias("ts"),
        F.current_timestamp().alias("row_op_ts"),
        *(["_rp_at"] if hold is not None else []),
    )


def coupon_get(changes: DataFrame, database: str | None = None) -> DataFrame:
    """Coupons handed out."""
    rows = table_rows(changes, "coupon_use", "insert", database=database)
    return _coupon(rows, "get_time", "get_time", "dwd_tool_coupon_get")


def coupon_order(changes: DataFrame, database: str | None = None, compat: bool = False) -> DataFrame:
    """Coupons put on an order. With ``compat`` the time is the hand-out time, as older feeds show it."""
    rows = table_rows(changes, "coupon_use", "update", database=database)
    rows = rows.where(changed_to("coupon_status", COUPON_IN_USE))
    return _coupon(rows, "get_time" if compat else "using_time", "using_time", "dwd_tool_coupon_order")


def coupon_pay(changes: DataFrame, database: str | None = None, compat: bool = False) -> DataFrame:
    """Coupons used in a payment. ``compat`` as in :func:`coupon_order`."""
    rows = table_rows(changes, "coupon_use", "update", database=database)
    rows = rows.where(changed_to("coupon_status", COUPON_USED))
    return _coupon(rows, "get_time" if compat else "used_time", "used_time", "dwd_tool_coupon_pay")


def _coupon(rows: DataFrame, source: str, output: str, table: str) -> DataFrame:
    shaped = rows.select(
        *data_columns("id", "coupon_id", "user_id", **{output: source}),
        day_of_text(F.col("data")[source]).alias("date_id"),
        _seconds_text().alias("ts"),
    )
    return shaped.select(*columns_of(table))


def favor_add(changes: DataFrame, database: str | None = None) -> DataFrame:
    """Articles marked as favourite."""
    return table_rows(changes, "favor_info", "insert", database=database).select(
        *data_columns("id", "user_id", "sku_id"),
        day_of_text(F.col("data")["create_time"]).alias("date_id"),
        *data_columns("create_time"),
        _seconds_text().alias("ts"),
    )


def comment(changes: DataFrame, dictionary: DataFrame, database: str | None = None) -> DataFrame:
    """Comments with the text of their rating."""
    facts = table_rows(changes, "comment_info", "insert", database=database).select(
        *data_columns("id", "user_id", "sku_id", "order_id", "create_time", appraise_code="appraise"),
        day_of_text(F.col("data")["create_time"]).alias("date_id"),
        _seconds_text().alias("ts"),
    )
    named = join_dictionary(facts, dictionary, "appraise_code", "appraise_name")
    return named.select(*columns_of("dwd_interaction_comment"))


def user_register(changes: DataFrame, database: str | None = None) -> DataFrame:
    """Users who signed up."""
    return table_rows(changes, "user_info", "insert", database=database).select(
        *data_columns(user_id="id"),
        day_of_text(F.col("data")["create_time"]).alias("date_id"),
        *data_columns("create_time"),
        _seconds_text().alias("ts"),
    )
