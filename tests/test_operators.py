"""Operators on small hand-made rows and against brute force."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strataflow.catalog import registry, views
from strataflow.functions import (
    camel_case,
    day_gap,
    day_of_text,
    dictionary_words,
    distinct_words,
    double_or_zero,
    millis_of_text,
    snake_case,
)
from strataflow.operators import lookup
from strataflow.operators.changes import added_quantity
from strataflow.operators.latest import keep_earliest, keep_latest
from strataflow.operators.lookup import attach_per_key, join_dictionary, join_dimension
from strataflow.operators.routing import split_log, split_messages
from strataflow.operators.timed_join import bounded_join
from strataflow.operators.visits import active_days, bounces, repair_visitor_flag
from strataflow.plans import ads, dim, dwd_db, dwd_log, dws, ods
from strataflow.schemas import DIMENSION_COLUMNS, columns_of
from strataflow.session import session_conf, sized_for
from strataflow.sinks import json_messages, keyed_messages, without_columns
from strataflow.sources import csv_stream, json_rows, topic_frames

DAY = 86_400_000


def rows_of(frame):
    return sorted((tuple(row) for row in frame.collect()), key=str)


def change(table, kind, data, old=None, ts=100, database="shop"):
    return (database, table, kind, ts, data, old)


CHANGE = "database string, table string, type string, ts long, data map<string,string>, old map<string,string>"


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), CHANGE)


def dictionary(spark, **texts):
    return spark.createDataFrame(list(texts.items()) or [("x", "x")], "dic_code string, dic_name string")


# --- functions -------------------------------------------------------------------------------


def test_sizing():
    small, large = sized_for(1 << 30, 8), sized_for(100 << 40, 4000)
    assert small["spark.sql.shuffle.partitions"] == "24" and large["spark.sql.shuffle.partitions"] == "409600"


def test_column_names():
    assert snake_case("homeUvCt") == "home_uv_ct"
    assert camel_case("HOME_UV_CT") == "homeUvCt"
    assert snake_case(camel_case("category1_id")) == "category1_id"


def test_time_text(spark):
    row = spark.sql("SELECT '2023-11-05 10:20:30' AS t, 'bad' AS b, '2023-11-05' AS d, '2023-11-09' AS later").select(
        day_of_text(F.col("t")), day_of_text(F.col("b")), millis_of_text(F.col("t")), millis_of_text(F.col("d")),
        day_gap(F.col("later"), F.col("d")), double_or_zero(F.col("b")),
    )
    assert tuple(row.first()) == ("2023-11-05", None, 1699179630000, 1699142400000, 4, 0.0)


def test_words(spark):
    frame = spark.createDataFrame([("Blue blue Pear, 東京地図 7",), (None,)], "t string")
    assert [r[0] for r in frame.select(distinct_words(F.col("t"))).collect()] == [["blue", "pear", "東京地図", "7"], None]
    cut = dictionary_words(["東京", "地図"])
    assert [r[0] for r in frame.select(cut(F.lit("東京地図東京"))).collect()] == [["東京", "地図"]] * 2


# --- change rows -----------------------------------------------------------------------------


def test_cart_quantities(spark):
    feed = changes(
        spark,
        change("cart_info", "insert", {"sku_num": "1"}),
        change("cart_info", "update", {"sku_num": "4"}, {"sku_num": "1"}),
        change("cart_info", "update", {"sku_num": "2"}, {"sku_num": "4"}),
        change("cart_info", "update", {"sku_num": "2"}, {"source_id": "1"}),
        change("cart_info", "update", {"sku_num": "x"}, {"sku_num": "1"}),
    )
    assert [r[0] for r in feed.select(added_quantity()).collect()] == ["1", "3", None, None, None]


def test_two_changes_of_an_order_in_one_second_are_two(spark):
    feed = changes(
        spark,
        change("order_detail", "insert", {"id": "7", "order_id": "3", "order_price": "2", "sku_num": "1", "source_type": "2401", "create_time": "2023-01-01 00:00:00"}),
        *[change("order_info", "update", {"id": "3", "order_status": after}, {"order_status": before}) for before, after in
          (("1001", "1002"), ("1002", "1003"), ("1002", "1003"))],
    )
    pre = dwd_db.order_pre_process(feed, dictionary(spark, **{"2401": "search"}))
    assert sorted(r.order_status for r in pre.collect()) == ["1002", "1003"]


def test_change_time_given_as_text(spark):
    text = spark.createDataFrame([('{"database":"shop","table":"t","type":"insert","ts":"12","data":{"id":"1"}}',)], "value string")
    assert [r.ts for r in ods.parse_changes(text).collect()] == [12]


def test_cart_add_drops_unknown_code(spark):
    feed = changes(
        spark,
        change("cart_info", "insert", {"id": "1", "sku_num": "2", "source_type": "2401"}),
        change("cart_info", "insert", {"id": "2", "sku_num": "2", "source_type": "9"}),
        change("cart_info", "insert", {"id": "3", "sku_num": "2", "source_type": "2401"}, database="other"),
    )
    found = dwd_db.cart_add(feed, dictionary(spark, **{"2401": "search"}), "shop")
    assert [(r.id, r.source_type_name) for r in found.collect()] == [("1", "search")]


def test_malformed_text_is_dropped(spark):
    texts = ['{"common":{"mid":"1"},"ts":"12"}', "no json", "[1]", "{", "", None, '{"common":{"mid":"2"},"ts":7}', "{}"]
    frame = spark.createDataFrame([(t,) for t in texts], "value string")
    assert rows_of(ods.parse_log(frame).select("common.mid", "ts")) == [("1", 12), ("2", 7), (None, None)]
    marked = frame.select(ods.is_json_object()).collect()
    assert [r[0] for r in marked] == [True, False, False, False, False, False, True, True]


def test_change_text(spark):
    text = '{"database":"shop","table":"a","type":"insert","ts":1,"data":{"id":5,"x":1.50},"old":null}'
    row = ods.parse_changes(spark.createDataFrame([(text,), ("junk",)], "value string")).collect()
    assert len(row) == 1 and row[0]["data"]["id"] == "5" and row[0]["old"] is None


def test_order_pre_process_keeps_one_row_per_line_and_change(spark):
    line = {"id": "1", "order_id": "7", "sku_num": "3", "order_price": "12.50", "source_type": "2401",
            "create_time": "2022-06-27 10:00:00"}
    feed = changes(
        spark,
        change("order_detail", "insert", line),
        change("order_detail", "insert", line),
        change("order_info", "insert", {"id": "7", "order_status": "1001"}),
        change("order_info", "update", {"id": "7", "order_status": "1003", "operate_time": "2022-06-28 01:00:00"},
               {"order_status": "1001"}, ts=200),
        change("order_detail_coupon", "insert", {"order_detail_id": "1", "coupon_id": "9"}),
    )
    pre = dwd_db.order_pre_process(feed, dictionary(spark, **{"2401": "search"}))
    found = rows_of(pre.select("type", "split_original_amount", "activity_id", "coupon_id", "date_id", "operate_date_id"))
    assert found == [
        ("insert", "37.5000", None, "9", "2022-06-27", None),
        ("update", "37.5000", None, "9", "2022-06-27", "2022-06-28"),
    ]
    assert dwd_db.order_detail(pre).count() == 1
    cancel = dwd_db.order_cancel(pre).first()
    assert (cancel.date_id, cancel.cancel_time, cancel.ts) == ("2022-06-28", "2022-06-28 01:00:00", "200")


def test_refund_pay_status_filter(spark):
    feed = changes(
        spark,
        change("refund_payment", "update", {"id": "1", "order_id": "7", "sku_id": "s", "payment_type": "1", "refund_status": "0705"},
               {"refund_status": "0701"}),
        change("refund_payment", "insert", {"id": "2", "order_id": "7", "sku_id": "s", "payment_type": "1"}),
        change("order_info", "update", {"id": "7", "user_id": "u", "order_status": "1006"}, {"order_status": "1005"}),
        change("order_refund_info", "update", {"id": "3", "order_id": "7", "sku_id": "s", "refund_num": "1",
                                               "refund_status": "0705"}, {"refund_status": "0701"}),
    )
    texts = dictionary(spark, **{"1": "card"})
    assert sorted(r.id for r in dwd_db.refund_pay(feed, texts).collect()) == ["1", "2"]
    assert [r.id for r in dwd_db.refund_pay(feed, texts, require_status="0705").collect()] == ["1"]


def test_coupon_times(spark):
    data = {"id": "1", "get_time": "2022-01-01 00:00:00", "used_time": "2022-01-02 00:00:00", "coupon_status": "1403"}
    feed = changes(spark, change("coupon_use", "update", data, {"coupon_status": "1402"}))
    assert dwd_db.coupon_pay(feed).first().date_id == "2022-01-02"
    assert dwd_db.coupon_pay(feed, compat=True).first().used_time == "2022-01-01 00:00:00"
    assert dwd_db.coupon_order(feed).count() == 0


# --- one row per key -------------------------------------------------------------------------


def test_latest_and_earliest(spark):
    frame = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z"), ("a", 3, "w")], "k string, t int, v string")
    assert rows_of(keep_latest(frame, ["k"], ["t", "v"])) == [("a", 3, "y"), ("b", 2, "z")]
    assert rows_of(keep_earliest(frame, ["k"], ["t", "v"])) == [("a", 1, "x"), ("b", 2, "z")]


def test_latest_limits_groups_before_the_shuffle(spark):
    frame = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    plan = keep_latest(frame, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below and "Partial" in below


# --- lookups ---------------------------------------------------------------------------------


def test_dimension_lookup(spark):
    facts = spark.createDataFrame([("1",), ("2",), (None,)], "sku_id string")
    skus = spark.createDataFrame([("1", "one")], "id string, sku_name string")
    found = join_dimension(facts, skus, "sku_id", {"sku_name": "name"})
    assert rows_of(found) == [("1", "one"), ("2", None), (None, None)]
    with pytest.raises(PySparkException, match="no dimension row for sku_id=2"):
        join_dimension(facts, skus, "sku_id", {"sku_name": "name"}, missing="fail").collect()
    with pytest.raises(PySparkException, match="no dimension row"):
        join_dimension(facts, skus, "sku_id", {"sku_name": "name"}, missing="fail").count()
    assert join_dimension(facts.where("sku_id = '1'"), skus, "sku_id", {"sku_name": "name"}, "fail").count() == 1


def test_two_lookups_in_one_dictionary(spark):
    facts = spark.createDataFrame([("1", "2"), ("1", "9")], "a string, b string")
    texts = dictionary(spark, **{"1": "one", "2": "two"})
    both = join_dictionary(join_dictionary(facts, texts, "a", "a_name"), texts, "b", "b_name")
    assert rows_of(both.select("a_name", "b_name")) == [("one", "two")]


def test_hot_keys_are_answered_in_place(spark, monkeypatch):
    monkeypatch.setattr(lookup, "HEAVY_KEYS", 2)
    rng = random.Random(1)
    data = [(rng.choice(["hot"] * 10 + ["warm"] * 4 + ["a", "b", "c", None]), i) for i in range(600)]
    rows = spark.createDataFrame(data, "k string, n int")
    per_key = rows.where("k IS NOT NULL").groupBy("k").agg(F.max("n").alias("top"), F.count("*").alias("w"))
    found = attach_per_key(rows, per_key.where("k <> 'c'"), ["k"], ["top"], "w")
    best = {}
    for k, n in data:
        best[k] = max(n, best.get(k, -1))
    assert rows_of(found) == sorted(((k, n, None if k in (None, "c") else best[k]) for k, n in data), key=str)


def test_hot_keys_do_not_enter_the_shuffle(spark):
    rows = spark.createDataFrame([("hot", i) for i in range(50)] + [(None, 1)], "k string, n int")
    per_key = rows.where("k IS NOT NULL").groupBy("k").agg(F.max("n").alias("top"), F.count("*").alias("w"))
    found = attach_per_key(rows, per_key, ["k"], ["top"], "w")
    assert found.count() == 51
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "_hit" in plan


def test_hot_order_is_split_at_run_time(spark):
    lines = spark.range(60_000).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("order_id"),
    )
    lines = lines.select("*", *[F.lit("x").alias(c) for c in columns_of("dwd_trade_order_detail")[2:]])
    paid = spark.range(60_000).select(
        F.lit("shop").alias("database"), F.lit("payment_info").alias("table"), F.lit("update").alias("type"),
        F.lit(1).cast("long").alias("ts"),
        F.create_map(
            F.lit("order_id"), F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")),
            F.lit("payment_status"), F.when(F.col("id") < 60_000, "1602").otherwise("1601"),
            F.lit("payment_type"), F.when(F.col("id") % 2 == 0, "1").otherwise("2"),
        ).alias("data"),
        F.create_map(F.lit("payment_status"), F.lit("1601")).alias("old"),
    )
    tight = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    }
    with session_conf(spark, **{key.replace(".", "__"): value for key, value in tight.items()}):
        joined = dwd_db.pay_detail(paid, lines, dictionary(spark, **{"1": "card", "2": "cash"}))
        joined = joined.select("order_detail_id", "payment_type_name")
        assert joined.count() == 60_000
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


def test_bounded_join_limits(spark):
    left = spark.sql("SELECT * FROM VALUES ('a', timestamp'2024-01-01 00:30:00') AS t(k, lt)")
    right = spark.sql(
        "SELECT * FROM VALUES ('a', timestamp'2024-01-01 00:00:00'), ('a', timestamp'2023-12-31 23:59:59'), "
        "('a', timestamp'2024-01-01 00:30:01'), ('b', timestamp'2024-01-01 00:10:00') AS t(rk, rt)"
    )
    found = bounded_join(left, right, [("k", "rk")], "lt", "rt", "-30 minutes", "0 seconds")
    assert [str(r.rt) for r in found.select(F.col("rt").cast("string").alias("rt")).collect()] == ["2024-01-01 00:00:00"]


# --- visits ----------------------------------------------------------------------------------

PAGE = "common struct<mid:string,uid:string,is_new:string>, page struct<page_id:string,last_page_id:string>, ts long"


def pages(spark, *rows):
    return spark.createDataFrame([((m, m, "1"), (p, last), ts) for m, p, last, ts in rows], PAGE)


@pytest.mark.parametrize("within_ms, plan", [(3000, dwd_log.bounced_pages), (5000, dwd_log.bounced_pages_timeout_only)])
def test_bounced_pages_equal_the_rule(spark, within_ms, plan):
    """Random visits: an entry stays alone if nothing follows in time, or, in the first pattern, another entry does."""
    rng = random.Random(within_ms)
    visits = []
    for device in ("d0", "d1", "d2"):
        at = 0
        for _ in range(60):
            at += rng.choice((1, 400, within_ms - 1, within_ms, within_ms + 1, 90_000))
            visits.append((device, rng.choice(("home", "cart")), rng.choice((None, "", "home")), at))
    expected = []
    for (device, _, last, at), after in zip(visits, [*visits[1:], None]):
        follows = after is not None and after[0] == device and after[3] - at < within_ms
        if not last and not (follows and (after[2] or plan is dwd_log.bounced_pages_timeout_only)):
            expected.append((device, at))
    assert rows_of(plan(pages(spark, *visits)).select("common.mid", "ts")) == sorted(expected, key=str)


@pytest.mark.parametrize("entry_follows", [True, False])
@pytest.mark.parametrize("slice_ms", [5, 8, 1000])
def test_bounces_equal_brute_force(spark, entry_follows, slice_ms):
    rng = random.Random(slice_ms)
    data = [(f"m{rng.randint(0, 3)}", i, rng.randint(0, 120), rng.random() < 0.5) for i in range(150)] + [("z", 0, 5, True)]
    frame = spark.createDataFrame([(m, i, t, e) for m, i, t, e in data], "mid string, n int, ts long, entry boolean")
    found = bounces(frame, F.col("entry"), 5, tie=["n"], entry_follows=entry_follows, slice_ms=slice_ms)
    expected = []
    for m in {d[0] for d in data}:
        mine = sorted((d for d in data if d[0] == m), key=lambda d: (d[2], d[1]))
        for here, after in zip(mine, [*mine[1:], None]):
            gone = after is None or after[2] - here[2] >= 5 or (entry_follows and after[3])
            if here[3] and gone:
                expected.append(here)
    assert rows_of(found) == sorted(expected, key=str)


def test_visitor_flag(spark):
    data = [
        ("a", "1", 10 * DAY), ("a", "1", 10 * DAY + 5), ("a", "1", 11 * DAY), ("a", "0", 12 * DAY),
        ("b", "0", 10 * DAY), ("b", "1", 10 * DAY + 1), (None, "1", 5), ("c", None, 10 * DAY), ("c", "1", 9 * DAY),
    ]
    frame = spark.createDataFrame(data, "mid string, is_new string, ts long")
    assert rows_of(repair_visitor_flag(frame)) == sorted(
        [("a", "1", 10 * DAY), ("a", "1", 10 * DAY + 5), ("a", "0", 11 * DAY), ("a", "0", 12 * DAY),
         ("b", "0", 10 * DAY), ("b", "0", 10 * DAY + 1), (None, "1", 5), ("c", None, 10 * DAY), ("c", "1", 9 * DAY)],
        key=str,
    )


def test_active_days(spark):
    frame = spark.createDataFrame([("u", 5), ("u", 3), ("u", 9 * DAY), (None, 1)], "uid string, ts long")
    found = rows_of(active_days(frame, ["uid"], "ts", previous=True))
    assert found == [("u", "1970-01-01", 3, None), ("u", "1970-01-10", 9 * DAY, "1970-01-01")]


def test_returning_user_needs_more_than_seven_days(spark):
    frame = pages(spark, ("u", "home", None, 0), ("u", "home", None, 7 * DAY), ("u", "home", None, 15 * DAY))
    assert [(r.back_ct, r.uu_ct) for r in dws.user_login(frame).orderBy("stt").collect()] == [(0, 1), (0, 1), (1, 1)]


# --- routing ---------------------------------------------------------------------------------


def test_split(spark):
    record = (
        '{"common":{"mid":"1","is_new":"1"},"page":{"page_id":"home","item":"p"},"displays":[{"item":"d","order":"1"},'
        '{"order":"2"}],"actions":[{"action_id":"x","ts":"5"}],"err":{"error_code":"e"},"ts":9}'
    )
    start = '{"common":{"mid":"2"},"start":{"entry":"icon"},"err":{"error_code":"f"},"ts":3}'
    records = ods.parse_log(spark.createDataFrame([(record,), (start,)], "value string"))
    branches = split_log(records)
    assert {name: rows.count() for name, rows in branches.items()} == {
        "err": 2, "start": 1, "display": 2, "action": 1, "page": 1,
    }
    assert rows_of(branches["display"].select("item", "order", "mid", "ts")) == [("p", "1", "1", 9), ("p", "2", "1", 9)]
    assert rows_of(branches["action"].select("action_id", "page_id", "ts")) == [("x", "home", 5)]
    assert branches["err"].where("displays IS NOT NULL").count() == 1
    assert "err" not in branches["page"].columns

    messages = split_messages(records)
    for name, rows in branches.items():
        mine = messages.where(F.col("branch") == name).select("value")
        assert rows_of(mine) == rows_of(json_messages(rows)), name


def test_dimension_routing(spark):
    feed = changes(
        spark,
        change("base_region", "bootstrap-insert", {"id": "1", "region_name": "north", "junk": "x"}),
        change("base_region", "update", {"id": "1", "region_name": "south"}, ts=200),
        change("base_region", "delete", {"id": "1"}),
        change("order_info", "insert", {"id": "1"}),
        change("base_region", "insert", None),
    )
    config = dim.default_config(spark)
    assert config.count() == 15
    routed = dim.dim_rows(feed, config)
    assert sorted(sorted(r["data"]) for r in routed.collect()) == [["id", "region_name"]] * 2
    snapshot = dim.dim_snapshot(feed, config)
    assert rows_of(dim.dim_table(snapshot, "base_region")) == [("1", "south")]
    assert dim.dim_table(snapshot, "sku_info").columns == DIMENSION_COLUMNS["sku_info"].split(",")


# --- summaries and sinks ---------------------------------------------------------------------


def test_order_counts_and_missing_amounts(spark):
    details = spark.createDataFrame(
        [("1", "o1", "s", "p", "5.10", None, "1", 10), ("1", "o1", "s", "p", "6.10", None, "2", 10),
         ("2", "o1", "s", "p", "1.00", "0.50", "1", 11), ("3", "o2", "s", "p", "1.00", "x", "1", 12)],
        "id string, order_id string, sku_id string, province_id string, split_total_amount string, "
        "split_coupon_amount string, row_op_ts string, ts long",
    ).withColumns({"split_original_amount": F.lit("0"), "split_activity_amount": F.lit("0")})
    provinces = spark.createDataFrame([("p", "north")], "id string, name string")
    row = dws.province_order(details, provinces, "1 minute").first()
    assert (row.province_name, row.order_count, row.order_amount) == ("north", 2, 8.1)


def test_rollup(spark):
    summary = spark.createDataFrame(
        [("2024-01-01 00:00:00", "2024-01-01 00:00:05", "a", 1), ("2024-01-01 00:00:05", "2024-01-01 00:00:10", "a", 2),
         ("2024-01-02 00:00:00", "2024-01-02 00:00:05", "a", 4)],
        "stt string, edt string, k string, n long",
    )
    assert rows_of(ads.rollup(summary, ["k"], ["n"], until="2024-01-01 00:00:10")) == [("a", 3)]
    assert rows_of(ads.rollup(summary, [], ["n"], by_day=True)) == [("2024-01-01", 3), ("2024-01-02", 4)]


def test_messages(spark):
    frame = spark.createDataFrame([("1", "a", False), ("2", "b", True)], "id string, v string, gone boolean")
    assert rows_of(keyed_messages(frame, ["id"], "gone")) == [('{"id":"1"}', '{"id":"1","v":"a"}'), ('{"id":"2"}', None)]
    assert without_columns(frame.withColumnRenamed("v", "homeUvCt"), ["gone"]).columns == ["id", "home_uv_ct"]
    sent = keyed_messages(frame, ["id"], "gone")
    assert rows_of(json_rows(sent, frame.drop("gone").schema)) == [("1", "a")]


def test_topics_and_csv(spark):
    frame = spark.createDataFrame([("a", "1,x"), ("b", "2,y")], "topic string, value string")
    parts = topic_frames(frame, "a", "b")
    schema = spark.createDataFrame([], "id string, name string").schema
    assert rows_of(csv_stream(parts["a"], schema)) == [("1", "x")]


def test_lines_of_unknown_codes_do_not_go_to_the_orders(spark, folder):
    from strataflow.catalog import batch

    plan = batch.QUERIES["order_pre_process"](spark, folder)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    semi = [n for n, line in enumerate(plan) if "Join LeftSemi" in line]
    orders = [n for n, line in enumerate(plan) if "Join Inner" in line and "_order_key" in line]
    assert len(semi) == 1 and len(orders) == 1 and orders[0] < semi[0]


def test_latest_lines_are_picked_before_the_join(spark):
    """The ranking shuffles given columns only; versions and copies of lines, and copies of orders, count as they do after the join."""
    rng = random.Random(3)

    class Given:
        lineitem = spark.createDataFrame(
            [
                (rng.choice([None, *range(12)]), rng.choice([None, 1, 2, 3]), rng.randrange(3), rng.randrange(2), rng.choice([None, 5.0, 7.5]), float(rng.randrange(1, 4)), 0.05, 0.06, rng.choice([None, "2024-01-01", "2024-01-02"]))
                for _ in range(300)
            ],
            "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_extendedprice double, l_quantity double, l_discount double, l_tax double, ship string",
        ).withColumn("l_shipdate", F.col("ship").cast("timestamp"))
        orders = spark.createDataFrame([(k, k % 5) for k in range(2, 15)] + [(4, 4)], "o_orderkey long, o_custkey long").withColumn(
            "o_orderdate", F.timestamp_seconds(F.lit(1_704_067_200) + F.col("o_orderkey") * 86400)
        )

    names = ["id", "order_id", "sku_id", "province_id", "split_total_amount", "ts", "l_suppkey"]
    want = keep_latest(views.order_lines(Given), ["id"], ["row_op_ts", *views.LINE_TIE]).select(names)
    found = views.latest_order_lines(Given).select(names)
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect())) and want.count() > 20
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Window")


def test_summaries_of_lines_rank_before_the_join(spark, folder):
    for name in ("sku_order_window", "province_order_window"):
        plan = registry.queries()[name](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
        ranked = plan[plan.index("Window [") :]
        assert "Join" not in ranked and "decimal" not in ranked


def test_hot_order_of_latest_lines_is_split(spark):
    class Given:
        lineitem = spark.range(60_000).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 20_000).alias("l_orderkey"), F.col("id").alias("l_linenumber"), F.col("id").alias("l_partkey"),
            F.xxhash64("id").alias("l_suppkey"), F.rand(1).alias("l_extendedprice"), F.rand(2).alias("l_quantity"), F.rand(3).alias("l_discount"),
            F.rand(4).alias("l_tax"), F.current_timestamp().alias("l_shipdate"),
        )
        orders = spark.range(20_000).select(F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.current_timestamp().alias("o_orderdate"))

    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.shuffle.partitions": "8",
    }
    with session_conf(spark, **{key.replace(".", "__"): value for key, value in conf.items()}):
        lines = views.latest_order_lines(Given)
        assert len(lines.collect()) == 60_000
        assert "skew=true" in lines._jdf.queryExecution().executedPlan().toString()
