"""Jobs wired by topics, from raw text to summaries."""

import json

import pytest
from pyspark.sql import functions as F

from strataflow.schemas import DWD_COLUMNS, DWS_COLUMNS
from strataflow.streaming.topology import JOBS, FileBus, Inputs

START = 1_704_067_200
FAR = 4_070_908_800


def test_every_detail_and_summary_table_has_a_job():
    targets = {job.target for job in JOBS.values() if job.target}
    assert targets == {*DWD_COLUMNS, *DWS_COLUMNS, "dwd_traffic_uv", "dwd_traffic_uj_detail"}


def log(mid, last, second, page="home"):
    common = {"mid": mid, "uid": mid, "is_new": "1", "vc": "v", "ch": "c", "ar": "a"}
    return {"common": common, "page": {"page_id": page, "last_page_id": last, "during_time": 7}, "ts": second * 1000}


def change(table, kind, second, old=None, **data):
    return {"database": "shop", "table": table, "type": kind, "ts": second, "data": data, "old": old}


@pytest.fixture()
def world(spark, tmp_path):
    bus = FileBus(spark, str(tmp_path / "bus"))
    dims = {"base_province": spark.createDataFrame([("1", "north")], "id string, name string")}
    inputs = Inputs(
        bus.read, lambda: spark.sql("SELECT '2401' AS dic_code, 'search' AS dic_name"), lambda: dims, "shop"
    )
    place = str(tmp_path / "checkpoints")

    def publish(topic, *records):
        rows = [(topic, r if isinstance(r, str) else json.dumps(r)) for r in records]
        bus.publish(spark.createDataFrame(rows, "topic string, value string"), f"raw-{topic}", publish.batch)
        publish.batch += 1

    publish.batch = 0

    def run(*names):
        for name in names:
            bus.run(name, inputs, place, {"availableNow": True}).awaitTermination()

    def table(topic):
        rows = spark.read.schema("value STRING").parquet(f"{tmp_path}/bus/writer=*/batch=*/topic={topic}")
        return [json.loads(r.value) for r in rows.collect()]

    return publish, run, table


def test_log_to_traffic(world):
    publish, run, table = world
    publish("ods_log", log("m", None, START), log("m", "home", START + 1), "junk", log("n", None, START + 2))
    publish("ods_log", log("m", None, START + 86_400), log("far", None, FAR))
    run("log_split")
    flags = {(r["common"]["mid"], r["ts"] // 1000): r["common"]["is_new"] for r in table("dwd_traffic_page")}
    assert flags[("m", START)] == "1" and flags[("m", START + 86_400)] == "0"
    publish("dwd_traffic_page", log("far", None, FAR))
    run("unique_visitors", "bounces", "traffic_window")
    rows = {(r["stt"], r["is_new"]): r for r in table("dws_traffic_vc_ch_ar_is_new_page_view_window")}
    first = rows[("2024-01-01 00:00:00", "1")]
    assert [first[k] for k in ("pv_ct", "sv_ct", "uv_ct", "uj_ct", "dur_sum")] == [3, 2, 2, 1, 21]
    assert [rows[("2024-01-02 00:00:00", "0")][k] for k in ("pv_ct", "uv_ct", "uj_ct")] == [1, 1, 1]


def test_orders_to_provinces(world):
    publish, run, table = world

    def line(n, second, amount, order="7"):
        return change(
            "order_detail", "insert", second, id=n, order_id=order, sku_id="s", source_type="2401", sku_num="2",
            order_price="1.50", split_total_amount=amount, create_time="2024-01-01 00:00:00",
        )

    publish(
        "ods_db", line("1", START + 1, "3.00"), line("2", START + 2, "4.50"),
        change("order_info", "insert", START, id="7", user_id="u", province_id="1", order_status="1001"),
        change("order_detail_coupon", "insert", START + 2, order_detail_id="1", coupon_id="c"), "junk",
    )
    publish(
        "ods_db", line("f", FAR, "0", "f"), change("order_info", "insert", FAR, id="f", user_id="f", province_id="1"),
        change("order_detail_activity", "insert", FAR, order_detail_id="f", activity_id="a"),
        change("order_detail_coupon", "insert", FAR, order_detail_id="f", coupon_id="c"),
    )
    run("order_pre_process", "order_detail", "province_order_window", "order_window")
    details = {r["id"]: r for r in table("dwd_trade_order_detail")}
    assert details["1"]["coupon_id"] == "c" and "coupon_id" not in details["2"]
    assert details["1"]["split_original_amount"] == "3.0000"
    (row,) = [r for r in table("dws_trade_province_order_window") if r["stt"] < "2099"]
    assert row == {
        "stt": "2024-01-01 00:00:00", "edt": "2024-01-01 00:00:05", "province_id": "1", "province_name": "north",
        "order_count": 1, "order_amount": 7.5,
    }
    (row,) = [r for r in table("dws_trade_order_window") if r["stt"] < "2099"]
    assert (row["order_unique_user_count"], row["order_new_user_count"]) == (1, 1)


def test_stateless_jobs_build(spark):
    inputs = Inputs(
        lambda topic: spark.readStream.format("rate").load().select(F.col("value").cast("string").alias("value")),
        lambda: spark.sql("SELECT '1' AS dic_code, 'x' AS dic_name"),
        lambda: {
            name: spark.sql(f"SELECT '1' AS id, {columns}")
            for name, columns in {
                "sku_info": "'' AS sku_name, '' AS spu_id, '' AS tm_id, '' AS category3_id", "spu_info": "'' AS spu_name",
                "base_trademark": "'' AS tm_name", "base_category3": "'' AS name, '' AS category2_id",
                "base_category2": "'' AS name, '' AS category1_id", "base_category1": "'' AS name",
                "base_province": "'' AS name",
            }.items()
        },
    )
    from strataflow.schemas import columns_of

    for name, job in JOBS.items():
        built = job.build(inputs)
        if job.target and (job.target in DWD_COLUMNS or job.target in DWS_COLUMNS):
            assert built.columns == columns_of(job.target), name
