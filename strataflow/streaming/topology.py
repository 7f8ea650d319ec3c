"""All jobs of the warehouse by name: which topics each reads and what it writes.

Jobs are wired by topics only, so each is a query of its own with its own checkpoint. Where topics
live is up to the caller: ``read`` gives the text stream of a topic (for Kafka,
``lambda topic: kafka_text(spark, servers, topic)``), and ``FileBus`` keeps them in folders.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.operators.routing import split_messages
from strataflow.plans import dwd_db, dws, ods
from strataflow.schemas import PAGE_ROW, detail_schema
from strataflow.sinks import branch_messages, json_messages
from strataflow.sources import json_rows
from strataflow.streaming import jobs
from strataflow.streaming.runner import start

# Topics of the five log branches (fixed names).
LOG_TOPICS = {
    "page": "dwd_traffic_page",
    "start": "dwd_traffic_start",
    "err": "dwd_traffic_err",
    "display": "dwd_traffic_display",
    "action": "dwd_traffic_action",
}


@dataclass
class Inputs:
    """What the jobs read. ``dictionary`` and ``dimensions`` are called at the start of a job.

    ``landing`` gives the parsed change rows (``sinks.landed``); without it each job parses the feed itself.
    """

    read: Callable[[str], DataFrame]
    dictionary: Callable[[], DataFrame]
    dimensions: Callable[[], dict[str, DataFrame]]
    database: str | None = None
    size: str = "5 seconds"
    landing: Callable[[], DataFrame] | None = None

    def changes(self) -> DataFrame:
        return self.landing() if self.landing else ods.parse_changes(self.read("ods_db"))

    def pages(self, topic: str = "dwd_traffic_page") -> DataFrame:
        return json_rows(self.read(topic), PAGE_ROW)

    def details(self, table: str) -> DataFrame:
        return json_rows(self.read(table), detail_schema(table))


@dataclass(frozen=True)
class Job:
    """``build`` gives rows; they go to the topic or table ``target``. A split carries its topics."""

    layer: str
    target: str | None
    build: Callable[[Inputs], DataFrame]


JOBS: dict[str, Job] = {}


def _job(layer: str, target: str | None = None):
    def register(build: Callable[[Inputs], DataFrame]):
        name = build.__name__.lstrip("_")
        JOBS[name] = Job(layer, target, build)
        return build

    return register


# --- detail layer: log -----------------------------------------------------------------------


@_job("dwd")
def _log_split(i):
    text = i.read("ods_log")
    records = jobs.repaired(ods.parse_log(text.withColumn("_whole", F.col("value")), carry=("_whole",)), i.size)
    return branch_messages(split_messages(records, whole="_whole"), LOG_TOPICS)


@_job("dwd", "dwd_traffic_uv")
def _unique_visitors(i):
    return jobs.unique_visitors(i.pages(), size=i.size)


@_job("dwd", "dwd_traffic_uj_detail")
def _bounces(i):
    return jobs.bounces(i.pages())


# --- detail layer: business ------------------------------------------------------------------


@_job("dwd", "dwd_trade_cart_add")
def _cart_add(i):
    return dwd_db.cart_add(i.changes(), i.dictionary(), i.database)


@_job("dwd", "dwd_trade_order_pre_process")
def _order_pre_process(i):
    return dwd_db.order_pre_process(i.changes(), i.dictionary(), i.database, hold=dwd_db.ORDER_HOLD).drop("_od_at")


@_job("dwd", "dwd_trade_order_detail")
def _order_detail(i):
    return dwd_db.order_detail(i.details("dwd_trade_order_pre_process"))


@_job("dwd", "dwd_trade_cancel_detail")
def _order_cancel(i):
    return dwd_db.order_cancel(i.details("dwd_trade_order_pre_process"))


@_job("dwd", "dwd_trade_pay_detail_suc")
def _pay_detail(i):
    lines = i.details("dwd_trade_order_detail")
    return dwd_db.pay_detail(i.changes(), lines, i.dictionary(), i.database, hold=dwd_db.PAYMENT_HOLD).drop("_pay_at")


@_job("dwd", "dwd_trade_order_refund")
def _order_refund(i):
    return dwd_db.order_refund(i.changes(), i.dictionary(), i.database, hold=dwd_db.ORDER_HOLD).drop("_ri_at")


@_job("dwd", "dwd_trade_refund_pay_suc")
def _refund_pay(i):
    return dwd_db.refund_pay(i.changes(), i.dictionary(), i.database, hold=dwd_db.ORDER_HOLD).drop("_rp_at")


@_job("dwd", "dwd_tool_coupon_get")
def _coupon_get(i):
    return dwd_db.coupon_get(i.changes(), i.database)


@_job("dwd", "dwd_tool_coupon_order")
def _coupon_order(i):
    return dwd_db.coupon_order(i.changes(), i.database)


@_job("dwd", "dwd_tool_coupon_pay")
def _coupon_pay(i):
    return dwd_db.coupon_pay(i.changes(), i.database)


@_job("dwd", "dwd_interaction_favor_add")
def _favor_add(i):
    return dwd_db.favor_add(i.changes(), i.database)


@_job("dwd", "dwd_interaction_comment")
def _comment(i):
    return dwd_db.comment(i.changes(), i.dictionary(), i.database)


@_job("dwd", "dwd_user_register")
def _user_register(i):
    return dwd_db.user_register(i.changes(), i.database)


# --- summary layer ---------------------------------------------------------------------------


@_job("dws", "dws_traffic_source_keyword_page_view_window")
def _keyword_window(i):
    return jobs.keyword(i.pages(), i.size)


@_job("dws", "dws_traffic_vc_ch_ar_is_new_page_view_window")
def _traffic_window(i):
    counters = dws.traffic_counters(i.pages(), i.pages("dwd_traffic_uv"), i.pages("dwd_traffic_uj_detail"))
    return dws.traffic_totals(counters.withWatermark("_at", jobs.TRAFFIC_DELAY), i.size)


@_job("dws", "dws_traffic_page_view_window")
def _home_detail_window(i):
    return jobs.home_detail(i.pages(), i.size)


@_job("dws", "dws_user_user_login_window")
def _login_window(i):
    return jobs.user_login(i.pages(), i.size)


@_job("dws", "dws_user_user_register_window")
def _register_window(i):
    return dws.user_register(i.details("dwd_user_register"), i.size, jobs.DELAY)


@_job("dws", "dws_trade_cart_add_uu_window")
def _cart_add_window(i):
    return jobs.cart_add_uu(i.details("dwd_trade_cart_add"), i.size)


@_job("dws", "dws_trade_payment_suc_window")
def _payment_window(i):
    return jobs.payment_suc(i.details("dwd_trade_pay_detail_suc"), i.size)


@_job("dws", "dws_trade_order_window")
def _order_window(i):
    return jobs.trade_order(i.details("dwd_trade_order_detail"), i.size)


@_job("dws", "dws_trade_sku_order_window")
def _sku_order_window(i):
    lines = jobs.lines_latest(dws.sku_lines(i.details("dwd_trade_order_detail")), size=i.size)
    return dws.sku_named(dws.sku_totals(lines, i.size), i.dimensions())


@_job("dws", "dws_trade_province_order_window")
def _province_order_window(i):
    lines = jobs.lines_latest(dws.province_lines(i.details("dwd_trade_order_detail")), size=i.size)
    return dws.province_named(dws.province_totals(lines, i.size), i.dimensions()["base_province"])


@_job("dws", "dws_trade_trademark_category_user_refund_window")
def _refund_window(i):
    dims = i.dimensions()
    lines = dws.refund_lines(i.details("dwd_trade_order_refund"), dims["sku_info"]).withWatermark("_at", jobs.DELAY)
    return dws.refund_result(dws.refund_totals(lines, i.size), dims)


# --- running ---------------------------------------------------------------------------------


def messages(name: str, inputs: Inputs) -> DataFrame:
    """The output of a job as messages with their topic; a summary goes by its table name."""
    job = JOBS[name]
    rows = job.build(inputs)
    return rows if job.target is None else json_messages(rows, job.target)


class FileBus:
    """Topics kept as parquet folders of text rows."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path.rstrip("/")

    def publish(self, rows: DataFrame, writer: str, batch: int) -> None:
        """Write messages (topic, value) of one micro-batch; a retry replaces its own folder."""
        target = f"{self._path}/writer={writer}/batch={batch}"
        rows.select("topic", "value").write.mode("overwrite").partitionBy("topic").parquet(target)

    def read(self, topic: str) -> DataFrame:
        """A topic as a stream. Of the wildcard parts only whole batches are seen: Spark moves a
        batch's files in place when its write is done."""
        return self._spark.readStream.schema("value STRING").parquet(f"{self._path}/writer=*/batch=*/topic={topic}")

    def run(self, name: str, inputs: Inputs, checkpoints: str, trigger: dict | None = None):
        """Start a job that writes to this bus."""
        return start(
            messages(name, inputs),
            f"{checkpoints}/{name}",
            each_batch=lambda rows, batch: self.publish(rows, name, batch),
            trigger=trigger,
        )
