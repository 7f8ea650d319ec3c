"""Streams over several micro-batches equal their batch forms; restart, late rows, upserts."""

import os
import random
from collections import Counter

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from strataflow.operators.latest import latest_in_session, latest_in_window
from strataflow.operators.timed_join import bounded_join
from strataflow.operators.tumbling import window_totals, window_totals_per_member
from strataflow.plans import dim, dwd_db, dwd_log, dws
from strataflow.sinks import UpsertTable, branch_messages, jdbc_batch
from strataflow.sinks.writers import JDBC_ROWS
from strataflow.sources import kafka_text, text_files
from strataflow.streaming import jobs
from strataflow.streaming.dims import DimensionStore, run_dimensions
from strataflow.streaming.runner import run_available, start

PAGE = (
    "common struct<mid:string,uid:string,is_new:string,vc:string,ch:string,ar:string>, "
    "page struct<page_id:string,last_page_id:string,during_time:string,item:string,item_type:string>, ts long, log_id long"
)
FAR = 4_070_908_800_000


class Feed:
    """A folder that takes one file per micro-batch, in order."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema, self.files = spark, path, schema, 0
        self.path.mkdir()

    def add(self, rows):
        part = self.path.parent / f"part-{self.path.name}-{self.files}"
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.parquet(str(part))
        (source,) = part.glob("*.parquet")
        target = self.path / f"{self.files:04d}.parquet"
        target.write_bytes(source.read_bytes())
        os.utime(target, (1_700_000_000 + self.files,) * 2)
        self.files += 1
        return self

    def stream(self):
        schema = self.spark.createDataFrame([], self.schema).schema
        return self.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(self.path))

    def batch(self):
        return self.spark.read.parquet(str(self.path)).where("ts < 4000000000000")


def page(mid, page_id, last, ts, n, is_new="1"):
    return ((mid, mid, is_new, "v", "c", "a"), (page_id, last, "10", None, None), ts, n)


FUTURE = [page("future", "home", None, FAR, -1)]


def shuffled_pages(seed, count=400, span=600_000, disorder=2_000):
    """Pages in arrival order, at most ``disorder`` behind the greatest time before them."""
    rng = random.Random(seed)
    data = []
    for n in range(count):
        ts = 1_704_067_200_000 - 300_000 + n * span // count
        last = rng.choice([None, "", "home", "login"])
        data.append(page(f"m{rng.randint(0, 5)}", rng.choice(["home", "good_detail", "cart"]), last, ts, n, rng.choice("01")))
    return sorted(data, key=lambda row: row[2] + rng.randint(0, disorder))


@pytest.fixture()
def page_feed(spark, tmp_path):
    data = shuffled_pages(5)
    feed = Feed(spark, tmp_path / "pages", PAGE)
    for at in range(0, len(data), 100):
        feed.add(data[at : at + 100])
    return feed.add(FUTURE)


def bag(frame, *drop):
    return Counter(tuple(map(str, row)) for row in frame.drop(*drop).collect())


def same(stream_table: DataFrame, batch: DataFrame, future: str = "stt >= '2099-01-01'"):
    found, expected = bag(stream_table.where(f"NOT ({future})")), bag(batch)
    assert found == expected
    assert expected


def test_home_detail(page_feed):
    same(run_available(jobs.home_detail(page_feed.stream()), "t"), dws.home_detail(page_feed.batch()))


def test_user_login_over_midnight(page_feed):
    same(run_available(jobs.user_login(page_feed.stream()), "t"), dws.user_login(page_feed.batch()))


def test_unique_visitors(page_feed):
    found = run_available(jobs.unique_visitors(page_feed.stream(), ("log_id",)), "t")
    same(found, dwd_log.unique_visitors(page_feed.batch(), ("log_id",)), "log_id < 0")


@pytest.mark.parametrize("entry_follows", [True, False])
def test_bounces(page_feed, entry_follows):
    plain = dwd_log.bounced_pages if entry_follows else dwd_log.bounced_pages_timeout_only
    found = run_available(jobs.bounces(page_feed.stream(), 3000, "log_id", entry_follows), "t")
    same(found, plain(page_feed.batch(), 3000, ("log_id",)), "log_id < 0")


def test_bounces_stay_in_the_jvm(page_feed):
    plan = jobs.bounces(page_feed.stream(), 3000, "log_id")._jdf.queryExecution().analyzed().toString()
    assert "Pandas" not in plan and "Python" not in plan and "collect_list" in plan


def test_daily_state_ends_with_the_day(spark, tmp_path):
    """Keys of a past day leave the state; a job that needs the day before keeps them."""
    day = 86_400_000
    feed = Feed(spark, tmp_path / "pages", PAGE)
    for n in range(4):
        feed.add([page(f"m{n}-{k}", "home", None, 1_704_067_200_000 + n * day + k * 1000, n * 100 + k) for k in range(30)])
    left = {}
    for name, job in (("ends", jobs.home_detail), ("stays", jobs.user_login)):
        query = start(job(feed.stream()), str(tmp_path / name / "checkpoint"), table=str(tmp_path / name / "table"), trigger={"availableNow": True})
        query.awaitTermination()
        rows = [[o["numRowsTotal"] for o in p["stateOperators"] if "transformWithState" in o["operatorName"]] for p in query.recentProgress]
        left[name] = [sum(r) for r in rows if r]
        # All rows but those of the last, still open window have been counted.
        assert spark.read.parquet(str(tmp_path / name / "table")).count() > 0
    # Each day brings thirty new keys.
    assert 0 < max(left["ends"]) <= 60 < max(left["stays"]) == left["stays"][-1]


@pytest.mark.parametrize("name", ["home_detail", "user_login", "repaired"])
def test_state_calls_grow_with_buckets_not_keys(spark, tmp_path, monkeypatch, name):
    """Many keys share a bucket, its state and its calls, and each is counted by itself."""
    monkeypatch.setattr("strataflow.streaming.processors.BUCKETS", 3)
    feed = Feed(spark, tmp_path / "pages", PAGE)
    for n, at in enumerate((0, 10, 86_400, 2 * 86_400)):
        feed.add([page(f"m{k}", "home", None, 1_704_067_200_000 + at * 1000 + k, n * 100 + k, "01"[k % 2]) for k in range(0, 60, n + 1)])
    feed.add(FUTURE)
    query = start(getattr(jobs, name)(feed.stream()), str(tmp_path / "checkpoint"), table=str(tmp_path / "table"), trigger={"availableNow": True})
    query.awaitTermination()
    rows = [o["numRowsUpdated"] for p in query.recentProgress for o in p["stateOperators"] if "transformWithState" in o["operatorName"]]
    assert 0 < max(rows) <= 9  # a value and two marks of a timer each
    batch = dwd_log if name == "repaired" else dws
    same(spark.read.parquet(str(tmp_path / "table")), getattr(batch, name)(feed.batch()), "log_id < 0" if name == "repaired" else "stt >= '2099-01-01'")


def test_latest_row_is_held_once(spark):
    """State and shuffle hold each column of the kept row once; columns without an order still work."""
    rows = spark.sql("SELECT * FROM VALUES ('a', 1L, 'x', 5L), ('a', 2L, 'y', 5L), ('b', 1L, NULL, 5L) AS t(id, version, v, ts)")
    rows = rows.withColumn("at", F.timestamp_seconds("ts"))
    for frame in (rows, rows.withColumn("m", F.create_map("id", "version"))):
        for found in (latest_in_window(frame, ["id"], "at", ["version", "v"], "5 seconds"), latest_in_session(frame, ["id"], "at", ["version", "v"], "5 seconds")):
            assert ("max_by" in found._jdf.queryExecution().analyzed().toString()) == ("m" in frame.columns)
            assert found.columns[: len(frame.columns)] and set(frame.columns) <= set(found.columns)
            assert sorted((r.id, r.version, r.v) for r in found.collect()) == [("a", 2, "y"), ("b", 1, None)]


def test_keywords_share_rows_of_state(spark, tmp_path):
    rng = random.Random(7)
    feed = Feed(spark, tmp_path / "pages", PAGE)
    at = 1_704_067_200_000
    searches = []
    for n in range(90):
        item = rng.choice([None, "", " ".join(f"w{rng.randrange(900)}" for _ in range(120)), "often often Often 2024"])
        kind = "keyword" if n % 9 else "sku_id"
        searches.append((("m", "u", "1", "v", "c", "a"), ("good_list", "search", "10", item, kind), at + n * 700 + rng.randrange(500), n))
    for n in range(0, 90, 30):
        feed.add(searches[n : n + 30])
    feed.add([(("f", "f", "1", "v", "c", "a"), ("good_list", "search", "10", "future", "keyword"), FAR, -1)])
    query = start(jobs.keyword(feed.stream(), "20 seconds"), f"{tmp_path}/out/checkpoint", f"{tmp_path}/out/table", trigger={"availableNow": True})
    query.awaitTermination()
    same(spark.read.parquet(f"{tmp_path}/out/table"), dws.keyword(feed.batch(), "20 seconds"))
    updated = max(p.stateOperators[0].numRowsUpdated for p in query.recentProgress if p.stateOperators)
    assert 0 < updated <= 3 * jobs.KEYWORD_PARTS


def test_visitor_flag(page_feed):
    found = run_available(jobs.repaired(page_feed.stream()), "t")
    same(found, dwd_log.repaired(page_feed.batch()), "log_id < 0")


def test_restart_goes_on_where_it_stopped(spark, tmp_path):
    data = shuffled_pages(9)
    feed = Feed(spark, tmp_path / "pages", PAGE)
    feed.add(data[:150]).add(data[150:220])
    place = str(tmp_path / "out")
    run_available(jobs.user_login(feed.stream()), "t", place)
    feed.add(data[220:]).add(FUTURE)
    found = run_available(jobs.user_login(feed.stream()), "t", place)
    same(found, dws.user_login(feed.batch()))


def test_late_rows_leave_the_window_and_can_be_seen(spark, tmp_path):
    feed = Feed(spark, tmp_path / "rows", "k string, ts long")
    feed.add([("a", 1_000), ("a", 60_000)]).add([("a", 61_000)]).add([("a", 62_000), ("a", 2_000)]).add([("a", FAR)])
    rows = jobs.with_event_time(feed.stream(), "3 seconds")
    counted = run_available(window_totals(rows, "_at", ["k"], [F.count("*").alias("n")]), "t")
    assert bag(counted.where("stt < '2099'")) == bag(
        window_totals(
            feed.batch().where("ts <> 2000").withColumn("_at", F.timestamp_millis("ts")), "_at", ["k"], [F.count("*").alias("n")]
        )
    )
    late = run_available(jobs.late_rows(feed.stream(), "3 seconds"), "late")
    assert bag(late) == Counter([("a", "2000")])


def test_latest_version_then_two_windows(spark, tmp_path):
    schema = "id string, order_id string, amount long, version long, ts long"
    feed = Feed(spark, tmp_path / "rows", schema)
    feed.add([("1", "o1", 5, 1, 1_000), ("2", "o1", 7, 1, 1_500)]).add([("1", "o1", 6, 2, 1_000), ("3", "o2", 1, 1, 9_000)])
    feed.add([("9", "o9", 0, 0, FAR)])
    rows = jobs.with_event_time(feed.stream(), "3 seconds")
    latest = latest_in_window(rows, ["id"], "_at", ["version"], "5 seconds")
    totals = window_totals_per_member(latest.withColumn("k", F.lit("x")), "_at", ["k"], "order_id", "orders", ["amount"])
    found = run_available(totals, "t").where("stt < '2099'").orderBy("stt")
    assert [(r.orders, r.amount) for r in found.collect()] == [(1, 13), (1, 1)]


@pytest.mark.parametrize("how,expected", [("inner", [("1", "a", "10")]), ("left", [("1", "a", "10"), ("2", "b", "None")])])
def test_stream_joins_give_final_rows_only(spark, tmp_path, how, expected):
    names = Feed(spark, tmp_path / "s1", "id string, name string, ts long")
    ages = Feed(spark, tmp_path / "s2", "age_id string, age int, ts2 long")
    names.add([("1", "a", 1_000), ("2", "b", 1_000)]).add([("x", "x", 5_000)]).add([("f", "f", FAR)])
    ages.add([("y", 1, 1_000)]).add([("1", 10, 4_000), ("2", 5, 90_000)]).add([("g", 1, FAR)])
    left = names.stream().withColumn("lt", F.timestamp_millis("ts")).withWatermark("lt", "3 seconds")
    right = ages.stream().withColumn("rt", F.timestamp_millis("ts2")).withWatermark("rt", "3 seconds")
    joined = bounded_join(left, right, [("id", "age_id")], "lt", "rt", "-10 seconds", "10 seconds", how)
    found = run_available(joined.select("id", "name", "age"), "t").where("id IN ('1', '2')")
    assert bag(found) == Counter(expected)


# --- upserts ---------------------------------------------------------------------------------


def upserted(spark, path, deleted=None):
    schema = spark.createDataFrame([], "id string, v string, t long").schema
    return UpsertTable(spark, str(path), schema, ["id"], ["t"], deleted=deleted)


def test_upsert_keeps_last_write_and_can_be_retried(spark, tmp_path):
    table = upserted(spark, tmp_path / "t", deleted="gone")
    assert table.read().count() == 0
    schema = "id string, v string, t long, gone boolean"
    table.write_batch(spark.createDataFrame([("1", "a", 1, False), ("1", "b", 2, False), ("2", "x", 9, None)], schema), 0)
    second = spark.createDataFrame([("1", "c", 1, False), ("2", None, 1, True), ("3", "n", 1, False)], schema)
    table.write_batch(second, 1)
    table.write_batch(second, 1)
    expected = Counter([("1", "c", "1"), ("3", "n", "1")])
    assert bag(table.read()) == expected
    table.compact(1)
    assert [p.name for p in (tmp_path / "t").iterdir()] == ["gen=base-1"]
    assert bag(table.read()) == expected
    table.write_batch(spark.createDataFrame([("2", "back", 0, False)], schema), 2)
    assert bag(table.read()) == expected + Counter([("2", "back", "0")])


def test_compaction_cut_short_changes_nothing(spark, tmp_path, monkeypatch):
    table = upserted(spark, tmp_path / "t")
    schema = "id string, v string, t long"
    table.write_batch(spark.createDataFrame([("1", "a", 1), ("2", "b", 1)], schema), 0)
    table.write_batch(spark.createDataFrame([("1", "c", 1)], schema), 1)
    before = bag(table.read())
    monkeypatch.setattr(UpsertTable, "_files", lambda self: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        table.compact(1)
    monkeypatch.undo()
    table._save(table._last_writes(F.col("_batch") <= 1), "gen=base-1")  # folded, old folders still there
    assert bag(table.read()) == before


CHANGE = "database string, table string, type string, ts long, data map<string,string>, old map<string,string>"
CONFIG = "source_table string, sink_table string, sink_columns string, sink_pk string, sink_extend string"


def test_dimension_store_follows_the_configuration(spark, tmp_path):
    feed = Feed(spark, tmp_path / "changes", CHANGE)
    place, config = tmp_path / "out", [("a", "dim_a", "id,x", None, None)]
    store = DimensionStore(spark, str(place / "rows"))

    def run():
        run_dimensions(
            feed.stream(), lambda: spark.createDataFrame(config, CONFIG), store, str(place / "checkpoint"), "shop",
            {"availableNow": True},
        ).awaitTermination()

    def row(table, kind, ts, **data):
        return ("shop", table, kind, ts, data, None)

    feed.add([row("a", "insert", 1, id="1", x="old", y="no"), row("b", "insert", 1, id="7")])
    feed.add([row("a", "update", 2, id="1", x="new"), row("a", "insert", 1, id="2")])
    run()
    assert bag(store.table("dim_a", "id,x")) == Counter([("1", "new"), ("2", "None")])
    assert store.table("dim_b", "id").count() == 0
    config.append(("b", "dim_b", "id", "id", None))
    feed.add([row("b", "insert", 3, id="8")])
    run()
    assert bag(store.table("dim_b", "id")) == Counter([("8",)])
    plan = store.table("dim_a", "id,x")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sink_table" in plan
    store.compact(10)
    assert bag(store.table("dim_a", "id,x")) == Counter([("1", "new"), ("2", "None")])


# --- sources and sinks -----------------------------------------------------------------------


def test_jdbc_batch_stamps_and_batches(spark, monkeypatch):
    seen = {}

    def jdbc(self, url, table, mode=None, properties=None):
        seen.update(url=url, table=table, mode=mode, properties=properties, columns=self._df.columns)

    monkeypatch.setattr(DataFrameWriter, "jdbc", jdbc)
    jdbc_batch("jdbc:x", "dws", user="u")(spark.range(1), 0)
    assert seen == {
        "url": "jdbc:x", "table": "dws", "mode": "append", "columns": ["id", "ts"],
        "properties": {"batchsize": JDBC_ROWS, "user": "u"},
    }


def test_text_files_through_split_to_topics(spark, tmp_path):
    from strataflow.operators.routing import split_messages
    from strataflow.plans import ods

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"common":{"mid":"1"},"page":{"page_id":"home"},"ts":1}\nnot json\n')
    records = ods.parse_log(text_files(spark, str(tmp_path / "in"), 1))
    found = run_available(branch_messages(split_messages(records), {"page": "dwd_traffic_page"}), "t")
    assert bag(found) == Counter([("dwd_traffic_page", '{"common":{"mid":"1"},"page":{"page_id":"home"},"ts":1}')])


def test_kafka_without_connector_says_so(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_text(spark, "host:9092", "ods_log")


def test_per_batch_function(spark, tmp_path):
    feed = Feed(spark, tmp_path / "rows", "k string, ts long").add([("a", 1)]).add([("b", 2)])
    sizes = []
    query = start(
        feed.stream(), str(tmp_path / "checkpoint"), each_batch=lambda rows, batch: sizes.append((batch, rows.count())),
        trigger={"availableNow": True},
    )
    query.awaitTermination()
    assert sizes == [(0, 1), (1, 1)]


def test_copies_do_not_multiply_in_stream_joins(spark, tmp_path):
    feed = Feed(spark, tmp_path / "changes", CHANGE)

    def rows(n, at):
        line = {"id": n, "order_id": n, "sku_num": "2", "order_price": "3", "source_type": "2401"}
        return [
            ("shop", "order_detail", "insert", at, line, None),
            ("shop", "order_detail_coupon", "insert", at + 1, {"order_detail_id": n, "coupon_id": "c"}, None),
            ("shop", "order_detail_activity", "insert", at + 1, {"order_detail_id": n, "activity_id": "a"}, None),
            ("shop", "order_info", "insert", at, {"id": n, "order_status": "1001"}, None),
            # Two changes within one second are two.
            ("shop", "order_info", "update", at + 2, {"id": n, "order_status": "1002"}, {"order_status": "1001"}),
            ("shop", "order_info", "update", at + 2, {"id": n, "order_status": "1003"}, {"order_status": "1002"}),
        ]

    feed.add(rows("1", 1_704_067_200) * 2).add(rows("1", 1_704_067_200)).add(rows("future", 4_070_908_800))
    dictionary = spark.createDataFrame([("2401", "search")], "dic_code string, dic_name string")
    made = dwd_db.order_pre_process(feed.stream(), dictionary, "shop", hold=dwd_db.ORDER_HOLD)
    found = run_available(made.select("id", "coupon_id", "activity_id", "order_status"), "copies").where("id = '1'")
    assert bag(found) == Counter([("1", "c", "a", status) for status in ("1001", "1002", "1003")])


def test_dimension_writes_of_one_second(spark, tmp_path):
    """The place in the feed decides, the same in one batch, in several, and in any order."""
    schema = CHANGE + ", position long"

    def write(kind, ts, place, name):
        return ("shop", "base_region", kind, ts, {"id": "1", "region_name": name}, None, place)

    data = [write("insert", 5, 1, "first"), write("update", 5, 3, "last"), write("update", 5, 2, "second"), write("update", 4, 9, "late")]
    config = dim.default_config(spark)
    snapshot = dim.dim_snapshot(spark.createDataFrame(data, schema), config, "shop")
    assert [r.region_name for r in dim.dim_table(snapshot, "base_region").collect()] == ["last"]
    store = DimensionStore(spark, str(tmp_path / "rows"))
    for n, one in enumerate(data):
        store.upsert(spark.createDataFrame([one], schema), config, n, "shop")
    assert [r["data"]["region_name"] for r in store.rows().collect()] == ["last"]
    plain = [row[:-1] for row in data[:2]]
    snapshot = dim.dim_snapshot(spark.createDataFrame(plain, CHANGE), config, "shop")
    assert [r.region_name for r in dim.dim_table(snapshot, "base_region").collect()] == ["last"]


def test_payments_and_lines_come_part_by_part(spark, folder, monkeypatch):
    """The joined payments do not hold all lines at once, and copies are known by a digest, not by their whole row."""
    from strataflow.catalog import streams

    dealt = []
    monkeypatch.setattr(streams.StreamTables, "in_batches", lambda self, frame, name, *a, f=streams.StreamTables.in_batches: dealt.append(name) or f(self, frame, name, *a))
    made = streams.stream_pay_detail(streams.StreamTables(spark, folder))
    assert sorted(dealt) == ["detail-topic", "payments"]
    plan = made._jdf.queryExecution().analyzed().toString()
    keys = [line.split("DeduplicateWithinWatermark [")[1].split("]")[0] for line in plan.splitlines() if "DeduplicateWithinWatermark [" in line]
    assert len(keys) == 2 and all(k.startswith("_version") and "," not in k for k in keys)
