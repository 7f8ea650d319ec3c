"""The change feed in files by table and time, and the segmenter over a word list."""

import datetime as dt
import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from strataflow.catalog.streams import StreamTables
from strataflow.functions import dictionary_words, word_list, words
from strataflow.plans import dwd_db, ods
from strataflow.sinks.landing import land, land_stream, landed

DAY = 86_400
TABLES = (
    "cart_info", "order_detail", "order_info", "order_detail_activity", "order_detail_coupon", "payment_info", "order_refund_info",
    "refund_payment", "coupon_use", "favor_info", "comment_info", "user_info",
)


def feed(spark, *more):
    rows = [
        {"database": "shop", "table": table, "type": kind, "ts": day * DAY + n, "data": {"id": str(n)}, "old": {"id": "0"} if n % 2 else None}
        for day in (0, 1, 19_000) for n, table in enumerate(TABLES) for kind in ("insert", "update")
    ]
    odd = [{"table": "cart_info", "type": "insert"}, {"table": None, "type": "insert", "ts": 5}, {"table": "a/b c=d", "ts": -1, "data": {}}]
    texts = [json.dumps(row) for row in rows + odd] + ["junk", None, *more]
    return spark.createDataFrame([(t,) for t in texts], "value string")


def plain(rows):
    return sorted(json.dumps(r.asDict(), sort_keys=True) for r in rows.collect())


@pytest.mark.parametrize("unit", ["day", "year"])
def test_landed_rows_are_the_parsed_rows(spark, tmp_path, unit):
    text, path = feed(spark), str(tmp_path / "landing")
    land(text, path, unit)
    parsed = ods.parse_changes(text)
    rows = landed(spark, path, unit)
    assert rows.columns == parsed.columns and plain(rows) == plain(parsed)
    between = landed(spark, path, unit, since=dt.date(1970, 1, 2), until=dt.date(1970, 1, 2))
    assert plain(between) == plain(parsed.where((F.col("ts") >= DAY) & (F.col("ts") < 2 * DAY)))
    land(spark.createDataFrame([], "value string"), path, unit)
    assert landed(spark, path, unit).count() == parsed.count()


def test_each_job_reads_its_tables_only(spark, tmp_path):
    path = str(tmp_path / "landing")
    land(feed(spark), path)
    rows, dic = landed(spark, path), spark.sql("SELECT '1' AS dic_code, 'x' AS dic_name")
    order = {"order_detail", "order_info", "order_detail_activity", "order_detail_coupon"}
    pre = dwd_db.order_pre_process(rows, dic)
    jobs = {
        "order_pre_process": (pre, order), "order_detail": (dwd_db.order_detail(pre), order), "order_cancel": (dwd_db.order_cancel(pre), order),
        "cart_add": (dwd_db.cart_add(rows, dic), {"cart_info"}), "comment": (dwd_db.comment(rows, dic), {"comment_info"}),
        "coupon_get": (dwd_db.coupon_get(rows), {"coupon_use"}), "coupon_order": (dwd_db.coupon_order(rows), {"coupon_use"}),
        "coupon_pay": (dwd_db.coupon_pay(rows), {"coupon_use"}), "favor_add": (dwd_db.favor_add(rows), {"favor_info"}),
        "user_register": (dwd_db.user_register(rows), {"user_info"}),
        "order_refund": (dwd_db.order_refund(rows, dic), {"order_refund_info", "order_info"}),
        "refund_pay": (dwd_db.refund_pay(rows, dic), {"refund_payment", "order_refund_info", "order_info"}),
        "pay_detail": (dwd_db.pay_detail(rows, dwd_db.order_detail(pre), dic), order | {"payment_info"}),
    }
    for name, (job, tables) in jobs.items():
        plan = job._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if "FileScan" in line]
        assert scans and all("table" in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans), name
        assert {f for f in TABLES if any(f"= {f})" in line for line in scans)} == tables, name


def test_stream_lands_and_is_read_as_stream(spark, tmp_path):
    feed(spark).where("value is not null").write.text(str(tmp_path / "in"))
    source = spark.readStream.text(str(tmp_path / "in"))
    path = str(tmp_path / "landing")
    land_stream(source, path, str(tmp_path / "checkpoint"), trigger={"availableNow": True}).awaitTermination()
    assert plain(landed(spark, path)) == plain(ods.parse_changes(feed(spark)))
    carts = landed(spark, path, stream=True).where("table = 'cart_info'").select("type", "ts")
    query = carts.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c2")).option("path", str(tmp_path / "out"))
    query.trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 7


def brute(dictionary, text):
    found = []
    for run in "".join(c if c.isalnum() else " " for c in text.lower()).split():
        at = 0
        while at < len(run):
            word = max((w for w in dictionary if run.startswith(w, at)), key=len, default=run[at])
            found.append(word)
            at += len(word)
    return list(dict.fromkeys(found))


@pytest.mark.parametrize("window", [1, 3, 1 << 18])
def test_segments_equal_plain_longest_match(spark, monkeypatch, window):
    monkeypatch.setattr(words, "WINDOW", window)
    rng = random.Random(window)
    letters = "abß東京\U00020000"
    dictionary = {"".join(rng.choices(letters, k=rng.randint(1, 5))) for _ in range(60)}
    texts = ["".join(rng.choices(letters + "  .\n", k=rng.randint(0, 60))) for _ in range(80)] + [""]
    trie = words._trie(dictionary)
    assert words._segments(trie, [" ".join(w for w in "".join(c if c.isalnum() else " " for c in t).split()) for t in texts]) == [
        brute(dictionary, t) for t in texts
    ]
    assert words._segments(words._trie([]), ["ab a", ""]) == [["a", "b"], []] and words._segments(trie, []) == []
    cut = dictionary_words([*dictionary, "a b", ""])
    frame = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    assert [r[0] for r in frame.select(cut(F.col("t"))).collect()] == [*(brute(dictionary, t) for t in texts), None]


def test_long_text_and_word_lists(spark):
    long = "abc" * 400_000
    trie = words._trie(["abc", "abca", "bc"])
    assert words._segments(trie, [long, "x"]) == [brute(["abc", "abca", "bc"], long[:300]), ["x"]]
    frame = spark.createDataFrame([("Pear",), ("pear",), (None,), ("",), ("Fig",)], "w string")
    assert word_list(frame, "w") == ["fig", "pear"]
    with pytest.raises(ValueError, match="more than 1"):
        word_list(frame, "w", limit=1)



def test_writes_that_are_read_again_leave_no_shuffle_files(spark, tmp_path):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def left(before, tries=50):
        count = sum("shuffle_" in files.getAllFiles().apply(i).getName() for i in range(files.getAllFiles().size()))
        if count <= before or not tries:
            return count
        time.sleep(0.1)
        return left(before, tries - 1)

    before, base = left(0, 0), spark.conf.get("spark.checkpoint.dir")
    land(feed(spark), str(tmp_path / "landing"), "year")
    t = StreamTables(spark, "none")
    rows = spark.range(400).repartition(3, "id").selectExpr("id", "id AS ts")
    t.in_batches(rows, "probe", F.pmod("id", F.lit(4)), {"id": "-1"})
    t.staged(rows, "whole", {"id": "-1"})
    assert left(before) <= before
    kept = [name for name in os.listdir(base) if name.startswith("probe-")]
    # The copy dealt out by part is gone; what the stream reads holds all rows.
    assert len(kept) == 1 and spark.read.parquet(f"{base}/{kept[0]}").count() == 401
