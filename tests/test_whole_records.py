"""Fields that no schema names through the split, and distinct counts out of mergeable summaries."""

import json
import random

import pytest
from pyspark.sql import functions as F

from strataflow.operators.routing import split_messages
from strataflow.plans import ads, ods

RECORDS = [
    {
        "common": {"mid": "1", "is_new": "1", "os": {"name": "x", "v": [1, 2]}, "vc": None}, "page": {"page_id": "p", "item": None, "refer": True},
        "displays": [{"item": "a", "rank": 3, "mid": "own"}, {"item": "b", "ts": 5}], "actions": [{"action_id": "c", "ts": 7, "extra": {"n": None}}],
        "err": {"error_code": 5, "trace": "t"}, "ts": 100, "sdk": [1, None, "é"],
    },
    {"common": {"mid": "2"}, "start": {"entry": "icon", "more": 1.5}, "err": {"msg": "m"}, "ts": 200, "note": "n", "displays": [{"item": "never"}]},
    {"page": {"page_id": "q"}, "ts": 300, "x": {"y": {"z": []}}},
    {"common": None, "page": {"page_id": "r", "ts": 1}, "displays": [], "actions": None, "ts": 400},
    {"unknown": 1},
]


def expected(record):
    """The rule on plain dictionaries."""
    out, rest = [], dict(record)
    if rest.get("err") is not None:
        out.append(("err", dict(rest)))
    rest.pop("err", None)
    if rest.get("start") is not None:
        return [*out, ("start", rest)]
    around = {}
    for part in ("common", "page"):
        around.update({k: v for k, v in (rest.get(part) or {}).items() if v is not None and k != "ts"})
    out += [("display", {**e, **around, "ts": rest["ts"]}) for e in rest.get("displays") or []]
    out += [("action", {**e, **around}) for e in rest.get("actions") or []]
    if rest.get("page") is not None:
        out.append(("page", {k: v for k, v in rest.items() if k not in ("displays", "actions")}))
    return out


def test_whole_records_reach_all_branches(spark):
    text = spark.createDataFrame([(json.dumps(r),) for r in RECORDS] + [("{broken",), ("no json",)], "value string")
    records = ods.parse_log(text.withColumn("_whole", F.col("value")), carry=("_whole",))
    repaired = records.withColumn("common", F.when(F.col("common.mid") == "1", F.col("common").withField("is_new", F.lit("0"))).otherwise(F.col("common")))
    wanted = []
    for record in RECORDS:
        if (record.get("common") or {}).get("mid") == "1":
            record = {**record, "common": {**record["common"], "is_new": "0"}}
        wanted += [(branch, json.dumps(value, sort_keys=True)) for branch, value in expected(record)]
    got = [(r.branch, json.dumps(json.loads(r.value), sort_keys=True)) for r in split_messages(repaired, whole="_whole").collect()]
    assert sorted(got) == sorted(wanted)


def test_distinct_counts_from_summaries(spark):
    rng = random.Random(5)
    data = [(rng.choice(["a", "b", None]), rng.choice([None, *range(-5, 5), *range(32_760, 32_775), 10**12]), 1_000 * rng.randrange(100)) for _ in range(3000)]
    rows = spark.createDataFrame([(k, None if m is None else str(m), t) for k, m, t in data], "k string, m string, t long").withColumn("_at", F.timestamp_millis("t"))
    summary = ads.members(rows, ["k"], "m", "10 seconds")
    got = {r.k: r.n for r in ads.distinct_from(summary, ["k"], "n", since="1970-01-01 00:00:20", until="1970-01-01 00:01:00").collect()}
    assert got == {k: len({m for g, m, t in data if g == k and m is not None and 20_000 <= t < 60_000}) for k in ("a", "b", None)}
    [whole] = ads.distinct_from(summary, [], "n").collect()
    assert whole.n == len({m for _, m, _ in data if m is not None})
    # The widest row is a bitmap of 32,768 members, however many a group has.
    assert summary.agg(F.max(F.octet_length("members"))).first()[0] == 4096
    with pytest.raises(ValueError, match="order_count"):
        ads.rollup(summary, ["k"], ["order_count"])
    with pytest.raises(ValueError, match="uv_ct"):
        ads.rollup(summary, ["k"], ["uv_ct"])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ads.members(rows.withColumn("m", F.lit("order 7")), ["k"], "m", "10 seconds").collect()


def test_few_members_of_many_numbers_stay_small(spark):
    """Members far apart: each costs a long, not a bitmap, and is added up by hash and not by sorting."""
    rng = random.Random(6)
    data = [(rng.choice(["a", "b", None]), rng.choice([None, rng.randrange(-(10**9), 10**9), *range(-65, -60), *range(60, 68)]), 1_000 * rng.randrange(100)) for _ in range(3000)]
    rows = spark.createDataFrame([(k, None if m is None else str(m), t) for k, m, t in data], "k string, m string, t long").withColumn("_at", F.timestamp_millis("t"))
    summary = ads.members(rows, ["k"], "m", "10 seconds", width=ads.MASK)
    got = {r.k: r.n for r in ads.distinct_from(summary, ["k"], "n", since="1970-01-01 00:00:20", until="1970-01-01 00:01:00").collect()}
    assert got == {k: len({m for g, m, t in data if g == k and m is not None and 20_000 <= t < 60_000}) for k in ("a", "b", None)}
    whole = ads.distinct_from(summary, [], "n")
    assert whole.first().n == len({m for _, m, _ in data if m is not None})
    assert "SortAggregate" not in whole._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["ads_distinct_orders", "ads_range_rollup"])
def test_order_members_are_longs(spark, folder, monkeypatch, name):
    from strataflow.catalog import batch

    kinds = []
    monkeypatch.setattr(batch.ads, "distinct_from", lambda summary, *a, f=batch.ads.distinct_from, **b: kinds.append(dict(summary.dtypes)["members"]) or f(summary, *a, **b))
    batch.QUERIES[name](spark, folder)
    assert kinds and set(kinds) == {"bigint"}


def test_text_is_parsed_and_written_once(spark, folder):
    """No filter is pushed below a parse, where it would parse again and write the derived text again."""
    from strataflow.catalog import views

    feed = ods.parse_changes(views.change_text(views.Tables(spark, folder), "order_info"))
    plan = feed._jdf.queryExecution().optimizedPlan().toString()
    given = feed.select("table", "type", "ts", "data")._jdf.queryExecution().optimizedPlan().toString()
    for text in (plan, given):
        assert text.count("from_json(") == 1 and not [line for line in text.splitlines() if "Filter" in line and ("from_json" in line or "StructsToJson" in line)]


def test_split_messages_are_read_once(spark, folder):
    from strataflow.catalog import batch

    plan = batch.QUERIES["log_split_messages"](spark, folder)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    # The message is parsed once, and the number of an event read once for each reading of the events.
    assert not [line for line in plan if line.count("get_json_object") > 1] and not any("get_json_object(value" in line for line in plan)
    # No map is evaluated again for each key of another.
    assert not any("map_keys" in line for line in plan)
