"""Lookups in tables that change while a stream runs, and joins that correct themselves."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_streams import CHANGE, FAR, Feed, bag

from strataflow.plans import dwd_db, dws
from strataflow.sinks import UpsertTable
from strataflow.streaming.changelog import adds_only, changelog_left_join, folded, upsert_messages
from strataflow.streaming.fresh import fresh_lookup, versions_of
from strataflow.streaming.runner import run_available

FACTS = "n long, sku string, ts long, seen timestamp, price decimal(10,2)"


def change(table, ts, kind="insert", **data):
    return ("shop", table, kind, ts, data, None)


def test_code_and_article_that_come_while_the_job_runs(spark, tmp_path):
    """Rows whose code or article is unknown wait over a restart; nothing is lost, and unknown ones are counted."""
    feed = Feed(spark, tmp_path / "changes", CHANGE)
    codes = versions_of(feed.stream(), "base_dic", "dic_code", "shop")

    def cart(n, source):
        return change("cart_info", 10, id=n, user_id="u", sku_id=f"s{n}", sku_num="2", source_type=source)

    def run():
        return run_available(dwd_db.cart_add(feed.stream(), codes, "shop"), "t", str(tmp_path / "out"))

    feed.add([change("base_dic", 1, dic_code="1", dic_name="one"), cart("1", "1"), cart("2", "2"), cart("3", "9"), cart("4", None)])
    feed.add([cart("5", "2")])
    assert bag(run().select("id", "source_type_name")) == Counter([("1", "one")])
    feed.add([change("base_dic", 20, dic_code="2", dic_name="two")])
    feed.add([cart("6", "2"), change("base_dic", 30, "update", dic_code="1", dic_name="eins"), cart("7", "1")])
    feed.add([change("base_dic", 5, "update", dic_code="1", dic_name="older"), cart("8", "1")])
    expected = [("1", "one"), ("2", "two"), ("5", "two"), ("6", "two"), ("7", "eins"), ("8", "eins")]
    assert bag(run().select("id", "source_type_name")) == Counter(expected)

    skus = versions_of(feed.stream(), "sku_info", "id", "shop")
    rows = feed.stream().where("table = 'cart_info'").select(F.col("data")["id"].alias("id"), F.col("data")["sku_id"].alias("sku"))
    looked = fresh_lookup(rows, skus, "sku", {"sku_name": "name"})
    place = str(tmp_path / "skus")
    assert run_available(looked, "t", place).count() == 0
    feed.add([change("sku_info", 1, id="s1", sku_name="first")]).add([change("sku_info", 1, id="s2")])
    assert bag(run_available(looked, "t", place)) == Counter([("1", "s1", "first", "False"), ("2", "s2", "None", "False")])


def test_table_at_the_start(spark, tmp_path):
    feed = Feed(spark, tmp_path / "facts", "sku string, n long").add([("a", 1), ("b", 2), (None, 3)]).add([("c", 4)]).add([("a", 5)])
    changes = Feed(spark, tmp_path / "changes", CHANGE).add([change("sku_info", 9, id="zz", sku_name="z")]).add([change("sku_info", 9, id="b", sku_name="B")])
    known = spark.createDataFrame([("a", {"sku_name": "A"}, 1)], "id string, data map<string,string>, ts long")
    rows = fresh_lookup(feed.stream(), versions_of(changes.stream(), "sku_info"), "sku", {"sku_name": "name"}, known=known)
    found = run_available(rows, "t", str(tmp_path / "out"))
    assert bag(found) == Counter([("a", "1", "A", "False"), ("a", "5", "A", "False"), ("b", "2", "B", "False"), ("None", "3", "None", "True")])
    with pytest.raises(ValueError):
        fresh_lookup(feed.stream(), known, "sku", {}, patience_ms=5)


@pytest.mark.parametrize("seed", [1, 2])
def test_version_of_the_time_in_any_order(spark, tmp_path, seed):
    rng = random.Random(seed)
    versions = sorted({(f"s{rng.randrange(6)}", 1_000 * rng.randrange(100)) for _ in range(30)}, key=lambda x: x[1])
    facts = sorted((1_000 * rng.randrange(100) + rng.randrange(1000), n, rng.choice([*[f"s{k}" for k in range(8)], None])) for n in range(200))
    mixed = [(m, ("v", key, m)) for key, m in versions] + [(m, ("f", key, m, n)) for m, n, key in facts]
    mixed.sort(key=lambda x: x[0] + rng.randrange(4_000))  # within the delay
    schema = "kind string, key string, ts long, n long"
    feed = Feed(spark, tmp_path / "rows", schema)
    for at in range(0, len(mixed), 60):
        feed.add([(x[0], x[1], x[2], x[3] if len(x) > 3 else None) for _, x in mixed[at : at + 60]])
    feed.add([("f", "none", FAR, -1)])
    rows = feed.stream().withColumn("_at", F.timestamp_millis("ts")).withWatermark("_at", "5 seconds")
    written = rows.where("kind = 'v'").select(F.col("key").alias("id"), F.create_map(F.lit("x"), F.col("ts").cast("string")).alias("data"), (F.col("ts") / 1000).cast("long").alias("ts"))
    looked = fresh_lookup(rows.where("kind = 'f'"), written, "key", {"x": "x"}, as_of=F.col("ts"), patience_ms=20_000)
    got = {r.n: (r.x, r.lookup_missing) for r in run_available(looked, "t").where("n >= 0").collect()}
    for m, n, key in facts:
        own = sorted(v for k, v in versions if k == key)
        x = str(max((v for v in own if v <= m), default=own[0])) if own else None
        late = own and own[0] > m + 20_000  # may have passed before its first version came
        assert got[n] == (x, x is None) or (late and got[n] == (None, True)), (m, n, key)
    assert len(got) == len(facts)


def test_chained_lookups_after_a_window(spark, tmp_path):
    """Summary rows wait for each dimension of a chain in turn."""
    feed = Feed(spark, tmp_path / "rows", "trademark_id string, category3_id string, ts long")
    feed.add([("t1", "c3", 1_000), ("t1", "c3", 2_000)]).add([("t2", "c4", 60_000)]).add([("x", "x", FAR)])
    feed_dims = Feed(spark, tmp_path / "dims", CHANGE)
    feed_dims.add([change("base_trademark", 1, id="t1", tm_name="T1"), change("base_category3", 1, id="c3", name="C3", category2_id="c2")])
    feed_dims.add([change("base_category1", 1, id="c1", name="C1")]).add([change("base_category2", 1, id="c2", name="C2", category1_id="c1")])
    dims = {name: versions_of(feed_dims.stream(), name) for name in ("base_trademark", "base_category3", "base_category2", "base_category1")}
    rows = feed.stream().withColumn("_at", F.timestamp_millis("ts")).withWatermark("_at", "3 seconds")
    counted = rows.groupBy(F.window("_at", "5 seconds").alias("span"), "trademark_id", "category3_id").agg(F.count("*").alias("n"))
    named = dws.with_categories(counted.select("trademark_id", "category3_id", "n"), dims)
    found = run_available(named, "t", str(tmp_path / "out"))
    one = ("t1", "c3", "2", "T1", "C3", "c2", "C2", "c1", "C1")
    assert bag(found) == Counter([one])
    feed_dims.add([change("base_trademark", 1, id="t2", tm_name="T2"), change("base_category3", 1, id="c4", name="C4", category2_id="c2")])
    found = run_available(named, "t", str(tmp_path / "out"))
    assert bag(found) == Counter([one, ("t2", "c4", "1", "T2", "C4", "c2", "C2", "c1", "C1")])


LEFT, RIGHT = "id string, v string, ts long, gone boolean", "ref string, w string, ts long"


def _sides(spark, tmp_path, seed=None):
    left, right = Feed(spark, tmp_path / "left", LEFT), Feed(spark, tmp_path / "right", RIGHT)
    return left, right


def _timed(feed):
    return feed.stream().withColumn("at", F.timestamp_millis("ts")).withWatermark("at", "5 seconds")


def _joined(left, right, **options):
    return changelog_left_join(
        _timed(left), {"right": _timed(right)}, {"left": "id", "right": "ref"}, "at", 60_000, {"left": ["v"], "right": ["w"]}, **options
    )


def test_provisional_row_is_taken_back(spark, tmp_path):
    left, right = _sides(spark, tmp_path)
    left.add([("1", "a", 1_000, False), ("2", "b", 1_000, False), (None, "n", 1_000, False)]).add([("1", "a", 1_000, False)]).add([("2", None, 3_000, True)])
    right.add([("9", "z", 1_000)]).add([("1", "x", 2_000)]).add([("1", "x", 2_000)])
    changes = run_available(_joined(left, right, deleted=F.coalesce(F.col("gone"), F.lit(False))), "t")
    got = [(r.key, r.op, r.left.v, r.right.w if r.right else None) for r in changes.orderBy("key", "number").collect()]
    assert got == [("1", "+I", "a", None), ("1", "-D", "a", None), ("1", "+I", "a", "x"), ("2", "+I", "b", None), ("2", "-D", "b", None)]
    assert adds_only(changes).count() == 3
    messages = upsert_messages(changes, F.col("key").alias("id"), F.col("left.v"), F.col("right.w"))
    assert bag(folded(messages)) == Counter([('{"id":"1"}', '{"id":"1","v":"a","w":"x"}')])
    assert messages.where("value IS NULL").count() == 2
    # The same messages in a table that keeps the last write per key, over batches.
    table = UpsertTable(spark, str(tmp_path / "t"), messages.schema, ["key"], ["number"], deleted="gone", batch_first=False)
    for batch, op in enumerate(("+I", "-D")):
        some = messages.where(F.col("value").isNotNull() if op == "+I" else F.col("value").isNull())
        table.write_batch(some.withColumn("gone", F.col("value").isNull()), batch)
    assert bag(table.read().select("key")) == Counter([('{"id":"1"}',)])


@pytest.mark.parametrize("seed", [1, 2])
def test_fold_equals_the_batch_join(spark, tmp_path, seed):
    rng = random.Random(seed)
    left, right = _sides(spark, tmp_path)
    rows = [(f"k{rng.randrange(40)}", f"v{rng.randrange(9)}", 1_000 * rng.randrange(40), False) for _ in range(120)]
    others = [(f"k{rng.randrange(60)}", f"w{rng.randrange(9)}", 1_000 * rng.randrange(40)) for _ in range(120)]
    for at in range(0, 120, 30):
        left.add(rows[at : at + 30])
        right.add(others[at : at + 30])
    changes = run_available(_joined(left, right), "t")
    latest = {k: v for _, v, k in sorted((ts, v, k) for k, v, ts, _ in rows)}
    partner = {k: w for _, w, k in sorted((ts, w, k) for k, w, ts in others)}
    messages = upsert_messages(changes, F.col("key").alias("id"), F.col("left.v"), F.col("right.w"))
    got = {r.id: (r.v, r.w) for r in folded(messages).select(F.from_json("value", "id string, v string, w string").alias("r")).select("r.*").collect()}
    assert got == {k: (v, partner.get(k)) for k, v in latest.items()}
    assert changes.where("op = '-D'").count() > 5


def test_quiet_keys_are_forgotten(spark, tmp_path):
    left, right = _sides(spark, tmp_path)
    left.add([("1", "a", 1_000, False)]).add([("2", "b", 200_000, False)]).add([("3", "c", 400_000, False)]).add([("1", "late", 500_000, False)])
    right.add([("9", "z", 1_000)]).add([("9", "z", 200_000)]).add([("9", "z", 400_000)]).add([("9", "z", 500_000)])
    changes = run_available(_joined(left, right), "t")
    got = [(r.key, r.op, r.left.v) for r in changes.where("key = '1'").orderBy("number").collect()]
    assert got == [("1", "+I", "a"), ("1", "+I", "late")]  # no partner and no former row is remembered
    messages = upsert_messages(changes, F.col("left.v"))
    assert dict(bag(folded(messages.where("key LIKE '%1%'")))) == {('{"id":"1"}', '{"v":"late"}'): 1}
