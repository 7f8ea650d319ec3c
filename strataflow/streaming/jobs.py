"""Streaming forms of the stateful jobs, with the contracts of the batch forms in ``plans``.

Stateless, windowed and joined jobs need no second form: the functions in ``plans`` accept streams.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.functions import day_of, distinct_words, from_millis, second_text
from strataflow.operators.latest import latest_in_window
from strataflow.operators.tumbling import DEFAULT_SIZE
from strataflow.operators.visits import first_claims, first_day
from strataflow.plans import dwd_log, dws
from strataflow.plans.dwd_log import is_entry
from strataflow.schemas import columns_of
from strataflow.streaming.processors import BUCKET, DailyFirst, FirstDay, LateRows, bucket_of

# Allowed disorder of the jobs (fixed values).
DELAY = "3 seconds"
CART_DELAY = ORDER_DELAY = "5 seconds"
TRAFFIC_DELAY = "15 seconds"

SALTS = 16
#: Parts of a window's words, by hash: one row of state each. Windows of very many words want more, set before the first start.
KEYWORD_PARTS = 64


def with_event_time(rows: DataFrame, delay: str, millis: str = "ts") -> DataFrame:
    return rows.withColumn("_at", from_millis(F.col(millis))).withWatermark("_at", delay)


def daily_firsts(
    rows: DataFrame, keys: Sequence[str], millis: str = "ts", size: str = DEFAULT_SIZE, ends: bool = False
) -> DataFrame:
    """First row per key and day of watermarked rows: keys, ``day``, ``previous_day``, ``_at``.

    With ``ends`` state lasts a day only, for jobs that read no ``previous_day``.

    Rows are first reduced to one per key and window by a plain aggregate, which combines on the map
    side; only those reach the keyed state, in time order. ``_at`` is the last instant of the window.
    """
    for key in keys:
        rows = rows.where(F.col(key).isNotNull())
    # A window may hold midnight when it is longer than the day grid; the day is part of the group.
    reduced = rows.groupBy(F.window("_at", size).alias("_span"), *keys, day_of(F.col("_at")).alias("day")).agg(
        F.min(millis).alias("millis")
    )
    windows = reduced.select(bucket_of(*keys), *keys, "day", "millis", F.window_time("_span").alias("_at"))
    output = T.StructType([*windows.schema.fields[1:], T.StructField("previous_day", T.StringType())])
    return windows.groupBy(BUCKET).transformWithStateInPandas(
        DailyFirst(windows.columns, keys, ends), output, "Append", "EventTime", eventTimeColumnName="_at"
    )


def home_detail(pages: DataFrame, size: str = DEFAULT_SIZE, delay: str = DELAY) -> DataFrame:
    rows = with_event_time(dws.home_detail_rows(pages), delay)
    return dws.home_detail_totals(daily_firsts(rows, ["mid", "page_id"], size=size, ends=True), size)


def user_login(
    pages: DataFrame, size: str = DEFAULT_SIZE, away_days: int = dws.RETURN_AFTER_DAYS, delay: str = DELAY
) -> DataFrame:
    rows = with_event_time(dws.login_rows(pages), delay)
    return dws.login_totals(daily_firsts(rows, ["uid"], size=size), size, away_days)


def cart_add_uu(added: DataFrame, size: str = DEFAULT_SIZE, delay: str = CART_DELAY) -> DataFrame:
    rows = with_event_time(dws.user_seconds(added), delay)
    return dws.cart_add_totals(daily_firsts(rows, ["user_id"], size=size, ends=True), size)


def payment_suc(paid: DataFrame, size: str = DEFAULT_SIZE, delay: str = DELAY) -> DataFrame:
    firsts = daily_firsts(with_event_time(dws.user_seconds(paid), delay), ["user_id"], size=size)
    return dws.first_ever_totals(firsts, "dws_trade_payment_suc_window", size)


def trade_order(details: DataFrame, size: str = DEFAULT_SIZE, delay: str = ORDER_DELAY) -> DataFrame:
    firsts = daily_firsts(with_event_time(dws.user_seconds(details), delay), ["user_id"], size=size)
    return dws.first_ever_totals(firsts, "dws_trade_order_window", size)


def _keywords_of_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of the searches of a batch, counted by window, in a row for each window and part."""
    for batch in batches:
        row, words = pc.list_parent_indices(batch.column(2)), pc.list_flatten(batch.column(2))
        if not len(words):
            continue
        found = pa.table([batch.column(0).take(row), batch.column(1).take(row), words], names=["start", "_at", "keyword"])
        found = found.group_by(["start", "keyword"]).aggregate([("_at", "max"), ([], "count_all")])
        known = found["keyword"].combine_chunks().dictionary_encode("encode")
        part = np.array([zlib.crc32(w.encode("utf-8", "surrogatepass")) % KEYWORD_PARTS if w is not None else 0 for w in known.dictionary.to_pylist()], np.int32)
        found = found.append_column("part", pa.array(part[known.indices.to_numpy()])).sort_by([("start", "ascending"), ("part", "ascending")])
        start, part, at = (found[name].to_numpy() for name in ("start", "part", "_at_max"))
        first = np.concatenate([[0], 1 + np.flatnonzero((start[1:] != start[:-1]) | (part[1:] != part[:-1]))])
        ends = pa.array([*first.tolist(), len(part)], pa.int32())
        lists = [pa.ListArray.from_arrays(ends, found[name].combine_chunks()) for name in ("keyword", "count_all")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(start[first]), pa.array(part[first]), pa.array(np.maximum.reduceat(at, first)), *lists],
            names=["start", "part", "_at", "words", "counts"],
        )


def _keyword_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``stt, edt, keyword, keyword_count`` of closed windows' parts; a few rows of state at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            rows = batch.slice(at, 256)
            seen, held = pc.list_parent_indices(rows.column(2)), pc.list_flatten(rows.column(2))
            words, counts = held.field("words"), held.field("counts")
            row = seen.take(pc.list_parent_indices(words))
            found = pa.table([row, pc.list_flatten(words), pc.list_flatten(counts)], names=["row", "keyword", "n"])
            found = found.group_by(["row", "keyword"]).aggregate([("n", "sum")]).combine_chunks()
            row = found["row"].combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [rows.column(0).take(row), rows.column(1).take(row), found["keyword"].combine_chunks(), found["n_sum"].combine_chunks()],
                names=["stt", "edt", "keyword", "keyword_count"],
            )


def keyword(pages: DataFrame, size: str = DEFAULT_SIZE, words=distinct_words, delay: str = DELAY) -> DataFrame:
    """Searches per word. ``pages`` bring no watermark; their time is ``ts``.

    Words are counted within each batch of rows first, so state holds one row for each window and part of its words, not
    one for each word, and is read and written so many times less often. A word adds one entry a batch, however often it is searched for.
    """
    searches = dws.word_searches(pages, words).select(
        F.unix_micros(F.window("_at", size)["start"]).alias("start"), F.unix_micros("_at").alias("_at"), "words"
    )
    counted = searches.mapInArrow(_keywords_of_batch, "start long, part int, _at long, words array<string>, counts array<long>")
    counted = counted.withColumn("_at", F.timestamp_micros("_at")).withWatermark("_at", delay)
    held = F.collect_list(F.struct("words", "counts")).alias("held")
    closed = counted.groupBy(F.window("_at", size).alias("_span"), "part").agg(held)
    closed = closed.select(second_text(F.col("_span.start")).alias("stt"), second_text(F.col("_span.end")).alias("edt"), "held")
    totals = closed.mapInArrow(_keyword_totals, "stt string, edt string, keyword string, keyword_count long")
    return totals.withColumn("source", F.lit("search")).select(*columns_of("dws_traffic_source_keyword_page_view_window"))


def unique_visitors(
    pages: DataFrame, tie: Sequence[str] = (), size: str = DEFAULT_SIZE, delay: str = DELAY
) -> DataFrame:
    """First page of every user and day, emitted when the window of that page has closed."""
    rows = with_event_time(dwd_log.with_keys(pages).where(F.col("_uid").isNotNull()), delay)
    reduced = rows.groupBy(F.window("_at", size).alias("_span"), "_uid", day_of(F.col("_at")).alias("day")).agg(
        F.min("ts").alias("millis"),
        F.min_by(F.to_json(F.struct(*pages.columns)), F.struct("ts", *tie)).alias("payload"),
    )
    windows = reduced.select(bucket_of("_uid"), "_uid", "day", "millis", "payload")
    output = T.StructType([*windows.schema.fields[1:], T.StructField("previous_day", T.StringType())])
    firsts = windows.groupBy(BUCKET).transformWithStateInPandas(
        DailyFirst(windows.columns, ["_uid"]), output, "Append", "EventTime"
    )
    return _payload_rows(firsts, pages)


def _payload_rows(rows: DataFrame, like: DataFrame) -> DataFrame:
    return rows.select(F.from_json("payload", like.schema).alias("_row")).select("_row.*")


def bounces(
    pages: DataFrame,
    within_ms: int = dwd_log.ENTRY_TWICE_MS,
    tie: str | None = None,
    entry_follows: bool = True,
    slice_ms: int | None = None,
    delay: str = DELAY,
) -> DataFrame:
    """Bounced entry pages, decided in arrays of sorted structs without leaving the JVM.

    A device is cut into slices of time as in the batch form: windows that reach over the start of the next one, as
    look-ahead. So state is small and ends with its window, and a backlog of one device is worked on by many tasks.
    """
    slice_ms = slice_ms or 20 * within_ms
    rows = with_event_time(dwd_log.with_keys(pages).where(F.col("_mid").isNotNull()), delay)
    seen = F.struct(
        F.col("ts").alias("millis"), (F.col(tie).cast("long") if tie else F.lit(0).cast("long")).alias("tie"), is_entry().alias("entry"),
        F.when(is_entry(), F.to_json(F.struct(*pages.columns))).alias("payload"),
    )
    span = F.window("_at", f"{slice_ms + within_ms} milliseconds", f"{slice_ms} milliseconds")
    slices = rows.groupBy(span.alias("_span"), "_mid").agg(F.array_sort(F.collect_list(seen)).alias("_seen"))
    own_end = F.unix_millis(F.col("_span.start")) + slice_ms

    def left(row: Column, at: Column) -> Column:
        after = F.get("_seen", at + 1)
        alone = after.isNull() | (after["millis"] - row["millis"] >= within_ms)
        if entry_follows:
            alone = alone | F.coalesce(after["entry"], F.lit(False))
        return row["entry"] & (row["millis"] < own_end) & alone

    found = slices.select(F.explode(F.filter("_seen", left)).alias("_hit")).select("_hit.payload")
    return _payload_rows(found, pages)


def repaired(records: DataFrame, size: str = DEFAULT_SIZE, delay: str = DELAY) -> DataFrame:
    """Log records with a repaired new-visitor flag.

    The first record of each device and window goes through the keyed state that knows the device's
    first day; the answer is joined back to the records by device, window and salt. So the state sees
    one row per device and window, and the records of a hot device are dealt out over ``SALTS`` join
    partitions. Records without a device pass in a branch of their own.
    """
    lifted = dwd_log.with_keys(records).withColumn("_flag", F.col("common.is_new"))
    rows = with_event_time(lifted, delay).where(F.col("_mid").isNotNull())
    windows = rows.groupBy(F.window("_at", size).alias("_span"), "_mid").agg(*first_claims("_flag", "ts"))
    firsts = windows.select(
        bucket_of("_mid"),
        "_mid",
        F.least("_new_at", "_old_at").alias("millis"),
        first_day().alias("day"),
        F.window_time("_span").alias("_end"),
    )
    output = T.StructType([*firsts.schema.fields[1:], T.StructField("first_day", T.StringType())])
    known = firsts.groupBy(BUCKET).transformWithStateInPandas(
        FirstDay(firsts.columns, "_mid"), output, "Append", "EventTime", eventTimeColumnName="_end"
    ).select(
        F.col("_mid").alias("_known_mid"), "_end", "first_day",
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_known_salt"),
    )
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("ts"), F.lit(SALTS)).cast("int"))
    joined = salted.join(
        known,
        (F.col("_mid") == F.col("_known_mid"))
        & (F.col("_salt") == F.col("_known_salt"))
        & (F.col("_at") <= F.col("_end"))
        & (F.col("_at") > F.col("_end") - F.expr(f"INTERVAL {size}")),
    )
    wrong = (F.col("_flag") == "1") & (day_of(F.col("_at")) != F.col("first_day"))
    fixed = F.when(wrong, F.lit("0")).otherwise(F.col("_flag"))
    named = joined.withColumn("common", F.col("common").withField("is_new", fixed)).select(*records.columns)
    return named.unionByName(records.where(F.col("common.mid").isNull()))


def lines_latest(lines: DataFrame, tie: Sequence[str] = (), size: str = DEFAULT_SIZE, delay: str = DELAY) -> DataFrame:
    """Latest version of each order line within its window, ready for the trade totals."""
    return latest_in_window(lines.withWatermark("_at", delay), ["id"], "_at", ["row_op_ts", *tie], size)


def late_rows(rows: DataFrame, delay: str = DELAY, millis: str = "ts") -> DataFrame:
    """Rows that arrive behind the query's own watermark: those that a window of the same delay may drop.

    A window takes a row still while it has not closed, so this shows no fewer rows than it drops. Rows without a
    time are passed over. The time goes as a plain number, since Spark drops late rows ahead of a
    stateful operator that sees the watermarked column. Rows are dealt out by content, and nothing is kept.
    """
    timed = with_event_time(rows.where(F.col(millis).isNotNull()), delay, millis)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(SALTS)).alias("_salt")
    plain = timed.select(salt, F.col(millis).alias("millis"), *[c for c in rows.columns if c != millis])
    output = T.StructType(plain.schema.fields[1:])
    found = plain.groupBy("_salt").transformWithStateInPandas(LateRows(plain.columns), output, "Append", "EventTime")
    return found.withColumnRenamed("millis", millis).select(*rows.columns)
