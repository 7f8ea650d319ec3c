"""Left joins that answer at once and correct themselves: change rows, their messages, and their fold.

A row of the left side goes out as soon as it comes, with NULLs for partners that have not. When one comes, the
provisional row is taken back and the completed one follows. Readers fold the changes by key.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from strataflow.operators.latest import keep_latest
from strataflow.streaming.processors import BUCKET, Packed, _named, bucket_of

ADD, TAKE_BACK = "+I", "-D"
_COLUMNS = [BUCKET, "_key", "side", "moment", "version", "payload"]


class Completing(StatefulProcessor):
    """The sides of a bucket of keys: input ``_key``, ``side`` (0 the left one), ``moment``, ``version`` and ``payload`` (NULL: deleted).

    State: for each key the latest row of each side, and the number of its last change. The row last given out is what
    these rows make. A key ends when it was quiet for ``hold_ms`` of event time.
    """

    def __init__(self, sides: int, hold_ms: int):
        self._sides, self._hold = sides, hold_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._keys = Packed(handle, "keys")

    def _given(self, held: list) -> list | None:
        """The payloads of a key's sides, if it has a left row."""
        return None if held[0] is None or held[0][2] is None else [side and side[2] for side in held]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(_named(rows, _COLUMNS)), ignore_index=True)
        frame = frame.astype({"side": "int64", "moment": "int64"}).sort_values(["moment", "version"], kind="stable")
        latest = frame.drop_duplicates(["_key", "side"], keep="last")
        latest = latest.assign(payload=latest["payload"].astype(object).where(latest["payload"].notna(), None))
        known = self._keys.get()
        came: dict[str, list] = {}
        for name, side, moment, version, payload in latest[_COLUMNS[1:]].itertuples(index=False, name=None):
            came.setdefault(name, []).append((side, moment, version, payload))
        out, timers = [], set()
        for name, sides in came.items():
            number, quiet_at, held = known.get(name, (0, 0, [None] * self._sides))
            given = self._given(held)
            for side, *row in sides:
                if held[side] is None or row[:2] >= held[side][:2]:
                    held[side] = row
            greatest = max(moment for _, moment, *_ in sides)
            quiet_at = max(quiet_at, greatest + self._hold)
            now = self._given(held)
            if now != given:
                # Numbers grow with time, so they still do after a quiet key was forgotten.
                number = max(number, greatest)
                for op, payloads in ((TAKE_BACK, given), (ADD, now)):
                    if payloads is not None:
                        number += 1
                        out.append((name, number, op, *payloads))
            known[name] = (number, quiet_at, held)
            timers.add(quiet_at)
        self._keys.put(known)
        # One mark is enough: when it is due, the next one is set.
        self._handle.registerTimer(min(timers))
        if out:
            yield pd.DataFrame(out, columns=["key", "number", "op", *[f"s{k}" for k in range(self._sides)]])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        left = {name: held for name, held in self._keys.get().items() if held[1] > now}
        self._keys.put(left)
        if left:
            self._handle.registerTimer(min(held[1] for held in left.values()))
        return iter(())

    def close(self) -> None:
        pass


def _side(rows: DataFrame, number: int, key: str, moment: str, order: Sequence[str], deleted: Column | None) -> DataFrame:
    payload = F.to_json(F.struct(*rows.columns))
    return rows.where(F.col(key).isNotNull()).select(
        F.col(key).cast("string").alias("_key"), F.lit(number).alias("side"), F.unix_millis(moment).alias("moment"),
        # The unit character sorts below all others, so texts compare part by part.
        F.concat_ws("\x1f", *[F.coalesce(F.col(name).cast("string"), F.lit("")) for name in order]).alias("version"),
        (payload if deleted is None else F.when(~deleted, payload)).alias("payload"),
    )


def changelog_left_join(
    left: DataFrame,
    rights: Mapping[str, DataFrame],
    keys: Mapping[str, str],
    at: str,
    hold_ms: int,
    order: Mapping[str, Sequence[str]] | None = None,
    deleted: Column | None = None,
) -> DataFrame:
    """Change rows ``key, number, op, left`` and a struct per right side, of a left join with several sides on one key.

    Each side has one row per key: the one of the greatest time ``at`` (a watermarked timestamp), then of the
    greatest ``order`` columns (as text), so copies and older versions change nothing. ``keys`` names each side's key column
    (``left`` for the left one); rows without a key have no partner and are left out, also on the left side, which is keyed by it. ``op`` is
    ``+I``, or ``-D`` for a row taken back, with the content it had; ``number`` orders the changes of a key. Where ``deleted`` holds, a
    left row is a deletion. What happens within one micro-batch gives at most one pair of changes. A key that was quiet for ``hold_ms`` is forgotten.
    """
    order = order or {}
    sides = {"left": left, **rights}
    packed = None
    for n, (name, rows) in enumerate(sides.items()):
        one = _side(rows, n, keys[name], at, order.get(name, ()), deleted if name == "left" else None)
        packed = one if packed is None else packed.unionByName(one)
    shape = "key string, number long, op string, " + ", ".join(f"s{k} string" for k in range(len(sides)))
    packed = packed.select(bucket_of("_key"), *packed.columns)
    found = packed.groupBy(BUCKET).transformWithStateInPandas(Completing(len(sides), hold_ms), shape, "Append", "EventTime")
    return found.select(
        "key", "number", "op", *[F.from_json(f"s{k}", rows.schema).alias(name) for k, (name, rows) in enumerate(sides.items())]
    )


def adds_only(changes: DataFrame) -> DataFrame:
    """Change rows that add; a reader of these alone sees provisional rows next to completed ones."""
    return changes.where(F.col("op") == ADD)


def upsert_messages(changes: DataFrame, *columns: Column) -> DataFrame:
    """``key, value, number``: messages of an upsert topic, JSON under a JSON key; a row taken back is a NULL value."""
    return changes.select(
        F.to_json(F.struct(F.col("key").alias("id"))).alias("key"), F.when(F.col("op") == ADD, F.to_json(F.struct(*columns))).alias("value"), "number"
    )


def folded(messages: DataFrame) -> DataFrame:
    """The rows that upsert messages leave: the last message of each key, unless it deletes."""
    return keep_latest(messages, ["key"], ["number"]).where(F.col("value").isNotNull()).select("key", "value")
