"""Keyed state for the steps that plain streaming operators cannot express.

Each processor sees the pandas rows of one bucket of keys and keeps what it knows of them as one packed
value; grouping, shuffling, state storage and timers are Spark's. A call costs some 20 ms however few
rows it sees, so calls grow with the fixed number of buckets and not with the keys. Upstream aggregation has
already reduced the rows of a key to one per short window wherever a step allows it, so a hot key does not flood its task.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Buckets of keys. Fixed by the first start of a query, as its state is laid out by them.
BUCKETS = 1024
BUCKET = "_bucket"


def bucket_of(*keys: str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias(BUCKET)


class Packed:
    """A dictionary kept as one compressed value of a bucket."""

    def __init__(self, handle: StatefulProcessorHandle, name: str):
        self._state = handle.getValueState(name, "held binary")

    def get(self) -> dict:
        held = self._state.get() if self._state.exists() else None
        return json.loads(zlib.decompress(bytes(held[0]))) if held else {}

    def put(self, held: dict) -> None:
        if held:
            self._state.update((zlib.compress(json.dumps(held, separators=(",", ":")).encode(), 1),))
        else:
            self._state.clear()


def _named(frames: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[pd.DataFrame]:
    """Columns arrive in the order of the input but may carry optimizer-made names."""
    return (frame.set_axis(columns, axis=1) for frame in frames)


def _in_order(frames: Iterator[pd.DataFrame], columns: list[str], by: list[str]) -> pd.DataFrame:
    return pd.concat(list(_named(frames, columns)), ignore_index=True).sort_values(by, kind="stable")


DAY_MS = 24 * 60 * 60 * 1000


def _keyed(frame: pd.DataFrame, keys: Sequence[str]) -> pd.Series:
    """The key of each row as one text; keys are never NULL here."""
    if len(keys) == 1:
        return frame[keys[0]].astype(str)
    return pd.Series([json.dumps(k) for k in frame[list(keys)].astype(str).itertuples(index=False, name=None)], frame.index, dtype=object)


class DailyFirst(StatefulProcessor):
    """Pass on the first row of a key and day, with the last earlier day the key was seen.

    Input: one row per key and closed window, columns ``day`` and ``millis`` among others. State: the
    last day each key of the bucket was seen. With ``ends`` a key is forgotten when its day is over, and ``previous_day`` stays NULL.
    """

    def __init__(self, columns: list[str], keys: Sequence[str], ends: bool = False):
        self._columns, self._keys, self._ends = columns, list(keys), ends

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = Packed(handle, "last_days")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = _in_order(rows, self._columns, ["millis"])
        frame["_key"] = _keyed(frame, self._keys)
        known = self._last.get()
        last = frame["_key"].map({k: day for k, (day, _) in known.items()}).astype(object)
        before = frame.groupby("_key", sort=False)["day"].shift(1)
        new = frame["day"].ne(before) & (last.isna() | (frame["day"] > last.fillna("")))
        firsts = frame[new].copy()
        if firsts.empty:
            return
        if self._ends:
            firsts["previous_day"] = None
        else:
            before = firsts.groupby("_key", sort=False)["day"].shift(1)
            firsts["previous_day"] = before.where(before.notna(), last[new])
        firsts["previous_day"] = firsts["previous_day"].astype(object).where(firsts["previous_day"].notna(), None)
        over = (firsts["millis"].astype("int64") // DAY_MS + 1) * DAY_MS
        known.update(zip(firsts["_key"], zip(firsts["day"], over.tolist())))
        self._last.put(known)
        if self._ends:
            for over_at in over.unique().tolist():
                self._handle.registerTimer(over_at)
        yield firsts.drop(columns=[BUCKET, "_key"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        self._last.put({k: (day, over_at) for k, (day, over_at) in self._last.get().items() if over_at > now})
        return iter(())

    def close(self) -> None:
        pass


class FirstDay(StatefulProcessor):
    """First day of a device: input one row per device and closed window with the first day it would
    mean, output those rows with the first day the device's first window meant."""

    def __init__(self, columns: list[str], key: str):
        self._columns, self._key = columns, key

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._first = Packed(handle, "first_days")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = _in_order(rows, self._columns, ["millis"])
        known = self._first.get()
        firsts = frame.drop_duplicates(self._key)
        new = {k: day for k, day in zip(firsts[self._key], firsts["day"]) if k not in known}
        if new:
            known.update(new)
            self._first.put(known)
        yield frame.assign(first_day=frame[self._key].map(known)).drop(columns=[BUCKET])

    def close(self) -> None:
        pass


class LateRows(StatefulProcessor):
    """Rows behind the query's watermark; nothing is kept. Input: the key, the time as ``millis``, and what else a row has."""

    def __init__(self, columns: list[str]):
        self._columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        for frame in _named(rows, self._columns):
            late = frame[frame["millis"] < watermark]
            if not late.empty:
                yield late[self._columns[1:]]

    def close(self) -> None:
        pass
