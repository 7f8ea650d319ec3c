"""Lookups whose table changes while the stream runs.

The versions of a dimension table and the rows to look up meet in one stream, keyed by buckets of ids. State holds the
versions of a bucket's ids, and the rows that wait for one: an article or a code that comes late loses nothing.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from strataflow.operators.changes import UPSERT_TYPES, table_rows
from strataflow.streaming.processors import BUCKET, Packed, _named, bucket_of

#: Rows that look up one key are dealt out over so many buckets of state, so a hot key is no hot task. Each version is kept
#: as often: few codes of a dictionary may be dealt out wider than the many ids of a dimension.
SALTS, DIMENSION_SALTS = 16, 4
MISSING = "lookup_missing"
FOREVER = 1 << 62
_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
_COLUMNS = [BUCKET, "_key", "fact", "moment", "payload"]
_ROW = ["key", "since", "moment", "payload"]


class VersionLookup(StatefulProcessor):
    """Versions and waiting rows of one bucket of keys and salts; input columns ``_key, fact, moment, payload`` after the bucket.

    With ``as_of`` a row gets the version that held at its ``moment``, once the watermark has passed it; else the
    newest version known, at once. A row without any version waits; ``patience_ms`` after its moment it passes as missing.
    """

    def __init__(self, as_of: bool, patience_ms: int | None):
        self._as_of, self._patience = as_of, patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._versions, self._waiting = Packed(handle, "versions"), Packed(handle, "waiting")

    def _now(self, timer_values) -> int:
        return timer_values.getCurrentWatermarkInMs() if self._as_of else 0

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._keep(self._versions.get(), initialState.set_axis(_COLUMNS, axis=1), None)

    def _keep(self, known: dict[str, list], new: pd.DataFrame, now: int | None) -> dict[str, list]:
        """All versions of each key in order; state keeps those that a row after ``now`` can still get."""
        if not len(new):
            return known
        came: dict[str, set] = {}
        for key, moment, payload in zip(new["_key"], new["moment"].astype("int64").tolist(), new["payload"]):
            came.setdefault(key, {tuple(v) for v in known.get(key, ())}).add((moment, payload))
        versions = known | {key: sorted(held) for key, held in came.items()}
        kept = dict(versions)
        for key in came:
            if not self._as_of:
                versions[key] = kept[key] = versions[key][-1:]
            elif now is not None:
                past = sum(moment <= now for moment, _ in versions[key])
                kept[key] = versions[key][max(past - 1, 0) :]
        self._versions.put(kept)
        return versions

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = pd.concat(list(_named(rows, _COLUMNS)), ignore_index=True)
        is_fact, keyless = frame["fact"].astype(bool), frame["_key"].isna()
        if (is_fact & keyless).any():
            yield self._out(frame.loc[is_fact & keyless, "payload"], None)
        now = self._now(timerValues)
        versions = self._keep(self._versions.get(), frame[~is_fact], now)
        facts = frame[is_fact & ~keyless]
        facts = facts.assign(key=facts["_key"], since=facts["moment"] if self._as_of else now)[_ROW]
        yield from self._settled(facts, versions, now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._settled(pd.DataFrame(columns=_ROW), self._versions.get(), self._now(timerValues))

    def _settled(self, facts: pd.DataFrame, versions: dict[str, list], now: int) -> Iterator[pd.DataFrame]:
        waiting = self._waiting.get()
        rows = pd.concat([pd.DataFrame(waiting)[_ROW], facts], ignore_index=True) if waiting else facts.reset_index(drop=True)
        if not len(rows):
            return
        rows = rows.astype({"since": "int64", "moment": "int64"})
        known = rows["key"].isin(versions.keys())
        if self._as_of:
            # Without a version and without patience a row waits for as long as it takes.
            until = rows["moment"].where(known, FOREVER if self._patience is None else rows["since"] + (self._patience or 0))
            ready = until <= now
        else:
            until, ready = None, known
        if (ready & known).any():
            found = rows[ready & known]
            yield self._out(found["payload"], self._versions_of(found, versions))
        if (ready & ~known).any():
            yield self._out(rows.loc[ready & ~known, "payload"], None)
        if not ready.any() and not len(facts):
            return
        rest = rows[~ready]
        self._waiting.put({name: rest[name].tolist() for name in _ROW} if len(rest) else {})
        if until is not None and len(rest) and (first := int(until[~ready].min())) < FOREVER:
            self._handle.registerTimer(first)

    def _versions_of(self, rows: pd.DataFrame, versions: dict[str, list]) -> list:
        if not self._as_of:
            return [versions[key][-1][1] for key in rows["key"]]
        moments = {key: [moment for moment, _ in versions[key]] for key in rows["key"].unique()}
        # Before the first version, the first one holds.
        return [versions[key][max(bisect_right(moments[key], at) - 1, 0)][1] for key, at in zip(rows["key"], rows["moment"].tolist())]

    def _out(self, payloads: pd.Series, found) -> pd.DataFrame:
        values = pd.Series([None] * len(payloads) if found is None else found, dtype=object)
        return pd.DataFrame({"payload": payloads.reset_index(drop=True), "version": values, "missing": found is None})

    def close(self) -> None:
        pass


def versions_of(changes: DataFrame, table: str, key: str = "id", database: str | None = None) -> DataFrame:
    """``id, data, ts`` of the rows that write a dimension table, out of a change feed."""
    rows = table_rows(changes, table, *UPSERT_TYPES, database=database).where(F.col("data").isNotNull())
    return rows.select(F.col("data")[key].alias("id"), "data", "ts")


def _packed_versions(versions: DataFrame, columns: Mapping[str, str], salts: int) -> DataFrame:
    values = F.to_json(F.create_map(*[part for name in columns for part in (F.lit(name), F.col("data")[name])]))
    dealt = versions.where(F.col("id").isNotNull()).select(
        F.col("id").cast("string").alias("_key"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"),
        F.lit(False).alias("fact"), (F.col("ts").cast("long") * 1000).alias("moment"), values.alias("payload"),
    )
    return dealt.select(bucket_of("_key", "_salt"), "_key", "fact", "moment", "payload")


def fresh_lookup(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    columns: Mapping[str, str],
    as_of: Column | None = None,
    patience_ms: int | None = None,
    known: DataFrame | None = None,
    salts: int = DIMENSION_SALTS,
) -> DataFrame:
    """``facts`` with dimension columns by id, and ``lookup_missing``; ``columns`` maps source -> output.

    ``versions`` is a stream of ``id, data, ts`` (``versions_of``), ``known`` the table at the start. By default a row
    gets the newest version known when it comes, as a lookup in a live table does; of equal times the greater
    content. With ``as_of`` (the rows' time in epoch milliseconds; the stream needs a watermark on it) it gets the
    version of that time, or the first one if all are later, whatever order they come in. A row whose id has no version
    waits for one: nothing is lost. With ``as_of`` it passes with NULLs and ``lookup_missing`` once the watermark is
    ``patience_ms`` beyond it; so does a row with a NULL id, at once and always.
    """
    if patience_ms is not None and as_of is None:
        raise ValueError("patience is measured in the rows' own time: give as_of")
    payload = F.to_json(F.struct(*facts.columns), _EXACT)
    packed = facts.select(
        F.col(key).cast("string").alias("_key"), F.pmod(F.xxhash64(payload), F.lit(salts)).cast("int").alias("_salt"),
        # The time goes as a plain number, so rows behind the watermark are still answered.
        F.lit(True).alias("fact"), (F.lit(0) if as_of is None else as_of).cast("long").alias("moment"), payload.alias("payload"),
    )
    packed = packed.select(bucket_of("_key", "_salt"), "_key", "fact", "moment", "payload").unionByName(_packed_versions(versions, columns, salts))
    mode = "None" if as_of is None else "EventTime"
    start = None if known is None else _packed_versions(known, columns, salts).groupBy(BUCKET)
    processor = VersionLookup(as_of is not None, patience_ms)
    found = packed.groupBy(BUCKET).transformWithStateInPandas(
        processor, "payload string, version string, missing boolean", "Append", mode, initialState=start
    )
    rows = found.select(
        F.from_json("payload", facts.schema, _EXACT).alias("_row"), F.from_json("version", "map<string,string>").alias("_found"), "missing"
    )
    return rows.select("_row.*", *[F.col("_found")[name].alias(output) for name, output in columns.items()], F.col("missing").alias(MISSING))
