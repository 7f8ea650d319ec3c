"""One row per key: the latest or the earliest.

The rank filter becomes a per-task group limit ahead of the shuffle, so each map task sends at most
one row per key and a key that holds a large share of all rows stays cheap. Unused columns are pruned
below the ranking.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rank_in_key"


def _first_ranked(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    ranked = rows.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def keep_latest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row with the greatest ``order`` values per key; ``order`` should leave no tie."""
    return _first_ranked(rows, keys, [F.col(name).desc() for name in order])


def keep_earliest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row with the least ``order`` values per key."""
    return _first_ranked(rows, keys, [F.col(name).asc() for name in order])


def _greatest(rows: DataFrame, order: Sequence[str], names: Sequence[str]) -> Column:
    """The named columns of the row with the greatest ``order``, each held once: with ``max_by`` the state, the shuffle and
    the spill would hold the order columns twice. Columns that have no order (maps) still need ``max_by``."""
    types = {f.name: f.dataType for f in rows.schema.fields}
    rest = [name for name in names if name not in order]
    if any("map<" in types[name].simpleString() or "variant" in types[name].simpleString() for name in [*order, *rest]):
        return F.max_by(F.struct(*names), F.struct(*order))
    return F.max(F.struct(*order, *rest))


def latest_in_window(
    rows: DataFrame, keys: Sequence[str], moment: str, order: Sequence[str], size: str
) -> DataFrame:
    """Streaming form of :func:`keep_latest` for rows whose versions share one event time.

    All versions of a key fall in one window of ``size``, so one row per key and window is exact. The
    time column comes back as the last instant of the window: it keeps the watermark, so further
    windows of the same size can follow.
    """
    held = [name for name in rows.columns if name != moment and name not in keys]
    picked = rows.groupBy(F.window(moment, size).alias("_span"), *keys).agg(_greatest(rows, order, held).alias("_row"))
    others = [F.col(name) if name in keys else F.col("_row")[name].alias(name) for name in rows.columns if name != moment]
    return picked.select(*others, F.window_time("_span").alias(moment))


def latest_in_session(rows: DataFrame, keys: Sequence[str], moment: str, order: Sequence[str], gap: str) -> DataFrame:
    """Latest row of each burst of a key; a burst ends when the key was quiet for ``gap``.

    The row keeps its columns and gains ``settled_at``, the last instant of the burst.
    """
    held = [name for name in rows.columns if name not in keys]
    picked = rows.groupBy(F.session_window(moment, gap).alias("_burst"), *keys).agg(_greatest(rows, order, held).alias("_row"))
    named = [F.col(name) if name in keys else F.col("_row")[name].alias(name) for name in rows.columns]
    return picked.select(*named, F.window_time("_burst").alias("settled_at"))
