"""Joins with one row per key: dictionary codes, dimensions, and per-key facts on hot keys.

No broadcast is forced for tables that can grow. Catalyst broadcasts a side when its size is known
to be under ``spark.sql.autoBroadcastJoinThreshold``, adaptive execution re-checks it at run time and
splits skewed partitions of the shuffled form.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HEAVY_KEYS = 1000


def join_dictionary(rows: DataFrame, dictionary: DataFrame, code: str, name: str) -> DataFrame:
    """Add the text of a code. The lookup is inner: a row with an unknown code is dropped.

    A ``dictionary`` that is a stream of versions (``id, data, ts``) is looked up as it grows: a row
    with an unknown code waits for it, and one without a code is dropped.
    """
    if dictionary.isStreaming:
        from strataflow.streaming.fresh import MISSING, SALTS, fresh_lookup

        return fresh_lookup(rows, dictionary, code, {"dic_name": name}, salts=SALTS).where(~F.col(MISSING)).drop(MISSING)
    texts = dictionary.select(F.col("dic_code").alias(code), F.col("dic_name").alias(name))
    return rows.join(texts, code)


def join_dimension(
    rows: DataFrame, dimension: DataFrame, key: str, columns: Mapping[str, str], missing: str = "null"
) -> DataFrame:
    """Add dimension columns by id. ``columns`` maps dimension column -> output column.

    ``missing="null"`` keeps rows without a dimension row; ``missing="fail"`` stops the job on one.
    A ``dimension`` that is a stream of versions (``id, data, ts``) is looked up as it grows: rows wait for
    theirs; those without an id pass with NULLs.
    """
    if missing not in ("null", "fail"):
        raise ValueError(f"missing must be 'null' or 'fail', not {missing!r}")
    if dimension.isStreaming:
        from strataflow.streaming.fresh import MISSING, fresh_lookup

        return fresh_lookup(rows, dimension, key, columns).drop(MISSING)
    side = dimension.select(
        F.col("id").alias("_dim_id"), *[F.col(source).alias(output) for source, output in columns.items()]
    )
    joined = rows.join(side, F.col(key) == F.col("_dim_id"), "left")
    if missing == "fail":
        found = F.coalesce(
            F.col("_dim_id"), F.raise_error(F.concat(F.lit(f"no dimension row for {key}="), F.col(key).cast("string")))
        )
        # The check lives in a filter: a projected check would be pruned when nobody reads it.
        joined = joined.where(F.col(key).isNull() | found.isNotNull())
    return joined.drop("_dim_id")


def count_missing(rows: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Ids without a dimension row and how many rows carry each of them."""
    ids = dimension.select(F.col("id").alias(key))
    counted = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows_missing"))
    return counted.join(ids, key, "left_anti")


def attach_per_key(
    rows: DataFrame, per_key: DataFrame, keys: Sequence[str], values: Sequence[str], weight: str
) -> DataFrame:
    """Left-join one-row-per-key ``per_key`` to ``rows`` without sending a hot key to one task.

    ``weight`` is the number of rows behind each key. The ``HEAVY_KEYS`` heaviest keys are broadcast,
    so that side has a fixed bound, and their rows are answered where they lie; so are rows with a
    NULL key, which have no partner. Only the other rows are shuffled, and of those no key can hold
    more than 1/HEAVY_KEYS of the input.
    """
    counted = per_key.where(F.col(weight) > 0)  # always true; keeps all uses of per_key one plan
    heavy = counted.orderBy(F.col(weight).desc(), *keys).limit(HEAVY_KEYS).select(*keys, F.struct(*values).alias("_hit"))
    settled = F.col("_hit").isNotNull()
    for key in keys:
        settled = settled | F.col(key).isNull()
    marked = rows.join(F.broadcast(heavy), list(keys), "left")
    in_place = marked.where(settled).select(*rows.columns, *[F.col("_hit")[v].alias(v) for v in values])
    shuffled = marked.where(~settled).select(*rows.columns).join(counted.select(*keys, *values), list(keys), "left")
    return in_place.unionByName(shuffled.select(*rows.columns, *values))
