"""A table that keeps the last write per key, on plain parquet folders.

Every micro-batch adds its last write per key in a folder of its own, so a batch costs what it
brings, not what the table holds, and a retried batch replaces its own folder. Readers take the last
write per key over all folders. ``compact`` folds the folders into one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.operators.latest import keep_latest

_BATCH = "_batch"
_GONE = "_gone"


class UpsertTable:
    """Rows of ``schema`` keyed by ``keys``; ``order`` decides between writes of one batch.

    Between batches the later one wins, or with ``batch_first=False`` the greater ``order``, so that rows
    arriving late end as they do in one batch.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        keys: Sequence[str],
        order: Sequence[str],
        partition_by: str | None = None,
        deleted: str | None = None,
        batch_first: bool = True,
    ):
        self._spark, self._path, self._schema = spark, path.rstrip("/"), schema
        self._keys, self._order, self._partition_by, self._deleted = list(keys), list(order), partition_by, deleted
        self._across = [_BATCH, *order] if batch_first else [*order, _BATCH]

    def write_batch(self, rows: DataFrame, batch: int) -> None:
        """``foreachBatch`` target."""
        gone = F.lit(False) if self._deleted is None else F.coalesce(F.col(self._deleted), F.lit(False))
        marked = rows.withColumn(_GONE, gone).withColumn(_BATCH, F.lit(batch).cast("long"))
        last = keep_latest(marked, self._keys, self._order)
        self._save(last.select(*self._schema.fieldNames(), _GONE, _BATCH), f"gen=delta-{batch}")

    def read(self) -> DataFrame:
        """The table now: the last write per key, without deleted keys."""
        return self._last_writes().where(~F.col(_GONE)).select(*self._schema.fieldNames())

    def compact(self, upto: int) -> None:
        """Fold the writes of all batches up to ``upto`` into one folder.

        The folded rows keep their batch number, so a reader that sees the new folder next to the old
        ones gets the same table; only after the fold is complete are the old ones removed.
        """
        old = [name for name in self._folders() if self._upto(name) <= upto and name != f"gen=base-{upto}"]
        if not old:
            return
        kept = self._last_writes(F.col(_BATCH) <= upto)
        self._save(kept, f"gen=base-{upto}")
        files = self._files()
        for name in old:
            files.delete(self._hadoop_path(name), True)

    def _last_writes(self, condition=None) -> DataFrame:
        stored = T.StructType(
            [*self._schema.fields, T.StructField(_GONE, T.BooleanType()), T.StructField(_BATCH, T.LongType())]
        )
        if not self._folders():
            return self._spark.createDataFrame([], stored)
        rows = self._spark.read.schema(stored).option("basePath", self._path).parquet(self._path)
        rows = rows.select(*stored.fieldNames())
        if condition is not None:
            rows = rows.where(condition)
        return keep_latest(rows, self._keys, self._across)

    def _save(self, rows: DataFrame, folder: str) -> None:
        writer = rows.write.mode("overwrite")
        if self._partition_by:
            writer = writer.partitionBy(self._partition_by)
        writer.parquet(f"{self._path}/{folder}")

    @staticmethod
    def _upto(folder: str) -> int:
        return int(folder.rsplit("-", 1)[1])

    def _hadoop_path(self, *parts: str):
        return self._spark._jvm.org.apache.hadoop.fs.Path("/".join([self._path, *parts]))

    def _files(self):
        return self._hadoop_path().getFileSystem(self._spark._jsparkSession.sessionState().newHadoopConf())

    def _folders(self) -> list[str]:
        files = self._files()
        if not files.exists(self._hadoop_path()):
            return []
        names = [status.getPath().getName() for status in files.listStatus(self._hadoop_path())]
        return [name for name in names if name.startswith("gen=") and files.exists(self._hadoop_path(name, "_SUCCESS"))]
