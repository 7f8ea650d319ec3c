"""Helpers of the operators in this folder: input columns, scratch tables, connected components."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.session import drop_scratch, scratch_path, without_shuffle_files

#: White space that separates words, as a character class for Java and RE2 alike.
SPACE = r"[\x20\x09-\x0D]"
#: Most rows and bytes of text that one Arrow batch hands to Python.
BATCH_ROWS = 2000
BATCH_BYTES = 8 << 20
#: A table of at most so many rows of one or two numbers (some 48 MB as a hash table) may be broadcast; larger ones are joined by shuffle.
SMALL = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def column(frame: DataFrame, name: str) -> Column:
    """A column by its exact name, also where the name holds dots."""
    return frame[f"`{name}`"]


def id_and_text(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the two columns an operator works on, so that other columns cannot clash."""
    return docs.select(column(docs, key).alias("doc_id"), column(docs, text).alias("text"))


def small_batches(spark: SparkSession) -> None:
    """Bound the text of an Arrow batch: a worker holds few long documents at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


#: Scratch tables of the blocks of ``passing`` that are open, the innermost last.
_OPEN: list[list[str]] = []


@contextmanager
def passing(spark: SparkSession):
    """Scratch tables written in this block go when it ends, but for those saved with ``lasting``, which outlive it."""
    paths: list[str] = []
    _OPEN.append(paths)
    try:
        yield paths
    finally:
        _OPEN.pop()
        for path in paths:
            drop_scratch(spark, path)


def saved(frame: DataFrame, label: str, compression: str | None = None, lasting: bool = False) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage and survives lost executors.

    The shuffle files of the write go as soon as it ends: nothing reads them again, and they would stay until the driver
    happens to collect its garbage. The table goes with the block of ``passing`` it is written in, if any; a
    ``lasting`` one with the block around that.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, label)
    for paths in _OPEN[: -1 if lasting else None][-1:]:
        paths.append(path)
    with without_shuffle_files(spark):
        frame.write.parquet(path, compression=compression)
    stored = spark.read.schema(frame.schema).parquet(path)
    stored.scratch = path
    return stored


def spent(*frames: DataFrame) -> None:
    """Remove saved tables before the block they are written in ends."""
    for frame in frames:
        for paths in _OPEN:
            if frame.scratch in paths:
                paths.remove(frame.scratch)
        drop_scratch(frame.sparkSession, frame.scratch)


def few(frame: DataFrame) -> DataFrame:
    """A broadcast hint behind a count; larger frames are left to a shuffle join."""
    return F.broadcast(frame) if frame.limit(SMALL + 1).count() <= SMALL else frame


def _starred(pairs: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step over pairs (node > parent)."""
    if large:
        both = pairs.select("node", F.col("parent").alias("near")).unionByName(
            pairs.select(F.col("parent").alias("node"), F.col("node").alias("near"))
        )
        least = both.groupBy("node").agg(F.least(F.min("near"), F.col("node")).alias("least"))
        # Only a pair's greater end moves, so each node's least neighbour reaches its greater neighbours.
        joined = pairs.select(F.col("parent").alias("node"), F.col("node").alias("near")).join(least, "node")
        return joined.select(F.col("near").alias("node"), F.col("least").alias("parent")).distinct()
    least = pairs.groupBy("node").agg(F.min("parent").alias("least"))
    joined = pairs.join(least, "node")
    moved = joined.select(F.col("parent").alias("node"), F.col("least").alias("parent")).where("node <> parent")
    return moved.unionByName(least.select("node", F.col("least").alias("parent"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of the edges; the component is its least node.

    Alternates large-star and small-star steps (Kiveris et al., 2014): the links of each node are
    reduced to its least neighbour by a partial aggregate, so a hub never meets in one task, and
    the number of rounds grows with the logarithm of a component's size. Each round is written to
    the shared folder. Loops and rows with a NULL end are no links.
    """
    pairs = edges.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("parent")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    )
    spark = edges.sparkSession
    with passing(spark) as rounds:
        pairs = saved(pairs.distinct(), "links")
        before = None
        while True:
            mark = pairs.agg(F.count("*"), F.sum(F.xxhash64("node", "parent").cast("decimal(38,0)"))).first()
            if tuple(mark) == before or not mark[0]:
                break
            before = tuple(mark)
            pairs = saved(_starred(_starred(pairs, large=True), large=False), "links")
            drop_scratch(spark, rounds.pop(0))
        # The last round outlives the block.
        for paths in _OPEN[:-1][-1:]:
            paths.append(rounds[-1])
        rounds.clear()
    return pairs.select("node", F.col("parent").alias("component")).unionByName(
        pairs.select(F.col("parent").alias("node"), F.col("parent").alias("component")).distinct()
    )
