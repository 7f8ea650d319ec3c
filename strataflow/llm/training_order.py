"""Token shards in training order: a keyed permutation gives every sequence its slot."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm.byte_tokens import ByteTokens, read_ranks
from strataflow.llm.shared import id_and_text, saved, scratch_path, small_batches

LENGTH = 512
SEQUENCES = 512
ROUNDS = 6
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser with good avalanche."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[1])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[2])
    return x ^ (x >> np.uint64(31))


def feistel(index: np.ndarray, key: int, half: int) -> np.ndarray:
    """A keyed bijection of numbers of ``2 * half`` bits."""
    mask = np.uint64((1 << half) - 1)
    left, right = index.astype(np.uint64) >> np.uint64(half), index.astype(np.uint64) & mask
    for r in range(ROUNDS):
        round_key = np.uint64((key + (r + 1) * _MIX[0]) % (1 << 64))
        left, right = right, left ^ (_mixed(_mixed(right + round_key) ^ round_key) & mask)
    return (left << np.uint64(half)) | right


def slots(index: np.ndarray, total: int, key: int) -> np.ndarray:
    """The slot of each index below ``total``: a bijection, as values beyond are walked on."""
    half = max(1, -(-max(total - 1, 1).bit_length() // 2))
    out = feistel(index, key, half)
    beyond = np.nonzero(out >= np.uint64(total))[0]
    while len(beyond):
        out[beyond] = feistel(out[beyond], key, half)
        beyond = beyond[out[beyond] >= np.uint64(total)]
    return out.astype(np.int64)


def sequences(docs: DataFrame, ranks_path: str, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``doc_id, part, n_tokens, payload``: each text's tokens, cut to ``length`` and padded by the end mark.

    The end mark (one more than the last id) ends each document. Ids are little-endian, two bytes
    each if the vocabulary allows, else four. NULL and empty texts are one sequence of the end mark alone.
    """
    spark = docs.sparkSession
    small_batches(spark)
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    given = id_and_text(docs, key, text)
    shape = f"doc_id {given.schema['doc_id'].dataType.simpleString()}, part int, n_tokens int, payload binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ByteTokens(ranks.value)
        end = len(coder.width)
        kind = "<u2" if end < 1 << 16 else "<u4"
        for batch in batches:
            rows, parts, sizes, payloads = [], [], [], []
            for k, value in enumerate(batch.column(1).to_pylist()):
                ids = coder.encode(value)
                count = len(ids) // length + 1
                padded = np.full(count * length, end, kind)
                padded[: len(ids)] = ids
                rows.extend([k] * count)
                parts.extend(range(count))
                sizes.extend(min(length, len(ids) + 1 - p * length) for p in range(count))
                payloads.extend(padded[p * length : (p + 1) * length].tobytes() for p in range(count))
            for s in range(0, max(len(rows), 1), 4096):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows[s : s + 4096], pa.int64())), pa.array(parts[s : s + 4096], pa.int32()),
                     pa.array(sizes[s : s + 4096], pa.int32()), pa.array(payloads[s : s + 4096], pa.binary())],
                    names=["doc_id", "part", "n_tokens", "payload"],
                )

    return given.mapInArrow(cut, shape)


def training_order(
    docs: DataFrame, ranks_path: str, key: str = "doc_id", text: str = "text", length: int = LENGTH, per_shard: int = SEQUENCES, seed: int = 1,
) -> str:
    """Write all sequences of ``docs`` as shards in training order; returns the folder.

    Sequences of all rows, repeated ones too, are numbered without gaps, each partition after the
    one before, so only one count per partition reaches the driver. The keyed permutation turns the number into a slot; ``slot // per_shard`` is the
    shard and ``slot % per_shard`` the place in it. A shard is one row of ``shards`` whose
    ``payload`` holds its sequences at a fixed stride, and whose ``parts`` say which document part
    is in which place. Range partitions write the shards in order, so a reader can begin at any
    slot (``read_from``). An empty table gives no shards. Other columns are not read, also where they are named as results are.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "training-order")
    # Written first, so that a lost task cannot number its sequences in another way.
    cut = saved(sequences(docs, ranks_path, key, text, length), "sequences", compression="zstd")
    numbered = cut.select("doc_id", "part", "n_tokens", "payload", F.monotonically_increasing_id().alias("mono"))
    width = 1 << 33
    counts = numbered.groupBy(F.floor(F.col("mono") / width).alias("split")).count().orderBy("split").collect()
    starts, total = {}, 0
    for split, count in counts:
        starts[int(split)] = total
        total += count
    begin = spark.sparkContext.broadcast(starts)

    @F.pandas_udf("bigint")
    def slot_of(mono):
        import pandas as pd

        values = mono.to_numpy(np.int64)
        split = values // width
        index = values % width
        for s in np.unique(split):
            index[split == s] += begin.value[int(s)]
        return pd.Series(slots(index, total, seed))

    placed = numbered.select("doc_id", "part", "n_tokens", "payload", slot_of("mono").alias("slot"))
    placed = placed.withColumn("shard", F.floor(F.col("slot") / per_shard).cast("long"))
    key_type = cut.schema["doc_id"].dataType.simpleString()
    parts_type = f"array<struct<doc_id: {key_type}, part: int, n_tokens: int>>"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by slot, and a shard lies in one partition: at most one shard is held."""
        held: list[dict] = []

        def shard() -> pa.RecordBatch:
            parts = [[{k: r[k] for k in ("doc_id", "part", "n_tokens")} for r in held]]
            return pa.RecordBatch.from_arrays(
                [pa.array([held[0]["shard"]], pa.int64()), pa.array([held[0]["slot"]], pa.int64()), pa.array([len(held)], pa.int32()),
                 pa.array(parts, pa.list_(pa.struct([("doc_id", kind[0]), ("part", pa.int32()), ("n_tokens", pa.int32())]))),
                 pa.array([b"".join(r["payload"] for r in held)], pa.binary())],
                names=["shard", "first_slot", "n_sequences", "parts", "payload"],
            )

        kind = [pa.int64()]
        for batch in batches:
            kind[0] = batch.schema.field("doc_id").type
            for row in batch.to_pylist():
                if held and held[0]["shard"] != row["shard"]:
                    yield shard()
                    held.clear()
                held.append(row)
        if held:
            yield shard()

    ordered = placed.repartitionByRange("shard").sortWithinPartitions("slot")
    shape = f"shard bigint, first_slot bigint, n_sequences int, parts {parts_type}, payload binary"
    ordered.mapInArrow(pack, shape).write.parquet(f"{folder}/shards", compression="zstd")
    width_of_id = 2 if len(ByteTokens(read_ranks(ranks_path)).width) < 1 << 16 else 4
    about = spark.createDataFrame([(length, width_of_id, per_shard, total, seed)], "length int, width int, per_shard int, total long, seed long")
    about.coalesce(1).write.parquet(f"{folder}/about")
    return folder


def read_from(
    spark: SparkSession, folder: str, slot: int = 0, per_shard: int | None = None, length: int | None = None, width: int | None = None
) -> DataFrame:
    """``slot, doc_id, part, n_tokens, payload`` from a slot on: whole shards are skipped by their number.

    Lengths and widths are read from what was written next to the shards (``about``: length, width, per_shard, total, seed);
    a caller that states others is told so.
    """
    about = spark.read.parquet(f"{folder}/about").first()
    for name, stated in (("per_shard", per_shard), ("length", length), ("width", width)):
        if stated not in (None, about[name]):
            raise ValueError(f"the shards were written with {name}={about[name]}, not {stated}")
    shards = spark.read.parquet(f"{folder}/shards").where(F.col("shard") >= slot // about.per_shard)
    stride = about.length * about.width
    rows = shards.select("first_slot", "payload", F.posexplode("parts").alias("place", "of"))
    return rows.select(
        (F.col("first_slot") + F.col("place")).alias("slot"), "of.doc_id", "of.part", "of.n_tokens",
        F.substring("payload", F.col("place") * stride + 1, F.lit(stride)).alias("payload"),
    ).where(F.col("slot") >= slot)
