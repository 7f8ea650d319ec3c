"""Near-duplicate documents by SimHash, compared exactly in tiles of numpy arrays."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm import shingle_join
from strataflow.llm.shared import column, components, few, id_and_text, saved, small_batches

RADIUS = 2
SHINGLE = 3
SEED = 42
#: Parts of a fingerprint whose population counts make its cell, and fingerprints of one cell in a tile.
PARTS = 4
TILE = 4096
_CODE = 32  # more than the population count of a part, so that cells have distinct codes

_LOWER = {upper: upper + 32 for upper in range(65, 91)}
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_hashes(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """A hash of each run of so many words, or of all words of a shorter text; none without words."""
    words = _WORDS.findall(text.translate(_LOWER)) if text else []
    if len(words) <= shingle:
        pieces = [" ".join(words)] if words else []
    else:
        pieces = map(" ".join, zip(*(words[i:] for i in range(shingle))))
    return np.fromiter((xxhash.xxh64_intdigest(p, seed) for p in pieces), np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """Signed 64-bit number of the bits set in over half of the hashes; zero without any."""
    if not len(hashes):
        return 0
    votes = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 4096):
        part = hashes[start : start + 4096].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits((2 * votes > len(hashes)).astype(np.uint8))
    return int(bits.view(">u8").astype(np.uint64).view(np.int64)[0])


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Signed 64-bit SimHash of a whole text; zero without words."""
    return simhash(shingle_hashes(text, shingle, seed))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, version, fp`` for every row (``version`` hashes id and text); NULL, empty and blank texts get zero."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("bigint")
    def marked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return id_and_text(docs, key, text).select("doc_id", F.xxhash64("doc_id", "text").alias("version"), marked("text").alias("fp"))


def _shifts(radius: int) -> list[tuple[int, ...]]:
    """Shifts of a cell to later cells that can hold a fingerprint within the radius."""
    near = (d for d in product(range(-radius, radius + 1), repeat=PARTS) if sum(map(abs, d)) <= radius)
    return sorted(d for d in near if d > (0,) * PARTS)


def tile_links(own: np.ndarray, other: np.ndarray, radius: int, block: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links between own fingerprints and (own + other): positions of both ends.

    Each block of own rows is compared with all rows after it, by exclusive-or and bit counts; blocks whose
    population counts differ by more than the radius are passed over. The pairs of a block are folded into labels
    at once, so no list of all pairs is kept.
    """
    every = np.concatenate([own, other])
    order = np.concatenate([np.argsort(np.bitwise_count(own), kind="stable"), len(own) + np.argsort(np.bitwise_count(other), kind="stable")])
    every, count = every[order], np.bitwise_count(every[order]).astype(np.int16)
    label = np.arange(len(every))
    starts = [*range(0, len(own), block), *range(len(own), len(every), 8 * block)]
    ends = [*(min(s + block, len(own)) for s in range(0, len(own), block)), *(min(s + 8 * block, len(every)) for s in range(len(own), len(every), 8 * block))]
    for a in range(-(-len(own) // block)):
        low, high = starts[a], ends[a]
        for s, e in zip(starts[a:], ends[a:]):
            if count[s] > count[high - 1] + radius or count[e - 1] < count[low] - radius:
                continue
            i, j = np.nonzero(np.bitwise_count(every[low:high, None] ^ every[None, s:e]) <= radius)
            i, j = i + low, j + s
            i, j = i[i != j], j[i != j]
            while len(i):
                least = np.minimum(label[i], label[j])
                if (label[i] == least).all() and (label[j] == least).all():
                    break
                old = label.copy()
                np.minimum.at(label, old[i], least)
                np.minimum.at(label, old[j], least)
                np.minimum.at(label, i, least)
                np.minimum.at(label, j, least)
                label = label[label]
    while (label != label[label]).any():
        label = label[label]
    moved = np.nonzero(label != np.arange(len(label)))[0]
    return order[moved], order[label[moved]]


def fingerprint_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``a, b``: links that join every two of the distinct ``fp`` values within the radius.

    Tiles hold fingerprints with equal population counts in each of four parts (cells), because
    two values within the radius have counts that differ by no more than the radius in sum. A cell goes to the later
    cells within it, so every pair is compared once; other pairs of tiles are never made. Cells
    over ``TILE`` values are split, and each tile meets the later ones of its cell.
    """
    spark = distinct.sparkSession
    width = 64 // PARTS
    mask = (1 << width) - 1
    parts = [F.bit_count(F.shiftrightunsigned("fp", i * width).bitwiseAND(F.lit(mask))) for i in range(PARTS)]
    cell = sum(((radius + p) * _CODE**i for i, p in enumerate(parts)), F.lit(0)).cast("int")
    placed = distinct.select("fp", cell.alias("cell"))
    # No more rows than there are combinations of counts: 17 ** 4.
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))
    sizes = saved(sizes.repartition(1), "cells")
    steps = [0, *(sum(x * _CODE**i for i, x in enumerate(d)) for d in _shifts(radius))]
    sent = placed.select("fp", F.col("cell").alias("home"), F.explode(F.array(*[F.col("cell") + F.lit(s) for s in steps])).alias("cell"))
    sent = sent.join(F.broadcast(sizes), "cell")
    mine = F.pmod(F.xxhash64("fp"), "tiles").cast("int")
    first = F.when(F.col("home") == F.col("cell"), mine).otherwise(0)
    sent = sent.select("fp", "home", "cell", mine.alias("mine"), F.explode(F.sequence(first, F.col("tiles") - 1)).alias("tile"))
    sent = sent.select(
        "fp", "cell", "tile", ((F.col("home") == F.col("cell")) & (F.col("tile") == F.col("mine"))).alias("own")
    )

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        own = rows["own"].to_numpy(dtype=bool)
        values = rows["fp"].to_numpy()
        ordered = np.concatenate([values[own], values[~own]])
        a, b = tile_links(values[own].view(np.uint64), values[~own].view(np.uint64), radius)
        return pd.DataFrame({"a": ordered[a], "b": ordered[b]})

    small_batches(spark)
    return sent.groupBy("cell", "tile").applyInPandas(compare, "a bigint, b bigint")


def simhash_components(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, version, fp, component, component_id`` for every row of ``docs``; ``component`` is a fingerprint.

    ``component_id`` is the least id reachable over links of at most ``radius`` differing bits,
    the row's own id included. Equal fingerprints are one node, so copies make no pairs. Rows with
    a NULL id are linked like any other and take the least id of their group (NULL without one).
    NULL, empty and blank texts have fingerprint zero. Repeated rows come back repeated.
    """
    found = saved(fingerprints(docs, key, text, shingle), "fingerprints")
    nodes = found.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    groups = components(fingerprint_links(nodes.select("fp"), radius)).withColumnRenamed("node", "fp")
    grouped = saved(nodes.join(groups, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "nodes")
    least = grouped.groupBy("component").agg(F.min("least_id").alias("component_id"))
    by_fp = grouped.join(least, "component").select("fp", "component", "component_id")
    return found.join(by_fp, "fp").select("doc_id", "version", "fp", "component", "component_id")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, similarity: float | None = None) -> DataFrame:
    """The rows of ``docs`` that stand for their groups: the least id, then the least version; one of repeated rows.

    NULL ids stand for a group only if all its ids are NULL. With a similarity, groups are those of exact Jaccard
    similarity of the shingles: SimHash links come first and are checked, and ``shingle_join`` finds the links that the
    radius misses, as texts of that similarity can differ in more bits.
    """
    if similarity is None:
        found = simhash_components(docs, key, text, shingle=shingle)
        first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "version"))
        stands = found.groupBy("component").agg(first.alias("first")).select(F.col("first.version").alias("__version"))
    else:
        stands = shingle_join.firsts(docs, shingle_hashes, shingle, similarity, simhash, fingerprint_links, key, text).withColumnRenamed("version", "__version")
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(column(docs, key), column(docs, text)).alias("__version"))
    stands, many = saved(stands, "stands"), rows.groupBy("__version").agg(F.count("*").alias("n")).where("n > 1")
    many = few(saved(many.select("__version"), "repeated"))
    kept = rows.join(few(stands), "__version", "left_semi")
    # Only repeated rows, few as a rule, are grouped: whole texts need no shuffle for it.
    again = kept.join(many, "__version", "left_semi").groupBy("__version").agg(F.first("row").alias("row"))
    return kept.join(many, "__version", "left_anti").select("row").unionByName(again.select("row")).select("row.*")


def hex_digits(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
