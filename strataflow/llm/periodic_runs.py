"""Stretches of words that repeat with a period, found in tiles and stitched; texts without the repeats.

Periods are taken by octave. A run of period q in [B, 2B) and of three periods or more holds two
multiples of B or more that lie a period before its end; at each of these boundaries c the text agrees with
itself from c and from c + q on. How far, forward and backward, are two Z-functions of the tile
around c, and give the part of the run that the tile shows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.shared import column, id_and_text, saved, small_batches

#: A run has at least so many words and so many periods.
LEAST, PERIODS = 24, 3
#: Spacing of the boundaries of the first octave, which holds all periods below twice as many; LEAST allows no more.
BASE = 8
#: Words that a tile of the lower octaves answers for; longer texts are cut. Higher octaves have tiles of so many boundaries.
CORE, HIGHER = 1 << 16, 8
#: Texts of more bytes are dealt out tile by tile.
LONG = 4 << 20
#: Bytes split into words at once.
PIECE = 1 << 20
#: Most comparisons of one step in memory.
STEP = 1 << 20
#: A table of runs of at most so many rows is broadcast to the documents; beyond, they are joined by shuffle.
SMALL = 100_000

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_TILE = pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("low", pa.int64()), ("high", pa.int64()), ("begin", pa.int64()), ("core", pa.int64()), ("stop", pa.int64()), ("ids", pa.binary())])


def words_of(text: str) -> Iterator[list[bytes]]:
    """The words of a text, a piece at a time: bytes split at exactly the six ASCII blanks."""
    raw = text.encode()
    at = 0
    while at < len(raw):
        cut = _SPACE.search(raw, at + PIECE)
        end = cut.start() if cut else len(raw)
        yield raw[at:end].split()
        at = end


def numbered(text: str | None) -> np.ndarray:
    """A number for each word: equal for equal words of the text."""
    known: dict[bytes, int] = {}
    parts = []
    for words in words_of(text or ""):
        for word in words:
            if word not in known:
                known[word] = len(known)
        parts.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
    return np.concatenate(parts) if parts else np.zeros(0, np.int32)


def octaves(n: int) -> list[int]:
    """Spacings of boundaries for a text of ``n`` words: BASE, then each further power of two."""
    found, b = [], BASE
    while n >= LEAST and (b == BASE or PERIODS * b <= n):
        found.append(b)
        b *= 2
    return found


def tiles(n: int) -> Iterator[tuple[int, int, int, int, int]]:
    """``low, high, begin, core, stop``: octaves ``low`` to ``high``, and words ``begin`` to ``stop``.

    A tile answers for the boundaries from ``core`` on, up to the next tile's. It reaches a spacing
    back and four ahead, more than any part of a run that is needed to stitch it.
    """
    spacings = octaves(n)
    lower = [b for b in spacings if b * HIGHER <= CORE]
    groups = [lower] if lower else []
    groups += [[b] for b in spacings if b * HIGHER > CORE]
    for group in groups:
        wide = group[-1]
        step = max(CORE, HIGHER * wide)
        for core in range(0, n, step):
            yield group[0], wide, max(0, core - wide), core, min(n, core + step + 4 * wide)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _prime_factors(q: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each number in turn one of its prime factors, and where it has one; until all are used."""
    rest, p = q.copy(), 2
    while len(rest) and rest.max() > 1:
        if p * p > rest.max():
            yield np.where(rest > 1, rest, q), rest > 1
            return
        has = rest % p == 0
        if has.any():
            yield np.full(len(q), p), has
            while has.any():
                rest[has] //= p
                has = rest % p == 0
        p += 1 if p == 2 else 2


def _reach(ids: np.ndarray, a: np.ndarray, q: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
    """The Z-function at chosen offsets: for how many places from ``a`` on (``step`` 1) or before it (-1) the text equals itself ``q`` later.

    Doubling blocks: few places are compared where texts part soon.
    """
    out = np.zeros(len(a), np.int64)
    live, width = np.nonzero(most > 0)[0], 16
    while len(live):
        for part in np.array_split(live, -(-len(live) * width // STEP)):
            at = np.minimum(out[part, None] + np.arange(width), most[part, None] - 1)
            here = a[part, None] + at if step > 0 else a[part, None] - 1 - at
            same = ids[here] == ids[here + q[part, None]]
            parted = ~same.all(1)
            out[part] = np.where(parted, out[part] + same.argmin(1), np.minimum(out[part] + width, most[part]))
            most[part[parted]] = 0
        live = live[out[live] < most[live]]
        width = min(2 * width, STEP)
    return out


def solve(given: list[tuple[int, int, int, int, int, int, np.ndarray]]) -> list[tuple[int, int, int, int]]:
    """``tile, period, start, stop`` (words of the text) of the parts of runs that the tiles show; those that meet are joined.

    ``given`` has ``n, low, high, begin, core, stop, ids`` of each tile. All tiles are solved at once, octave by
    octave: a hash of B words from each place on, from two of B / 2, tells at which offsets a
    boundary's words come again. Offsets that are a multiple of a smaller period are passed over.
    The others' Z-functions are taken word by word, so hashes never decide that words are equal.
    """
    order = sorted(range(len(given)), key=lambda t: -len(given[t][6]))
    size = np.array([len(given[t][6]) for t in order], np.int64)
    n, low, high, begin, core, stop = (np.array([given[t][k] for t in order], np.int64) for k in range(6))
    if not len(size) or not size[0]:
        return []
    # Each tile is followed by a place of its own that equals no other, so no agreement reaches across.
    offset = np.concatenate([[0], np.cumsum(size + 1)])
    ids = np.empty(offset[-1], np.int64)
    for k, t in enumerate(order):
        ids[offset[k] : offset[k + 1] - 1] = given[t][6]
        ids[offset[k + 1] - 1] = -1 - k
    tile = np.repeat(np.arange(len(size)), size + 1)
    place = np.arange(len(ids)) - offset[tile] + begin[tile]  # word number in the text
    first_next = core + np.maximum(CORE, HIGHER * high)  # boundaries from here on are the next tile's
    hashes, width = _mixed(ids.astype(np.uint64) + np.uint64(1)), 1
    found = []

    def doubled(values: np.ndarray, width: int) -> np.ndarray:
        out = values.copy()
        out[: len(values) - width] = _mixed(values[: len(values) - width] * np.uint64(0xD1342543DE82EF95) + values[width:])
        return out

    for b in octaves(int(n.max())):
        reach = offset[int((size >= 2 * b).sum())]  # shorter tiles come last
        if not reach:
            break
        hashes = hashes[:reach]
        while width < b:
            hashes, width = doubled(hashes, width), 2 * width
        here = (low <= b) & (b <= high)
        at = np.arange(reach)
        if b == BASE:
            bounds = at[place[:reach] % BASE == 0]
            c = np.repeat(bounds, 2 * BASE - 1)
            p = c + np.tile(np.arange(1, 2 * BASE), len(bounds))
            fits = p < reach
            c, p = c[fits], p[fits]
        else:
            back = place[:reach] % b + b
            c, p = at - back, at
            fits = c >= 0
            c, p = c[fits], p[fits]
        same = hashes[c] == hashes[p]
        c, p = c[same], p[same]
        t, q = tile[c], p - c
        ok = here[t] & (tile[p] == t) & (place[c] >= core[t]) & (place[c] < first_next[t])
        c, q, t = c[ok], q[ok], t[ok]
        # [c, c + q + b) has the period q. With the period q / r too, q is not the least one.
        plain = np.ones(len(q), bool)
        for r, has in _prime_factors(q):
            d = q // r
            span = q + b - d  # so many places are equal to those d later, if d is a period
            last = c + np.maximum(span - b, 0)
            middle = np.minimum(c + b, last)
            equal = (hashes[c] == hashes[c + d]) & (hashes[middle] == hashes[middle + d]) & (hashes[last] == hashes[last + d])
            plain &= ~(has & equal)
        c, q, t = c[plain], q[plain], t[plain]
        if not len(c):
            continue
        left, right = offset[t], offset[t] + size[t]
        forward = _reach(ids, c, q, right - c - q, 1)
        backward = _reach(ids, c, q, c - left, -1)
        whole = forward + backward >= q
        start = place[c] - backward
        end = place[c] + q + forward
        found.extend(zip(*(x[whole].tolist() for x in (t, q, start, end))))
    found.sort()
    merged: list[list[int]] = []
    for k, q, start, end in found:
        if merged and merged[-1][:2] == [k, q] and start <= merged[-1][3] - q:
            merged[-1][3] = max(merged[-1][3], end)
        else:
            merged.append([k, q, start, end])
    return [(order[k], q, start, end) for k, q, start, end in merged]


def _exploded(docs: DataFrame) -> DataFrame:
    """The tiles of each document: its word numbers, cut per group of octaves."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = numbered(text.as_py())
                for low, high, begin, core, stop in tiles(len(ids)):
                    rows.append((doc, len(ids), low, high, begin, core, stop, ids[begin:stop].tobytes()))
                    held += stop - begin
                    if held > STEP:
                        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), _TILE)], schema=_TILE)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows), _TILE)], schema=_TILE)

    return docs.mapInArrow(explode, "doc bigint, n bigint, low bigint, high bigint, begin bigint, core bigint, stop bigint, ids binary")


def _parts(exploded: DataFrame) -> DataFrame:
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column(0).to_pylist()
            numbers = [batch.column(k).to_pylist() for k in range(1, 7)]
            ids = [np.frombuffer(x.as_buffer(), np.int32) for x in batch.column(7)]
            found = solve(list(zip(*numbers, ids)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc[t] for t, *_ in found], pa.int64()), *[pa.array([x[k] for x in found], pa.int64()) for k in (1, 2, 3)]],
                names=["doc", "period", "start", "stop"],
            )

    return exploded.mapInArrow(answer, "doc bigint, period bigint, start bigint, stop bigint")


def stitched(parts: DataFrame) -> DataFrame:
    """``doc, period, start, stop`` of whole runs: parts of a document's period that overlap by a period or more are one."""
    by = Window.partitionBy("doc", "period").orderBy("start", "stop")
    before = F.max("stop").over(by.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(before.isNull() | (F.col("start") > before - F.col("period")), 1).otherwise(0)
    numbered_parts = parts.distinct().select("*", begins.alias("begins")).select("*", F.sum("begins").over(by).alias("run"))
    runs = numbered_parts.groupBy("doc", "period", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    long = (F.col("stop") - F.col("start")) >= F.greatest(F.lit(LEAST), PERIODS * F.col("period"))
    return runs.where(long).select("doc", "period", "start", "stop")


def find_runs(docs: DataFrame, long: int = LONG) -> DataFrame:
    """``doc, period, start, stop`` of every run of ``docs`` (``doc`` a 64-bit key, ``text``).

    Texts of more than ``long`` bytes are dealt out tile by tile; others are solved where they are read.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0))

    def some(wanted: Column) -> DataFrame:
        # A filter would be pushed into the expressions that make the text, and evaluate them again for each word.
        return docs.select("doc", F.explode(F.when(wanted, F.array("text"))).alias("text"))

    near = _parts(_exploded(some(size <= long)))
    far = _parts(_exploded(some(size > long)).repartition("doc", "high", "core"))
    return stitched(near.unionByName(far))


def collapse(text: str | None, runs: list[tuple[int, int, int]]) -> tuple[int, str]:
    """How many words a text has, and its words but those after the first period of any run, joined by a blank."""
    n, kept = 0, []
    drop = sorted((start + period, start + length) for start, length, period in runs)
    for words in words_of(text or ""):
        left, at = [], 0
        for a, b in drop:
            a, b = max(a - n, 0), min(b - n, len(words))
            if a < b and b > at:
                left += words[at:a]
                at = max(at, b)
        n += len(words)
        kept.append(b" ".join(left + words[at:]) if drop else b" ".join(words))
    return n, b" ".join(x for x in kept if x).decode()


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", long: int = LONG, small: int = SMALL) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row of ``docs``.

    Words are parted by the six ASCII blanks. ``runs`` is an array of ``start, length, period`` in
    words, by start, then period: stretches of ``LEAST`` words and ``PERIODS`` times their smallest period or more,
    that no neighbouring word extends. ``collapsed`` has the words that are in no run, or in the first period
    of each run they are in, joined by blanks. NULL and empty texts have no words, no runs and an empty ``collapsed``. Rows
    equal in id and text come back alike; NULL ids and rows that share an id are kept apart by a hash of id and text. Other columns are not read.

    Tiles are solved alone; parts of runs are shuffled by document and period to be stitched, and
    whole runs by document. The texts are joined with their runs by broadcast if all runs are ``small`` rows at most, else by shuffle.
    """
    small_batches(docs.sparkSession)
    given = id_and_text(docs, key, text).select("doc_id", F.col("text").cast("string").alias("text"))
    doc = F.xxhash64("doc_id", "text")
    runs = find_runs(given.select(doc.alias("doc"), "text"), long)
    each = runs.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("start", (F.col("stop") - F.col("start")).alias("length"), "period"))).alias("runs"))
    each = saved(each.withColumnRenamed("doc", "of"), "runs")
    total = each.agg(F.sum(F.size("runs"))).first()[0] or 0
    rows = given.select("doc_id", "text", doc.alias("doc")).join(F.broadcast(each) if total <= small else each, F.col("doc") == F.col("of"), "left")
    none = F.array().cast("array<struct<start: bigint, length: bigint, period: bigint>>")
    rows = rows.select("doc_id", F.coalesce("runs", none).alias("runs"), "text")

    def collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = batch.column(1).offsets.to_numpy()
            start, length, period = (batch.column(1).values.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            counts, texts = [], []
            for k, value in enumerate(batch.column(2)):
                a, b = ends[k], ends[k + 1]
                n, left = collapse(value.as_py(), list(zip(start[a:b].tolist(), length[a:b].tolist(), period[a:b].tolist())))
                counts.append(n)
                texts.append(left)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), batch.column(1), pa.array(texts, pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    kind = given.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(collapsed, f"doc_id {kind}, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def strongest(runs: str = "runs"):
    """The run of the greatest exact length over period; the array's order decides ties. NULL if there is none."""
    def better(best, run):
        return F.when(best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run).otherwise(best)

    return F.aggregate(F.col(runs), F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), better)


def digests(found: DataFrame) -> DataFrame:
    """Figures of each document's runs: their number, the strongest one, and hashes of all runs and of the collapsed text."""
    line = F.transform("runs", lambda r: F.concat_ws("", F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.select("doc_id", "n_words", "runs", "collapsed", strongest().alias("best"))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


def with_planted(docs: DataFrame) -> DataFrame:
    """Every tenth document by a hash of its id gets a periodic tail from some word on; its words are then joined by blanks."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    rows = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("w"), F.floor(h / 10).cast("long").alias("g"))
    rows = rows.select("*", (F.col("g") % F.nullif(F.size("w"), F.lit(0))).alias("a"))
    rows = rows.select("*", (1 + F.floor((F.size("w") - F.col("a")) / (3 + F.col("g") % 8))).alias("p"))
    tail = F.transform(
        F.sequence(F.lit(0).cast("long"), F.size("w").cast("long") - 1),
        lambda i: F.when(i < F.col("a"), F.element_at("w", (i + 1).cast("int"))).otherwise(F.element_at("w", (F.col("a") + (i - F.col("a")) % F.col("p") + 1).cast("int"))),
    )
    return rows.select("doc_id", F.when(F.size("w") > 0, F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"))
