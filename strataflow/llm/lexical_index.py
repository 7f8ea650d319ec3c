"""Ranked lexical search: an index of documents by length stratum, and exact best documents for each item.

Documents of equal normaliser m are a stratum; its postings are kept by term and then by term
frequency, so an impact (term, frequency, m) is computed once for all documents that share it. The greatest
frequency of each term bounds what a document of a stratum can score; strata are visited
in the order of these bounds, and not at all once enough documents score more.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataflow.llm.shared import id_and_text, saved, scratch_path, small_batches
from strataflow.session import session_conf

#: Fixed values of the score: the normaliser is LEAST_M + LENGTH_SHARE * n * N div L.
LEAST_M, LENGTH_SHARE, UNIT, PER_TF, PER_M = 75, 25, 1_000_000_000, 1000, 12
TOP = 20
#: Documents and postings of a block, the row of the index; a larger stratum has several.
BLOCK, POSTINGS = 4096, 1 << 19
#: Item terms searched in one pass over the index, strata that each item visits first, and cells of a score table in memory.
PAIRS, FIRST, CELLS = 1 << 20, 8, 1 << 21

#: Terms are runs of ASCII letters and digits and of all other characters beyond ASCII: blanks for the rest, small letters for A-Z.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    # Bytes beyond ASCII never equal an ASCII one in UTF-8, so bytes are split where characters would be.
    return text.encode().translate(_TERM_BYTES).split() if text else []


def vectors(docs: DataFrame) -> DataFrame:
    """``doc_id, n, terms, tfs`` of every row with a term: its number of terms, the distinct ones joined by blanks, and how often each occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes, terms, tfs = [], [], [], []
            for k, text in enumerate(batch.column(1)):
                found = terms_of(text.as_py())
                if found:
                    seen = Counter(found)
                    rows.append(k)
                    sizes.append(len(found))
                    terms.append(b" ".join(seen))
                    tfs.append(np.fromiter(seen.values(), np.int32, len(seen)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()), pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())],
                names=["doc_id", "n", "terms", "tfs"],
            )

    return docs.mapInArrow(count, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n bigint, terms binary, tfs binary")


def _block(m: int, ids: pa.Array, terms: list[bytes], tfs: list[bytes]) -> pa.RecordBatch:
    """Documents of a stratum as one row: postings by term, then falling frequency, then place among the documents."""
    lists = [t.split() for t in terms]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    coded = pa.array([t for found in lists for t in found], pa.binary()).dictionary_encode()
    names = coded.dictionary
    order = pc.sort_indices(names).to_numpy()
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    term = number[coded.indices.to_numpy()]
    tf = np.frombuffer(b"".join(tfs), np.int32)
    place = np.repeat(np.arange(len(lists), dtype=np.int32), sizes)
    by = np.lexsort((place, -tf, term))
    term, tf, place = term[by], tf[by], place[by]
    begins = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (tf[1:] != tf[:-1])]))
    group_docs = np.diff(np.append(begins, len(term)))

    def packed(values: np.ndarray) -> pa.Array:
        return pa.array([values.astype("<i4").tobytes()], pa.binary())

    columns = {
        "m": pa.array([m], pa.int64()), "n_docs": pa.array([len(lists)], pa.int32()), "docs": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
        "terms": pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names.take(pa.array(order))),
        "term_docs": packed(np.bincount(term, minlength=len(names))), "term_groups": packed(np.bincount(term[begins], minlength=len(names))),
        "tfs": packed(tf[begins]), "group_docs": packed(group_docs), "places": packed(place),
    }
    return pa.RecordBatch.from_pydict(columns)


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> str:
    """Index every row of ``docs``; returns the index's folder (``search`` reads it).

    Terms are the longest stretches of ASCII letters and digits and characters beyond ASCII, A-Z in lower case. Rows without
    a term (NULL, empty or of other characters only) are in no stratum and never found. Rows that share an id are documents of their own. Texts
    of any length count whole; other columns are not read. An empty table gives an empty index.

    Texts are read once. Documents are dealt out by range of m and a number of their own, so a
    stratum with many documents lies in several tasks, and a block never grows with it.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = scratch_path(spark, "index")
    counted = saved(vectors(id_and_text(docs, key, text)), "vectors", compression="zstd")
    n_docs, n_terms = counted.agg(F.count("*"), F.sum("n")).first()
    n_terms = n_terms or 0
    m = F.expr(f"cast({LEAST_M} + (cast(n as decimal(20, 0)) * {LENGTH_SHARE * n_docs}) div {max(n_terms, 1)} as bigint)")
    numbered = counted.select("doc_id", m.alias("m"), F.monotonically_increasing_id().alias("own"), "terms", "tfs")
    dealt = numbered.repartitionByRange("m", "own").sortWithinPartitions("m", "doc_id").select("m", "doc_id", "terms", "tfs")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_m, ids, terms, tfs, postings = None, [], [], [], 0
        kind = None
        for batch in batches:
            kind = batch.schema.field(1).type
            for of, doc, words, counts in zip(*(c.to_pylist() for c in batch.columns)):
                if ids and (of != held_m or len(ids) >= BLOCK or postings + len(counts) // 4 > POSTINGS):
                    yield _block(held_m, pa.array(ids, kind), terms, tfs)
                    ids, terms, tfs, postings = [], [], [], 0
                held_m = of
                ids.append(doc)
                terms.append(words)
                tfs.append(counts)
                postings += len(counts) // 4
        if ids:
            yield _block(held_m, pa.array(ids, kind), terms, tfs)

    key_type = counted.schema["doc_id"].dataType.simpleString()
    shape = f"m bigint, n_docs int, docs array<{key_type}>, terms array<binary>, term_docs binary, term_groups binary, tfs binary, group_docs binary, places binary"
    dealt.mapInArrow(pack, shape).write.parquet(f"{folder}/blocks", compression="zstd")
    spark.createDataFrame([(n_docs, n_terms)], "n_docs bigint, n_terms bigint").coalesce(1).write.parquet(f"{folder}/about")
    return folder


@dataclass
class Items:
    """Items of one pass: their distinct terms, and for each item the terms it holds and how often."""

    numbers: np.ndarray
    vocabulary: list[bytes]
    begins: np.ndarray  # of each item's pairs
    term: np.ndarray
    times: np.ndarray
    weight: np.ndarray | None = None


def _passes(items: DataFrame) -> Iterator[Items]:
    """Items are read one after another, and given out at PAIRS terms."""
    known: dict[bytes, int] = {}
    numbers, begins, term, times = [], [], [], []

    def made() -> Items:
        return Items(np.array(numbers, np.int64), list(known), np.array(begins, np.int64), np.array(term, np.int64), np.array(times, np.int64))

    for row in items.select("item", "terms", "tfs").toLocalIterator():
        numbers.append(row.item)
        begins.append(len(term))
        for name, count in zip(bytes(row.terms).split(), np.frombuffer(row.tfs, np.int32).tolist()):
            term.append(known.setdefault(name, len(known)))
            times.append(count)
        if len(term) >= PAIRS:
            yield made()
            known, numbers, begins, term, times = {}, [], [], [], []
    if numbers:
        yield made()


def _unpacked(value: pa.BinaryScalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), "<i4")


def _document_counts(blocks: DataFrame, items) -> np.ndarray:
    """How many documents hold each term of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(items.value.vocabulary, pa.binary())
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            at = pc.index_in(batch.column(0).flatten(), value_set=wanted)
            held = at.is_valid().to_numpy(zero_copy_only=False)
            docs = np.concatenate([_unpacked(x) for x in batch.column(1)])
            np.add.at(total, at.fill_null(0).to_numpy()[held], docs[held])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "docs"])

    found = blocks.select("terms", "term_docs").mapInArrow(count, "term bigint, docs bigint")
    df = np.zeros(len(items.value.vocabulary), np.int64)
    for row in found.groupBy("term").agg(F.sum("docs").alias("docs")).collect():  # at most the vocabulary of a pass
        df[row.term] = row.docs
    return df


def _impact(tf: np.ndarray, m: int) -> np.ndarray:
    return UNIT * tf // (PER_TF * tf + PER_M * m)


class _Scorer:
    """What one task needs to bound and score the items in its blocks."""

    def __init__(self, items: Items):
        self.items = items
        self.wanted = pa.array(items.vocabulary, pa.binary())

    def load(self, m: int, terms: pa.Array, groups: np.ndarray, tfs: np.ndarray) -> np.ndarray:
        """Take up a block; returns for each item the most that one of its documents can score."""
        at = pc.index_in(terms, value_set=self.wanted)
        self.held = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
        self.number = at.fill_null(0).to_numpy()[self.held].astype(np.int64)
        first = (np.cumsum(groups) - groups)[self.held]  # each term's groups begin with its greatest frequency
        most = np.zeros(len(self.items.vocabulary), np.int64)
        most[self.number] = self.items.weight[self.number] * _impact(tfs[first].astype(np.int64), m)
        return np.add.reduceat(most[self.items.term] * self.items.times, self.items.begins)

    def scores(self, m: int, chosen: np.ndarray, n_docs: int, term_docs, tfs, group_docs, places) -> np.ndarray:
        """Scores of the chosen items (rows) for the documents of the block that was taken up last."""
        begin = np.zeros(len(self.items.vocabulary), np.int64)
        count = np.zeros(len(self.items.vocabulary), np.int64)
        begin[self.number] = (np.cumsum(term_docs, dtype=np.int64) - term_docs)[self.held]
        count[self.number] = term_docs[self.held]
        impact = np.repeat(_impact(tfs.astype(np.int64), m), group_docs)
        out = np.zeros((len(chosen), n_docs), np.int64)
        ends = np.append(self.items.begins[1:], len(self.items.term))
        for row, item in enumerate(chosen.tolist()):
            for pair in range(self.items.begins[item], ends[item]):
                term = self.items.term[pair]
                if n := count[term]:
                    a = begin[term]
                    # A document has one posting of a term, so no place comes twice.
                    out[row, places[a : a + n]] += impact[a : a + n] * (self.items.weight[term] * self.items.times[pair])
        return out


def _first_strata(blocks: DataFrame, items) -> DataFrame:
    """``item, m`` of the strata that bound each item highest."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(items.value)
        best = np.zeros((len(items.value.numbers), 0), np.int64)
        strata = np.zeros((len(items.value.numbers), 0), np.int64)
        for batch in batches:
            for k, m in enumerate(batch.column(0).to_pylist()):
                most = scorer.load(m, batch.column(1)[k].values, _unpacked(batch.column(2)[k]), _unpacked(batch.column(3)[k]))
                again = strata == m  # by an earlier block of the stratum
                known = again.any(1)
                best = np.where(again, np.maximum(best, most[:, None]), best)
                best = np.concatenate([best, np.where(known, -1, most)[:, None]], 1)
                strata = np.concatenate([strata, np.where(known, -1, m)[:, None]], 1)
                if best.shape[1] > FIRST:
                    keep = np.argsort(-best, axis=1, kind="stable")[:, :FIRST]
                    best, strata = np.take_along_axis(best, keep, 1), np.take_along_axis(strata, keep, 1)
        item, column = np.nonzero(best > 0)
        yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(strata[item, column]), pa.array(best[item, column])], names=["item", "m", "bound"])

    found = blocks.select("m", "terms", "term_groups", "tfs").mapInArrow(bound, "item bigint, m bigint, bound bigint")
    by = Window.partitionBy("item").orderBy(F.desc("bound"), "m")
    return found.groupBy("item", "m").agg(F.max("bound").alias("bound")).select("*", F.row_number().over(by).alias("nth")).where(F.col("nth") <= FIRST).select("item", "m")


def _visited(blocks: DataFrame, items, least, strata, first: bool, k: int) -> DataFrame:
    """``item, doc_id, score``: the best ``k`` documents that each task finds for each item.

    ``strata`` has the items that visit a stratum first; the rest, where ``first`` is not set, visit it
    if its bound reaches their ``least`` score and what the task has found so far.
    """
    key_type = blocks.schema["docs"].dataType.elementType.simpleString()

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(items.value)
        bar = least.value.copy()
        best: dict[int, list] = {}
        for batch in batches:
            kind = batch.schema.field(2).type.value_type
            for j in range(batch.num_rows):
                m, n_docs, docs, terms, *numbers = (batch.column(c)[j] for c in range(batch.num_columns))
                m, n_docs = m.as_py(), n_docs.as_py()
                now = strata.value.get(m, np.zeros(0, np.int64))
                if first and not len(now):
                    continue
                term_docs, groups, tfs, group_docs, places = map(_unpacked, numbers)
                most = scorer.load(m, terms.values, groups, tfs)
                may = (most >= bar) & (most > 0)
                chosen = now[may[now]] if first else np.setdiff1d(np.flatnonzero(may), now)
                for part in np.array_split(chosen, max(1, -(-len(chosen) * n_docs // CELLS))):
                    table = scorer.scores(m, part, n_docs, term_docs, tfs, group_docs, places)
                    for row, item in zip(table, part.tolist()):
                        reached = np.flatnonzero(row >= max(bar[item], 1))
                        if not len(reached):
                            continue
                        # Places follow the ids, so at equal scores the least ids stay.
                        top = reached[np.argsort(-row[reached], kind="stable")[:k]]
                        ids = docs.values.take(pa.array(top)).to_pylist()
                        held = best.get(item, []) + [(-s, doc is not None, doc if doc is not None else 0) for s, doc in zip(row[top].tolist(), ids)]
                        held.sort()
                        best[item] = held[:k]
                        if len(held) >= k:
                            bar[item] = max(bar[item], -held[k - 1][0])
        rows = [(items.value.numbers[item], doc if known else None, -s) for item, held in best.items() for s, known, doc in held]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), (pa.int64(), kind, pa.int64()))], names=["item", "doc_id", "score"])

    if first:
        blocks = blocks.where(F.col("m").isin([int(m) for m in strata.value]))
    return blocks.mapInArrow(visit, f"item bigint, doc_id {key_type}, score bigint")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return found.select("*", F.row_number().over(by).alias("rank")).where(F.col("rank") <= k)


def search(spark: SparkSession, folder: str, items: DataFrame, key: str = "item_id", text: str = "text", k: int = TOP) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of an index that score highest for each row of ``items``.

    A score sums ``w * impact`` over the item's terms, repeats included. Only scores above 0 are given;
    at equal scores the least id comes first, NULL ids before all. Items without terms have no rows; rows that share
    an id are ranked each. Nothing is cut: every document whose stratum can reach the item's ``k``-th score is scored.

    Items go through the index ``PAIRS`` terms at a time. Each pass counts the documents of the items' terms,
    bounds every stratum, scores the ``FIRST`` best bounded strata of each item, and then the strata whose
    bound reaches the ``k``-th of those scores. A task gives ``k`` rows an item, and none sees more than a block at once.
    """
    small_batches(spark)
    # A block is a long row: rows are read one by one, not thousands at a time as columns.
    with session_conf(spark, spark__sql__parquet__enableNestedColumnVectorizedReader="false"):
        return _searched(spark, folder, vectors(id_and_text(items, key, text)), k)


def _searched(spark: SparkSession, folder: str, items: DataFrame, k: int) -> DataFrame:
    blocks = spark.read.parquet(f"{folder}/blocks")
    total = spark.read.parquet(f"{folder}/about").first().n_docs
    columns = blocks.select("m", "n_docs", "docs", "terms", "term_docs", "term_groups", "tfs", "group_docs", "places")
    given = saved(items.select("*", F.monotonically_increasing_id().alias("item")), "items")
    parts = []
    for some in _passes(given):
        df = _document_counts(blocks, spark.sparkContext.broadcast(some))
        some.weight = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * int(d) + 1))) for d in df], np.int64)
        shared = spark.sparkContext.broadcast(some)
        picked: dict[int, list[int]] = {}
        for row in _first_strata(blocks, shared).collect():  # FIRST rows an item of the pass
            picked.setdefault(row.m, []).append(row.item)
        strata = spark.sparkContext.broadcast({m: np.array(sorted(of), np.int64) for m, of in picked.items()})
        bar = np.ones(len(some.numbers), np.int64)
        first = saved(_ranked(_visited(columns, shared, spark.sparkContext.broadcast(bar.copy()), strata, True, k), k), "first")
        place = {number: n for n, number in enumerate(some.numbers.tolist())}
        for row in first.where(F.col("rank") == k).select("item", "score").collect():  # one row an item of the pass
            bar[place[row.item]] = row.score
        rest = _visited(columns, shared, spark.sparkContext.broadcast(bar), strata, False, k)
        parts.append(saved(_ranked(rest.unionByName(first.drop("rank")), k), "ranked"))
    names = given.select(F.col("item").alias("of"), F.col("doc_id").alias("item_id"))
    kind = blocks.schema["docs"].dataType.elementType.simpleString()
    found = spark.createDataFrame([], f"item bigint, doc_id {kind}, score bigint, rank int")
    for part in parts:
        found = found.unionByName(part)
    return found.join(names, F.col("item") == F.col("of")).select("item_id", "rank", "doc_id", "score")


def oracle() -> str:
    terms = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""
    WITH words AS (SELECT doc_id, unnest({terms}) AS term FROM documents),
    postings AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
    sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM postings GROUP BY doc_id),
    totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
    normal AS (SELECT doc_id, {LEAST_M} + ({LENGTH_SHARE} * n * n_docs) // n_terms AS m FROM sizes, totals),
    weights AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w
        FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), totals),
    asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({terms}) AS term FROM benchmark) GROUP BY item_id, term),
    scored AS (SELECT item_id, doc_id, CAST(sum(times * w * (({UNIT} * tf) // ({PER_TF} * tf + {PER_M} * m))) AS BIGINT) AS score
        FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN normal USING (doc_id) GROUP BY item_id, doc_id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS nth FROM scored WHERE score > 0)
    SELECT item_id, CAST(nth AS INTEGER) AS rank, doc_id, score FROM ranked WHERE nth <= {TOP}
    """
