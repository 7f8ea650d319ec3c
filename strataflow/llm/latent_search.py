"""Benchmark decontamination: latent semantic candidates, then common subsequences and answers."""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.shared import column, id_and_text, saved, small_batches

WINDOW, STEP = 40, 20
#: Latent width, columns of the term space, power steps.
RANK, COLUMNS, POWER_STEPS = 128, 1 << 14, 2
#: All documents together weigh as much against the items as so many do, however many there are.
FIT_DOCUMENTS = 4000
#: Words of documents whose passages are multiplied at once, and tasks that add up the parts of a sum over all documents.
FIT_WORDS, SUMS = 1 << 13, 16
#: From so many places on, the rows of a word's places are added by a matrix product.
FREQUENT = 4
#: Benchmark items searched for in one pass; more items take more passes.
BLOCK = 200
COSINE = 0.45
#: Windows of a document searched at once.
PART = 2048
#: A leak holds this share of the item's words in order, or the smaller share and the answer's.
SAME, PARAPHRASE, ANSWER = 0.8, 0.6, 0.75
ANSWER_WORDS = 8
#: From this share of words of the vocabulary on, a stretch is searched whole: nearly every window has enough of them for a short item.
DENSE = 0.25
#: Pairs of a window and an item whose words are looked up at once.
PAIRS = 1 << 14

_WORD, _MARK = re.compile(r"\w+"), re.compile(r"[^\w\s]")
_MARKS = string.punctuation.replace("_", "")


def words(text: str | None) -> list[str]:
    """Runs of word characters in lower case; once the usual marks are blanks, most texts are split faster than searched."""
    if not text:
        return []
    text = text.lower()
    for mark in _MARKS:
        text = text.replace(mark, " ")
    return _WORD.findall(text) if _MARK.search(text) else text.split()


class Items(NamedTuple):
    """A block of benchmark items: their ids, word ids, answers' word ids, and the vocabulary."""

    keys: list[int]
    terms: list[list[int]]
    answers: list[list[int]]
    vocabulary: dict[str, int]


def read_items(rows: list) -> Items:
    vocabulary: dict[str, int] = {}
    keys, terms, answers = [], [], []
    for key, text, answer in rows:
        ids = [vocabulary.setdefault(w, len(vocabulary)) for w in words(text)]
        if not ids:
            continue
        own = [vocabulary.setdefault(w, len(vocabulary)) for w in words(answer)]
        keys.append(key)
        terms.append(ids)
        answers.append(own or ids[-ANSWER_WORDS:])
    return Items(keys, terms, answers, vocabulary)


def common_subsequence(short: list[int], long: list[int]) -> int:
    """Length of the longest common subsequence, with one big-number step per element of ``long``."""
    where: dict[int, int] = {}
    for i, x in enumerate(short):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(short)) - 1
    row = full
    for x in long:
        hit = row & where.get(x, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return len(short) - row.bit_count()


def windows(ids: np.ndarray) -> np.ndarray:
    """Word ids by window, -1 behind the end."""
    count = max(1, -(-(len(ids) - WINDOW) // STEP) + 1)
    padded = np.full((count - 1) * STEP + WINDOW, -1, np.int64)
    padded[: len(ids)] = ids
    return padded[np.arange(count)[:, None] * STEP + np.arange(WINDOW)]


def projected(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Latent rows of all windows of a text: sums of the vectors of its words, -1 for words without one.

    Windows overlap by whole steps, so each word is added once to its step, and each window takes its steps.
    """
    count = max(1, -(-(len(ids) - WINDOW) // STEP) + 1)
    padded = np.full((count - 1 + WINDOW // STEP) * STEP, -1, np.int64)
    padded[: len(ids)] = ids
    steps = step_sums(padded, vectors)
    return sum(steps[k : k + count] for k in range(WINDOW // STEP))


def step_sums(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Sums of the vectors of the words of each step, place by place."""
    places = ids.reshape(-1, STEP)
    total, rows = vectors[places[:, 0]], np.empty((len(places), vectors.shape[1]), np.float32)
    for k in range(1, STEP):
        total += np.take(vectors, places[:, k], axis=0, out=rows, mode="wrap")
    return total


def word_vectors(weight: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The latent vector of each word of the vocabulary, times its weight; the last row, of zeros, is for -1."""
    vectors = weight[:, None] * basis[np.arange(len(weight)) % len(basis)]
    return np.concatenate([vectors[:-1], np.zeros((1, basis.shape[1]))]).astype(np.float32)


def least_weights(items: Items, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of items, and the least weight that the words of a leak of an item of that size can have."""
    least: dict[int, float] = {}
    for terms in items.terms:
        needed = int(np.ceil(PARAPHRASE * len(terms) - 1e-9))
        least[len(terms)] = min(least.get(len(terms), np.inf), float(np.sort(weight[terms])[:needed].sum()))
    sizes = np.array(sorted(least))
    return sizes, np.array([least[s] for s in sizes])


def may_leak(ids: np.ndarray, weight: np.ndarray, sizes: np.ndarray, least: np.ndarray, first: int, count: int) -> np.ndarray:
    """Of windows ``first`` and on, those whose region holds enough words of the vocabulary, and weight, for an item of some size.

    A leak has ``PARAPHRASE`` of an item's words in its region, so a window passed over here can be none.
    """
    known = np.concatenate([[0], np.cumsum(ids >= 0)])
    mass = np.concatenate([[0.0], np.cumsum(weight[ids])])
    at = (first + np.arange(count))[:, None] * STEP

    def enough(at: np.ndarray, sizes: np.ndarray, least: np.ndarray) -> np.ndarray:
        low, high = np.maximum(at - sizes, 0), np.minimum(at + WINDOW + sizes, len(ids))
        return ((known[high] - known[low] >= PARAPHRASE * sizes - 1e-9) & (mass[high] - mass[low] >= least - 1e-6)).any(axis=1)

    # Most windows have enough for the shortest items; only the others are looked at for all sizes.
    kept = enough(at, sizes[:1], least[:1])
    rest = np.nonzero(~kept)[0]
    kept[rest] = enough(at[rest], sizes, least)
    return np.nonzero(kept)[0]


def to_search(ids: np.ndarray, weight: np.ndarray, sizes: np.ndarray, least: np.ndarray, first: int, count: int) -> np.ndarray:
    """Of windows ``first`` and on, those that are searched: all of a dense stretch, else those that ``may_leak``."""
    if np.count_nonzero(ids >= 0) >= DENSE * len(ids):
        return np.arange(count)
    return may_leak(ids, weight, sizes, least, first, count)


def held_words(ids: np.ndarray, low: np.ndarray, high: np.ndarray, terms: np.ndarray, ends: np.ndarray, item: np.ndarray) -> np.ndarray:
    """How many words of an item, repeats included, a region of the text holds at all: for each pair of a region and an item.

    ``terms`` holds the words of all items one after another, ``ends`` where each ends after a leading zero. Places of the text's
    words are sorted by word, so a word is in a region if its first place from the region's start on lies before its end.
    """
    at = np.nonzero(ids >= 0)[0]
    places = np.append(np.sort(ids[at].astype(np.int64) * len(ids) + at), np.iinfo(np.int64).max)
    out = np.zeros(len(item), np.int64)
    for s in range(0, len(item), PAIRS):
        i = item[s : s + PAIRS]
        size = ends[i + 1] - ends[i]
        stop = np.cumsum(size)
        pair = np.repeat(np.arange(len(i)), size)
        word = terms[np.arange(stop[-1]) + np.repeat(ends[i] - (stop - size), size)] * len(ids)
        found = places[np.searchsorted(places, word + low[s : s + PAIRS][pair])] < word + high[s : s + PAIRS][pair]
        out[s : s + PAIRS] = np.add.reduceat(found, stop - size, dtype=np.int64)
    return out


def _dense(rows: np.ndarray, weight: np.ndarray, columns: int) -> np.ndarray:
    """A few TF-IDF rows over the whole term space."""
    out = np.zeros((len(rows), columns), np.float32)
    np.add.at(out, (np.arange(len(rows))[:, None], rows % columns), weight[rows])
    return out


def _gram(rows: np.ndarray, weight: np.ndarray, basis: np.ndarray, total: np.ndarray) -> None:
    """Adds the unit TF-IDF rows' transpose times the rows times the basis to ``total``."""
    for s in range(0, len(rows), 256):
        part = _dense(rows[s : s + 256], weight, len(basis))
        part /= np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-9)
        total += part.T @ (part @ basis)


def squares(word: np.ndarray, step: np.ndarray, weight: np.ndarray, columns: int, steps: int) -> np.ndarray:
    """Squared lengths of the TF-IDF rows of all windows that begin with a step: those of its two steps, and twice what both share."""
    key = step * columns + word % columns
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    value, key = np.add.reduceat(weight[word][order], first), key[first]
    own = np.bincount(key // columns, value * value, minlength=steps)
    after = np.minimum(np.searchsorted(key, key + columns), len(key) - 1)
    both = np.flatnonzero(key[after] == key + columns)
    shared = np.bincount(key[both] // columns, value[both] * value[after[both]], minlength=steps)
    return own[:-1] + own[1:] + 2 * shared[:-1]


def add_by_word(word: np.ndarray, row: np.ndarray, rows: np.ndarray, total: np.ndarray) -> None:
    """Adds the row of each place of a word to the word's row of ``total``."""
    order = np.argsort(word.astype(np.uint16) if len(total) <= 1 << 16 else word, kind="stable")
    row, first = row[order], np.flatnonzero(np.diff(word[order], prepend=-1))
    named, n = word[order][first], np.diff(np.append(first, len(word)))
    frequent = n >= FREQUENT
    # Words of few places: the first places of all, then the second ones, and so on.
    for k in range(FREQUENT - 1):
        more = ~frequent & (n > k)
        total[named[more]] += rows[row[first[more] + k]]
    if frequent.any():
        of = np.repeat(np.cumsum(frequent) - 1, n)
        place = np.repeat(frequent, n)
        count = np.bincount(of[place] * len(rows) + row[place], minlength=int(frequent.sum()) * len(rows))
        total[named[frequent]] += count.reshape(-1, len(rows)).astype(np.float32) @ rows


def gram_of(texts: list[np.ndarray], weight: np.ndarray, vectors: np.ndarray, columns: int, total: np.ndarray) -> None:
    """As ``_gram`` over all windows of some texts, from their known words alone; ``total`` is by word and lacks the word's weight.

    A window is two steps, so a word's part of the sum is what its step takes from the windows that hold the step.
    """
    sizes = np.array([max(2, -(-len(t) // STEP)) for t in texts])
    stop = np.cumsum(sizes)
    ids = np.full(int(stop[-1]) * STEP, -1, np.int64)
    for text, at in zip(texts, (stop - sizes) * STEP):
        ids[at : at + len(text)] = text
    at = np.flatnonzero(ids >= 0)
    if not len(at):
        return
    word, step = ids[at], at // STEP
    scale = 1 / np.maximum(squares(word, step, weight, columns, int(stop[-1])), 1e-18)
    # No window reaches from a text into the next one.
    scale[stop[:-1] - 1] = 0
    steps = step_sums(ids, vectors)
    seen = (steps[:-1] + steps[1:]) * scale[:, None].astype(np.float32)
    steps[0] = 0
    steps[1:] = seen
    steps[:-1] += seen
    add_by_word(word, step, steps, total)


def stretches(raws: list[bytes]) -> Iterator[list[np.ndarray]]:
    """Texts with known words, some ``FIT_WORDS`` words at a time; a long text goes in parts of whole windows."""
    held, n = [], 0
    for raw in raws:
        ids = np.frombuffer(raw, np.int32)
        for at in range(0, max(1, len(ids) - (WINDOW - STEP)), FIT_WORDS // STEP * STEP):
            part = ids[at : at + FIT_WORDS // STEP * STEP + WINDOW - STEP]
            if (part >= 0).any():
                held.append(part)
                n += len(part)
            if n >= FIT_WORDS:
                yield held
                held, n = [], 0
    if held:
        yield held


def summed(parts: DataFrame, columns: int, rank: int) -> np.ndarray:
    """Sum of ``block, part`` rows, each some rows of a matrix: added up in ``SUMS`` tasks, so that one matrix reaches the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total[block] = total.get(block, 0) + np.frombuffer(raw, np.float32).astype(np.float64)
        rows = [total[block].astype(np.float32).tobytes() for block in total]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(rows, pa.binary())], names=["block", "part"])

    out = np.zeros((columns, rank), np.float32)
    for block, raw in parts.repartition(SUMS, "block").mapInArrow(add, "block int, part binary").collect():
        out[np.arange(columns) % SUMS == block] = np.frombuffer(raw, np.float32).reshape(-1, rank)
    return out


def encoded(docs: DataFrame, vocabulary, key: str, text: str) -> DataFrame:
    """``doc_id, ids``: the words of each whole text as numbers of the vocabulary, -1 for others."""
    given = id_and_text(docs, key, text)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = vocabulary.value.get
        for batch in batches:
            found = [np.fromiter(map(get, words(t), repeat(-1)), np.int32).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["doc_id", "ids"])

    return given.mapInArrow(encode, f"doc_id {given.schema['doc_id'].dataType.simpleString()}, ids binary")


def term_weights(known: DataFrame, size: int) -> np.ndarray:
    """Inverse document frequency of each vocabulary word over all documents; one count per word is collected."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(size, np.int64), 0
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                ids = np.unique(np.frombuffer(raw, np.int32))
                total[ids[ids >= 0]] += 1
                rows += 1
        terms = np.nonzero(total)[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(terms, -1)), pa.array(np.append(total[terms], rows))], names=["term", "n"]
        )

    found = known.select("ids").mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(size, np.int64)
    documents = 1
    for term, n in found:
        if term < 0:
            documents += n
        else:
            counts[term] = n
    return np.append(np.log((1 + documents) / (1 + counts)), 0.0)


def latent_basis(known: DataFrame, items: Items, weight: np.ndarray, seed: int = 3) -> np.ndarray:
    """Right singular vectors of the TF-IDF passages by randomised subspace steps.

    Tasks multiply every passage of every document with the basis and back; their sums, each of columns times rank numbers whatever
    the corpus is, are added up by blocks of columns, and one matrix a step meets the items' own rows on the driver.
    """
    spark = known.sparkSession
    share = min(1.0, FIT_DOCUMENTS / max(1, known.count()))
    own = np.concatenate([windows(np.array(t)) for t in items.terms])
    columns = min(COLUMNS, len(items.vocabulary))
    rank = min(RANK, columns)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((columns, rank)))[0].astype(np.float32)
    for step in range(POWER_STEPS + 1):
        shared = spark.sparkContext.broadcast((basis, weight))

        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q, w = shared.value
            vectors, total = word_vectors(w, q), np.zeros((len(w) - 1, q.shape[1]), np.float32)
            for batch in batches:
                for texts in stretches(batch.column(0).to_pylist()):
                    gram_of(texts, w, vectors, len(q), total)
            total *= w[:-1, None].astype(np.float32)
            image = np.zeros_like(q)
            for at in range(0, len(total), len(q)):
                image[: len(total) - at] += total[at : at + len(q)]
            blocks = [image[np.arange(len(q)) % SUMS == block].tobytes() for block in range(SUMS)]
            yield pa.RecordBatch.from_arrays([pa.array(range(SUMS), pa.int32()), pa.array(blocks, pa.binary())], names=["block", "part"])

        image = summed(known.select("ids").mapInArrow(multiply, "block int, part binary"), columns, rank)
        # The items weigh more than the documents, so that each has its place in the basis.
        image *= share
        _gram(own, weight, 50 * basis, image)
        if step < POWER_STEPS:
            basis = np.linalg.qr(image)[0].astype(np.float32)
    values, turn = np.linalg.eigh(basis.T @ image)
    keep = values > 1e-6 * max(values.max(), 1e-12)
    return (basis @ turn[:, keep]).astype(np.float32)


def _search(docs: DataFrame, rows: list, key: str, text: str) -> DataFrame | None:
    spark = docs.sparkSession
    items = read_items(rows)
    if not items.keys:
        return None
    known = saved(encoded(docs, spark.sparkContext.broadcast(items.vocabulary), key, text), "words")
    weight = term_weights(known, len(items.vocabulary))
    basis = latent_basis(known, items, weight)

    def unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-9)

    vectors = word_vectors(weight, basis)
    own = [projected(np.array(t), vectors) for t in items.terms]
    owner = np.repeat(np.arange(len(own)), [len(w) for w in own])
    ends = np.cumsum([0, *map(len, items.terms)])
    flat = (np.concatenate(items.terms).astype(np.int64), ends)
    shared = spark.sparkContext.broadcast((items, weight, basis, owner, unit(np.concatenate(own)), flat, *least_weights(items, weight)))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight, basis, owner, latent, (terms, ends), sizes, least = shared.value
        vectors = word_vectors(weight, basis)
        for batch in batches:
            out: list[tuple] = []
            for k, raw in enumerate(batch.column(1).to_pylist()):
                ids = np.frombuffer(raw, np.int32)
                best: dict[int, tuple] = {}
                count = max(1, -(-(len(ids) - WINDOW) // STEP) + 1) if len(ids) else 0
                for first in range(0, count, PART):
                    size = min(PART, count - first)
                    # The stretch whose windows these are, and with it all that their regions reach.
                    before = min(first, -(-int(sizes[-1]) // STEP))
                    around = ids[(first - before) * STEP : (first + size - 1) * STEP + WINDOW + int(sizes[-1])]
                    part = to_search(around, weight, sizes, least, before, size)
                    if not len(part):
                        continue
                    near = unit(projected(ids[first * STEP : (first + size - 1) * STEP + WINDOW], vectors)[part]) @ latent.T
                    w, j = np.nonzero(near >= COSINE)
                    if not len(w):
                        continue
                    owned, starts = owner[j], (first + part[w]) * STEP
                    length = ends[owned + 1] - ends[owned]
                    low, high = np.maximum(starts - length, 0), np.minimum(starts + WINDOW + length, len(ids))
                    # Fewer words than a common subsequence needs.
                    base = low.min()
                    can = held_words(ids[base : high.max()], low - base, high - base, terms, ends, owned) >= PARAPHRASE * length
                    for n in np.nonzero(can)[0]:
                        i, length = int(owned[n]), len(items.terms[owned[n]])
                        region = ids[low[n] : high[n]].tolist()
                        share = common_subsequence(items.terms[i], region) / length
                        if share < PARAPHRASE:
                            continue
                        answer = common_subsequence(items.answers[i], region) / len(items.answers[i])
                        if share >= SAME or answer >= ANSWER:
                            best[i] = max(best.get(i, ()), (share, answer, float(near[w[n], j[n]])))
                out.extend((k, items.keys[i], *found) for i, found in best.items())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array([o[0] for o in out], pa.int64())), pa.array([o[1] for o in out], pa.int64())]
                + [pa.array([o[n] for o in out], pa.float64()) for n in (2, 3, 4)],
                names=["doc_id", "item_id", "share", "answer", "cosine"],
            )

    kind = known.schema["doc_id"].dataType.simpleString()
    return known.mapInArrow(find, f"doc_id {kind}, item_id bigint, share double, answer double, cosine double")


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, item_id, share, answer, cosine``: one row for each document and item it leaks.

    ``share`` is the part of the item's words that a region of the document holds in order,
    ``answer`` the same of its answer: a column ``answer`` of the benchmark, or else its last
    words. The benchmark is the query set: its items are searched for in blocks, against every passage of every document.
    NULL, blank and wordless texts leak nothing, and items without words are not found. Repeated
    rows of a document, or of an item, count once; rows with a NULL id are one document.
    """
    small_batches(docs.sparkSession)
    given = benchmark.select(
        column(benchmark, "item_id").cast("long").alias("item_id"), column(benchmark, "text").alias("text"),
        (column(benchmark, "answer") if "answer" in benchmark.columns else F.lit(None)).cast("string").alias("answer"),
    ).distinct()
    blocks = -(-given.count() // BLOCK)
    found = None
    for b in range(blocks):
        rows = given.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        # In a fixed order: word numbers, and so the basis, follow it.
        rows = sorted((tuple(r) for r in rows), key=lambda r: tuple((v is not None, v) for v in r))
        part = _search(docs, rows, key, text)
        found = part if found is None else found if part is None else found.unionByName(part)
    if found is None:
        kind = id_and_text(docs, key, text).schema["doc_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"doc_id {kind}, item_id bigint, share double, answer double, cosine double")
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("share", "answer", "cosine")).alias("best"))
    return best.select("doc_id", "item_id", "best.*")
