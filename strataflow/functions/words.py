"""Keyword text -> distinct words, the table function of the search report."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_PATTERN = r"[\p{L}\p{N}]+"


def distinct_words(text: Column, pattern: str = WORD_PATTERN) -> Column:
    """Array of the distinct lower-case words of a text, computed inside the JVM."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"({pattern})"), 1))


def register_word_function(spark: SparkSession, name: str = "distinct_words", pattern: str = WORD_PATTERN) -> None:
    """The same as a table function for SQL text: ``FROM t, LATERAL distinct_words(t.item)``.

    It is a SQL function, so the plan holds a plain explode and no Python.
    """
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(words_of STRING) RETURNS TABLE (keyword STRING) "
        f"RETURN SELECT explode(array_distinct(regexp_extract_all(lower(words_of), r'({pattern})', 1)))"
    )


#: Code points that one step of the segmenter holds, and words that a list may have.
WINDOW = 1 << 18
MAX_WORDS = 1_000_000
_CODES = 1 << 21


class _Trie(NamedTuple):
    """Edges sorted by (state, code point); the n-th edge leads to state n + 1. ``ends``: a word ends in the state."""

    edges: np.ndarray
    ends: np.ndarray
    longest: int


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)


def _trie(words: Iterable[str]) -> _Trie:
    """Built level by level, so that states, and with them the edges of all levels together, ascend."""
    spelt = sorted({word for word in words if word and not any(c.isspace() for c in word)}, key=len)
    size = np.array([len(word) for word in spelt], np.int64)
    codes, start = _codes("".join(spelt)), np.cumsum(size) - size
    state = np.zeros(len(spelt), np.int64)
    levels, ends, states = [], [np.zeros(1, bool)], 1
    for depth in range(int(size.max(initial=0))):
        left = size > depth
        start, size, state = start[left], size[left], state[left]
        edges, at = np.unique(state * _CODES + codes[start + depth], return_inverse=True)
        state = states + at
        found = np.zeros(len(edges), bool)
        found[at[size == depth + 1]] = True
        levels.append(edges)
        ends.append(found)
        states += len(edges)
    return _Trie(np.concatenate([np.zeros(0, np.int64), *levels]), np.concatenate(ends), len(levels))


def _longest(trie: _Trie, codes: np.ndarray) -> np.ndarray:
    """Length of the longest word that begins at each place, 1 where none does; all places step together."""
    best = np.ones(len(codes), np.int64)
    at, state = np.arange(len(codes)), np.zeros(len(codes), np.int64)
    for depth in range(min(trie.longest, len(codes))):
        inside = at + depth < len(codes)
        at, state = at[inside], state[inside]
        wanted = state * _CODES + codes[at + depth]
        edge = np.searchsorted(trie.edges, wanted)
        hit = trie.edges[np.minimum(edge, len(trie.edges) - 1)] == wanted
        at, state = at[hit], edge[hit] + 1
        if not len(at):
            break
        best[at[trie.ends[state]]] = depth + 1
    return best


def _segments(trie: _Trie, texts: list[str]) -> list[list[str]]:
    """Distinct segments of each text, in order. Blanks part words and are none."""
    joined = "\n".join(texts)
    stops = np.cumsum([len(text) + 1 for text in texts]).tolist()
    found: list[dict[str, None]] = [{} for _ in texts]
    at = row = 0
    for begin in range(0, len(joined), WINDOW):
        # Words that begin in the window may end behind it.
        end = min(begin + WINDOW, len(joined))
        sizes = _longest(trie, _codes(joined[begin : end + trie.longest]))[: end - begin].tolist()
        while at < end:
            size = sizes[at - begin]
            while at >= stops[row]:
                row += 1
            segment = joined[at : at + size]
            if not segment.isspace():
                found[row][segment] = None
            at += size
    return [list(words) for words in found]


def word_list(words: DataFrame, column: str, limit: int = MAX_WORDS) -> list[str]:
    """The distinct lower-case words of a table, for ``dictionary_words``; NULL and empty words are none.

    The list travels to every task, so a table of more than ``limit`` words is an error, which is found
    before more than ``limit`` words reach the driver.
    """
    rows = words.select(F.lower(column).alias("word")).where("word <> ''").distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} words; a word list goes to every task")
    return sorted(row.word for row in rows)


def dictionary_words(dictionary: Iterable[str], pattern: str = WORD_PATTERN) -> Callable[[Column], Column]:
    """Distinct words of text without blanks between words: at each place the longest word of a list.

    Runs of the pattern's characters are cut within the JVM; a trie over the list then steps through all
    places of a batch at once. A character that begins no word stands alone; words that hold blanks are passed over.
    NULL gives NULL.
    """
    trie = _trie(word.lower() for word in dictionary)

    @F.pandas_udf("array<string>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for runs in batches:
            given = runs.notna().to_numpy()
            words = iter(_segments(trie, runs[given].tolist()))
            yield pd.Series([next(words) if there else None for there in given], dtype=object)

    return lambda text: cut(F.array_join(F.regexp_extract_all(F.lower(text), F.lit(f"({pattern})"), 1), " "))
