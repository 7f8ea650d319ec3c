"""Token counts per section: documents are encoded once, token spans joined to section spans."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strataflow.llm.byte_tokens import ByteTokens, read_ranks
from strataflow.llm.shared import column, id_and_text, small_batches

SECTIONS = "array<struct<name: string, start: int, end: int>>"


def attribute(begin: np.ndarray, end: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token span, -1 for none, and whether the token crosses a boundary.

    Spans are in bytes; sections are in order and do not overlap. A token goes to the section that holds most of its
    bytes, the earlier one at a tie; a token outside all sections to none.
    """
    if not len(starts) or not len(begin):
        return np.full(len(begin), -1), np.zeros(len(begin), bool)
    low = np.maximum(np.searchsorted(stops, begin, side="right"), 0)
    high = np.searchsorted(starts, end, side="left") - 1  # last section that begins before the token's end
    owner = np.where(low <= high, low, -1)
    inside = owner >= 0
    held = np.zeros(len(begin), np.int64)
    held[inside] = np.minimum(end[inside], stops[low[inside]]) - np.maximum(begin[inside], starts[low[inside]])
    crosses = inside & (held < end - begin)
    for step in range(1, int((high - low).max()) + 1 if inside.any() else 0):
        more = np.nonzero(low + step <= high)[0]
        s = low[more] + step
        share = np.minimum(end[more], stops[s]) - np.maximum(begin[more], starts[s])
        better = share > held[more]
        owner[more[better]], held[more[better]] = s[better], share[better]
    return owner, crosses


def token_counts(docs: DataFrame, ranks_path: str, key: str = "doc_id", text: str = "text", sections: str | None = None) -> DataFrame:
    """``doc_id, section, n_chars, n_tokens, n_crossing`` for every section of every row of ``docs``.

    ``sections`` names a column of type ``SECTIONS`` with spans in code points; without it each
    line is a section, named by its number from 0, its line break included. Tokens that no section
    holds are counted under the section NULL (no such row if there are none). A token over a boundary goes to the
    section with most of its bytes, the earlier one at a tie; ``n_crossing`` counts those that a
    section got. The counts of a document always sum to its tokens. NULL texts have no rows, an
    empty text has one empty line. NULL or overlapping spans: NULL ones are dropped, and of
    overlapping ones the part after the earlier span's end counts. Repeated rows are counted each. Nothing is shuffled.
    """
    spark = docs.sparkSession
    small_batches(spark)
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))  # as large as the vocabulary
    given = id_and_text(docs, key, text)
    if sections:
        given = docs.select(column(docs, key).alias("doc_id"), column(docs, text).alias("text"), column(docs, sections).cast(SECTIONS).alias("spans"))
    shape = f"doc_id {given.schema['doc_id'].dataType.simpleString()}, section string, n_chars bigint, n_tokens bigint, n_crossing bigint"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ByteTokens(ranks.value)
        for batch in batches:
            rows, names, chars, tokens, crossing = [], [], [], [], []
            spans = batch.column(2).to_pylist() if sections else None
            for k, value in enumerate(batch.column(1).to_pylist()):
                if value is None:
                    continue
                width = coder.width[coder.encode(value)]
                end = np.cumsum(width)
                raw = np.frombuffer(value.encode(), np.uint8)
                if sections:
                    place = np.concatenate([np.nonzero((raw & 0xC0) != 0x80)[0], [len(raw)]])
                    own = sorted((s["start"], s["end"], s["name"]) for s in spans[k] or [] if s and s["start"] is not None and s["end"] is not None)
                    label = [s[2] for s in own]
                    starts = place[np.clip([s[0] for s in own], 0, len(place) - 1).astype(int)]
                    stops = place[np.clip([s[1] for s in own], 0, len(place) - 1).astype(int)]
                    stops = np.maximum.accumulate(np.maximum(stops, starts)) if len(own) else stops
                    starts = np.maximum(starts, np.concatenate([[0], stops[:-1]])) if len(own) else starts
                else:
                    breaks = np.nonzero(raw == 10)[0] + 1
                    starts, stops = np.concatenate([[0], breaks]), np.concatenate([breaks, [len(raw)]])
                    label = [str(n) for n in range(len(starts))]
                owner, crosses = attribute(end - width, end, starts, stops)
                n = np.bincount(owner + 1, minlength=len(label) + 1)
                over = np.bincount(owner[crosses] + 1, minlength=len(label) + 1)
                letters = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                rows.extend([k] * len(label))
                names.extend(label)
                chars.extend((letters[stops] - letters[starts]).tolist())
                tokens.extend(n[1:].tolist())
                crossing.extend(over[1:].tolist())
                if n[0]:
                    rows.append(k)
                    names.append(None)
                    chars.append(int(letters[-1] - (letters[stops] - letters[starts]).sum()))
                    tokens.append(int(n[0]))
                    crossing.append(int(over[0]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(names, pa.string()), pa.array(chars, pa.int64()), pa.array(tokens, pa.int64()), pa.array(crossing, pa.int64())],
                names=["doc_id", "section", "n_chars", "n_tokens", "n_crossing"],
            )

    return given.mapInArrow(count, shape)
