"""SentencePiece encoding and decoding: Unigram Viterbi over a double-array trie of scored pieces."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strataflow.llm.shared import id_and_text, small_batches

MARK = "▁"
#: What an unknown character costs beyond the worst piece, as in the published Unigram model.
UNKNOWN_PENALTY = 10.0
#: Most segments a worker remembers, and code points it encodes at once.
REMEMBERED = 300_000
CHUNK = 1 << 18


class Vocabulary(NamedTuple):
    """Pieces by id, and a double-array trie of the normal ones over dense character codes."""

    pieces: list[str]
    scores: np.ndarray
    byte_ids: np.ndarray  # id of each byte's piece, or -1
    byte_of: np.ndarray  # byte of each piece, or -1
    control: np.ndarray  # pieces that decode to nothing
    unknown: int
    unknown_score: float
    codes: np.ndarray  # character code of each code point, 0 for those in no piece
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray  # piece id at a node, or -1
    longest: int
    splits_words: bool  # no piece has a mark after another character


def double_array(words: dict[tuple[int, ...], int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``base, check, value`` of the trie: child ``c`` of ``s`` is ``base[s] + c`` if ``check`` there is ``s``."""
    children: list[dict[int, int]] = [{}]
    ids = [-1]
    for word, word_id in words.items():
        node = 0
        for code in word:
            if code not in children[node]:
                children[node][code] = len(children)
                children.append({})
                ids.append(-1)
            node = children[node][code]
        ids[node] = word_id
    size = 2 * len(children) + max((max(c, default=0) for c in children), default=0) + 2
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    taken = np.zeros(size, bool)
    taken[0] = True
    value[0] = ids[0]
    place = {0: 0}
    free = 1
    queue = [0]
    for node in queue:
        codes = np.fromiter(sorted(children[node]), np.int64, len(children[node]))
        if not len(codes):
            continue
        while taken[free]:
            free += 1
        # Bases may be negative, so the first child can take any free place; look through windows of them.
        low, at = free, None
        while at is None:
            if low + 4096 + int(codes[-1]) >= len(taken):
                grow = len(taken) + int(codes[-1]) + 4096
                base, check, value, taken = (np.concatenate([x, np.full(grow, fill, x.dtype)]) for x, fill in ((base, 0), (check, -1), (value, -1), (taken, False)))
            spots = low + np.nonzero(~taken[low : low + (4096 if len(codes) > 1 else 64)])[0]
            fits = np.nonzero(~taken[spots[:, None] - codes[0] + codes].any(axis=1))[0] if len(codes) > 1 else np.arange(len(spots))
            if len(fits):
                at = int(spots[fits[0]] - codes[0])
            low += 4096 if len(codes) > 1 else 64
        here = place.pop(node)
        base[here] = at
        for code in codes.tolist():
            child = children[node][code]
            spot = at + code
            taken[spot], check[spot], value[spot], place[child] = True, here, ids[child], spot
        queue.extend(children[node].values())
    return base, check, value


def vocabulary(pieces: list[tuple[str, float, str]]) -> Vocabulary:
    """From (piece, score, kind) by id; kinds are normal, byte, control, unknown and unused."""
    normal = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == "normal" and p}
    alphabet = {c: k + 1 for k, c in enumerate(sorted({c for p in normal for c in p}))}
    codes = np.zeros(0x110000, np.int32)
    for c, k in alphabet.items():
        codes[ord(c)] = k
    base, check, value = double_array({tuple(alphabet[c] for c in p): i for p, i in normal.items()})
    scores = np.array([s for _, s, _ in pieces], np.float64)
    byte_ids, byte_of = np.full(256, -1, np.int32), np.full(len(pieces), -1, np.int32)
    for i, (p, _, kind) in enumerate(pieces):
        if kind == "byte":
            byte_ids[int(p[3:5], 16)], byte_of[i] = i, int(p[3:5], 16)
    worst = min((scores[i] for i in normal.values()), default=0.0)
    return Vocabulary(
        [p for p, _, _ in pieces], scores, byte_ids, byte_of, np.array([kind == "control" for _, _, kind in pieces], bool),
        next((i for i, (_, _, kind) in enumerate(pieces) if kind == "unknown"), 0), worst - UNKNOWN_PENALTY, codes, base, check, value,
        max(map(len, normal), default=1), not any(re.search(f"[^{MARK}]{MARK}", p) for p in normal),
    )


def read_model(path: str) -> list[tuple[str, float, str]]:
    """The pieces of a model file, read on the driver once; their number bounds what tasks receive."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def kind(i: int) -> str:
        tests = (("byte", model.is_byte), ("control", model.is_control), ("unknown", model.is_unknown), ("unused", model.is_unused))
        return next((name for name, test in tests if test(i)), "normal")

    return [(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.get_piece_size())]


def viterbi(v: Vocabulary, texts: list[str]) -> list[list[int]]:
    """Piece ids of the best-scored division of each text, with unknown characters as bytes.

    All texts advance together: the trie is walked from every position at once, one character a
    step, and position p of every text is settled from the matches that end there. Of equally good
    divisions the one whose last piece is longest wins.
    """
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    total = len(points)
    codes = v.codes[points].astype(np.int64)
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    text_of = np.repeat(np.arange(len(texts)), lengths)
    left = (first + lengths)[text_of] - np.arange(total)  # characters from here to the text's end
    starts, sizes, ids = [np.arange(total)], [np.ones(total, np.int64)], [np.full(total, -1, np.int64)]
    at, node = np.arange(total), np.zeros(total, np.int64)
    known = np.zeros(total, bool)
    for depth in range(v.longest):
        inside = left[at] > depth
        at, node = at[inside], node[inside]
        code = codes[at + depth]
        step = v.base[node] + code
        hit = (code > 0) & (step >= 0) & (step < len(v.check))
        hit[hit] = v.check[step[hit]] == node[hit]
        at, node = at[hit], step[hit]
        if not len(at):
            break
        found = v.value[node]
        ok = found >= 0
        starts.append(at[ok])
        sizes.append(np.full(ok.sum(), depth + 1))
        ids.append(found[ok].astype(np.int64))
        if depth == 0:
            known[at[ok]] = True
    starts[0], sizes[0], ids[0] = starts[0][~known], sizes[0][~known], ids[0][~known]
    start, size, piece = np.concatenate(starts), np.concatenate(sizes), np.concatenate(ids)
    score = np.where(piece < 0, v.unknown_score, v.scores[np.maximum(piece, 0)])
    # best[p + text]: score up to before position p; each text has one place more than characters.
    slot = start + text_of[start]
    end = slot + size
    height = (start + size) - first[text_of[start]]
    order = np.lexsort((start, end, height))
    slot, end, size, piece, score, height = (x[order] for x in (slot, end, size, piece, score, height))
    best = np.zeros(total + len(texts))
    take, back = np.full(total + len(texts), -1, np.int64), np.zeros(total + len(texts), np.int64)
    bounds = np.searchsorted(height, np.arange(1, (height.max() if len(height) else 0) + 2))
    for low, high in zip(bounds[:-1], bounds[1:]):
        if low == high:
            continue
        sums = best[slot[low:high]] + score[low:high]
        goal = end[low:high]
        head = np.nonzero(np.concatenate([[True], goal[1:] != goal[:-1]]))[0]
        top = np.maximum.reduceat(sums, head)
        group = np.cumsum(np.concatenate([[0], (goal[1:] != goal[:-1]).astype(np.int64)]))
        won = np.nonzero(sums == top[group])[0]
        won = won[np.concatenate([[True], group[won][1:] != group[won][:-1]])]
        best[goal[won]], take[goal[won]], back[goal[won]] = top, piece[low:high][won], size[low:high][won]
    # Walk back from all ends at once.
    cursor = first + np.arange(len(texts)) + lengths
    floor = first + np.arange(len(texts))
    row = np.arange(len(texts))
    seen_row, seen_at, seen_piece = [], [], []
    while len(row):
        open_ = cursor > floor[row]
        row, cursor = row[open_], cursor[open_]
        if not len(row):
            break
        seen_row.append(row)
        seen_at.append(cursor - back[cursor])
        seen_piece.append(take[cursor])
        cursor = cursor - back[cursor]
    out: list[list[int]] = [[] for _ in texts]
    if not seen_row:
        return out
    row, where, piece = np.concatenate(seen_row), np.concatenate(seen_at), np.concatenate(seen_piece)
    order = np.argsort(where, kind="stable")
    for r, w, p in zip(row[order].tolist(), where[order].tolist(), piece[order].tolist()):
        if p >= 0:
            out[r].append(p)
        elif v.byte_ids[0] >= 0:
            out[r].extend(v.byte_ids[list(chr(points[w - r]).encode())].tolist())
        else:
            out[r].append(v.unknown)
    return out


def segments(v: Vocabulary, text: str, dummy_prefix: bool = True) -> list[str]:
    """The marked text, cut where no piece can reach across: before each run of marks."""
    if not text:
        return []
    if not v.splits_words:
        return [(MARK if dummy_prefix else "") + text.replace(" ", MARK)]
    if dummy_prefix and "  " not in text and MARK not in text and text[0] != " " and text[-1] != " ":
        return (MARK + text.replace(" ", " " + MARK)).split(" ")
    return re.findall(f"{MARK}*[^{MARK}]+|{MARK}+", (MARK if dummy_prefix else "") + text.replace(" ", MARK))


class Encoder:
    """Encodes texts by segments and remembers a bounded number of them."""

    def __init__(self, v: Vocabulary, dummy_prefix: bool = True):
        self.v, self.dummy_prefix = v, dummy_prefix
        self.known: dict[str, int] = {}
        self.flat, self.start, self.length = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _learn(self, new: list[str]) -> None:
        flat, lengths, chunk, size = [], [], [], 0
        for k, segment in enumerate(new):
            chunk.append(segment)
            size += len(segment)
            if size >= CHUNK or k == len(new) - 1:
                for ids in viterbi(self.v, chunk):
                    flat.extend(ids)
                    lengths.append(len(ids))
                chunk, size = [], 0
        lengths = np.array(lengths, np.int64)
        begin = len(self.flat) + np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else np.zeros(0, np.int64)
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        self.flat = np.concatenate([self.flat, np.array(flat, np.int32)])
        self.start, self.length = np.concatenate([self.start, begin.astype(np.int64)]), np.concatenate([self.length, lengths])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and the number of each text's ids."""
        if len(self.known) > REMEMBERED:
            self.__init__(self.v, self.dummy_prefix)
        cut = [segments(self.v, t or "", self.dummy_prefix) for t in texts]
        new = list(dict.fromkeys(s for part in cut for s in part if s not in self.known))
        if new:
            self._learn(new)
        look = np.fromiter((self.known[s] for part in cut for s in part), np.int64)
        n = self.length[look]
        ends = np.cumsum(n)
        spots = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n) + np.repeat(self.start[look], n)
        owner = np.repeat(np.arange(len(texts)), [len(part) for part in cut])
        return self.flat[spots], np.bincount(owner, weights=n, minlength=len(texts)).astype(np.int64)


def decode(v: Vocabulary, ids, dummy_prefix: bool = True) -> str:
    """The text of ids: marks become blanks, runs of bytes UTF-8; the dummy prefix goes."""
    out = bytearray()
    for i in ids:
        if v.byte_of[i] >= 0:
            out.append(v.byte_of[i])
        elif i == v.unknown:
            out += " ⁇ ".encode()
        elif not v.control[i]:
            out += v.pieces[i].encode()
    text = out.decode("utf-8", "replace").replace(MARK, " ")
    return text[1:] if dummy_prefix and text.startswith(" ") else text


def encode_documents(docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", dummy_prefix: bool = True) -> DataFrame:
    """``doc_id, ids, n_tokens, n_byte_tokens, round_trip`` for every row of ``docs``.

    ``round_trip`` says that the ids decode to the text again; a text with U+2581, which the model
    family itself cannot tell from a blank, must give its blanks. NULL and empty texts have no ids and round-trip to the
    empty text. Rows with NULL ids, repeated rows and other columns need no care: nothing is shuffled.
    Whole texts are encoded, of any length; a worker remembers a bounded number of segments.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(vocabulary(read_model(model_path)))
    given = id_and_text(docs, key, text)
    shape = f"doc_id {given.schema['doc_id'].dataType.simpleString()}, ids array<int>, n_tokens bigint, n_byte_tokens bigint, round_trip boolean"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        encoder = Encoder(v, dummy_prefix)
        raw = [b"" if v.control[i] else p.replace(MARK, " ").encode() for i, p in enumerate(v.pieces)]
        raw[v.unknown] = " ⁇ ".encode()
        for i in np.nonzero(v.byte_of >= 0)[0]:
            raw[i] = bytes([v.byte_of[i]])
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids, sizes = encoder.encode(texts)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            is_byte = np.concatenate([[0], np.cumsum(v.byte_of[ids] >= 0)])
            same = []
            for k, t in enumerate(texts):
                back = b"".join(map(raw.__getitem__, ids[ends[k] : ends[k + 1]].tolist())).decode("utf-8", "replace")
                back = back[1:] if dummy_prefix and back.startswith(" ") else back
                same.append(back == (t or "").replace(MARK, " "))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())), pa.array(sizes),
                 pa.array(is_byte[ends[1:]] - is_byte[ends[:-1]], pa.int64()), pa.array(same, pa.bool_())],
                names=["doc_id", "ids", "n_tokens", "n_byte_tokens", "round_trip"],
            )

    return given.mapInArrow(encode, shape)
