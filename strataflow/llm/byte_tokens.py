"""Byte-level token ids of whole texts, from a public rank file."""

from __future__ import annotations

import base64
import re

import numpy as np

#: Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Runs of white space (the characters that the pattern's ``\\s`` stands for) that are cut out of a text before the pattern sees
#: it: its look-ahead runs out of stack on long ones.
LONG_RUN = 4096
_LONG = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class ByteTokens:
    """Encodes texts; ``width`` has the bytes of each id."""

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken

        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.width = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
        for token, rank in ranks.items():
            self.width[rank] = len(token)

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of one whole text. Strings of control tokens in it are ordinary text.

        A long run of white space is one piece by the pattern's own rule, but for its last character if more text
        follows; that one goes with what follows. So the ids are those of the text in one go.
        """
        if not text:
            return np.zeros(0, np.uint32)
        parts, at = [], 0
        for run in _LONG.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            parts.append(self.encoding.encode_to_numpy(text[at : run.start()], disallowed_special=()))
            parts.append(np.array(self.encoding._encode_single_piece(text[run.start() : end].encode()), np.uint32))
            at = end
        if not parts:
            return self.encoding.encode_to_numpy(text, disallowed_special=())
        parts.append(self.encoding.encode_to_numpy(text[at:], disallowed_special=()))
        return np.concatenate(parts)
