"""Pre-tokens of byte-level BPE by numpy over whole columns.

Gives the matches of the public split pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

as runs of character classes: a run of white space gives up its last
character to what follows (joined to it if it is a space), and an
apostrophe that stands alone takes a contraction's letters.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

from trainprep.llm import textbytes as tb

SPACE, LETTER, NUMBER, OTHER = range(4)
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point."""
    import regex

    points = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    table = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, points):
            a, b = ord(m.group()[0]), ord(m.group()[-1])
            table[a : b + 1] = kind
    table[0xD800:0xE000] = OTHER
    return table


def pretokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(pre-tokens of all texts as bytes, first pre-token of each text)."""
    data, offsets = tb.buffer_of(texts)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(points)
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    place = np.zeros(n + 1, np.int64)
    np.cumsum(width, out=place[1:])
    cut = np.zeros(n + 1, bool)
    cut[np.searchsorted(place, offsets)] = True
    kind = classes()[points]
    start = np.ones(n + 1, bool)
    start[1:n] = kind[1:] != kind[:-1]
    start |= cut
    runs = np.flatnonzero(start[:n])
    ends = np.append(runs[1:], n)[: len(runs)]
    edge = start.copy()

    white = kind[runs] == SPACE
    inner = white & ~cut[ends]
    edge[ends[inner] - 1] = True
    joined = inner & (points[np.maximum(ends - 1, 0)] == 0x20)
    edge[ends[joined]] = False

    # a lone apostrophe, not joined to a space, before letters of the same text
    quote = (kind[runs] == OTHER) & (ends - runs == 1) & (points[runs] == 0x27) & edge[runs] & ~cut[ends] if n else np.empty(0, bool)
    at = np.flatnonzero(quote)
    at = at[at + 1 < len(runs)]
    at = at[kind[runs[at + 1]] == LETTER]
    a, b = runs[at + 1], ends[at + 1]
    one = np.isin(points[a], [ord(c) for c in ONE_LETTER])
    second = points[np.minimum(a + 1, n - 1)] if n else points
    two = np.zeros(len(at), bool)
    for pair in TWO_LETTERS:
        two |= (points[a] == ord(pair[0])) & (second == ord(pair[1])) & (b - a >= 2)
    took = np.where(one, 1, np.where(two, 2, 0))
    hit = took > 0
    edge[a[hit]] = False
    edge[a[hit] + took[hit]] = True

    bounds = place[np.flatnonzero(edge[:n])]
    first = np.searchsorted(bounds, offsets)
    bounds = np.append(bounds, len(data)).astype(np.int64)
    pieces = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
    return pieces, first


def spread(flat: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows ``codes`` of a ragged table (``flat`` cut by ``sizes``), end
    to end; with the offset of each."""
    begin = np.cumsum(sizes) - sizes
    lengths = sizes[codes]
    offsets = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return flat[np.arange(offsets[-1]) + np.repeat(begin[codes] - offsets[:-1], lengths)], offsets


class Recent:
    """What was computed for the pieces seen lately: two generations of at
    most ``size`` entries, the older dropped when the newer is full."""

    def __init__(self, size: int) -> None:
        self.size, self.new, self.old = size, {}, {}

    def __getstate__(self):
        return {"size": self.size, "new": {}, "old": {}}

    def get(self, piece: bytes):
        value = self.new.get(piece)
        if value is None:
            value = self.old.get(piece)
            if value is not None:
                self.put(piece, value)
        return value

    def put(self, piece: bytes, value) -> None:
        if len(self.new) >= self.size:
            self.new, self.old = {}, self.new
        self.new[piece] = value
