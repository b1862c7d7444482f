"""Whole Arrow string columns as one byte buffer, and words in it by numpy."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

SPACES = np.zeros(256, dtype=bool)
SPACES[[32, *range(9, 14)]] = True

# ASCII letters and digits
ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = True

_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xFF51AFD7ED558CCD)
_M2 = np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type):
        texts = pc.fill_null(texts, "")
    else:
        texts = pc.fill_null(texts, b"")
    texts = texts.cast(pa.large_binary())
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_in(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, breaks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): runs of bytes that are word bytes (``inside``
    is a mask over ``data``), never across texts nor over a place in
    ``breaks``; words of text d are ``first[d]:first[d + 1]``."""
    n = len(data)
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    if breaks is not None:
        cut[breaks] = True
    before = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    before &= ~cut[:-1]
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(n, dtype=bool)
    after[:-1] = inside[1:]
    after &= ~cut[1:]
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    """Of every code point: 0 outside words, 1 within words (letters, marks,
    numbers), 2 a word of its own (those of scripts without spaces)."""
    import regex

    points = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    table = np.zeros(0x110000, np.uint8)
    scripts = "".join(rf"\p{{{s}}}" for s in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar"))
    for kind, pattern in ((1, r"[\p{L}\p{M}\p{N}]+"), (2, rf"(?V1)[[{scripts}]&&[\p{{L}}\p{{M}}\p{{N}}]]+")):
        for m in regex.finditer(pattern, points):
            table[np.frombuffer(m.group().encode("utf-32-le"), np.uint32)] = kind
    return table


def unicode_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, first) of the words of every text, in lower case
    by Unicode's simple mapping: runs of letters, marks and numbers, single
    characters in scripts that are written without spaces."""
    data, offsets = buffer_of(pc.utf8_lower(texts))
    inside = ALNUM[data]
    lead = np.flatnonzero(data >= 0xC0)
    if not len(lead):
        return data, *words_in(data, offsets, inside)
    point = data[lead].astype(np.int32)
    width = 2 + (point >= 0xE0) + (point >= 0xF0)
    point &= 0x7F >> width
    for k in (1, 2, 3):
        more = np.flatnonzero(width > k)
        point[more] = point[more] << 6 | data[lead[more] + k] & 0x3F
    kind = _kinds()[point]
    for k in range(4):
        inside[lead[(kind > 0) & (width > k)] + k] = True
    alone = np.flatnonzero(kind == 2)
    return data, *words_in(data, offsets, inside, np.concatenate([lead[alone], lead[alone] + width[alone]]))


def mix64(h: np.ndarray) -> np.ndarray:
    """The public 64-bit finaliser of MurmurHash3."""
    h = (h ^ (h >> _S33)) * _M1
    h = (h ^ (h >> _S33)) * _M2
    return h ^ (h >> _S33)


_BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * _ODD)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, 1 << 16)
        up = np.full(size, _ODD)
        up[0] = 1
        down = np.full(size, np.uint64(pow(int(_ODD), -1, 1 << 64)))
        down[0] = 1
        _POWERS["up"], _POWERS["down"] = np.cumprod(up), np.cumprod(down)
    return _POWERS["up"], _POWERS["down"]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial hash, for :func:`span_hash`."""
    up, _ = _powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every span of bytes, the same wherever it stands."""
    _, down = _powers(len(prefix))
    return mix64((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans, ascending and apart, as an Arrow binary array."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    step = np.zeros(len(data) + 1, np.int8)
    step[starts] += 1
    step[ends] -= 1  # zero where one span ends and the next begins
    inside = np.cumsum(step[:-1], dtype=np.int8).view(bool)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])


def to_bytes(values: pa.Array) -> list[bytes]:
    """The elements of a binary array."""
    data, offsets = buffer_of(values)
    raw, at = data.tobytes(), offsets.tolist()
    return [raw[a:b] for a, b in zip(at, at[1:])]
