"""The first four bytes of the MD5 of many short words, by numpy: hashing word by word took most of an embedding."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

#: Words of fewer bytes fill one block of MD5; longer ones are left to hashlib.
_ONE_BLOCK = 56
#: So many words are hashed at once; their blocks take 64 bytes each, twice.
_WORDS_AT_ONCE = 1 << 15
_SINES = np.floor(np.abs(np.sin(np.arange(1, 65))) * 2.0**32).astype(np.uint32)
_TURNS = np.array([7, 12, 17, 22] * 4 + [5, 9, 14, 20] * 4 + [4, 11, 16, 23] * 4 + [6, 10, 15, 21] * 4, np.uint32)
_START = [np.uint32(x) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]


def first_of_md5(words: pa.Array) -> np.ndarray:
    """The first four bytes of each word's MD5, as a number with the largest byte first; no word is null."""
    words = words.cast(pa.large_binary())
    _, positions, values = words.buffers()
    if not len(words):
        return np.zeros(0, np.uint32)
    offsets = np.frombuffer(positions, np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    out = np.empty(len(words), np.uint32)
    for a in range(0, len(words), _WORDS_AT_ONCE):
        part = offsets[a:a + _WORDS_AT_ONCE + 1]
        lengths = np.diff(part)
        out[a:a + len(lengths)] = _hashed(data[part[0]:part[-1]], lengths)
        for i in np.flatnonzero(lengths >= _ONE_BLOCK):
            word = data[part[i]:part[i + 1]].tobytes()
            out[a + i] = int.from_bytes(hashlib.md5(word, usedforsecurity=False).digest()[:4], "little")
    return out.byteswap()


def _hashed(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The first word of MD5's state for spans of fewer than 56 bytes; for longer ones anything."""
    n = len(lengths)
    short = np.minimum(lengths, _ONE_BLOCK - 1)
    blocks = np.zeros((n, 64), np.uint8)
    of = np.repeat(np.arange(n), lengths)
    at = np.arange(len(data)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    inside = at < _ONE_BLOCK - 1
    blocks[of[inside], at[inside]] = data[inside]
    blocks[np.arange(n), short] = 0x80
    message = np.ascontiguousarray(blocks.view("<u4").T)
    message[14] = short * 8
    a, b, c, d = (np.full(n, x, np.uint32) for x in _START)
    for i in range(64):
        if i < 16:
            f, g = d ^ (b & (c ^ d)), i
        elif i < 32:
            f, g = c ^ (d & (b ^ c)), (5 * i + 1) % 16
        elif i < 48:
            f, g = b ^ c ^ d, (3 * i + 5) % 16
        else:
            f, g = c ^ (b | ~d), 7 * i % 16
        f = f + a + _SINES[i] + message[g]
        a, d, c, b = d, c, b, b + ((f << _TURNS[i]) | (f >> (np.uint32(32) - _TURNS[i])))
    return a + _START[0]
