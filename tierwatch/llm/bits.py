"""Bitmaps with rank directories, as numpy arrays; runs inside tasks only."""

from __future__ import annotations

import numpy as np

_U = np.uint64


def directory(flags: np.ndarray) -> dict[str, np.ndarray]:
    """Bits in 64-bit words, with the counts before each 512 bits (``blocks``) and, within those, each 64 (``words``)."""
    n_words = (len(flags) // 512 + 1) * 8
    padded = np.zeros(n_words * 64, bool)
    padded[:len(flags)] = flags
    bits = np.packbits(padded, bitorder="little").view("<u8")
    ones = np.bitwise_count(bits).astype(np.int64)
    before = np.cumsum(ones) - ones
    blocks = before[::8]
    return {"bits": bits, "blocks": blocks.astype("<u8"), "words": (before - np.repeat(blocks, 8)).astype("<u2")}


def rank(bits: np.ndarray, blocks: np.ndarray, words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each bit is set, and how many set bits are before it."""
    word, bit = at >> 6, (at & 63).astype(_U)
    found = bits[word]
    below = np.bitwise_count(found & ((_U(1) << bit) - _U(1)))
    return (found >> bit) & _U(1) == 1, blocks[at >> 9].astype(np.int64) + words[word] + below
