"""Words of Arrow text batches as numpy arrays; runs inside tasks only.

Texts are taken as the UTF-8 bytes of an Arrow batch. A word class is a table of 256
byte flags, so that every byte from 0x80 on is either a word byte or not; the classes used
here separate on ASCII only, where bytes and characters agree. Words never cross rows.

Spans get 64-bit polynomial hashes with a finaliser. Blocks of a few MB bound the memory
that hashing needs, whatever the length of a text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tierwatch.functions.memory import give_back

CHUNK_BYTES = 1 << 19
HASH_BYTES = 1 << 18

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C55)
_BASE_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def giving_back(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """What ``run`` makes of a group; the memory goes back once its own names are gone."""
    def call(group: pa.Table) -> pa.Table:
        made = run(group)
        give_back()
        return made
    return call


def byte_class(ranges: list[tuple[int, int]]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


SPACES = byte_class([(0x20, 0x20), (0x09, 0x0D)])
#: ``[^\x20\x09-\x0D]+``
NOT_SPACE = ~SPACES
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z: digits, a-z and all that is not ASCII
LETTERS = byte_class([(0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of the base and of its inverse, grown to the longest block seen."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, _U)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            factors = np.full(size, _BASE), np.full(size, _BASE_INVERSE)
            for f in factors:
                f[0] = 1
                np.multiply.accumulate(f, out=f)
            self.up, self.down = factors
        return self.up, self.down


_POWERS = _Powers()


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span; spans are in order and do not overlap."""
    out = np.zeros(len(starts), _U)
    first = 0
    while first < len(starts):
        base = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, base + HASH_BYTES, "right")))
        block = data[base:ends[last - 1]]
        up, down = _POWERS.to(len(block) + 1)
        sums = np.zeros(len(block) + 1, _U)
        np.cumsum((block.astype(_U) + _U(1)) * up[:len(block)], out=sums[1:])
        a, b = starts[first:last] - base, ends[first:last] - base
        out[first:last] = mix((sums[b] - sums[a]) * down[a] + (b - a).astype(_U) * _U(0xD6E8FEB86659FD93))
        first = last
    return out


@dataclass
class Words:
    """Words of some texts: byte spans in ``data``, hashes, and the first word of each text."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray

    def rows(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text array; a null is an empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, positions, values = texts.buffers()
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(positions, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(values, np.uint8)[offsets[0]:offsets[-1]] if values is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Slices of about ``limit`` bytes (one text at least), with their first row."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets = raw(texts)
    row = 0
    while row < len(texts):
        until = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        until = min(max(until, row + 1), len(texts))
        yield row, texts.slice(row, until - row)
        row = until
    pa.default_memory_pool().release_unused()


def spans(flags: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of flagged bytes, cut where a text begins."""
    edge = np.zeros(len(flags) + 1, bool)
    edge[offsets] = True
    opens, closes = flags.copy(), flags.copy()
    opens[1:] &= ~flags[:-1] | edge[1:-1]
    closes[:-1] &= ~flags[1:] | edge[1:-1]
    return np.flatnonzero(opens), np.flatnonzero(closes) + 1


def words(texts: pa.Array, table: np.ndarray, lower: bool) -> Words:
    data, offsets = raw(texts)
    if lower:
        data = _LOWER[data]
    starts, ends = spans(table[data], offsets) if len(data) else (np.zeros(0, np.int64),) * 2
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets), hash_spans(data, starts, ends))


def windows(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words within a text, and the index of its first word."""
    n = len(found.hashes) - size + 1
    if n <= 0:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    total = np.zeros(n, _U)
    for j in range(size):
        total = total * _BASE + found.hashes[j:j + n]
    rows = found.rows()
    inside = np.flatnonzero(rows[:n] == rows[size - 1:])
    return mix(total[inside]), inside


def count_between(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each text."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[offsets])


def of_row(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Keys that are told apart by row as well."""
    return mix(keys + mix(rows.astype(_U) + _U(1)))
