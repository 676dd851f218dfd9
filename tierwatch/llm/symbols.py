"""Words as numbers: exact dictionaries of Arrow text batches, and packed blocks of word tuples.

A *chunk* is some MB of whole texts that a task works on at once. Within a chunk a word is the
number of its place in the chunk's dictionary, found by its bytes, not by a hash. What tasks hand on
are *blocks*: columns of such numbers, with the words that occur in them. Blocks of different chunks are put
together by merging their dictionaries, so that equal words get equal numbers again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tierwatch.llm.words import _LOWER, chunks, give_back, mix, raw, spans

CHUNK_BYTES = 8 << 20
_U = np.uint64
_NOT_SPACE = np.ones(256, bool)
_NOT_SPACE[32] = False


def gathered(batches: Iterator[pa.RecordBatch], text: int, limit: int = CHUNK_BYTES) -> Iterator[pa.Table]:
    """The rows of a task in tables of about ``limit`` bytes of text, one row at least."""
    held, size = [], 0
    for batch in batches:
        for row, part in chunks(batch.column(text), limit):
            held.append(batch.slice(row, len(part)))
            size += part.nbytes
            if size >= limit:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
        held = []
    give_back()


@dataclass
class Coded:
    """The words of some texts in order: numbers, their dictionary, and where each word and text begins."""

    codes: np.ndarray
    dictionary: pa.Array
    starts: np.ndarray
    bounds: np.ndarray
    data: np.ndarray

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def _column(texts: pa.Array | pa.ChunkedArray) -> pa.Array:
    return texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts


def _dictionary(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, flags: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Numbers and dictionary of spans that are exactly the flagged bytes."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    spelled = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[flags]))])
    coded = spelled.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def coded(texts: pa.Array | pa.ChunkedArray, word_bytes: np.ndarray, lower: bool = True,
          cut: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]] | None = None) -> Coded:
    """Maximal runs of the flagged bytes, lower-cased by ASCII; ``cut`` may split the runs further."""
    data, offsets = raw(_column(texts))
    data = _LOWER[data] if lower else data
    flags = word_bytes[data]
    starts, ends = spans(flags, offsets) if len(data) else (np.zeros(0, np.int64),) * 2
    if cut is not None:
        starts, ends = cut(data, starts, ends)
    codes, dictionary = _dictionary(data, starts, ends, flags)
    return Coded(codes, dictionary, starts, np.searchsorted(starts, offsets), data)


def distinct(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places of one of each distinct tuple, in order of the tuples, and how often each is there."""
    key, span = columns[0].astype(np.int64), int(columns[0].max(initial=0)) + 1
    for column in columns[1:]:
        base = int(column.max(initial=0)) + 1
        if span > (1 << 62) // base:
            kinds, key = np.unique(key, return_inverse=True)
            span = len(kinds)
        key, span = key * base + column, span * base
    _, first, counts = np.unique(key, return_index=True, return_counts=True)
    return first, counts


def spread(*hashes: np.ndarray) -> np.ndarray:
    """One well-mixed value of some hashes, in order."""
    value = np.full(len(hashes[0]), 0x2545F4914F6CDD1D, _U)
    for h in hashes:
        value = mix(value + h.astype(_U))
    return value


def runs(*columns: np.ndarray) -> np.ndarray:
    """Where a new tuple begins in sorted columns, and the end."""
    if not len(columns[0]):
        return np.zeros(1, np.int64)
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), len(new))


def pack_columns(columns: list[np.ndarray]) -> bytes:
    """Columns of numbers below 2 ** 31, deflated; meant for a first column that is sorted."""
    table = np.stack(columns).astype("<i4")
    # Differences of the first are mostly zero. Bytes of equal weight go together.
    table[0, 1:] -= table[0, :-1].copy()
    planes = table.view(np.uint8).reshape(len(table), -1, 4).transpose(0, 2, 1).tobytes()
    return pa.compress(planes, "zstd", asbytes=True)


def unpack_columns(columns: bytes, width: int, n: int) -> np.ndarray:
    if not n:
        return np.zeros((width, 0), "<i4")
    planes = np.frombuffer(pa.decompress(columns, decompressed_size=4 * width * n, codec="zstd"), np.uint8)
    table = np.ascontiguousarray(planes.reshape(width, 4, n).transpose(0, 2, 1)).view("<i4").reshape(width, n)
    np.cumsum(table[0], out=table[0])
    return table


def pack_words(dictionary: pa.Array, places: np.ndarray) -> tuple[int, bytes]:
    """Size and deflated bytes of some words of a dictionary."""
    spelled = b"".join([w + b" " for w in dictionary.take(pa.array(places)).to_pylist()])
    return len(spelled), pa.compress(spelled, "zstd", asbytes=True)


def unpack_words(size: int, spelled: bytes) -> bytes:
    """The words, each followed by a space."""
    return pa.decompress(spelled, decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def pack(dictionary: pa.Array, words: list[np.ndarray], numbers: list[np.ndarray]) -> tuple[int, bytes, bytes]:
    """A block: size and bytes of its words, and all columns. ``words`` are places in ``dictionary`` plus one, 0 is none."""
    used, places = np.unique(np.concatenate(words), return_inverse=True)
    none = int(len(used) > 0 and used[0] == 0)
    return *pack_words(dictionary, used[none:] - 1), pack_columns([*(places + (1 - none)).reshape(len(words), -1), *numbers])


def merge(spelled: list[bytes]) -> tuple[pa.Array, list[np.ndarray]]:
    """One dictionary of some blocks' words; for each block, the place plus one of each of its words, 0 before them."""
    data = np.frombuffer(b"".join(spelled), np.uint8)
    ends = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    codes, dictionary = _dictionary(data, starts, ends, _NOT_SPACE[data])
    cuts = np.searchsorted(ends, np.cumsum([len(s) for s in spelled]) - 1, "right")
    return dictionary, [np.concatenate([[0], codes[a:b] + 1]) for a, b in zip([0, *cuts[:-1]], cuts)]
