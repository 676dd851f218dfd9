"""Text to vector: the embedder plug-in and its default.

An embedder turns an Arrow array of texts into a matrix. It runs inside Arrow UDFs, so
Spark decides how rows are partitioned and batched, and each text is embedded once per
row whatever the number of concepts it is compared with.

The UDFs are deterministic, so that filters on other columns go below them. Where a result may be filtered,
``once.with_once`` keeps Spark from computing it again for the filter.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from tierwatch.constants import EMBEDDING_DIM
from tierwatch.functions.digests import first_of_md5
from tierwatch.functions.text import TOKEN_SEPARATOR, message_text

#: Texts are cut into words in slices of so many rows and bytes at most (or one text), whatever the size of a batch.
_ROWS_AT_ONCE, _BYTES_AT_ONCE = 512, 1 << 20


class Embedder(Protocol):
    name: str
    dim: int

    def encode(self, texts: pa.Array) -> np.ndarray:
        """One row of length ``dim`` per text; texts hold no nulls."""


class WordEmbedder(Embedder, Protocol):
    """An embedder whose vector follows from the words of a text and their numbers: a text that is cut already is embedded from these."""

    def encode_words(self, rows: np.ndarray, words: np.ndarray, distinct: pa.Array, n: int) -> np.ndarray:
        """What ``encode`` gives for ``n`` texts with this :func:`token_table`."""


def token_table(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(row, word index, distinct words) for every token; vectorised over the batch."""
    spaced = pc.replace_substring_regex(pc.utf8_lower(texts), TOKEN_SEPARATOR, " ")
    split = pc.split_pattern(spaced, " ")
    rows = pc.list_parent_indices(split)
    words = pc.list_flatten(split)
    real = pc.not_equal(words, "")
    encoded = words.filter(real).dictionary_encode()
    return (rows.filter(real).to_numpy(zero_copy_only=False).astype(np.int64),
            encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
            encoded.dictionary)


@dataclass(frozen=True)
class HashedWords:
    """Counts of words hashed into ``dim`` places. Deterministic; no claim to meaning."""

    dim: int = EMBEDDING_DIM
    name: str = "hashed-words"

    def encode(self, texts: pa.Array) -> np.ndarray:
        return self.encode_words(*token_table(texts), len(texts))

    def encode_words(self, rows: np.ndarray, words: np.ndarray, distinct: pa.Array, n: int) -> np.ndarray:
        places = (first_of_md5(distinct) % self.dim).astype(np.int64)
        cells = rows * self.dim + places[words] if len(words) else rows
        return np.bincount(cells, minlength=n * self.dim).reshape(n, self.dim).astype(np.float64)


def _slices(texts: pa.Array):
    for part, in _slices_of(texts):
        yield part


def _slices_of(*columns: pa.Array):
    """The same rows of some columns of texts, so many as are cut at once."""
    filled = [pc.fill_null(c, "") for c in columns]
    ends = np.cumsum(sum(pc.binary_length(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in filled))
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        fit = int(np.searchsorted(ends, before + _BYTES_AT_ONCE, "right")) - start
        size = min(max(fit, 1), _ROWS_AT_ONCE)
        yield tuple(f.slice(start, size) for f in filled)
        start += size


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; a zero row stays zero."""
    lengths = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))[:, None]
    return np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)


def embed(text: Column, embedder: Embedder | None = None) -> Column:
    """The vector of a text as ``array<float>``; null for null text."""
    chosen = embedder or HashedWords()

    @F.arrow_udf("array<float>")
    def encode(texts: pa.Array) -> pa.Array:
        blocks = [chosen.encode(part).astype(np.float32) for part in _slices(texts)]
        flat = np.concatenate(blocks).ravel() if blocks else np.zeros(0, np.float32)
        offsets = np.arange(len(texts) + 1, dtype=np.int32) * chosen.dim
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat), mask=pc.is_null(texts))

    return encode(text)


def packed(vector: Column) -> Column:
    """A vector as the bytes of its 4-byte numbers: one value to store and to read in place of hundreds. Null for null."""

    @F.arrow_udf("binary")
    def pack(vectors: pa.Array) -> pa.Array:
        flat = vectors.flatten().cast(pa.float32()).to_numpy(zero_copy_only=False)
        return _bytes(flat, pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(), pc.is_null(vectors))

    return pack(vector)


def _bytes(flat: np.ndarray, sizes: np.ndarray, missing: pa.Array) -> pa.Array:
    ends = np.append(0, np.cumsum(sizes, dtype=np.int64) * 4)
    stored = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(missing), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(flat, "<f4"))])
    return pc.if_else(missing, pa.scalar(None, pa.large_binary()), stored).cast(pa.binary())


def float_lists(vectors: pa.Array) -> pa.Array:
    """Lists of numbers, also of :func:`packed` vectors."""
    if not pa.types.is_binary(vectors.type) and not pa.types.is_large_binary(vectors.type):
        return vectors
    stored = pc.fill_null(vectors.cast(pa.large_binary()), b"")
    _, positions, values = stored.buffers()
    ends = np.frombuffer(positions, np.int64)[stored.offset:stored.offset + len(stored) + 1] if len(stored) else np.zeros(1, np.int64)
    flat = np.frombuffer(values, np.uint8)[ends[0]:ends[-1]].view("<f4") if values is not None else np.zeros(0, np.float32)
    return pa.ListArray.from_arrays(pa.array(((ends - ends[0]) // 4).astype(np.int32)), pa.array(flat), mask=pc.is_null(vectors))


def unpacked(vector: Column) -> Column:
    """The ``array<float>`` of a :func:`packed` vector."""

    @F.arrow_udf("array<float>")
    def unpack(vectors: pa.Array) -> pa.Array:
        return float_lists(vectors)

    return unpack(vector)


def embed_literal(text: str, embedder: Embedder | None = None) -> list[float]:
    """The vector of one text that is known when the plan is built."""
    chosen = embedder or HashedWords()
    return [float(x) for x in chosen.encode(pa.array([text]))[0].astype(np.float32)]


def similarities(text: Column, phrases: Mapping[str, str], embedder: Embedder | None = None) -> Column:
    """Cosine of a text with each phrase, as a struct with one double per phrase name.

    The phrase vectors are computed once, when the plan is built. Null text gives null
    similarities, a text without words gives 0.0.
    """
    chosen = embedder or HashedWords()
    names = list(phrases)
    targets = unit_rows(chosen.encode(pa.array([phrases[n] for n in names]))).T

    @F.arrow_udf(", ".join(f"{n} double" for n in names))
    def compare(texts: pa.Array) -> pa.Array:
        blocks = [unit_rows(chosen.encode(part)) @ targets for part in _slices(texts)]
        scores = np.concatenate(blocks) if blocks else np.zeros((0, len(names)))
        missing = pc.is_null(texts).to_numpy(zero_copy_only=False)
        columns = [pa.array(scores[:, j], mask=missing) for j in range(len(names))]
        return pa.StructArray.from_arrays(columns, names=names)

    return compare(text)


def word_counts(text: Column, words: Sequence[str]) -> Column:
    """``struct<length, tf_0, tf_1, ...>``: words of a text, and counts of given words.

    Null text counts as a text without words.
    """
    names = [f"tf_{i}" for i in range(len(words))]
    asked = pa.array(list(words), pa.string())

    @F.arrow_udf(", ".join(f"{n} int" for n in ["length", *names]))
    def count(texts: pa.Array) -> pa.Array:
        blocks = []
        for part in _slices(texts):
            rows, found, distinct = token_table(part)
            lengths = np.bincount(rows, minlength=len(part))
            which = pc.fill_null(pc.index_in(distinct, asked), -1).to_numpy(zero_copy_only=False)
            hit = which[found] if len(found) else found
            cells = rows[hit >= 0] * len(asked) + hit[hit >= 0]
            tf = np.bincount(cells, minlength=len(part) * len(asked)).reshape(len(part), len(asked))
            blocks.append(np.column_stack([lengths, tf]))
        table = np.concatenate(blocks) if blocks else np.zeros((0, len(names) + 1))
        columns = [pa.array(table[:, j].astype(np.int32)) for j in range(len(names) + 1)]
        return pa.StructArray.from_arrays(columns, names=["length", *names])

    return count(text)


def term_counts(text: Column) -> Column:
    """Distinct words of a text with their counts, as ``array<struct<term, tf>>``.

    Counting inside the row means an index build shuffles one row per distinct word of
    a message rather than one per word. Null text gives an empty array.
    """

    @F.arrow_udf("array<struct<term string, tf int>>")
    def count(texts: pa.Array) -> pa.Array:
        return _terms((token_table(part), len(part)) for part in _slices(texts))

    return count(text)


def _terms(tables: Iterable[tuple[tuple[np.ndarray, np.ndarray, pa.Array], int]]) -> pa.Array:
    """Distinct words with their counts for each row of some token tables, given with their numbers of rows."""
    sizes, term_parts, count_parts = [], [], []
    for (rows, words, distinct), n in tables:
        width = max(len(distinct), 1)
        cells, tf = np.unique(rows * width + words, return_counts=True)
        sizes.append(np.bincount(cells // width, minlength=n))
        term_parts.append(distinct.take(pa.array(cells % width)))
        count_parts.append(tf.astype(np.int32))
    ends = np.cumsum(np.concatenate(sizes)) if sizes else np.zeros(0)
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    terms = pa.concat_arrays([t.cast(pa.string()) for t in term_parts] or [pa.array([], pa.string())])
    counts = pa.array(np.concatenate(count_parts) if count_parts else np.zeros(0, np.int32))
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([terms, counts], names=["term", "tf"]))


def terms_and_vector(subject: Column, body: Column, embedder: Embedder | None = None, body_chars: int | None = None) -> Column:
    """``struct<terms, embedding>``: :func:`term_counts` of a body, and the :func:`packed` vector of subject and body joined by a space.

    Where the vector follows from the words of whole texts, each text is cut once for both.
    """
    chosen = embedder or HashedWords()
    if body_chars is not None or not hasattr(chosen, "encode_words"):
        return F.struct(term_counts(body).alias("terms"), packed(embed(message_text(subject, body, body_chars), chosen)).alias("embedding"))

    @F.arrow_udf("struct<terms: array<struct<term: string, tf: int>>, embedding: binary>")
    def cut(subjects: pa.Array, bodies: pa.Array) -> pa.Array:
        tables, blocks = [], []
        for head, part in _slices_of(subjects, bodies):
            (rows, words, distinct), (more_rows, more_words, more) = token_table(part), token_table(head)
            both = pa.concat_arrays([distinct, more.cast(distinct.type)])
            tables.append(_terms([((rows, words, distinct), len(part))]))
            blocks.append(chosen.encode_words(np.concatenate([rows, more_rows]), np.concatenate([words, more_words + len(distinct)]),
                                              both, len(part)).astype(np.float32))
        flat = np.concatenate(blocks).ravel() if blocks else np.zeros(0, np.float32)
        missing = pc.or_(pc.is_null(subjects), pc.is_null(bodies))
        vectors = _bytes(flat, np.full(len(bodies), chosen.dim), missing)
        return pa.StructArray.from_arrays([pa.concat_arrays(tables) if tables else _terms([]), vectors], names=["terms", "embedding"])

    return cut(subject, body)
