"""Benchmark decontamination with an FM-index per training shard.

A shard is a few MB of texts within a task. Its words become symbols: those of the benchmark get
numbers, all others the separator. Runs of benchmark words too short for any phrase cannot hold
one and are left out. Over the rest stands an FM-index: the Burrows-Wheeler transform in a wavelet
matrix of ranked bitmaps, symbol counts, and suffix positions at every ``SAMPLED`` words and at the
start of every run. All phrases are searched backward at once; each occurrence walks back
to a sampled suffix, and occurrences are merged to spans of hit words.

A phrase is a window of ``WINDOW`` consecutive words of an item, or all of a shorter item. Items are
stored in the shared folder in blocks of about ``BLOCK_BYTES`` of text, whatever their number; a
task reads one block at a time.

Edge cases: null texts have no words; null item ids count as the empty string; items without words
hold no phrase; repeated item ids are listed once per document; repeated rows are each reported; an
empty benchmark hits nothing; an empty table gives an empty result; only named columns are read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierwatch.llm.bits import directory, rank
from tierwatch.llm.registered import query, table
from tierwatch.llm.shared_files import get, put
from tierwatch.llm.words import LETTERS, Words, chunks, words
from tierwatch.session import scratch_path

WINDOW = 10
SAMPLED = 8
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 2 << 20
_FOUND = "n_words long, n_hit long, items array<string>, starts array<long>, ends array<long>"


@dataclass
class Phrases:
    """Distinct phrases of some items: their words as symbols from 1, and the items of each."""

    vocabulary: np.ndarray
    symbols: np.ndarray
    lengths: np.ndarray
    item_ids: list[str]
    item_bounds: np.ndarray
    items: np.ndarray


def phrases(item_ids: list[str], texts: pa.Array, window: int = WINDOW) -> Phrases:
    found = words(texts, LETTERS, lower=True)
    vocabulary, symbols = np.unique(found.hashes, return_inverse=True)
    rows, lengths, of = [], [], []
    for item in range(len(item_ids)):
        first, last = found.bounds[item], found.bounds[item + 1]
        n = min(window, last - first)
        for at in range(first, last - n + 1) if n else ():
            rows.append(np.concatenate([np.zeros(window - n, np.int64), symbols[at:at + n] + 1]))
            lengths.append(n)
            of.append(item)
    if not rows:
        empty = np.zeros(0, np.int64)
        return Phrases(vocabulary, np.zeros((0, window), np.int64), empty, item_ids, np.zeros(1, np.int64), empty)
    distinct, which = np.unique(np.array(rows), axis=0, return_inverse=True)
    pairs = np.unique(np.column_stack([which.ravel(), of]), axis=0)
    return Phrases(vocabulary, distinct, (distinct > 0).sum(axis=1), item_ids,
                   np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1)), pairs[:, 1])


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Positions in order of their suffixes, by prefix doubling; every 0 ends the text and is told
    from others by its position, so the doubling ends with the longest run that repeats."""
    n = len(text)
    ends = text == 0
    n_ends = int(ends.sum())
    order_of = np.where(ends, np.cumsum(ends) - 1, text + n_ends)
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[:-step or None] = order_of[step:] + 1 if step < n else 0
        key = order_of * (n + max(n_ends, 1) + int(text.max(initial=0)) + 2) + np.where(ends, 0, after)
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        if new[order[-1]] == n - 1:
            return order
        order_of, step = new, step * 2


class WaveletMatrix:
    """Counts of any symbol before any position, one ranked bitmap per binary digit."""

    def __init__(self, symbols: np.ndarray, largest: int) -> None:
        self.digits = max(1, int(largest).bit_length())
        self.levels = []
        for digit in reversed(range(self.digits)):
            ones = (symbols >> digit) & 1 == 1
            self.levels.append((digit, directory(ones), int((~ones).sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank(self, symbol: np.ndarray, before: np.ndarray) -> np.ndarray:
        """How often each symbol is found before the position beside it."""
        first = np.zeros_like(before)
        for digit, bits, zeros in self.levels:
            one = (symbol >> digit) & 1 == 1
            in_first, in_before = rank(**bits, at=first)[1], rank(**bits, at=before)[1]
            first = np.where(one, zeros + in_first, first - in_first)
            before = np.where(one, zeros + in_before, before - in_before)
        return before - first


class FMIndex:
    """Search in a text of symbols where 0 separates runs and stands last."""

    def __init__(self, text: np.ndarray, largest: int) -> None:
        order = suffix_array(text)
        self.n = len(text)
        self.last = text[order - 1]
        self.matrix = WaveletMatrix(self.last, largest)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=largest + 1))])
        run_start = np.concatenate([[True], text[:-1] == 0])
        kept = run_start[order] | (order % SAMPLED == 0)
        self.sampled = directory(kept)
        self.samples = order[kept]

    def search(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of suffixes that begin with each (right-aligned) phrase."""
        low, high = np.zeros(len(symbols), np.int64), np.full(len(symbols), self.n)
        for back in range(1, symbols.shape[1] + 1):
            at = np.flatnonzero((lengths >= back) & (high > low))
            c = symbols[at, -back]
            low[at] = self.before[c] + self.matrix.rank(c, low[at])
            high[at] = self.before[c] + self.matrix.rank(c, high[at])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text positions of suffixes: walk back to a sampled one, at most to the run's start."""
        out, steps, left = np.zeros(len(rows), np.int64), 0, np.arange(len(rows))
        while len(left):
            known, place = rank(**self.sampled, at=rows)
            out[left[known]] = self.samples[place[known]] + steps
            left, rows = left[~known], rows[~known]
            c = self.last[rows]
            rows = self.before[c] + self.matrix.rank(c, rows)
            steps += 1
        return out


def _occurrences(found: Words, of_word: np.ndarray, wanted: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """First word and phrase of every occurrence in a shard."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(wanted.lengths) or not len(of_word):
        return none
    place = np.searchsorted(wanted.vocabulary, found.hashes)
    place[place == len(wanted.vocabulary)] = 0
    symbols = np.where(wanted.vocabulary[place] == found.hashes, place + 1, 0)
    # Runs of benchmark words within one text; each is followed by a 0.
    starts = (symbols > 0) & np.concatenate([[True], (symbols[:-1] == 0) | (of_word[1:] != of_word[:-1])])
    run = np.cumsum(starts)[symbols > 0] - 1
    position = np.flatnonzero(symbols > 0)
    long_enough = np.bincount(run)[run] >= wanted.lengths.min() if len(run) else np.zeros(0, bool)
    position, run = position[long_enough], run[long_enough]
    if not len(position):
        return none
    at = np.arange(len(position)) + np.concatenate([[0], np.cumsum(run[1:] != run[:-1])])
    text, origin = np.zeros(at[-1] + 2, np.int64), np.zeros(at[-1] + 2, np.int64)
    text[at], origin[at] = symbols[position], position
    index = FMIndex(text, len(wanted.vocabulary))
    low, high = index.search(wanted.symbols, wanted.lengths)
    times = high - low
    phrase = np.repeat(np.arange(len(times)), np.maximum(times, 0))
    rows = np.arange(len(phrase)) - np.repeat(np.cumsum(times) - times, times) + low[phrase]
    return origin[index.locate(rows)], phrase


@dataclass
class Hits:
    """Hit words of a shard, and the (row, item id) pairs found."""

    words: Words
    hit: np.ndarray
    items: list[set[str]]

    def spans(self, row: int) -> tuple[np.ndarray, np.ndarray]:
        """Merged byte spans of a text's hit words, from its own start."""
        a, b = self.words.bounds[row], self.words.bounds[row + 1]
        hit = np.concatenate([[False], self.hit[a:b], [False]])
        first, last = np.flatnonzero(hit[1:] & ~hit[:-1]), np.flatnonzero(hit[:-1] & ~hit[1:]) - 1
        begin = self.words.offsets[row]
        return self.words.starts[a + first] - begin, self.words.ends[a + last] - begin


def find(texts: pa.Array, blocks: Iterator[Phrases]) -> Hits:
    """All phrases of all blocks in a shard."""
    found = words(texts, LETTERS, lower=True)
    of_word, change = found.rows(), np.zeros(len(found.hashes) + 1, np.int64)
    items: list[set[str]] = [set() for _ in range(len(texts))]
    for wanted in blocks:
        first, phrase = _occurrences(found, of_word, wanted)
        np.add.at(change, first, 1)
        np.subtract.at(change, first + wanted.lengths[phrase], 1)
        for row, p in np.unique(np.column_stack([of_word[first], phrase]), axis=0):
            items[row].update(wanted.item_ids[i] for i in wanted.items[wanted.item_bounds[p]:wanted.item_bounds[p + 1]])
    return Hits(found, np.cumsum(change[:-1]) > 0, items)


def cut_out(texts: list[str | None], blocks) -> list[str | None]:
    """Texts of a shard without their hit spans; what was cut is searched again, until cutting has joined no new phrase."""
    out, pending = list(texts), list(range(len(texts)))
    while pending:
        hits, again = find(pa.array([out[i] for i in pending], pa.string()), blocks()), []
        for row in sorted(set(hits.words.rows()[hits.hit].tolist())):
            starts, ends = hits.spans(row)
            raw = out[pending[row]].encode()
            kept = [raw[a:b] for a, b in zip([0, *ends], [*starts, len(raw)])]
            out[pending[row]] = b"".join(kept).decode()
            again.append(pending[row])
        pending = again
    return out


@lru_cache(maxsize=1)
def load_block(path: str) -> Phrases:
    """A worker holds the block read last: one block alone stays, of several only one at a time."""
    return pickle.loads(get(path))


def _loader(paths: list[str]):
    """An iterator factory over the blocks."""
    return lambda: map(load_block, paths)


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW,
                block_bytes: int = BLOCK_BYTES) -> list[str]:
    """Write the items' phrases to the shared folder, as files of about ``block_bytes`` of text; their paths."""
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = max(1, -(-int(size) // block_bytes))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(n)))
    folder, paths = scratch_path(items.sparkSession, "phrases"), []
    for block in range(n):
        part = dealt.filter(F.col("block") == block).toArrow()  # block_bytes on average
        made = phrases(part.column("id").to_pylist(), pa.array(part.column("text").to_pylist(), pa.string()), window)
        paths.append(f"{folder}/{block:06d}.pickle")
        put(paths[-1], pickle.dumps(made))
    return paths


def search(text: Column, paths: list[str]) -> Column:
    """``struct<n_words, n_hit, items, starts, ends>``; items sorted as strings, spans in bytes."""
    blocks = _loader(paths)

    @F.arrow_udf(_FOUND)
    def look(texts: pa.Array) -> pa.Array:
        columns: list[list] = [[], [], [], [], []]
        for _, part in chunks(texts, SHARD_BYTES):
            hits = find(part, blocks())
            total = np.concatenate([[0], np.cumsum(hits.hit)])[hits.words.bounds]
            n_hit = np.diff(total)
            columns[0].append(np.diff(hits.words.bounds))
            columns[1].append(n_hit)
            for row, n in enumerate(n_hit):
                starts, ends = hits.spans(row) if n else ([], [])
                columns[2].append(sorted(hits.items[row]))
                columns[3].append(starts)
                columns[4].append(ends)
        kinds = [pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64())]
        arrays = [pa.array(np.concatenate(c or [np.zeros(0)]).astype(np.int64)) for c in columns[:2]]
        arrays += [pa.array(c, k) for c, k in zip(columns[2:], kinds)]
        return pa.StructArray.from_arrays(arrays, names=["n_words", "n_hit", "items", "starts", "ends"])

    return look(text)


def cleaned(text: Column, paths: list[str]) -> Column:
    """The text without its hit spans; null stays null, a text without hits stays as it is."""
    blocks = _loader(paths)

    @F.arrow_udf("string")
    def clean(texts: pa.Array) -> pa.Array:
        out: list = []
        for _, part in chunks(texts, SHARD_BYTES):
            out += cut_out(part.to_pylist(), blocks)
        return pa.array(out, pa.string())

    return clean(text)


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_hit, items, starts, ends`` of every row."""
    found = docs.select(F.col(id_col).alias("doc_id"), search(F.col(text_col), item_blocks(items)).alias("found"))
    return found.select("doc_id", "found.*")


def cut_benchmark(docs: DataFrame, items: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with benchmark passages cut out of the text, in its own columns; ``n_chars`` follows.

    Rows that lose all their words go; rows without hits, null texts too, stay as they are.
    """
    changed = docs.withColumn("__clean", cleaned(F.col(text_col), item_blocks(items)))
    same = F.col("__clean").eqNullSafe(F.col(text_col))
    left = changed.filter(same | F.col("__clean").rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"))
    columns = {text_col: F.col("__clean")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(same, F.col("n_chars")).otherwise(
            F.char_length("__clean")).cast(docs.schema["n_chars"].dataType)
    return left.select(*[columns.get(c, F.col(c)).alias(c) for c in docs.columns])


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
SQL = f"""WITH item_words AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
phrases AS (
  SELECT DISTINCT item_id, len(g) AS n, array_to_string(g, ' ') AS g FROM (
    SELECT item_id, unnest(list_transform(range(1, greatest(len(ws) - {WINDOW - 1}, 1) + 1),
                                          lambda i: ws[i:i + {WINDOW - 1}])) AS g FROM item_words WHERE len(ws) > 0) t),
doc_words AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
places AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM doc_words),
grams AS (
  SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS g FROM places, (SELECT DISTINCT n FROM phrases) l
  WHERE i + n - 1 <= len(ws)),
found AS (SELECT doc_id, i, p.n, item_id FROM grams JOIN phrases p USING (n, g)),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (
  SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) t GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (
  SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) t GROUP BY 1)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc_words w LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""


@query(SQL)
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
