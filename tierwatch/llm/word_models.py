"""Cross-entropy difference of two matched word bigram models, counted over whole tables.

Words are runs of ASCII letters, digits and characters that are not ASCII, lower-cased by ASCII;
from U+3000 on (CJK, Hangul and the like, written without spaces) each character is a word. Every text
has one end mark. Both models are bigrams with Witten-Bell interpolation over one vocabulary,
all words of all texts given; nothing is cut by frequency, so what is gathered grows with the corpus.

Each text is cut into words once. A task hands on, for each chunk of texts, the distinct bigrams of
each text in packed blocks by the hash of the first word, the *context*; a text's membership in the two corpora goes
with them. One task then has all bigrams of its contexts: it counts them, totals the contexts and
gives each text its share of the losses, so no bigram is joined with anything. The counts of single words, which the
interpolation needs, are asked for by their words: buckets of contexts ask, buckets of words answer, both packed.

A context that makes up a ``1 / HOT`` of all words or more is split by the next word; its totals, a few
numbers for each of the few, are summed first. Which contexts are split changes no result. Words are told apart by
their bytes. Every step is stored before the next one, and shuffle files that nothing needs any more are released.
"""

from __future__ import annotations

import gc
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwatch.llm.symbols import (coded, distinct, gathered, merge, pack, pack_columns, pack_words, runs, spread, unpack_columns,
                                   unpack_words)
from tierwatch.llm.words import LETTERS, give_back, giving_back
from tierwatch.session import materialize

#: Contexts of first words, and end marks; no word has these bytes.
START, END = b"\x01", b"\x02"
#: Contexts with a larger share of all words than one in so many are split.
HOT = 64
#: Tokens of the corpus for each bucket of contexts and of words; they only split the work.
TOKENS_PER_BUCKET, TOKENS_PER_WORD_BUCKET = 3_600_000, 8_000_000
#: Losses are worked out for so many distinct bigrams at once.
BIGRAMS_AT_ONCE = 1 << 17
_WIDE, _WIDER = 0xE3, 0xF0
_BLOCK, _WORDS, _IDS, _ASKED, _ANSWER, _TOTAL = range(6)
#: One schema for all that is handed on: blocks, words, ids of a chunk, questions, answers, totals.
_ROW = ("kind int, bucket int, chunk long, n int, m int, spelled_bytes int, spelled binary, columns binary, more binary, "
        "ids array<long>, numbers array<long>")
_NAMES = [part.split()[0] for part in _ROW.split(", ")]
_KINDS = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(),
          pa.list_(pa.int64()), pa.list_(pa.int64())]


def _row(kind: int, bucket: int | None = None, chunk: int | None = None, **rest) -> dict:
    return {"kind": kind, "bucket": bucket, "chunk": chunk, **rest}


def _table(rows: list[dict]) -> pa.Table:
    return pa.table({name: pa.array([r.get(name) for r in rows], kind) for name, kind in zip(_NAMES, _KINDS)})


def _cut_wide(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters from U+3000 on are words by themselves."""
    wide = np.flatnonzero(data >= _WIDE)
    cuts = np.union1d(wide, wide + np.where(data[wide] >= _WIDER, 4, 3))
    if not len(cuts):
        return starts, ends
    of = np.searchsorted(starts, cuts, "right") - 1
    cuts = cuts[(cuts > starts[of]) & (cuts < ends[of])]
    return np.union1d(starts, cuts), np.union1d(ends, cuts)


class _Chunk:
    """Tokens of a chunk of texts: the place of each token's context and word in a dictionary that ends in START and END."""

    def __init__(self, texts: pa.ChunkedArray) -> None:
        found = coded(texts, LETTERS, cut=_cut_wide)
        n_texts, kinds = len(texts), len(found.dictionary)
        self.dictionary = pa.concat_arrays([found.dictionary.cast(pa.large_binary()), pa.array([START, END], pa.large_binary())])
        ends = found.bounds[1:] + np.arange(n_texts)
        self.word = np.full(len(found.codes) + n_texts, kinds + 1)
        inside = np.ones(len(self.word), bool)
        inside[ends] = False
        self.word[inside] = found.codes
        self.context = np.concatenate([[kinds], self.word[:-1]])
        self.context[ends[:-1] + 1] = kinds
        self.row = np.repeat(np.arange(n_texts), np.diff(found.bounds) + 1)

    def hashes(self) -> np.ndarray:
        return np.array([zlib.crc32(w) for w in self.dictionary.to_pylist()], np.int64)


def hot_contexts(texts: DataFrame) -> tuple[int, list[bytes]]:
    """The number of tokens, and the words that start a large share of all bigrams; at most ``HOT``.

    Words that are rare in a chunk are not counted there: the list says how work is split, no more.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in gathered(batches, 0):
            chunk = _Chunk(rows.column(0))
            n = np.bincount(chunk.context, minlength=len(chunk.dictionary))
            often = np.flatnonzero(n * 4 * HOT >= n.sum())
            words = [None, *chunk.dictionary.take(pa.array(often)).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([n.sum(), *n[often]], pa.int64())], names=["word", "n"])

    found = texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    total = found.filter(F.col("word").isNull()).agg(F.sum("n")).first()[0] or 0
    hot = found.filter(F.col("word").isNotNull() & (F.col("n") * HOT >= total)).collect()
    return total, [bytes(r["word"]) for r in hot]


def corpus_blocks(rows: DataFrame, hot: list[bytes], buckets: int, word_buckets: int) -> DataFrame:
    """Blocks of bigrams, words and ids of each chunk of ``id, text, target, background, scored``.

    Blocks of split contexts have buckets from ``buckets`` on.
    """
    split = set(hot)

    def blocks(chunk: _Chunk, number: int, target: np.ndarray, background: np.ndarray) -> Iterator[dict]:
        hashes = chunk.hashes()
        is_hot = np.array([w in split for w in chunk.dictionary.to_pylist()])
        first, counts = distinct([chunk.context, chunk.word, chunk.row])
        context, word, row = chunk.context[first], chunk.word[first], chunk.row[first]
        own, both = (spread(hashes[context]), spread(hashes[context], hashes[word]))
        bucket = (np.where(is_hot[context], both, own) % np.uint64(buckets)).astype(np.int64) + buckets * is_hot[context]
        order = np.argsort(bucket, kind="stable")
        context, word, row, counts, bucket = context[order], word[order], row[order], counts[order], bucket[order]
        cuts = runs(bucket)
        for a, b in zip(cuts[:-1], cuts[1:]):
            texts, place = np.unique(row[a:b], return_inverse=True)
            size, spelled, columns = pack(chunk.dictionary, [context[a:b] + 1, word[a:b] + 1], [place, counts[a:b]])
            yield _row(_BLOCK, int(bucket[a]), number, n=int(b - a), m=len(texts), spelled_bytes=size, spelled=spelled, columns=columns,
                       more=pack_columns([texts, target[texts], background[texts]]))
        kinds = len(hashes)
        totals = [np.bincount(chunk.word, weights=side[chunk.row], minlength=kinds).astype(np.int64) for side in (target, background)]
        words = np.delete(np.arange(kinds), kinds - 2)
        bucket = (spread(hashes[words]) % np.uint64(word_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        words, bucket = words[order], bucket[order]
        cuts = runs(bucket)
        for a, b in zip(cuts[:-1], cuts[1:]):
            size, spelled = pack_words(chunk.dictionary, words[a:b])
            yield _row(_WORDS, int(bucket[a]), number, n=int(b - a), spelled_bytes=size, spelled=spelled,
                       columns=pack_columns([t[words[a:b]] for t in totals]))

    def handed_on(table: pa.Table, number: int) -> list[dict]:
        chunk = _Chunk(table["text"])
        target, background = (table[c].to_numpy().astype(np.int64) for c in ("target", "background"))
        scored = np.flatnonzero(table["scored"].to_numpy())
        tokens = np.bincount(chunk.row, minlength=len(table))
        ids = _row(_IDS, chunk=number, n=len(table), columns=pack_columns([scored, tokens[scored]]), m=len(scored),
                   ids=table["id"].take(pa.array(scored)).to_pylist())
        return [*blocks(chunk, number, target, background), ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for table in gathered(batches, 1):
            made = handed_on(table, number)
            for a in range(0, len(made), 100):
                yield from _table(made[a:a + 100]).to_batches()
            number += 1

    return rows.select("id", "text", "target", "background", "scored").mapInArrow(run, _ROW)


class _Bucket:
    """All bigrams of some contexts, in order of context and word."""

    def __init__(self, rows: list[dict]) -> None:
        texts = [unpack_columns(r["more"], 3, r["m"]) for r in rows]
        self.dictionary, places = merge([unpack_words(r["spelled_bytes"], r.pop("spelled")) for r in rows])
        give_back()
        first, begins = (np.cumsum([0, *(r[c] for r in rows)]) for c in ("m", "n"))
        base = len(self.dictionary) + 1
        # Columns of a bucket are what a task holds most of: one key for context and word, and four bytes for a number.
        key, text, n = (np.empty(begins[-1], kind) for kind in (np.int64, np.int32, np.int32))
        for r, place, a, b, f in zip(rows, places, begins[:-1], begins[1:], first):
            context, word, of, text_n = unpack_columns(r.pop("columns"), 4, r["n"])
            key[a:b] = (place[context] - 1) * base + place[word] - 1
            text[a:b], n[a:b] = of + f, text_n
        order = np.argsort(key, kind="stable")
        key, self.text, self.n = key[order], text[order], n[order]
        del order, text, n
        self.texts, self.first = texts, first
        cuts = runs(key)
        self.lengths = np.diff(cuts)
        self.context, self.word = key[cuts[:-1]] // base, key[cuts[:-1]] % base
        del key
        sides = (np.concatenate([t[i] for t in texts]) for i in (1, 2))
        self.counts = [np.add.reduceat(np.multiply(self.n, side[self.text], dtype=np.int64), cuts[:-1]) for side in sides]

    def contexts(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """Places of the contexts; how often each was seen in either corpus, and with how many words."""
        cuts = runs(self.context)[:-1]
        return self.context[cuts], [np.add.reduceat(c, cuts) for side in self.counts for c in (side, (side > 0).astype(np.int64))]


def _hot_totals(blocks: DataFrame, buckets: int) -> dict[bytes, list[int]]:
    """Totals of the split contexts."""
    def run(group: pa.Table) -> pa.Table:
        bucket = _Bucket(group.to_pylist())
        places, totals = bucket.contexts()
        return pa.table({"word": bucket.dictionary.take(pa.array(places)).cast(pa.binary()),
                         **{f"x{i}": pa.array(t.astype(np.int64)) for i, t in enumerate(totals)}})

    columns = [f"x{i}" for i in range(4)]
    split = blocks.filter((F.col("kind") == _BLOCK) & (F.col("bucket") >= buckets))
    summed = split.groupBy("bucket").applyInArrow(giving_back(run), "word binary, " + ", ".join(f"{c} long" for c in columns)).groupBy("word").agg(
        *(F.sum(c).alias(c) for c in columns))
    return {bytes(r["word"]): [r[c] for c in columns] for r in summed.collect()}


def _single_counts(blocks: DataFrame, word_buckets: int) -> DataFrame:
    """Answers to each bucket of contexts: the counts of its words in both corpora; and totals of all words."""
    def ask(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        dictionary, _ = merge([unpack_words(r["spelled_bytes"], r["spelled"]) for r in rows])
        of = (spread(np.array([zlib.crc32(w) for w in dictionary.to_pylist()], np.int64)) % np.uint64(word_buckets)).astype(np.int64)
        order = np.argsort(of, kind="stable")
        cuts, made = runs(of[order]), []
        for a, b in zip(cuts[:-1], cuts[1:]):
            size, spelled = pack_words(dictionary, order[a:b])
            made.append(_row(_ASKED, int(of[order[a]]), rows[0]["bucket"], n=int(b - a), spelled_bytes=size, spelled=spelled))
        return _table(made)

    def answer(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        dictionary, places = merge([unpack_words(r["spelled_bytes"], r["spelled"]) for r in rows])
        totals = np.zeros((2, len(dictionary) + 1), np.int64)
        counted = np.zeros(len(dictionary) + 1, bool)
        for r, place in zip(rows, places):
            if r["kind"] == _WORDS:  # the words of a chunk are distinct
                totals[:, place[1:]] += unpack_columns(r["columns"], 2, r["n"])
                counted[place[1:]] = True
        made = [_row(_TOTAL, numbers=[int(counted.sum()), *map(int, totals.sum(axis=1))])]
        for r, place in zip(rows, places):
            if r["kind"] == _ASKED:  # the number of the asking bucket is kept in the place of a chunk's
                made.append(_row(_ANSWER, r["chunk"], n=r["n"], spelled_bytes=r["spelled_bytes"], spelled=r["spelled"],
                                 columns=pa.compress(totals[:, place[1:]].tobytes(), "zstd", asbytes=True)))
        return _table(made)

    empty = F.lit(None)
    asked = blocks.filter(F.col("kind") == _BLOCK).select("bucket", "spelled_bytes", "spelled").groupBy("bucket").applyInArrow(giving_back(ask), _ROW)
    words = blocks.filter(F.col("kind") == _WORDS).select(
        *(c if c in ("kind", "bucket", "n", "spelled_bytes", "spelled", "columns") else empty.alias(c) for c in _NAMES))
    return words.union(asked).groupBy("bucket").applyInArrow(giving_back(answer), _ROW)


def _shares(blocks: DataFrame, answers: DataFrame, hot: dict[bytes, list[int]], totals: list[int]) -> DataFrame:
    """``chunk, texts, losses``: what a bucket of contexts adds to the losses of a chunk's texts."""
    kinds, *tokens = totals

    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        mine, answered = ([r for r in rows if r["kind"] == k] for k in (_BLOCK, _ANSWER))
        bucket = _Bucket(mine)
        single = np.zeros((2, len(bucket.dictionary)), np.int64)
        # START is a context only: nobody knows its count, and nobody needs it.
        names, places = merge([unpack_words(r["spelled_bytes"], r.pop("spelled")) for r in answered])
        give_back()
        found = np.zeros((2, len(names)), np.int64)
        for r, place in zip(answered, places):
            found[:, place[1:] - 1] = np.frombuffer(pa.decompress(r.pop("columns"), decompressed_size=16 * r["n"], codec="zstd"), np.int64).reshape(2, -1)
        at = pc.index_in(bucket.dictionary, value_set=names).to_numpy(zero_copy_only=False)
        single[:] = found[:, at.astype(np.int64)]
        places, sums = bucket.contexts()
        for i, word in enumerate(bucket.dictionary.take(pa.array(places)).to_pylist() if hot else ()):
            if word in hot:
                for s, value in zip(sums, hot[word]):
                    s[i] = value
        of = np.searchsorted(places, bucket.context)
        ends = np.append(0, np.cumsum(bucket.lengths))
        losses = np.zeros((2, int(bucket.first[-1])))
        for a in range(0, len(of), BIGRAMS_AT_ONCE):
            grams = slice(a, min(a + BIGRAMS_AT_ONCE, len(of)))
            rows_of = slice(ends[grams.start], ends[grams.stop])
            for i in range(2):
                chance = (single[i][bucket.word[grams]] + 1.0) / (tokens[i] + kinds)
                seen, after = sums[2 * i][of[grams]], sums[2 * i + 1][of[grams]]
                loss = -np.log(np.where(seen > 0, (bucket.counts[i][grams] + after * chance) / np.maximum(seen + after, 1), chance))
                np.add.at(losses[i], bucket.text[rows_of], bucket.n[rows_of] * np.repeat(loss, bucket.lengths[grams]))
        parts = [slice(a, b) for a, b in zip(bucket.first[:-1], bucket.first[1:])]
        return pa.table({"chunk": pa.array([r["chunk"] for r in mine], pa.int64()),
                         "texts": pa.array([np.ascontiguousarray(t[0]).tobytes() for t in bucket.texts], pa.binary()),
                         "losses": pa.array([np.stack([x[p] for x in losses]).tobytes() for p in parts], pa.binary())})

    met = blocks.filter(F.col("kind") == _BLOCK).select(*_NAMES).unionByName(answers.filter(F.col("kind") == _ANSWER))
    return met.groupBy("bucket").applyInArrow(giving_back(run), "chunk long, texts binary, losses binary")


def _summed(blocks: DataFrame, shares: DataFrame) -> DataFrame:
    """Mean losses of each scored text."""
    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        head = next(r for r in rows if r["ids"] is not None)
        total = np.zeros((2, head["n"]))
        # In a fixed order, so that sums do not depend on the order of arrival.
        for r in sorted((r for r in rows if r["ids"] is None), key=lambda r: (r["texts"], r["losses"])):
            total[:, np.frombuffer(r["texts"], "<i4")] += np.frombuffer(r["losses"], float).reshape(2, -1)
        scored, n = unpack_columns(head["columns"], 2, head["m"])
        target, background = total[:, scored] / n
        return pa.table({"doc_id": pa.array(head["ids"], pa.int64()), "n_tokens": pa.array(n.astype(np.int64)), "target_loss": pa.array(target),
                         "background_loss": pa.array(background), "difference": pa.array(target - background)})

    heads = blocks.filter(F.col("kind") == _IDS).select("chunk", "n", "m", "columns", "ids")
    return heads.unionByName(shares, allowMissingColumns=True).groupBy("chunk").applyInArrow(
        giving_back(run), "doc_id long, n_tokens long, target_loss double, background_loss double, difference double")


def _release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that are gone; it does so when the driver's JVM collects them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def score_rows(rows: DataFrame) -> DataFrame:
    """Mean losses under both models, in nats, and their difference, of the scored rows of ``id, text, target, background, scored``.

    ``target`` and ``background`` say how often a row counts in either corpus. The lower the difference, the
    more a text is like the target.
    """
    spark = rows.sparkSession
    total, hot = hot_contexts(rows.select("text"))
    buckets, word_buckets = (max(1, -(-total // size)) for size in (TOKENS_PER_BUCKET, TOKENS_PER_WORD_BUCKET))
    blocks = materialize(corpus_blocks(rows, hot, buckets, word_buckets), "bigram-blocks")
    _release(spark)
    split = _hot_totals(blocks, buckets) if hot else {}
    answers = materialize(_single_counts(blocks, word_buckets), "word-counts")
    sums = [F.coalesce(F.sum(F.col("numbers")[i]), F.lit(0)) for i in range(3)]
    totals = list(answers.filter(F.col("kind") == _TOTAL).agg(*sums).first())
    _release(spark)
    return _summed(blocks, _shares(blocks, answers, split, totals))


def score_words(docs: DataFrame, target: DataFrame, background: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`score_rows` of ``docs`` with two corpora given as tables of their own."""
    def side(df: DataFrame, ids, target: int, background: int, scored: bool) -> DataFrame:
        return df.select(ids.cast("long").alias("id"), F.col(text_col).alias("text"), F.lit(target).alias("target"),
                         F.lit(background).alias("background"), F.lit(scored).alias("scored"))

    none = F.lit(None)
    return score_rows(side(docs, F.col(id_col), 0, 0, True).union(side(target, none, 1, 0, False)).union(side(background, none, 0, 1, False)))
