"""Blocks of postings: the messages that hold a word, with what bounds their scores."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tierwatch.functions.memory import give_back

#: Postings in a block, at most.
BLOCK_ROWS = 128
#: Postings that a task works on at once, about: of messages as they are cut into lists, and of lists as they are cut into blocks.
LISTED_AT_ONCE, CUT_AT_ONCE = 1 << 19, 1 << 18
#: The first bytes of a word that stand beside its bucket in a number, by which most comparisons of a sort are settled.
_LEADING = 6
#: Counts and lengths of the postings of a block that may have its highest weight, whatever the mean length is.
IMPACTS = ["impact_tf", "impact_length"]


def bucket_of(term: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(term.cast("binary")), F.lit(buckets)).cast("int")


def schema(messages: T.StructType, key: str, attributes: Sequence[str]) -> T.StructType:
    """The columns of blocks."""
    long, integer = T.LongType(), T.IntegerType()
    kinds = {"tf": integer, key: messages[key].dataType, "length": integer, "since": long, **{a: messages[a].dataType for a in attributes}}
    return T.StructType([
        T.StructField("bucket", integer), T.StructField("term", T.StringType()),
        *(T.StructField(name, kinds[key]) for name in ("first", "last")), T.StructField("n", integer),
        *(T.StructField(name, T.ArrayType(integer)) for name in IMPACTS),
        *(T.StructField(name, T.ArrayType(kind)) for name, kind in kinds.items())])


def pack(messages: DataFrame, key: str, attributes: Sequence[str], buckets: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of the words of ``key, terms, length, since, attributes``, dealt by bucket.

    Some thousands of messages give a list for each of their words; lists of a word that meet are put together, by key, and cut into
    blocks. Beside it stand the postings that no other one of
    the block beats in both count and length. The bucket of a frequent word is split over tasks: its blocks then
    cover ranges of keys that overlap.
    """
    made = schema(messages.schema, key, attributes)
    columns = [key, "length", "since", *attributes]
    short = T.StructType([T.StructField("place", T.LongType()), *(f for f in made if f.name in ("bucket", "term", "tf", *columns))])

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The postings of each word of some messages, by key: far fewer rows to sort than postings."""
        for batch in gathered(batches, "terms", LISTED_AT_ONCE):
            sizes = pc.fill_null(pc.list_value_length(batch["terms"]), 0).to_numpy()
            found = batch["terms"].flatten()
            if not len(found):
                continue
            owner = np.repeat(np.arange(len(batch)), sizes)
            place = np.empty(len(batch), np.int64)
            place[pc.sort_indices(batch[key]).to_numpy()] = np.arange(len(batch))
            term = found.field("term").dictionary_encode()
            codes = term.indices.to_numpy()
            order = np.lexsort((place[owner], codes))
            starts = np.flatnonzero(np.diff(codes[order], prepend=-1))
            words = term.dictionary.take(pa.array(codes[order][starts]))
            spelled = [w.encode() for w in words.to_pylist()]
            bucket = np.array([zlib.crc32(w) % buckets for w in spelled], np.int32)
            leading = np.array([int.from_bytes(w[:_LEADING].ljust(_LEADING, b"\0"), "big") for w in spelled], np.int64)
            offsets = pa.array(np.append(starts, len(order)).astype(np.int32))
            rows = pa.array(owner[order])
            yield pa.RecordBatch.from_arrays(
                [pa.array((bucket.astype(np.int64) << 8 * _LEADING) + leading), pa.array(bucket), words, pa.ListArray.from_arrays(offsets, found.field("tf").take(pa.array(order))),
                 *(pa.ListArray.from_arrays(offsets, batch[c].take(rows)) for c in columns)], names=short.names)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, "tf", CUT_AT_ONCE):
            sizes = pc.list_value_length(batch["tf"]).to_numpy()
            # Neighbouring lists of one word come together, by key.
            new = np.ones(len(batch), bool)
            codes = batch["term"].dictionary_encode().indices.to_numpy()
            new[1:] = codes[1:] != codes[:-1]
            run = np.repeat(np.cumsum(new) - 1, sizes)
            owner = np.repeat(np.arange(len(batch)), sizes)
            flat = pa.table({"run": run, "key": batch[key].flatten()})
            order = pc.sort_indices(flat, sort_keys=[("run", "ascending"), ("key", "ascending")])
            run, owner = run[order.to_numpy()], owner[order.to_numpy()]
            values = {c: batch[c].flatten().take(order) for c in ("tf", *columns)}
            starts = np.flatnonzero(np.diff(run, prepend=-1))
            within = np.arange(len(run)) - np.repeat(starts, np.diff(np.append(starts, len(run))))
            starts = np.flatnonzero(within % block_rows == 0)
            ends = np.append(starts[1:], len(run))
            offsets = pa.array(np.append(starts, len(run)).astype(np.int32))
            head, first = pa.array(owner[starts]), pa.array(starts)
            yield pa.RecordBatch.from_arrays(
                [batch["bucket"].take(head), batch["term"].take(head), values[key].take(first), values[key].take(pa.array(ends - 1)),
                 pa.array((ends - starts).astype(np.int32)), *_impacts(values["tf"].to_numpy(), values["length"].to_numpy(), starts),
                 *(pa.ListArray.from_arrays(offsets, values[c]) for c in ("tf", *columns))], names=made.names)

    listed = messages.select("terms", *columns).mapInArrow(lists, short)
    return listed.hint("rebalance", F.col("bucket")).sortWithinPartitions("place", "term").mapInArrow(blocks, made)


def gathered(batches: Iterator[pa.RecordBatch], lists: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The rows of a task in batches of about ``limit`` elements of a column of lists, or one batch; none is empty."""
    held, size = [], 0
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        size += len(batch[lists].flatten())
        if size >= limit:
            yield _one(held)
            held, size = [], 0
    if held:
        yield _one(held)
        held = []
    give_back()


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _impacts(tf: np.ndarray, length: np.ndarray, starts: np.ndarray) -> list[pa.Array]:
    """Of each block, counts that fall and lengths that fall with them."""
    block = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(tf))))
    order = np.lexsort((length, -tf, block))
    # Each block's lengths lie below those of the block before it, so the running minimum begins anew.
    lowered = length[order].astype(np.int64) - block[order] * (int(length.max()) + 1)
    lowest = np.minimum.accumulate(lowered)
    kept = np.ones(len(order), bool)
    kept[1:] = lowered[1:] < lowest[:-1]
    at = order[kept]
    offsets = pa.array(np.append(0, np.cumsum(np.bincount(block[at], minlength=len(starts)))).astype(np.int32))
    return [pa.ListArray.from_arrays(offsets, pa.array(x[at].astype(np.int32))) for x in (tf, length)]


def highest(weight: Callable[[Column, Column], Column]) -> Column:
    """The highest weight of a count and length in a block."""
    return F.array_max(F.zip_with(*IMPACTS, weight))


def unpack(blocks: DataFrame, *keep: str | Column) -> DataFrame:
    """One row for each posting: ``term``, the columns of postings, and ``keep``."""
    names = [c for c in blocks.columns if isinstance(blocks.schema[c].dataType, T.ArrayType) and c not in IMPACTS]
    return blocks.select("term", *keep, F.inline(F.arrays_zip(*names)))
