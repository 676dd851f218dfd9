"""Packing documents into sequences by the sum of squares.

A text becomes its token ids and an end id. Texts longer than a sequence are cut into full
sequences, the first piece holding what is left over. Every other piece is placed where the sum
over all gaps g of (number of open sequences with gap g) squared gets smallest, a new sequence
being one of the choices; ties go to the smaller gap. Long pieces are placed first.

Pieces are dealt out evenly into groups of a bounded number by their place in the stored table
of pieces, each group is packed by itself in one task, and only a few sequences per
group stay open at its end. Only lengths are moved; ids stay out of the shuffle.

Edge cases: a null or empty text is one piece with just the end id; null and repeated ids are
kept, each row by itself; an empty table gives an empty result; only the id and the text are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwatch.llm.registered import query, table
from tierwatch.llm.tokens import default_path, encoded
from tierwatch.llm.words import give_back
from tierwatch.session import materialize

CAPACITY = 2048
END_ID = 0
GROUP_PIECES = 50_000
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, place long"
_PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
_FAR = 1 << 62


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each length, all between 1 and the capacity."""
    order = np.argsort(-lengths, kind="stable")
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_with = np.zeros(capacity + 1, np.int64)
    at_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    made = 0
    for i in order:
        size = int(lengths[i])
        here = open_with[size:capacity]
        change = np.where(here > 0, 2 * (open_with[:capacity - size] - here) + 2, _FAR)
        if len(change):
            change[0] += here[0] > 0 and -1 - 2 * int(open_with[0])
        best = int(change.argmin()) if len(change) else -1
        new = 2 * int(open_with[capacity - size]) + 1 if size < capacity else 0
        if best >= 0 and change[best] <= new:
            gap = size + best
            which = at_gap[gap].pop()
            open_with[gap] -= 1
        else:
            gap, which, made = capacity, made, made + 1
        sequence[i], offset[i] = which, capacity - gap
        if gap > size:
            at_gap[gap - size].append(which)
            open_with[gap - size] += 1
    return sequence, offset


def cut(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = END_ID,
        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of every document: ``doc_id, piece, start, length, ids_crc32, place``.

    ``place`` numbers the rows of the stored table; it is fixed once that is written.
    """
    path = tokenizer or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        place = TaskContext.get().partitionId() << 40

        def batch() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "place"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for doc, ids in encoded(batches, path):
            ids = np.append(ids, end_id).astype("<u4")
            start = 0
            for piece in range(-(-len(ids) // capacity)):
                end = len(ids) - (-(-len(ids) // capacity) - piece - 1) * capacity
                rows.append((doc, piece, start, end - start, zlib.crc32(ids[start:end].tobytes()), place))
                start, place = end, place + 1
            if len(rows) >= 10_000:
                yield batch()
                rows = []
        if rows:
            yield batch()
        rows = []
        give_back()

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, _PIECES)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``; ``pieces`` must be stored, as it is read twice."""
    full = F.col("length") == capacity
    groups = max(1, -(-pieces.filter(~full).count() // group_pieces))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place", ignore_index=True)
        sequence, offset = pack(rows["length"].to_numpy(np.int64), capacity)
        rows = rows.assign(sequence_id=(rows["group"].to_numpy(np.int64) << 32) + sequence, offset=offset)
        return rows.drop(columns=["group", "place"])

    open_ones = pieces.filter(~full).withColumn("group", F.pmod(F.xxhash64("place"), F.lit(groups)))
    packed = open_ones.groupBy("group").applyInPandas(run, _PACKED)
    alone = pieces.filter(full).select(*pieces.columns[:-1], (-F.col("place") - 1).alias("sequence_id"),
                                       F.lit(0).cast("long").alias("offset"))
    return packed.unionByName(alone)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, end_id: int = END_ID,
                   group_pieces: int = GROUP_PIECES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    pieces = materialize(cut(docs, capacity, tokenizer, end_id, id_col, text_col), "pieces")
    return pack_pieces(pieces, capacity, group_pieces)


@query()
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
