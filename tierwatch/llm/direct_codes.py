"""Token files with directly addressable codes.

An id is cut into chunks of 8, 8 and 16 bits. Level 1 holds the low chunk of every id and a
bitmap of the ids that go on; level 2 holds the next chunk of those, and so on. To read the id
at a position, take its chunk, and while its bit says so, go on at ``rank(bit)`` of the next
level. Ranks come from a stored directory (a count per 512 bits, another per 64 within it) and
one popcount, so any token is read without decoding others.

A file: 8 magic bytes, the length of a JSON header, the header (counts and sections), then the
sections, each aligned to 8 bytes: document ids and their validity, first token of each
document, and per level chunks, bitmap, directories.

Files are written in ascending order of document id: rows are ranged by id, sorted within
their partition, and every task writes files of a bounded number of tokens. Names are new for
each attempt and a manifest, written by Spark, lists those of the attempts that count; files of
lost or repeated tasks are never read. The folder is one that ``pyarrow.fs`` and all
executors reach.

Edge cases: a null text holds just the end id; null ids come first; repeated ids are ordered
by their text's checksum and each kept; an empty table gives an empty manifest; only the id and
the text are read.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tierwatch.llm.bits import directory, rank
from tierwatch.llm.registered import query, table
from tierwatch.llm.shared_files import get, put
from tierwatch.llm.tokens import default_path, encoded
from tierwatch.session import materialize, scratch_path

MAGIC = b"TWDACS01"
LEVELS = ((8, np.uint8), (8, np.uint8), (16, np.uint16))
FILE_TOKENS = 4 << 20
END_ID = 2
READ_AT_ONCE = 1 << 19
_MANIFEST = "part long, number long, path string, n_docs long, n_tokens long"


def encode_file(doc_ids: list[int | None], tokens: list[np.ndarray]) -> bytes:
    """One file of documents and their ids."""
    rest = np.concatenate(tokens).astype(np.uint32) if tokens else np.zeros(0, np.uint32)
    sections = {
        "doc_ids": np.array([0 if d is None else d for d in doc_ids], "<i8"),
        "doc_valid": np.array([d is not None for d in doc_ids], np.uint8),
        "doc_first": np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype("<u8"),
    }
    header = {"n_docs": len(doc_ids), "n_tokens": len(rest), "sections": {}}
    for level, (width, kind) in enumerate(LEVELS):
        sections[f"chunks{level}"] = (rest & np.uint32((1 << width) - 1)).astype(kind)
        rest = rest >> np.uint32(width)
        more = rest > 0
        if level + 1 < len(LEVELS):
            sections |= {f"{name}{level}": part for name, part in directory(more).items()}
        rest = rest[more]
    body, at = [], 0
    for name, part in sections.items():
        header["sections"][name] = [at, len(part), part.dtype.str]
        body += [part.tobytes(), bytes(-part.nbytes % 8)]
        at += part.nbytes + -part.nbytes % 8
    head = json.dumps(header).encode()
    head += b" " * (-len(head) % 8)
    return b"".join([MAGIC, len(head).to_bytes(8, "little"), head, *body])


class TokenFile:
    """Random access to the ids of one file; ``data`` may be a memory map."""

    def __init__(self, data) -> None:
        view = memoryview(data)
        if bytes(view[:8]) != MAGIC:
            raise ValueError("not a token file")
        size = int.from_bytes(view[8:16], "little")
        self.header = json.loads(bytes(view[16:16 + size]))
        base = 16 + size
        self.parts = {name: np.frombuffer(view, np.dtype(kind), n, base + at)
                      for name, (at, n, kind) in self.header["sections"].items()}

    def __len__(self) -> int:
        return self.header["n_tokens"]

    def get(self, positions: np.ndarray) -> np.ndarray:
        """The ids at any positions."""
        at = np.asarray(positions, np.int64)
        if len(at) and (at.min() < 0 or at.max() >= len(self)):
            raise IndexError("position outside the file")
        out, rows, shift = np.zeros(len(at), np.uint32), np.arange(len(at)), 0
        for level, (width, _) in enumerate(LEVELS):
            out[rows] |= self.parts[f"chunks{level}"][at].astype(np.uint32) << np.uint32(shift)
            if level + 1 < len(LEVELS):
                goes_on, before = rank(*(self.parts[f"{k}{level}"] for k in ("bits", "blocks", "words")), at)
                rows, at, shift = rows[goes_on], before[goes_on], shift + width
        return out

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Document id, its first token in this file, and its ids, each read by position."""
        ids, valid, first = (self.parts[k] for k in ("doc_ids", "doc_valid", "doc_first"))
        for doc in range(self.header["n_docs"]):
            start, end = int(first[doc]), int(first[doc + 1])
            found = [self.get(np.arange(a, min(a + READ_AT_ONCE, end))) for a in range(start, end, READ_AT_ONCE)]
            yield int(ids[doc]) if valid[doc] else None, start, (np.concatenate(found) if found else np.zeros(0, np.uint32))


def write_tokens(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID, id_col: str = "doc_id",
                 text_col: str = "text", file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Write all texts below ``folder``; the manifest, one row per file, with ``start``, the ids before it."""
    path = tokenizer or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done = TaskContext.get().partitionId(), []
        ids, tokens, n = [], [], 0

        def flush() -> None:
            name = f"{folder}/{part:06d}-{len(done):06d}-{uuid.uuid4().hex}.tokens"
            put(name, encode_file(ids, tokens))
            done.append({"part": part, "number": len(done), "path": name, "n_docs": len(ids), "n_tokens": n})

        for doc, found in encoded(batches, path):
            ids.append(doc)
            tokens.append(np.append(found, np.uint32(end_id)))
            n += len(found) + 1
            if n >= file_tokens:
                flush()
                ids, tokens, n = [], [], 0
        if ids:
            flush()
        if done:
            yield pa.RecordBatch.from_pylist(done)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ranged = rows.withColumn("tie", F.crc32(F.coalesce("text", F.lit("")).cast("binary"))).repartitionByRange("id", "tie")
    written = materialize(ranged.sortWithinPartitions("id", "tie").select("id", "text").mapInArrow(run, _MANIFEST), "manifest")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return written.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                file = TokenFile(get(path))
                rows = [(doc, before + first, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                        for doc, first, ids in file.documents()]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])

    # One small row stands for one file of work.
    tasks = max(1, manifest.sparkSession.sparkContext.defaultParallelism * 4)
    return manifest.select("path", "start").repartition(tasks).mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long")


@query()
def op9_direct_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    return read_tokens(write_tokens(table(spark, sf_dir, "documents"), folder))
