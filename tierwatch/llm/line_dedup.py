"""Lines that many documents share, removed everywhere but in one of them.

The key of a line is the line without white space at its ends, lower-cased in A-Z. A key of at
least ``min_chars`` code points that is found in at least ``min_docs`` documents loses all its lines
except in the largest document id that holds it, where all of them stay.

Method. Each row hands on the 128-bit digest of every long key with its positions, never text. The
digests are dealt out by ranges of (digest, id), the ids falling, and sorted within the ranges: the
first rows of a digest are those that keep their lines, and a task decides on the others as they stream
past, holding no more than the first ``min_docs - 1`` ids of one digest. The line that a third
of all documents share lies over many ranges; what a range cannot decide alone, its first digest and
perhaps its last, waits for the counts of all ranges, two rows each, which are summed and broadcast. The
decisions go back to the rows as compressed bitmaps of the lines to keep; texts meet them once, at the end.

Edge cases: a null or empty text is one empty line. Ids that are null are no documents: they do not
count, and lose every line that is removed. Rows that share an id are one document; each keeps or
loses lines by itself, and repeated rows alike. An empty table gives an empty result. Only the id and the text are
read, so other columns cannot clash. A very long text or a line of any length is handled whole. A text
without removed lines stays as it is, byte for byte.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tierwatch.llm.registered import query, table
from tierwatch.session import materialize

MIN_CHARS, MIN_DOCS = 40, 5
#: What tasks put into one Arrow batch of line entries.
BATCH_ENTRIES = 20_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TO_LOWER = bytes.maketrans(_UPPER.encode(), _LOWER.encode())
_DROP, _WAIT, _COUNT = 0, 1, 2
_ENTRY = "hi long, lo long, doc_id long, row_key long, n_lines int, places binary"
_DECIDED = f"kind int, {_ENTRY}, n_docs long"
_NAMES = ["hi", "lo", "doc_id", "row_key", "n_lines", "places"]


def long_key(line: bytes, min_chars: int) -> bytes | None:
    """The key of a line, or none if it is short."""
    key = line.strip(b" \t\n\x0b\x0c\r")
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    return key.translate(_TO_LOWER)


def text_entries(text: bytes | None, min_chars: int) -> tuple[int, dict[bytes, list[int]]]:
    """The number of lines, and the positions of each long key's digest."""
    lines = (text or b"").split(b"\n")
    places: dict[bytes, list[int]] = {}
    for i, line in enumerate(lines):
        key = long_key(line, min_chars)
        if key is not None:
            places.setdefault(blake2b(key, digest_size=16).digest(), []).append(i)
    return len(lines), places


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, row_key, text``: rows of one id are told apart by a hash of their texts."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("row_key"),
                       F.col(text_col).alias("text"))


def line_entries(rows: DataFrame, min_chars: int) -> DataFrame:
    """One row for each long key of each row of :func:`keyed`, with its positions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple] = []

        def flushed() -> pa.RecordBatch:
            digests = np.frombuffer(b"".join(m[0] for m in made), "<i8").reshape(-1, 2)
            arrays = [pa.array(digests[:, 0]), pa.array(digests[:, 1]), *(
                pa.array([m[i] for m in made], kind) for i, kind in ((1, pa.int64()), (2, pa.int64()), (3, pa.int32()), (4, pa.binary())))]
            made.clear()
            return pa.RecordBatch.from_arrays(arrays, names=_NAMES)

        for batch in batches:
            texts = batch.column(2).cast(pa.large_binary())
            for doc_id, row_key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                n_lines, places = text_entries(text.as_py(), min_chars)
                for digest, found in places.items():
                    made.append((digest, doc_id, row_key, n_lines, np.array(found, "<i4").tobytes()))
                    if len(made) >= BATCH_ENTRIES:
                        yield flushed()
        if made:
            yield flushed()

    return rows.mapInArrow(run, _ENTRY)


class _Stream:
    """Decisions on one range of sorted entries, batch by batch.

    A digest is *open* while its rows go on. ``n_docs`` ids have been seen of it, ``kept`` is the first
    and ``last`` the latest; ``held`` are the entries of further ids that may still be dropped.
    """

    def __init__(self, min_docs: int) -> None:
        self.min_docs = min_docs
        self.key, self.n_docs, self.kept, self.last = None, 0, None, None
        self.first = True
        self.held: list[pa.RecordBatch] = []

    def take(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        hi, lo = (batch.column(i).to_numpy() for i in (0, 1))
        named = np.asarray(batch.column(2).is_valid())
        ids = batch.column(2).fill_null(0).to_numpy()
        new_key = np.ones(len(hi), bool)
        new_key[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
        new_key[0] = self.key != (hi[0], lo[0])
        new_doc = named & new_key
        new_doc[1:] |= named[1:] & (ids[1:] != ids[:-1])
        if not new_key[0]:
            new_doc[0] = named[0] and ids[0] != self.last
        starts = np.flatnonzero(new_key)
        starts = starts if new_key[0] else np.concatenate([[0], starts])
        ends = np.append(starts[1:], len(hi))
        counts = np.add.reduceat(new_doc.astype(np.int64), starts)
        # Complete digests of this batch that no earlier row opened and no later row continues, all at once.
        whole = slice(1, len(starts) - 1)
        sizes = np.diff(np.append(starts, len(hi)))
        frequent = np.zeros(len(starts), bool)
        frequent[whole] = counts[whole] >= self.min_docs
        kept = np.repeat(ids[starts], sizes)
        drop = np.repeat(frequent, sizes) & ~(named & (ids == kept))
        if drop.any():
            yield self._out(_DROP, batch.filter(pa.array(drop)))
        for s in sorted({0, len(starts) - 1}):
            a, b = starts[s], ends[s]
            if new_key[a]:
                yield from self.close()
                self.key = (hi[a], lo[a])
                self.kept = ids[a] if named[a] else None
            yield from self._extend(batch.slice(a, b - a), ids[a:b], named[a:b], int(counts[s]))

    def _extend(self, part: pa.RecordBatch, ids: np.ndarray, named: np.ndarray, n_docs: int) -> Iterator[pa.RecordBatch]:
        """More rows of the open digest."""
        self.n_docs += n_docs
        if named.any():
            self.last = ids[np.flatnonzero(named)[-1]]
        if self.first:
            # Earlier ranges may hold larger ids of this digest.
            yield self._out(_WAIT, part)
            return
        others = part if self.kept is None else part.filter(pa.array(~(named & (ids == self.kept))))
        if self.n_docs >= self.min_docs:
            for held in [*self.held, others]:
                if len(held):
                    yield self._out(_DROP, held)
            self.held.clear()
            return
        # Rows without an id come last: what has too few ids by then stays.
        others = others.filter(others.column(2).is_valid())
        if len(others):
            self.held.append(others)

    def close(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        """The open digest has no more rows in this range; after the last one it may go on in the next."""
        if self.key is not None and (self.first or last):
            for held in self.held:
                yield self._out(_WAIT, held)
            kept = None if self.kept is None else int(self.kept)
            row = [self.key[0], self.key[1], kept, 0, 0, b""]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            yield self._out(_COUNT, pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=_NAMES))
        self.first = self.first and self.key is None
        self.key, self.n_docs, self.kept, self.last = None, 0, None, None
        self.held.clear()

    def _out(self, kind: int, rows: pa.RecordBatch) -> pa.RecordBatch:
        n = len(rows)
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), *rows.columns, pa.array(np.full(n, self.n_docs))],
                                          names=["kind", *_NAMES, "n_docs"])


def removed_lines(entries: DataFrame, min_docs: int) -> DataFrame:
    """The entries whose lines go."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = _Stream(min_docs)
        for batch in batches:
            if len(batch):
                yield from stream.take(batch)
        yield from stream.close(last=True)

    falling = F.col("doc_id").desc_nulls_last()
    sorted_ranges = entries.repartitionByRange("hi", "lo", falling).sortWithinPartitions("hi", "lo", falling, "row_key")
    # Stored, as the cuts between ranges must be the same for the counts and for what waits for them.
    decided = materialize(sorted_ranges.mapInArrow(run, _DECIDED), "line-decisions")
    # At most two rows from each range.
    counts = decided.filter(F.col("kind") == _COUNT).groupBy("hi", "lo").agg(
        F.sum("n_docs").alias("all_docs"), F.max("doc_id").alias("kept"))
    counts = counts.filter(F.col("all_docs") >= min_docs)
    waiting = decided.filter(F.col("kind") == _WAIT).join(F.broadcast(counts), ["hi", "lo"])
    waiting = waiting.filter(~F.col("doc_id").eqNullSafe(F.col("kept")))
    columns = ["hi", "lo", "doc_id", "row_key", "n_lines", "places"]
    return decided.filter(F.col("kind") == _DROP).select(*columns).unionByName(waiting.select(*columns))


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, row_key, n_lines, n_dropped, keep`` of the rows that lose a line; all others keep every line.

    ``keep`` is a deflated bitmap, one bit a line, the first line in the lowest bit.
    """
    @F.arrow_udf("struct<n_dropped: long, keep: binary>")
    def bitmap(n_lines: pa.Array, places: pa.Array) -> pa.Array:
        dropped, kept = [], []
        for n, parts in zip(n_lines.to_pylist(), places.to_pylist()):
            flags = np.ones(n, bool)
            flags[np.frombuffer(b"".join(parts), "<i4")] = False
            dropped.append(n - int(flags.sum()))
            kept.append(zlib.compress(np.packbits(flags, bitorder="little").tobytes(), 1))
        return pa.StructArray.from_arrays([pa.array(dropped, pa.int64()), pa.array(kept, pa.binary())], ["n_dropped", "keep"])

    entries = materialize(line_entries(keyed(docs, id_col, text_col), min_chars), "line-entries")
    # Repeated rows hand on equal entries; a set holds them once, so it is no larger than a text's lines.
    rows = removed_lines(entries, min_docs).groupBy("doc_id", "row_key").agg(
        F.first("n_lines").cast("long").alias("n_lines"), F.collect_set("places").alias("places"))
    return rows.select("doc_id", "row_key", "n_lines", bitmap("n_lines", "places").alias("made")).select(
        "doc_id", "row_key", "n_lines", "made.n_dropped", "made.keep")


def drop_lines(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_lines, n_dropped, text`` of every row of ``docs``; the text holds the lines that stay."""
    @F.arrow_udf("struct<n_lines: long, text: string>")
    def cut(texts: pa.Array, keeps: pa.Array) -> pa.Array:
        n_lines, kept = [], []
        for text, keep in zip(texts, keeps):
            text, keep = text.as_py() or "", keep.as_py()
            lines = text.split("\n")
            n_lines.append(len(lines))
            if keep is not None:
                flags = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines), bitorder="little")
                text = "\n".join(line for line, flag in zip(lines, flags.tolist()) if flag)
            kept.append(text)
        return pa.StructArray.from_arrays([pa.array(n_lines, pa.int64()), pa.array(kept, pa.string())], ["n_lines", "text"])

    rows, marks = keyed(docs, id_col, text_col).alias("r"), bitmaps.alias("b")
    same = F.col("r.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("r.row_key") == F.col("b.row_key"))
    met = rows.join(marks, same, "left").select("r.doc_id", F.coalesce("b.n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
                                                cut(F.col("r.text"), F.col("b.keep")).alias("made"))
    return met.select("doc_id", "made.n_lines", "n_dropped", "made.text")


_SPACE = r"[\x20\x09-\x0D]"
SQL = f"""WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (
  SELECT doc_id, i, parts[i] AS line, translate(regexp_replace(regexp_replace(parts[i], '^{_SPACE}+', ''), '{_SPACE}+$', ''),
         '{_UPPER}', '{_LOWER}') AS key
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS i FROM split)),
shared AS (
  SELECT key, max(doc_id) AS kept FROM lines WHERE length(key) >= {MIN_CHARS} GROUP BY key
  HAVING count(DISTINCT doc_id) >= {MIN_DOCS}),
marked AS (
  SELECT doc_id, i, line, kept IS NOT NULL AND doc_id <> kept AS gone FROM lines LEFT JOIN shared USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id"""


@query(SQL)
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts of all documents, and a digest of what stays of them."""
    docs = table(spark, sf_dir, "documents")
    kept = drop_lines(docs, keep_bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
