"""Records of CSV files whose values hold line breaks, read by splits."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

_SPLIT = ["file", "start", "size"]
_PIECE = "file string, start long, side int, first boolean, record string"
#: Pieces of a split: what ends a record of an earlier one, whole records, and the beginning of one that goes on.
_HEAD, _WHOLE, _TAIL = 0, 1, 2


def csv_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """``record``: the text of each record, with its line breaks; empty lines and the header of each file are left out.

    Files are read by lines in as many tasks as they have splits. A line break ends a record if the number of quotes before
    it in the file is even. Quotes are counted for each split; the counts of the splits before it, one row a split, tell how a split
    begins. Line breaks of two characters come out as one, as Spark's reader gives them. What lies over a border of splits, at most two pieces a split, is put together afterwards. Quotes must
    only be there to quote, doubled within quotes. Fields are left to ``from_csv``.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("size"), "value")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    splits = lines.groupBy(*_SPLIT).agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    begins = splits.select(*_SPLIT, (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("open"))
    quoted = {tuple(r[c] for c in _SPLIT): r["open"] for r in begins.collect()}  # one row a split

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, inside, side, first, held = None, False, _WHOLE, False, []
        made: list[tuple] = []

        def ended(last: bool) -> None:
            """The lines held are a piece."""
            nonlocal side, first
            if held or side == _HEAD:
                made.append((split[0], split[1], side if not (last and inside) or side == _HEAD else _TAIL, first, "\n".join(held)))
            held.clear()
            side, first = _WHOLE, False

        def batch() -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
            rows = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names=["file", "start", "side", "first", "record"])
            made.clear()
            return rows

        for rows in batches:
            for *at, value in zip(*(c.to_pylist() for c in rows.columns)):
                if tuple(at) != split:
                    if held:
                        ended(True)
                    split, inside = tuple(at), quoted[tuple(at)]  # an unknown split is an error: it was cut differently before
                    side, first = (_HEAD if inside else _WHOLE), split[1] == 0
                held.append(value)
                if value.count('"') % 2:
                    inside = not inside
                if not inside:
                    ended(False)
            if len(made) > 2000:
                yield batch()
        if held:
            ended(True)
        if made:
            yield batch()

    found = lines.mapInArrow(pieces, _PIECE)
    whole = found.filter(F.col("side") == _WHOLE).select("first", "record")
    # A head, or a split that lies in one record as a whole, belongs to the last tail before it.
    order = Window.partitionBy("file").orderBy("start", "side").rowsBetween(Window.unboundedPreceding, 0)
    parts = found.filter(F.col("side") != _WHOLE).withColumn("begun", F.max(F.when(F.col("side") == _TAIL, F.col("start"))).over(order))
    joined = parts.groupBy("file", "begun").agg(
        F.bool_or("first").alias("first"), F.sort_array(F.collect_list(F.struct("start", "side", "record"))).alias("parts"))
    stitched = joined.select("first", F.array_join(F.col("parts.record"), "\n").alias("record"))
    records = whole.unionByName(stitched).select("first", F.regexp_replace("record", "\r(\n|$)", "$1").alias("record"))
    kept = records.filter(~F.col("first")) if header else records
    return kept.filter(F.col("record") != "").select("record")
