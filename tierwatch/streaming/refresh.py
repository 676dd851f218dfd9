"""Incremental refresh of features, decisions and search indexes.

Every refresh takes what has arrived since its last run (``availableNow``) and stops, so
it fits any schedule. Operators are the batch ones; only duplicates need state.
"""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener

from tierwatch.operators.search_index import SearchIndex
from tierwatch.session import delete_folder, scratch_path

DEFAULT_DELAY = "1 day"
_EVENT_TIME = "_event_time"


@dataclass(frozen=True)
class RunReport:
    batches: int
    rows_in: int
    rows_dropped_late: int


def parquet_stream(spark: SparkSession, folder: str, schema: T.StructType, name_glob: str | None = None,
                   files_per_batch: int = 1000) -> DataFrame:
    """New Parquet files of a folder as a stream, a bounded number of files per batch.

    Files in folders below it are not found. The folder may be a pattern, which may also name files.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.parquet(folder)


def first_of_each(stream: DataFrame, key: Sequence[str], ts: str, delay: str = DEFAULT_DELAY) -> DataFrame:
    """Drop repeated keys; keys are forgotten once the watermark has passed them.

    A row that is later than ``delay`` behind the newest one is dropped; the run report
    counts such rows. The delay bounds the state. Rows of one key are expected to be
    equal: which of them stays is not defined; ``keyed_table`` defines it, and keeps late rows. Repeats within an Arrow batch leave before
    the shuffle to the state, so a key that arrives very often does not fill one task.
    Give it narrow rows: what it is given goes through that shuffle.
    """
    timed = _once_in_batch(stream.withColumn(_EVENT_TIME, F.col(ts).cast("timestamp")), key)
    return timed.withWatermark(_EVENT_TIME, delay).dropDuplicatesWithinWatermark(list(key)).drop(_EVENT_TIME)


def _once_in_batch(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keep one row per key and Arrow batch: the newest, which is the last to be late."""
    names = list(key)

    def reduce_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group = np.zeros(batch.num_rows, np.int64)
            for name in names:
                codes = batch.column(name).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                group = np.unique(group * (int(codes.max(initial=0)) + 1) + codes, return_inverse=True)[1]
            age = -pc.fill_null(batch.column(_EVENT_TIME).cast(pa.int64()), -2**62).to_numpy(zero_copy_only=False)
            order = np.lexsort((age, group))
            first = np.ones(len(order), bool)
            first[1:] = group[order][1:] != group[order][:-1]
            yield batch.take(pa.array(np.sort(order[first])))

    return rows.mapInArrow(reduce_batch, rows.schema)


@contextmanager
def _state_partitions(spark: SparkSession, n: int | None):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    if n:
        spark.conf.set(name, str(n))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class _Counted(StreamingQueryListener):
    """Adds up the progress of one query. Spark itself keeps the last batches only."""

    def __init__(self) -> None:
        self.batches: dict[str, dict[int, tuple[int, int]]] = {}
        self.ended: dict[str, threading.Event] = {}

    def expect(self, run_id: str) -> threading.Event:
        return self.ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        self.expect(str(event.runId))

    def onQueryProgress(self, event) -> None:
        done = event.progress
        late = sum(s.numRowsDroppedByWatermark for s in done.stateOperators)
        seen = self.batches.setdefault(str(done.runId), {})
        rows, before = seen.get(done.batchId, (0, 0))
        seen[done.batchId] = rows + done.numInputRows, before + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.expect(str(event.runId)).set()


def run_available(writer: DataStreamWriter, spark: SparkSession, state_partitions: int | None = None) -> RunReport:
    """Process what is there and report. The first run of a checkpoint fixes its state partitions."""
    counted = _Counted()
    spark.streams.addListener(counted)
    try:
        with _state_partitions(spark, state_partitions):
            query = writer.trigger(availableNow=True).start()
            query.awaitTermination()
        if not counted.expect(str(query.runId)).wait(120):
            raise TimeoutError("the end of the stream was not reported")
    finally:
        spark.streams.removeListener(counted)
    done = counted.batches.get(str(query.runId), {}).values()
    return RunReport(sum(rows > 0 for rows, _ in done), sum(rows for rows, _ in done), sum(late for _, late in done))


def append_refresh(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str,
                   key: Sequence[str], ts: str, delay: str = DEFAULT_DELAY,
                   state_partitions: int | None = None) -> RunReport:
    """Append ``transform`` of each new message to a Parquet table, once per key.

    ``transform`` must be row-wise (features, a model's probability, decision, route) and
    keep key and time; it then gives on the stream what it gives on a table. It runs
    first: only its narrow result goes through the shuffle to the state, never texts.
    """
    rows = first_of_each(transform(stream), key, ts, delay)
    writer = (rows.writeStream.outputMode("append").format("parquet")
              .option("path", out).option("checkpointLocation", checkpoint))
    return run_available(writer, stream.sparkSession, state_partitions)


def refresh_index(stream: DataFrame, index: SearchIndex, checkpoint: str, ts: str,
                  delay: str = DEFAULT_DELAY, state_partitions: int | None = None) -> RunReport:
    """Index new messages. A batch that is retried takes the place of its earlier attempt.

    The rows kept of a batch are stored in the shared folder until they are indexed. The
    origin of the batches is the stream's checkpoint.
    """
    spark, origin = stream.sparkSession, "stream" + hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    rows = first_of_each(stream, [index.key], ts, delay)

    def write(batch: DataFrame, batch_id: int) -> None:
        # The batch is read several times; state must be advanced by one of them only.
        path = scratch_path(spark, "arrived")
        try:
            batch.write.parquet(path)
            kept = spark.read.schema(batch.schema).parquet(path)
            if not kept.isEmpty():
                index.refresh(kept, batch_id, origin)
        finally:
            delete_folder(spark, path)

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return run_available(writer, stream.sparkSession, state_partitions)
