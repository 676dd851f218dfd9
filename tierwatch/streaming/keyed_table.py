"""A table with one row for each key that follows what arrives: later rows may replace earlier ones."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tierwatch.session import create_text, delete_folder, file_names, read_text, scratch_path
from tierwatch.streaming.refresh import RunReport, run_available

BUCKETS = 64


@dataclass(frozen=True)
class Version:
    """The state after a batch: the folder of each bucket that has rows, and counts of all batches so far."""

    n: int = 0
    batches: dict[str, int] = field(default_factory=dict)
    folders: dict[str, str] = field(default_factory=dict)
    newest: str | None = None
    rows_in: int = 0
    stored: int = 0
    repeats: int = 0
    late: int = 0


class KeyedTable:
    """Rows by key in Parquet, in buckets by a hash of the key.

    A batch rewrites the buckets that its keys touch and leaves the others; then one small file, the next version, makes that
    visible, so readers see all of a batch or nothing. Of the rows of a key the one with the latest time stays, or the one with
    the earliest if ``keep`` says so, and of equal times the one with the larger digest of its values: the order of arrival, and how it is
    cut into batches, makes no difference. Rows that are more than ``delay`` older than the newest of earlier batches are *late*:
    they go to a side table. Every row that comes in is stored, a repeat, or late. Rows without key or time are left out.
    A batch that is tried again changes nothing if it was done, and one table takes one writer at a time: a second one that is faster makes the
    first begin again.
    """

    def __init__(self, root: str, key: Sequence[str], ts: str, keep: str = "latest", delay: timedelta | None = None, buckets: int = BUCKETS):
        if keep not in ("latest", "earliest"):
            raise ValueError(f"keep the latest or the earliest: {keep!r}")
        self.root, self.key, self.ts, self.keep = root.rstrip("/"), list(key), ts, keep
        self.delay, self.buckets = delay, buckets

    def version(self, spark: SparkSession) -> Version:
        numbers = [int(name.removesuffix(".json")) for name in file_names(spark, f"{self.root}/versions") if name.endswith(".json")]
        return Version(**json.loads(read_text(spark, self._version_path(max(numbers))))) if numbers else Version()

    def rows(self, spark: SparkSession) -> DataFrame:
        """The rows of the last version."""
        return self._read(spark, self.version(spark).folders).drop("_digest", "_bucket", "_ours", "_new_key", "_version")

    def late_rows(self, spark: SparkSession) -> DataFrame:
        """Rows that came too late, with the origin and batch that brought them."""
        done = self.version(spark)
        late = spark.read.parquet(f"{self.root}/late")
        counted = [(F.col("origin") == origin) & (F.col("batch").cast("long") <= last) for origin, last in done.batches.items()]
        known = counted[0]
        for more in counted[1:]:
            known = known | more
        return late.filter(known)

    def changes(self, spark: SparkSession, batch_id: int, origin: str = "bulk") -> DataFrame:
        """What a batch changed: the rows it put in place, with ``change`` insert or update."""
        return spark.read.parquet(self._side("changes", origin, batch_id))

    def upsert(self, rows: DataFrame, batch_id: int, origin: str = "bulk") -> Version:
        """Take in the rows of one batch; ``rows`` are read several times."""
        spark = rows.sparkSession
        while True:
            before = self.version(spark)
            if before.batches.get(origin, -1) >= batch_id:
                return before
            after = self._merged(rows, batch_id, origin, before)
            if create_text(spark, self._version_path(after.n), json.dumps(asdict(after))):
                return after

    def _merged(self, rows: DataFrame, batch_id: int, origin: str, before: Version) -> Version:
        spark, time = rows.sparkSession, F.col(self.ts)
        usable = rows.filter(time.isNotNull() & ~F.greatest(*(F.col(k).isNull() for k in self.key), F.lit(False)))
        is_late: Column = F.lit(False)
        if before.newest and self.delay is not None:
            is_late = time.cast("timestamp_ntz") < F.lit(datetime.fromisoformat(before.newest) - self.delay)
        seen = Observation()
        late = usable.filter(is_late)
        late.observe(seen, F.count("*").alias("n")).write.mode("overwrite").parquet(self._side("late", origin, batch_id))
        n_late = seen.get["n"]

        values = [c for c in rows.columns if c not in (*self.key, self.ts)]
        timely = usable.filter(~is_late).withColumns({
            "_digest": F.xxhash64(F.lit(0), *values), "_bucket": F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")})
        # Repeats within the batch leave before anything is joined; each task combines its own.
        ours = self._one_each(timely, [F.lit(True)], {"_n": F.count("*"), "_newest": F.max(time.cast("timestamp_ntz"))})
        path = scratch_path(spark, "arrived")
        try:
            ours.write.parquet(path)
            ours = spark.read.schema(ours.schema).parquet(path)
            found = ours.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"), F.max("_newest").alias("newest"),
                             F.collect_set("_bucket").alias("touched")).first()  # at most as many as buckets
            folder, inserted = uuid.uuid4().hex, 0
            folders = dict(before.folders)
            if found["touched"]:
                columns = [*rows.columns, "_digest", "_bucket"]
                ours = ours.select(*columns)
                old = self._read(spark, {b: f for b, f in folders.items() if int(b) in found["touched"]}, ours.schema)
                both = old.withColumn("_ours", F.lit(False)).unionByName(ours.withColumn("_ours", F.lit(True)))
                # Of equal rows the stored one stays: it is no change.
                kept = self._one_each(both, [F.col("_ours")], {"_new_key": F.min("_ours")}).select(*columns, "_ours", "_new_key")
                version = f"{self.root}/rows/_version={folder}"
                seen = Observation()
                (kept.observe(seen, F.count_if("_new_key").alias("inserted")).repartition("_bucket")
                 .write.partitionBy("_bucket").parquet(version))
                inserted = seen.get["inserted"]
                written = spark.read.schema(kept.schema).parquet(version).filter("_ours")
                change = F.when(F.col("_new_key"), "insert").otherwise("update").alias("change")
                written.select(*rows.columns, change).write.mode("overwrite").parquet(self._side("changes", origin, batch_id))
                folders |= {str(b): folder for b in found["touched"]}
        finally:
            delete_folder(spark, path)
        newest = max(filter(None, [before.newest, found["newest"].isoformat() if found["newest"] else None]), default=None,
                     key=datetime.fromisoformat)
        return replace(before, n=before.n + 1, batches=before.batches | {origin: batch_id}, folders=folders, newest=newest,
                       rows_in=before.rows_in + found["n"] + n_late, stored=before.stored + inserted,
                       repeats=before.repeats + found["n"] - inserted, late=before.late + n_late)

    def _one_each(self, rows: DataFrame, then: list[Column], counts: dict[str, Column]) -> DataFrame:
        """The row of each key that stays, and some figures of the key's rows; tasks combine their own rows first."""
        latest = self.keep == "latest"
        digest = F.col("_digest") if latest else -F.col("_digest").cast("decimal(20,0)")
        order = F.struct(F.col(self.ts), digest, *((~c if latest else c) for c in then))
        others = [c for c in rows.columns if c not in self.key]
        return rows.groupBy(*self.key).agg(
            (F.max_by if latest else F.min_by)(F.struct(*others), order).alias("_row"), *(c.alias(n) for n, c in counts.items())).select(
                *self.key, "_row.*", *counts)

    def _read(self, spark: SparkSession, folders: dict[str, str], schema=None) -> DataFrame:
        if not folders:
            if schema is None:
                raise ValueError("the table has no rows yet")
            return spark.createDataFrame([], schema)
        by_folder: dict[str, list[int]] = {}
        for bucket, name in folders.items():
            by_folder.setdefault(name, []).append(int(bucket))
        paths = [f"{self.root}/rows/_version={name}/_bucket={b}" for name, bs in by_folder.items() for b in bs]
        stored = spark.read.option("basePath", f"{self.root}/rows").parquet(*paths)
        return stored.select(*schema.names) if schema else stored

    def _version_path(self, n: int) -> str:
        return f"{self.root}/versions/{n:012d}.json"

    def _side(self, name: str, origin: str, batch_id: int) -> str:
        return f"{self.root}/{name}/origin={origin}/batch={batch_id}"


def follow(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], table: KeyedTable, checkpoint: str) -> RunReport:
    """Take what has arrived into a table, by batches; ``transform`` must keep key and time and be row-wise."""
    spark, origin = stream.sparkSession, "stream" + hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    before = table.version(spark).late

    def write(batch: DataFrame, batch_id: int) -> None:
        # Transformed once; the table reads the narrow result several times.
        path = scratch_path(spark, "arrived")
        try:
            made = transform(batch)
            made.write.parquet(path)
            table.upsert(spark.read.schema(made.schema).parquet(path), batch_id, origin)
        finally:
            delete_folder(spark, path)

    report = run_available(stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), spark)
    return RunReport(report.batches, report.rows_in, table.version(spark).late - before)
