"""Sinks and materialised results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tierwatch.sources.contract import Checked, conform


def write_table(df: DataFrame, target: str, mode: str = "overwrite",
                partition_by: Sequence[str] = (), bucket_by: str | None = None,
                buckets: int = 0) -> None:
    """Store a result as a catalog table, or as Parquet when ``target`` holds a ``/``.

    Tables that are joined on the message key again and again (messages, features,
    predictions, analysis) should share ``bucket_by`` and ``buckets``: the joins then
    need no shuffle.
    """
    writer = df.write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if "/" in target:
        if bucket_by:
            raise ValueError("bucketing needs a catalog table")
        writer.save(target)
        return
    if bucket_by:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(target)


def append_conformed(df: DataFrame, target: str, schema: T.StructType,
                     identity: str | None = None) -> Checked:
    """Append the accepted rows with default columns filled; returns both sides.

    ``identity`` names a generated key column: numbers above those in the table, unique
    but with gaps. One writer at a time, as with any append of this kind.
    """
    checked = conform(df, schema)
    rows = checked.accepted
    if identity:
        start = _largest(df.sparkSession, target, identity) + 1
        rows = rows.select((F.monotonically_increasing_id() + start).alias(identity), "*")
    write_table(rows, target, mode="append")
    return checked


def _largest(spark: SparkSession, target: str, column: str) -> int:
    if "/" not in target and not spark.catalog.tableExists(target):
        return -1
    try:
        stored = spark.read.parquet(target) if "/" in target else spark.table(target)
        return stored.agg(F.coalesce(F.max(column), F.lit(-1))).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1


def create_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def export_csv(df: DataFrame, path: str, order_by: Sequence[str],
               columns: Sequence[str] | None = None) -> None:
    """Ordered CSV with a header, nulls as empty values.

    The order is kept by range partitions over several files. End ``order_by`` with
    the key, so that many rows with the same leading value still split over tasks.
    """
    chosen = df.orderBy(*order_by).select(*columns) if columns else df.orderBy(*order_by)
    texts = [f.name for f in chosen.schema.fields if isinstance(f.dataType, T.StringType)]
    filled = chosen.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in texts})
    (filled.write.mode("overwrite").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")
     .csv(path, header=True, quote='"', escape='"', emptyValue="",
          ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False))
