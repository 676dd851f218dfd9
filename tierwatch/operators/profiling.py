"""Data quality of a message table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tierwatch.functions.ratios import safe_ratio


def profile_messages(df: DataFrame, subject: str, columns: Sequence[str]) -> DataFrame:
    """Rows, null counts, and how many different subjects there are (exact).

    Distinct values are counted on a 16-byte digest: the shuffle moves digests, already
    reduced to one per value and task, not texts.
    """
    distinct = F.count_distinct(F.unhex(F.md5(F.col(subject).cast("binary"))))
    return (df.agg(F.count("*").alias("n"), distinct.alias("unique_subjects"),
                   *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])
            .withColumn("unique_ratio", safe_ratio(F.col("unique_subjects"), F.col("n"))))


def unique_key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count; a null key counts too."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def sample_rows(df: DataFrame, key: str, n: int, columns: Sequence[str] = ("*",)) -> DataFrame:
    """The first ``n`` rows by key: a sample that is the same in every run."""
    return df.orderBy(key).limit(n).select(*columns)
