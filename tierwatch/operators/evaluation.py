"""Counts, shares and quality metrics; every one stays a distributed aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierwatch.constants import (
    EVALUATION_THRESHOLD, HIGH_RISK, LOW_RISK, NEEDS_REVIEW, REVIEW_CATCH_RATE, REVIEW_PASS_RATE,
)
from tierwatch.functions.ratios import harmonic_mean, percent, safe_ratio


def _share_of_total(count: str) -> Column:
    # The window runs over the aggregate: one row per group value.
    return percent(F.col(count), F.sum(count).over(Window.partitionBy()))


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    """Count and percent per label, largest first."""
    return (df.groupBy(label).agg(F.count("*").alias("n"))
            .withColumn("pct", _share_of_total("n"))
            .orderBy(F.desc("n"), F.col(label)))


def group_distribution(df: DataFrame, group: str, target: str = "is_violation") -> DataFrame:
    """Count, share of all rows, violations and violation rate per group."""
    return (df.groupBy(group)
            .agg(F.count("*").alias("n"), F.sum(F.col(target).cast("long")).alias("violations"))
            .withColumn("pct", _share_of_total("n"))
            .withColumn("violation_rate", percent(F.col("violations"), F.col("n")))
            .orderBy(F.desc("violation_rate"), F.col(group)))


def violation_rate(df: DataFrame, target: str = "is_violation") -> DataFrame:
    """Rows, violations and their percentage, in one pass."""
    found = F.count_if(F.col(target) == 1)
    return df.agg(F.count("*").alias("n"), found.alias("violations"),
                  percent(found, F.count("*")).alias("pct"))


def confusion_counts(df: DataFrame, predicted: Column, actual: Column) -> DataFrame:
    """total, tp, fp, fn, tn of two boolean columns; a null in either counts only in total."""
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(predicted & actual).alias("tp"),
        F.count_if(predicted & ~actual).alias("fp"),
        F.count_if(~predicted & actual).alias("fn"),
        F.count_if(~predicted & ~actual).alias("tn"),
    )


def confusion(df: DataFrame, score: str, target: str = "is_violation",
              threshold: float = EVALUATION_THRESHOLD) -> DataFrame:
    """Confusion counts of a score at a threshold; at the threshold is positive."""
    return confusion_counts(df, F.col(score) >= threshold, F.col(target) == 1)


def with_quality(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and accuracy beside the counts; 0.0 where undefined."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return (counts
            .withColumn("precision", safe_ratio(tp, tp + fp))
            .withColumn("recall", safe_ratio(tp, tp + fn))
            .withColumn("f1", harmonic_mean(F.col("precision"), F.col("recall")))
            .withColumn("accuracy", safe_ratio(tp + tn, tp + fp + fn + tn)))


def funnel_quality(tiered: DataFrame, decision: str = "ml_decision",
                   target: str = "is_violation") -> DataFrame:
    """Violations per bucket, bucket sizes, and the quality of escalating only the high bucket."""
    bad = F.col(target) == 1
    in_bucket = {name: F.col(decision) == name for name in (HIGH_RISK, NEEDS_REVIEW, LOW_RISK)}
    counts = tiered.agg(
        F.count("*").alias("total"),
        F.count_if(bad).alias("total_violations"),
        F.count_if(in_bucket[HIGH_RISK]).alias("high_risk_count"),
        F.count_if(in_bucket[NEEDS_REVIEW]).alias("needs_review_count"),
        F.count_if(in_bucket[HIGH_RISK] & bad).alias("high_risk_violations"),
        F.count_if(in_bucket[NEEDS_REVIEW] & bad).alias("needs_review_violations"),
        F.count_if(in_bucket[LOW_RISK] & bad).alias("missed_violations"),
    )
    return (counts
            .withColumn("ml_precision", safe_ratio(F.col("high_risk_violations"), F.col("high_risk_count")))
            .withColumn("ml_recall", safe_ratio(F.col("high_risk_violations"), F.col("total_violations"))))


def hybrid_projection(funnel: DataFrame, catch_rate: float = REVIEW_CATCH_RATE,
                      pass_rate: float = REVIEW_PASS_RATE) -> DataFrame:
    """Quality to expect if the review step catches and passes the given shares of its bucket.

    Expected counts are cut to whole messages. The share of rows sent to review is taken
    from the table, not from a fixed size.
    """
    def whole(share: float, rows: Column) -> Column:
        return F.floor(rows.cast("double") * share).cast("long")

    hr, hr_v = F.col("high_risk_count"), F.col("high_risk_violations")
    nr, nr_v = F.col("needs_review_count"), F.col("needs_review_violations")
    return (funnel
            .withColumn("review_caught", whole(catch_rate, nr_v))
            .withColumn("hybrid_caught", hr_v + F.col("review_caught"))
            .withColumn("hybrid_false_positives", hr - hr_v + whole(pass_rate, nr - nr_v))
            .withColumn("hybrid_precision", safe_ratio(
                F.col("hybrid_caught"), F.col("hybrid_caught") + F.col("hybrid_false_positives")))
            .withColumn("hybrid_recall", safe_ratio(F.col("hybrid_caught"), F.col("total_violations")))
            .withColumn("recall_gain", F.col("hybrid_recall") - F.col("ml_recall"))
            .withColumn("review_share", safe_ratio(nr, F.col("total"))))


def hybrid_measured(tiered: DataFrame, decision: str = "ml_decision",
                    answer: str = "analysis", target: str = "is_violation") -> DataFrame:
    """Quality of the final flag: high risk, or reviewed and confirmed by the parsed answer."""
    confirmed = F.coalesce(F.col(answer)["is_violation"], F.lit(False))
    final = (F.col(decision) == HIGH_RISK) | ((F.col(decision) == NEEDS_REVIEW) & confirmed)
    return with_quality(confusion_counts(tiered, final, F.col(target) == 1))


def pair_stats(pairs: DataFrame, violation_like: str = "%VIOLATION%",
               clean_like: str = "%CLEAN%") -> DataFrame:
    """Size of a prompt/completion set and two independent, case-sensitive matches."""
    return pairs.agg(
        F.count("*").alias("total_examples"),
        F.count_if(F.col("completion").like(violation_like)).alias("violation_examples"),
        F.count_if(F.col("completion").like(clean_like)).alias("clean_examples"),
    )
