"""Quality of a score at every threshold: curves, areas, the best threshold and calibration.

Scores are counted, dealt by ranges and added up within the ranges; what lies before a range is one row a
range. So nothing sorts all scores in one task, and rows of equal score, however many, are one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierwatch.functions.ratios import harmonic_mean, safe_ratio
from tierwatch.session import materialize


def _counts(scored: DataFrame, score: str, target: str) -> DataFrame:
    """Rows and positives of each score, stored by falling ranges of it; rows without score or target are left out."""
    known = scored.filter(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & F.col(target).isNotNull())
    counts = known.groupBy(F.col(score).alias("threshold")).agg(
        F.count("*").alias("rows"), F.count_if(F.col(target) == 1).alias("positives"))
    dealt = counts.repartitionByRange(F.desc("threshold")).withColumn("part", F.spark_partition_id())
    return materialize(dealt, "score-counts")


def threshold_curve(scored: DataFrame, score: str, target: str = "is_violation") -> DataFrame:
    """``threshold, tp, fp, fn, tn, precision, recall, f1`` for each score that occurs, as a threshold; at it is positive."""
    counts = _counts(scored, score, target)
    parts = counts.groupBy("part").agg(F.sum("rows").alias("part_rows"), F.sum("positives").alias("part_positives"))
    # One row a range: its counts of all higher scores, and of all.
    ahead, every = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    parts = parts.select("part", *(f(c) for c in ("rows", "positives") for f in (
        lambda c: F.coalesce(F.sum(f"part_{c}").over(ahead), F.lit(0)).alias(f"before_{c}"),
        lambda c: F.sum(f"part_{c}").over(every).alias(f"all_{c}"))))
    within = Window.partitionBy("part").orderBy(F.desc("threshold"))
    found = counts.join(F.broadcast(parts), "part").select(
        "threshold", "all_rows", "all_positives", "rows", "positives",
        *((F.sum(c).over(within) + F.col(f"before_{c}")).alias(f"sum_{c}") for c in ("rows", "positives")))
    tp = F.col("sum_positives")
    fp = F.col("sum_rows") - tp
    curve = found.select("threshold", tp.alias("tp"), fp.alias("fp"), (F.col("all_positives") - tp).alias("fn"),
                         (F.col("all_rows") - F.col("all_positives") - fp).alias("tn"), F.col("rows").alias("rows_at"), F.col("positives").alias("positives_at"))
    curve = curve.withColumns({"precision": safe_ratio(F.col("tp"), F.col("tp") + F.col("fp")),
                               "recall": safe_ratio(F.col("tp"), F.col("tp") + F.col("fn"))})
    return curve.withColumn("f1", harmonic_mean(F.col("precision"), F.col("recall")))


def curve_summary(curve: DataFrame) -> DataFrame:
    """One row: rows, positives, average precision, area under the ROC, and the threshold of the best F1 (the highest of equal ones).

    Ties count by halves in the area, as pairs of a positive and a negative of equal score do.
    """
    positives, negatives = F.col("tp") + F.col("fn"), F.col("fp") + F.col("tn")
    fp_at = F.col("rows_at") - F.col("positives_at")
    under = fp_at * (F.col("tp") - F.col("positives_at") / 2.0)
    best = F.max(F.struct(F.round("f1", 12).alias("f1"), F.col("threshold")))
    found = curve.agg(
        F.max(positives + negatives).alias("total"), F.max(positives).alias("positives"), F.max(negatives).alias("_negatives"),
        F.sum(F.col("positives_at") * F.col("precision")).alias("_precision"), F.sum(under).alias("_under"), best.alias("_best"))
    return found.select("total", "positives", safe_ratio(F.col("_precision"), F.col("positives")).alias("average_precision"),
                        safe_ratio(F.col("_under"), F.col("positives") * F.col("_negatives").cast("double")).alias("area_under_roc"),
                        F.col("_best.threshold").alias("best_threshold"), F.col("_best.f1").alias("best_f1"))


def calibration(scored: DataFrame, score: str, target: str = "is_violation", bins: int = 10) -> DataFrame:
    """``bin, n, mean_score, violation_rate`` for equal parts of the scores from 0 to 1; 1 belongs to the last."""
    at: Column = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).cast("int")
    known = scored.filter(F.col(score).between(0, 1) & F.col(target).isNotNull())
    return known.groupBy(at.alias("bin")).agg(
        F.count("*").alias("n"), F.avg(score).alias("mean_score"), F.avg((F.col(target) == 1).cast("double")).alias("violation_rate"))
