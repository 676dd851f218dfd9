"""Decisions, the tiered view, and its read-outs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierwatch.functions.decisions import route, three_way


def decide(scored: DataFrame, probability: str = "predict_proba_1") -> DataFrame:
    """Add ``violation_probability`` and the three-way ``ml_decision``."""
    return (scored.withColumn("violation_probability", F.col(probability))
            .withColumn("ml_decision", three_way(F.col("violation_probability"))))


def tiered_view(predictions: DataFrame, messages: DataFrame, analysis: DataFrame,
                key: str = "email_id") -> DataFrame:
    """Predictions joined with message attributes and, where there is one, the analysis.

    Only the narrow columns take part; bodies are never shuffled. With the three tables
    bucketed alike on the key both joins run without a shuffle.
    """
    attributes = messages.select(key, "subject", "sender_dept", "recipient_dept",
                                 F.col("compliance_label").alias("actual_label"))
    answers = analysis.select(key, "analysis")
    scored = predictions.select(key, "ml_decision", "violation_probability", "is_violation")
    return (scored.join(attributes, key).join(answers, key, "left")
            .withColumn("pipeline_action", route(F.col("ml_decision")))
            .select(key, "subject", "sender_dept", "recipient_dept", "ml_decision",
                    "violation_probability", "pipeline_action", "analysis", "actual_label",
                    "is_violation"))
