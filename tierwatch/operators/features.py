"""Semantic features of a message."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tierwatch.constants import (
    BARRIER_PAIR, BASELINE_COLUMN, CLEAN, CONCEPTS, FEATURE_COLUMNS, FEATURE_PREVIEW_CHARS,
    FLAG_COLUMN, RISK_COLUMNS, TARGET_COLUMN,
)
from tierwatch.functions.decisions import cross_group_flag, violation_target
from tierwatch.functions.embedding import Embedder, similarities
from tierwatch.functions.once import with_once
from tierwatch.functions.text import message_text, preview


def concept_features(df: DataFrame, text: Column, concepts: Mapping[str, str] = CONCEPTS,
                     embedder: Embedder | None = None) -> DataFrame:
    """One similarity column per concept.

    Row-wise: no shuffle, a row without words stays, and the same plan runs on a stream.
    """
    return with_once(df, similarities(text, concepts, embedder), *concepts)


def relative_scores(df: DataFrame, risks: Sequence[str] = RISK_COLUMNS,
                    baseline: str = BASELINE_COLUMN) -> DataFrame:
    """Risk similarity minus baseline similarity, beside the raw columns."""
    return df.withColumns({_relative(r): F.col(r) - F.col(baseline) for r in risks})


def _relative(risk: str) -> str:
    return risk.removesuffix("_risk_score") + "_relative"


def message_features(messages: DataFrame, concepts: Mapping[str, str] = CONCEPTS,
                     pair: tuple[str, str] = BARRIER_PAIR, clean: str = CLEAN,
                     embedder: Embedder | None = None) -> DataFrame:
    """The semantic feature table: message columns, similarities, barrier flag, target."""
    scored = concept_features(messages, message_text(F.col("subject"), F.col("body")), concepts, embedder)
    return scored.withColumns({
        FLAG_COLUMN: cross_group_flag(F.col("sender_dept"), F.col("recipient_dept"), pair),
        TARGET_COLUMN: violation_target(F.col("compliance_label"), clean),
    })


def feature_view_columns(features: DataFrame, key: str = "email_id", ts: str = "sent_at",
                         columns: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Key, event time, model inputs and target: the narrow table that training reads."""
    return features.select(key, F.col(ts).alias("ts"), *columns, TARGET_COLUMN)


def label_separation(features: DataFrame, label: str = "compliance_label",
                     risks: Sequence[str] = RISK_COLUMNS, digits: int = 3) -> DataFrame:
    """Row count and mean of each score by label, largest label first."""
    means = [F.round(F.avg(r), digits).alias(f"avg_{r}") for r in risks]
    return (features.groupBy(label).agg(F.count("*").alias("n"), *means)
            .orderBy(F.desc("n"), F.col(label)))


def top_risk_messages(messages: DataFrame, columns: Sequence[str], key: str, k: int = 3,
                      label: str = "compliance_label", clean: str = CLEAN,
                      concepts: Mapping[str, str] = CONCEPTS, pair: tuple[str, str] = BARRIER_PAIR,
                      embedder: Embedder | None = None) -> DataFrame:
    """``top_risk`` straight from messages: the label decides first, so clean texts are never embedded."""
    flagged = messages.filter(F.col(label) != clean)
    return top_risk(message_features(flagged, concepts, pair, clean, embedder), columns, key, k, label, clean=clean)


def top_risk(features: DataFrame, columns: Sequence[str], key: str, k: int = 3,
             label: str = "compliance_label", body: str = "body", clean: str = CLEAN,
             chars: int = FEATURE_PREVIEW_CHARS) -> DataFrame:
    """The ``k`` labelled violations with the largest sum of scores.

    Ordered by the unrounded sum, ties by key. A missing label is left out here, as SQL
    inequality does.
    """
    total = reduce(lambda a, b: a + b, [F.col(c) for c in columns])
    return (features.filter(F.col(label) != clean)
            .withColumn("risk_total", total)
            .orderBy(F.desc_nulls_last("risk_total"), F.asc(key)).limit(k)
            .withColumn("body_preview", preview(F.col(body), chars)).drop(body))
