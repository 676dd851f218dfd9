"""Keyword baseline: flag, and examples of its errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tierwatch.constants import CLEAN, ERROR_PREVIEW_CHARS, SUSPICIOUS_PHRASES
from tierwatch.functions.text import contains_any, preview

FLAGGED = "FLAGGED"
PREDICTION = "baseline_prediction"


def keyword_flag(df: DataFrame, text: str, phrases: Sequence[str] = SUSPICIOUS_PHRASES,
                 into: str = PREDICTION) -> DataFrame:
    """FLAGGED when the lower-cased text holds a phrase anywhere; a null text is CLEAN."""
    return df.withColumn(into, F.when(contains_any(F.col(text), phrases), FLAGGED).otherwise(CLEAN))


def is_flagged(prediction: str = PREDICTION) -> Column:
    return F.col(prediction) == FLAGGED


def differs_from_clean(label: str, clean: str = CLEAN) -> Column:
    """True for any label but the clean one; a missing label counts as different."""
    return ~F.col(label).eqNullSafe(F.lit(clean))


def _examples(df: DataFrame, wanted: Column, key: str, body: str, limit: int, chars: int) -> DataFrame:
    return (df.filter(wanted).orderBy(key).limit(limit)
            .withColumn(body, preview(F.col(body), chars)))


def false_alarms(df: DataFrame, key: str, label: str, body: str, limit: int = 2,
                 chars: int = ERROR_PREVIEW_CHARS) -> DataFrame:
    """The first clean rows that were flagged."""
    return _examples(df, is_flagged() & ~differs_from_clean(label), key, body, limit, chars)


def missed_violations(df: DataFrame, key: str, label: str, body: str, limit: int = 3,
                      chars: int = ERROR_PREVIEW_CHARS) -> DataFrame:
    """The first violations that were not flagged."""
    return _examples(df, ~is_flagged() & differs_from_clean(label), key, body, limit, chars)
