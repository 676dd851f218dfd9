"""Restrictions an investigator puts on a search."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tierwatch.functions.text import contains_any
from tierwatch.operators.vector_search import equals


def restrict(messages: DataFrame, ts: str = "sent_at", since: datetime | None = None,
             until: datetime | None = None, filter_eq: Mapping[str, object] | None = None,
             text: str = "body", words: Sequence[str] = ()) -> DataFrame:
    """Messages of a time span (start included, end not), with attributes and any of some words.

    Time and attribute conditions reach the scan; a store partitioned by day skips the rest.
    """
    kept = messages.filter(equals(filter_eq))
    if since is not None:
        kept = kept.filter(F.col(ts) >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        kept = kept.filter(F.col(ts) < F.lit(until).cast("timestamp_ntz"))
    if words:
        kept = kept.filter(contains_any(F.col(text), words))
    return kept
