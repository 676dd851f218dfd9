"""Costly columns that no plan computes twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_once(df: DataFrame, columns: Column, *names: str) -> DataFrame:
    """``df`` with the fields ``names`` of a struct column; columns of these names are replaced.

    A plain column is computed again for a filter on it, because the filter is pushed below it. Here the fields come from a
    generator of one row: filters on them stay above it, filters on other columns still go below, and reach the scan.
    """
    return df.drop(*names).select("*", F.inline(F.array(columns)).alias(*names)) if names else df
