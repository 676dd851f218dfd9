"""Typed table contract: cast, not-null and length checks, load time."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tierwatch.sources.schemas import LOADED_AT, REJECT_REASON


class Checked(NamedTuple):
    accepted: DataFrame
    rejected: DataFrame


def _typed(field: T.StructField) -> Column:
    return F.col(field.name).try_cast(field.dataType)


def _reasons(schema: T.StructType, lengths: Mapping[str, int]) -> Column:
    checks = []
    for f in schema.fields:
        raw = F.col(f.name)
        if not isinstance(f.dataType, T.StringType):
            checks.append(F.when(raw.isNotNull() & _typed(f).isNull(), f"{f.name} is not {f.dataType.simpleString()}"))
        if not f.nullable:
            checks.append(F.when(raw.isNull(), f"{f.name} is missing"))
        if f.name in lengths:
            checks.append(F.when(F.length(raw) > lengths[f.name], f"{f.name} is too long"))
    return F.concat_ws("; ", *checks)


def conform(df: DataFrame, schema: T.StructType, lengths: Mapping[str, int] | None = None,
            load_time: bool = True) -> Checked:
    """Split rows by the contract of ``schema``.

    Accepted rows have exactly the declared columns and types (plus ``loaded_at``);
    a declared column that the input lacks is null. Rejected rows keep the input as it
    was with the reasons. Both sides come from one row-wise expression: no shuffle.
    """
    missing = [f for f in schema.fields if f.name not in df.columns]
    full = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else df
    found = _reasons(schema, lengths or {})
    if REJECT_REASON in full.columns:
        found = F.concat_ws("; ", F.col(REJECT_REASON), F.nullif(found, F.lit("")))
    marked = full.withColumn(REJECT_REASON, F.nullif(found, F.lit("")))
    accepted = marked.filter(F.col(REJECT_REASON).isNull()).select(
        *[_typed(f).alias(f.name) for f in schema.fields])
    if load_time:
        accepted = accepted.withColumn(LOADED_AT, F.current_timestamp().cast("timestamp_ntz"))
    return Checked(accepted, marked.filter(F.col(REJECT_REASON).isNotNull()))
