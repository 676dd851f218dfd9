"""Point-in-time feature lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_SECONDS = 3600


def _slot(ts: str, slot_seconds: int) -> Column:
    # Built from calendar fields: increases with a timestamp without zone in any session zone.
    moment = F.col(ts)
    seconds = (F.unix_date(F.to_date(moment)).cast("long") * 86400
               + F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment))
    return F.floor(seconds / slot_seconds)


def as_of_lookup(spine: DataFrame, features: DataFrame, key: str, ts: str, values: Sequence[str],
                 tie_break: str | None = None, slot_seconds: int = _SECONDS) -> DataFrame:
    """Each spine row with the values of the latest feature row of its key at or before its time.

    Feature rows with the same key and time are first reduced to one, the largest by
    ``tie_break`` (else by the values). Keys are cut into time slots: a window sees one
    key and slot, and the last feature of earlier slots is carried in from a
    pre-aggregated table with one row per key and slot. A key that holds a third of all
    rows therefore becomes many tasks.
    """
    slot = _slot(ts, slot_seconds)
    packed = F.struct(*values)
    order = F.col(tie_break) if tie_break else packed
    latest = (features.dropna(subset=[key, ts]).groupBy(key, ts).agg(F.max_by(packed, order).alias("_value"))
              .withColumn("_slot", slot))

    # Rows without key or time match nothing: they stay out of the windows, where they would be one group.
    known = F.col(key).isNotNull() & F.col(ts).isNotNull()
    left = spine.filter(known).withColumn("_slot", slot)
    rows = (left.withColumns({"_value": F.lit(None).cast(latest.schema["_value"].dataType), "_side": F.lit(1)})
            .unionByName(latest.select(key, ts, "_slot", "_value", F.lit(0).alias("_side")),
                         allowMissingColumns=True))
    so_far = (Window.partitionBy(key, "_slot").orderBy(ts, "_side")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inside = (rows.withColumn("_here", F.last("_value", ignorenulls=True).over(so_far))
              .filter("_side = 1"))

    # The value each slot starts with: the newest feature of any earlier slot.
    per_slot = latest.groupBy(key, "_slot").agg(F.max_by("_value", ts).alias("_last"))
    needed = left.select(key, "_slot").distinct()
    slots = needed.join(per_slot, [key, "_slot"], "full_outer")
    before = (Window.partitionBy(key).orderBy("_slot")
              .rowsBetween(Window.unboundedPreceding, -1))
    carried = slots.select(key, "_slot", F.last("_last", ignorenulls=True).over(before).alias("_before"))

    found = F.coalesce("_here", "_before")
    joined = inside.join(carried, [key, "_slot"], "left")
    kinds = {f.name: f.dataType for f in latest.schema["_value"].dataType.fields}
    nothing = spine.filter(~known).select(
        *spine.columns, *[F.lit(None).cast(kinds[v]).alias(f"asof_{v}") for v in values])
    return joined.select(*spine.columns, *[found[v].alias(f"asof_{v}") for v in values]).unionByName(nothing)
