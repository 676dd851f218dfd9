"""Text helpers built from native expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from string import Formatter

from pyspark.sql import Column, functions as F

TOKEN_SEPARATOR = r"[^\p{L}\p{N}]+"


def contains_any(text: Column, phrases: Sequence[str]) -> Column:
    """True when the lower-cased text contains one of the phrases anywhere; null for null.

    Text and phrases are lowered by the same function. The phrases are one array
    literal, so the expression has one form for a list of any length; each is a plain
    substring search on the bytes.
    """
    if not phrases:
        raise ValueError("at least one phrase is needed")
    lowered = F.lower(text)
    wanted = F.array(*[F.lower(F.lit(p)) for p in phrases])
    return F.when(text.isNotNull(), F.exists(wanted, lambda p: F.contains(lowered, p)))


def message_text(subject: Column, body: Column, body_chars: int | None = None,
                 skip_nulls: bool = False) -> Column:
    """Subject and body joined by a space.

    A null part makes the result null, as in SQL CONCAT, unless ``skip_nulls`` is set.
    """
    cut = body if body_chars is None else preview(body, body_chars)
    if skip_nulls:
        return F.concat_ws(" ", subject, cut)
    return F.concat(subject, F.lit(" "), cut)


def preview(text: Column, chars: int) -> Column:
    return F.substring(text, 1, chars)


def first_token(name: Column) -> Column:
    return F.split(name, " ")[0]


def route_label(sender: Column, recipient: Column) -> Column:
    """``a -> b``; null when one side is null."""
    return F.concat(sender, F.lit(" -> "), recipient)


def fill_template(template: str, values: Mapping[str, Column]) -> Column:
    """Fill ``{name}`` places of a template with columns; null when a value is null."""
    parts: list[Column] = []
    for literal, field, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is not None:
            parts.append(values[field].cast("string"))
    return F.concat(*parts)


def iso_to_timestamp(text: Column) -> Column:
    """Parse an ISO timestamp without zone; null when it is not one."""
    return text.try_cast("timestamp_ntz")


def timestamp_to_iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
