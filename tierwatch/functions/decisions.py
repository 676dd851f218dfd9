"""Flags, targets, decisions and routes as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from tierwatch.constants import (
    BARRIER_PAIR, CLEAN, DEFAULT_ROUTE, HIGH_RISK, HIGH_RISK_AT, LOW_RISK, LOW_RISK_AT,
    NEEDS_REVIEW, ROUTES,
)


def cross_group_flag(sender: Column, recipient: Column,
                     pair: tuple[str, str] = BARRIER_PAIR) -> Column:
    """1 when the message crosses between the two groups in either direction, else 0."""
    a, b = pair
    crosses = ((sender == a) & (recipient == b)) | ((sender == b) & (recipient == a))
    return F.when(crosses, 1).otherwise(0)


def violation_target(label: Column, clean: str = CLEAN) -> Column:
    """0 for the clean label and 1 for any other one, a missing label included."""
    return F.when(label == clean, 0).otherwise(1)


def three_way(probability: Column, high: float = HIGH_RISK_AT, low: float = LOW_RISK_AT) -> Column:
    """High at or above ``high``, low at or below ``low``; the rest and null need review."""
    return (F.when(probability >= high, HIGH_RISK)
            .when(probability <= low, LOW_RISK)
            .otherwise(NEEDS_REVIEW))


def route(decision: Column, routes: Mapping[str, str] = ROUTES,
          default: str = DEFAULT_ROUTE) -> Column:
    """The action for a decision; an unknown or missing decision gets the default."""
    chain = F
    for value, action in routes.items():
        chain = chain.when(decision == value, action)
    return chain.otherwise(default)


def logistic_score(columns: Sequence[str], weights: Sequence[float], bias: float) -> Column:
    """A logistic score with given weights: a probability source that needs no training."""
    if len(columns) != len(weights):
        raise ValueError("one weight per column is needed")
    terms = [F.col(c).cast("double") * float(w) for c, w in zip(columns, weights)]
    linear = reduce(lambda x, y: x + y, terms, F.lit(float(bias)))
    return 1.0 / (1.0 + F.exp(-linear))
