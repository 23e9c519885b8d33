"""Derived measures as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Limits of the high-risk flag.
HIGH_RISK_LEVEL = "high"
LOW_USAGE_RATIO = 0.2


def usage_cost_ratio(amount: Column, monthly_cost: Column) -> Column:
    """Amount per plan cost; null when the cost is null or zero."""
    return F.try_divide(amount, monthly_cost)


def high_risk_condition(risk_level: Column, ratio: Column) -> Column:
    """High-risk address and low usage; null or false when either is unknown."""
    return (risk_level == HIGH_RISK_LEVEL) & (ratio < LOW_USAGE_RATIO)


def is_high_risk(risk_level: Column, ratio: Column) -> Column:
    """The same as a flag: false, not null, when either is unknown."""
    return F.coalesce(high_risk_condition(risk_level, ratio), F.lit(False))


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part * F.lit(100.0), whole)
