"""Data-quality rules, all counted in one aggregate over the input."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow import schemas
from riskflow.functions.measures import LOW_USAGE_RATIO, percent
from riskflow.functions.privacy import CARD_FORMAT, CURRENCY_FORMAT, MASK_INVALID

# Fixed value: scores above this count as high risk in the high_risk_low_usage rule.
HIGH_RISK_SCORE = 80.0

# Fixed values here and below: names of columns and checks are the contract of the reports.
FORMATS = {"card_number": CARD_FORMAT, "currency": CURRENCY_FORMAT}


@dataclass(frozen=True)
class Rule:
    """A row violates the rule where ``violation`` is true; a null outcome is no violation."""

    column: str
    check: str
    violation: Column


def null_rules(columns: Iterable[str]) -> list[Rule]:
    return [Rule(name, "null_check", F.col(name).isNull()) for name in columns]


def range_rules() -> list[Rule]:
    return [Rule("amount", "range_check", F.col("amount") <= 0)]


def format_rules(columns: Iterable[str]) -> list[Rule]:
    """Format rules for those of ``columns`` that have a fixed format."""
    return [
        Rule(name, f"format_check for {name}", ~F.col(name).rlike(FORMATS[name]))
        for name in columns if name in FORMATS
    ]


def consistency_rules(high_risk_score: float = HIGH_RISK_SCORE) -> list[Rule]:
    """Rules between columns of the enriched table."""
    amount, cost, ratio = F.col("amount"), F.col("monthly_cost"), F.col("usage_cost_ratio")
    return [
        Rule("usage_cost_ratio", "usage_cost_ratio_invalid", ratio.isNull() | (ratio <= 0)),
        Rule("usage_cost_ratio", "high_risk_low_usage",
             (ratio < LOW_USAGE_RATIO) & (F.col("risk_score") > high_risk_score)),
        Rule("amount", "amount_without_monthly_cost", amount.isNotNull() & cost.isNull()),
        Rule("amount", "missing_currency_with_amount",
             (amount > 0) & F.col("currency").isNull()),
    ]


def raw_rules() -> list[Rule]:
    """The bronze report on the raw feed, while it still holds the clear values."""
    return null_rules(schemas.RAW.names) + range_rules() + format_rules(FORMATS)


def bronze_rules() -> list[Rule]:
    """The same report on the bronze table.

    A hash is null exactly where its value is, and the mask of a malformed card is a fixed text,
    so the report needs neither the clear values nor a second parse of the feed.
    """
    on_bronze = {
        "ip_address": F.col("hash_ip").isNull(),
        "format_check for card_number": F.col("card_number") == MASK_INVALID,
    }
    rules = null_rules(schemas.RAW.names) + range_rules() + format_rules(FORMATS)
    return [
        Rule(r.column, r.check, on_bronze.get(r.check, on_bronze.get(r.column, r.violation)))
        for r in rules
    ]


def silver_rules(high_risk_score: float = HIGH_RISK_SCORE) -> list[Rule]:
    """The silver report; card formats were checked in bronze, the silver card is a mask."""
    return (
        null_rules(schemas.SILVER.names) + range_rules() + format_rules(["currency"])
        + consistency_rules(high_risk_score)
    )


def dq_report(df: DataFrame, rules: Sequence[Rule], layer: str, batch_id: int) -> DataFrame:
    """One row per rule with its count and share of violations; no rows for an empty input."""
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(rule.violation).alias(f"v{i}") for i, rule in enumerate(rules)],
    ).where("total_rows > 0")
    results = F.array(*[
        F.struct(
            F.lit(rule.column).alias("column"),
            F.lit(rule.check).alias("check"),
            F.col(f"v{i}").alias("violation_count"),
        )
        for i, rule in enumerate(rules)
    ])
    report = counts.select("total_rows", F.inline(results))
    return report.select(
        F.lit(layer).alias("layer"),
        F.lit(batch_id).cast("long").alias("batch_id"),
        "column",
        "check",
        "violation_count",
        "total_rows",
        percent(F.col("violation_count"), F.col("total_rows")).alias("violation_percent"),
        F.when(F.col("violation_count") > 0, "fail").otherwise("pass").alias("status"),
    )
