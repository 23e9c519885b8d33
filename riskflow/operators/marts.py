"""Silver to gold: daily spend, daily product usage, high-risk flag."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.functions.measures import high_risk_condition, is_high_risk
from riskflow.operators.enrich import enrich
from riskflow.schemas import RISK
from riskflow.sources.lookups import Lookup

# Silver columns that each mart reads.
SPEND_INPUT = ("user_id", "event_date", "amount")
USAGE_INPUT = ("product_id", "event_date", "usage_cost_ratio")


def user_spend(df: DataFrame) -> DataFrame:
    """Amount per user and day; null when a user-day has no amount at all."""
    return df.groupBy("user_id", "event_date").agg(F.sum("amount").alias("Total_spent_per_user"))


def product_usage(df: DataFrame) -> DataFrame:
    """Mean usage-cost ratio per product and day, over the rows that have a ratio."""
    return df.groupBy("product_id", "event_date").agg(
        F.avg("usage_cost_ratio").alias("average_usage_cost_ratio")
    )


def spend_partial(df: DataFrame) -> DataFrame:
    """What one micro-batch adds to the spend table."""
    return df.groupBy("user_id", "event_date").agg(F.sum("amount").alias("spent_sum"))


def usage_partial(df: DataFrame) -> DataFrame:
    """What one micro-batch adds to the usage table: sum and count, as means do not add up."""
    return df.groupBy("product_id", "event_date").agg(
        F.sum("usage_cost_ratio").alias("ratio_sum"),
        F.count("usage_cost_ratio").alias("ratio_count"),
    )


def fold_spend(partials: DataFrame) -> DataFrame:
    """Partials of several batches as one."""
    return partials.groupBy("user_id", "event_date").agg(F.sum("spent_sum").alias("spent_sum"))


def fold_usage(partials: DataFrame) -> DataFrame:
    return partials.groupBy("product_id", "event_date").agg(
        F.sum("ratio_sum").alias("ratio_sum"), F.sum("ratio_count").alias("ratio_count")
    )


def merge_spend(partials: DataFrame) -> DataFrame:
    return partials.groupBy("user_id", "event_date").agg(
        F.sum("spent_sum").alias("Total_spent_per_user")
    )


def merge_usage(partials: DataFrame) -> DataFrame:
    return partials.groupBy("product_id", "event_date").agg(
        F.try_divide(F.sum("ratio_sum"), F.sum("ratio_count")).alias("average_usage_cost_ratio")
    )


def flag_high_risk(df: DataFrame) -> DataFrame:
    """All rows, with the flag."""
    return df.withColumn(
        "is_high_risk_txn", is_high_risk(F.col("risk_level"), F.col("usage_cost_ratio"))
    )


def risk_alerts(bronze: DataFrame, lookups: Mapping[str, Lookup]) -> DataFrame:
    """The flagged rows only, enriched.

    The two lookups that decide are joined first. The condition drops nulls in plain sight of the
    optimizer, which makes both joins inner ones and takes the risk level into the lookup; the few
    rows left meet the other lookups.
    """
    decided = enrich(bronze, lookups, ["plans", "ip_risk"])
    flagged = decided.where(high_risk_condition(F.col("risk_level"), F.col("usage_cost_ratio")))
    return enrich(flagged, lookups, ["users", "products"]).withColumn(
        "is_high_risk_txn", F.lit(True)
    ).select(*RISK.names)
