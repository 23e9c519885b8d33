"""Classes of anomalous transactions: a table of rules over signals of each row, of which one is how
its amount stands among those of its user, by quantile sketches that add up over batches."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.operators.timelines import UNITS, VelocityRule, device_changes, units, velocity
from riskflow.sources.lookups import BROADCAST_LIMIT_BYTES

# A KLL sketch of this size is exact for as many amounts, and beyond that a quantile's
# rank is off by less than this share of the amounts in 99 of 100 cases.
SKETCH_K = 1024
RANK_ERROR = 2.296 / SKETCH_K ** 0.9723
USUAL, HIGH = 0.5, 0.95
# A user with this share of all amounts is joined apart; there are at most a thousand of them.
HOT_SHARE = 1 / 1000
LIMIT_ROW_BYTES = 100
INPUT = ("user_id", "amount")


def amount_sketches(rows: DataFrame) -> DataFrame:
    """user_id, amount_count, amounts (a sketch): one row per user with an amount.

    Sketches are filled before the shuffle and merged after it, so a hot user's amounts are never
    sorted or gathered. Null and non-finite amounts and rows without a user are left out; a repeated
    row counts each time.
    """
    finite = F.abs(F.col("amount")) < float("inf")  # also false for NaN, which sorts above infinity
    return rows.where(F.col("user_id").isNotNull() & finite).groupBy("user_id").agg(
        F.count("*").alias("amount_count"), F.kll_sketch_agg_double("amount", SKETCH_K).alias("amounts"))


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """Sketches of several batches as one row per user, without a look at the rows again."""
    return sketches.groupBy("user_id").agg(
        F.sum("amount_count").alias("amount_count"),
        F.kll_merge_agg_double("amounts", SKETCH_K).alias("amounts"))


def amount_limits(sketches: DataFrame) -> DataFrame:
    """user_id, amount_count, usual_amount, high_amount: the median and the upper limit of a user."""
    def at(rank: float) -> Column:
        return F.kll_sketch_get_quantile_double("amounts", F.lit(rank))

    return sketches.select("user_id", "amount_count", at(USUAL).alias("usual_amount"), at(HIGH).alias("high_amount"))


def with_limits(rows: DataFrame, limits: DataFrame, broadcast_limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``rows`` with amount_count, usual_amount and high_amount of their user, null without any.

    ``limits`` should be a written table, as it is measured first. Within the limit it is broadcast.
    Beyond that only the users that it shows to be hot are; their rows and those without a user are
    spread over the tasks, and the others are joined by user.
    """
    names = ("amount_count", "usual_amount", "high_amount")
    users, total = limits.agg(F.count("*"), F.sum("amount_count")).first()
    if users * LIMIT_ROW_BYTES <= broadcast_limit:
        return rows.join(F.broadcast(limits), "user_id", "left").select(*rows.columns, *names)
    hot = limits.where(F.col("amount_count") >= total * HOT_SHARE).select(
        F.col("user_id").alias("_hot"), F.struct(*names).alias("_hot_limits"))
    others = limits.where(F.col("amount_count") < total * HOT_SHARE).select(
        F.col("user_id").alias("_user"), F.struct(*names).alias("_limits"), F.lit(0).cast("long").alias("_of"))
    known = rows.join(F.broadcast(hot), F.col("user_id") == F.col("_hot"), "left")
    alone = F.col("_hot").isNotNull() | F.col("user_id").isNull()
    # A null key meets nobody, and its second part scatters it.
    known = known.withColumn("_key", F.when(~alone, F.col("user_id"))).withColumn(
        "_part", F.when(alone, F.xxhash64(*rows.columns)).otherwise(F.lit(0).cast("long")))
    both = known.join(others, (F.col("_key") == F.col("_user")) & (F.col("_part") == F.col("_of")), "left")
    found = F.coalesce("_hot_limits", "_limits")
    return both.select(*rows.columns, *[found[name].alias(name) for name in names])


@dataclass(frozen=True)
class AnomalyRule:
    """A class, and the least value that each of its signals has to have."""

    name: str
    at_least: tuple[tuple[str, float], ...]

    def holds(self) -> Column:
        """False where a signal is null."""
        parts = [F.coalesce(F.col(signal).cast("double") >= least, F.lit(False)) for signal, least in self.at_least]
        return reduce(Column.__and__, parts)


NO_CLASS = "usual"
# In the order in which they are tried.
RULES = (
    AnomalyRule("velocity_attack", (("velocity_score", 100), ("device_changed", 1))),
    AnomalyRule("card_testing", (("velocity_score", 100),)),
    AnomalyRule("account_takeover", (("device_is_new", 1), ("device_changed", 1), ("amount_is_high", 1))),
    AnomalyRule("risky_address", (("risk_score", 8), ("amount_is_high", 1))),
    AnomalyRule("unusual_amount", (("amount_is_high", 1),)),
)
MIN_AMOUNTS = 20


def signals(silver: DataFrame, limits: DataFrame, rule: VelocityRule = VelocityRule(),
            min_amounts: int = MIN_AMOUNTS, broadcast_limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """``silver`` with the columns of its velocity, changes of device and limits, and amount_is_high:
    above the user's upper limit, where the user has at least ``min_amounts`` (else null)."""
    placed = with_limits(device_changes(velocity(silver, rule)), limits, broadcast_limit)
    enough = F.col("amount_count") >= min_amounts
    return placed.withColumn("amount_is_high", F.when(enough, F.col("amount") > F.col("high_amount")))


def classify(rows: DataFrame, rules: Sequence[AnomalyRule] = RULES) -> DataFrame:
    """``rows`` with anomaly_class, the first rule that holds; ``NO_CLASS`` where none does."""
    named = reduce(lambda rest, rule: F.when(rule.holds(), rule.name).otherwise(rest), reversed(rules), F.lit(NO_CLASS))
    return rows.withColumn("anomaly_class", named)


def class_shares(classified: DataFrame) -> DataFrame:
    """event_date, anomaly_class, transactions, share, amount: one grouping over the rows.

    ``share`` is that of the date's rows, exact. Rows without a date are a date of their own.
    """
    counted = classified.groupBy("event_date", "anomaly_class").agg(
        F.count("*").alias("transactions"), (F.sum(units(F.col("amount"))) / F.lit(float(UNITS))).alias("amount"))
    # A few rows per date.
    per_date = counted.groupBy(F.col("event_date").alias("_date")).agg(F.sum("transactions").alias("_all"))
    return counted.join(per_date, F.col("event_date").eqNullSafe(F.col("_date"))).select(
        "event_date", "anomaly_class", "transactions", (F.col("transactions") / F.col("_all")).alias("share"), "amount")
