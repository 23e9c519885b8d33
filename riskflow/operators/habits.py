"""Churn and retention from each user's days of use."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from riskflow.operators.timelines import MICROS, micros, stretch_of


@dataclass(frozen=True)
class ChurnRule:
    """A visit goes on until ``gap_seconds`` without a transaction; a user is gone after
    ``gone_days`` without one before the last day of the table."""

    gap_seconds: int = 1800
    gone_days: int = 14


def visits(df: DataFrame, gap_seconds: int = ChurnRule.gap_seconds,
           stretch_seconds: int = 24 * 3600) -> DataFrame:
    """user_id, visit_start, visit_end, transactions: runs of a user's transactions of which each
    comes less than a gap after the one before. visit_end is the time of the last one.

    Rows without a user or time are in no visit; rows of one time are in one visit. The runs are
    found within stretches of each user's timeline, so a hot user is spread over many tasks; the
    runs of a stretch, a gap apart and so few, are then joined across the borders.
    """
    gap = gap_seconds * MICROS
    known = df.where("user_id is not null and event_time is not null")
    rows = known.select("user_id", micros(F.col("event_time")).alias("_at"))
    line = Window.partitionBy("user_id", "_stretch").orderBy("_at")
    runs = _runs(rows.withColumn("_stretch", stretch_of(F.col("_at"), stretch_seconds)),
                 line, F.col("_at"), F.col("_at"), gap)
    runs = runs.groupBy("user_id", "_stretch", "_run").agg(
        F.min("_at").alias("_first"), F.max("_at").alias("_last"), F.count("*").alias("_n"))
    own = Window.partitionBy("user_id").orderBy("_first")
    whole = _runs(runs.drop("_run"), own, F.col("_first"), F.col("_last"), gap)
    return whole.groupBy("user_id", "_run").agg(
        F.timestamp_micros(F.min("_first")).alias("visit_start"),
        F.timestamp_micros(F.max("_last")).alias("visit_end"), F.sum("_n").alias("transactions"),
    ).drop("_run")


def _runs(rows: DataFrame, line: WindowSpec, first: Column, last: Column, gap: int) -> DataFrame:
    """``rows`` with the number of their run: a new one begins a gap after the row before."""
    apart = first - F.lag(last).over(line) >= gap
    begins = F.coalesce(apart, F.lit(True)).cast("int")
    return rows.withColumn("_begins", begins).withColumn(
        "_run", F.sum("_begins").over(line.rowsBetween(Window.unboundedPreceding, 0))).drop("_begins")


def daily_use(df: DataFrame) -> DataFrame:
    """user_id, event_date, transactions; rows without a user or date are left out."""
    return df.where("user_id is not null and event_date is not null").groupBy("user_id", "event_date").agg(
        F.count("*").alias("transactions"))


def churn(df: DataFrame, rule: ChurnRule = ChurnRule()) -> DataFrame:
    """One row per user: first_day, last_day, active_days, longest_streak, visits, mean_visit,
    trend, days_away, is_gone, retention.

    Days are those of the user's transactions, so a user has at most a row per day after the first
    grouping, whatever the number of transactions. ``longest_streak`` counts days in a row.
    ``mean_visit`` is the mean number of transactions of a visit. ``trend`` is the slope of the
    transactions per active day over the days since the first one, null for a user with one day.
    ``days_away`` counts from the last day to that of the whole table; ``retention`` is the share
    of days with use from the first day to that one. Rows without a user or a time count nowhere.
    """
    known = df.where("user_id is not null and event_time is not null")
    daily = daily_use(known)
    own = Window.partitionBy("user_id")
    # Days in a row have the same difference between the day and its place.
    line = daily.withColumns({
        "_island": F.date_sub("event_date", F.row_number().over(own.orderBy("event_date"))),
        "_day": F.datediff("event_date", F.min("event_date").over(own)).cast("double"),
    })
    streaks = line.groupBy("user_id", "_island").agg(
        F.count("*").alias("_streak"), F.min("event_date").alias("_first"), F.max("event_date").alias("_last"),
    ).groupBy("user_id").agg(F.max("_streak").alias("longest_streak"), F.sum("_streak").alias("active_days"),
                             F.min("_first").alias("first_day"), F.max("_last").alias("last_day"))
    trends = line.groupBy("user_id").agg(F.regr_slope(F.col("transactions").cast("double"), "_day").alias("trend"))
    seen = visits(known, rule.gap_seconds).groupBy("user_id").agg(
        F.count("*").alias("visits"), F.avg("transactions").alias("mean_visit"))
    last = daily.agg(F.max("event_date").alias("_today"))  # one row
    away = F.datediff("_today", "last_day")
    return (
        streaks.join(trends, "user_id").join(seen, "user_id").join(F.broadcast(last), F.lit(True))
        .select("user_id", "first_day", "last_day", "active_days", "longest_streak", "visits", "mean_visit", "trend",
                away.alias("days_away"), (away > rule.gone_days).alias("is_gone"),
                (F.col("active_days") / (F.datediff("_today", "first_day") + 1)).alias("retention"))
    )
