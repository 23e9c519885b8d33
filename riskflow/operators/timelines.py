"""Measures along each user's timeline: how fast transactions follow, and changes of device.

A timeline is cut into stretches of equal length, and a user's rows of one stretch are what a task
works on, so a user with very many rows is spread over many tasks. What a stretch needs of earlier
ones is little and is carried over: the rows of the last window for the velocity, the last device
before it and the devices first seen in it for the changes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MICROS = 1_000_000
# Amounts are added up in these units, which whole numbers hold exactly whatever the order.
UNITS = 10_000
# What a row of a stretch is, in the order in which they come.
CARRIED, SEEN, ROW = range(3)


@dataclass(frozen=True)
class VelocityRule:
    """Transactions of a user within the last ``window_seconds``; ``limit`` of them score 100.

    ``stretch_seconds`` is the length of a stretch, at least a window.
    """

    window_seconds: int = 3600
    limit: int = 5
    stretch_seconds: int = 6 * 3600

    def __post_init__(self) -> None:
        if self.window_seconds <= 0 or self.limit <= 0:
            raise ValueError("window and limit have to be positive")
        if self.stretch_seconds < self.window_seconds:
            raise ValueError("a stretch is at least as long as a window")


def micros(time: Column) -> Column:
    return F.unix_micros(time)


def stretch_of(at: Column, seconds: int) -> Column:
    """The number of the stretch that a time in microseconds falls in, also before 1970."""
    return F.floor(at / F.lit(float(seconds * MICROS))).cast("long")


def units(amount: Column) -> Column:
    """An amount in whole units; a null amount adds nothing."""
    return F.coalesce(F.round(amount * UNITS).cast("long"), F.lit(0).cast("long"))


def score(count: Column, limit: int) -> Column:
    return F.least(F.lit(100.0), F.round(count * F.lit(100.0) / F.lit(limit), 6))


def velocity(df: DataFrame, rule: VelocityRule = VelocityRule()) -> DataFrame:
    """``df`` with velocity_count, velocity_amount and velocity_score.

    Counted are the user's transactions with an event_time from the row's own back to one window
    before it, both ends included, so rows of the same time count each other. Rows without a user
    or a time have nulls and count nowhere; repeated rows count each.

    Each row enters the running sum of its stretch at its time and leaves it right after a window;
    rows of the last window of a stretch enter the next one too. One pass over a sorted stretch
    gives all sums, however many rows a window holds.
    """
    window, stretch = rule.window_seconds * MICROS, rule.stretch_seconds
    known = F.col("user_id").isNotNull() & F.col("event_time").isNotNull()
    at = F.when(known, micros(F.col("event_time")))
    own = df.select(
        "*", at.alias("_at"), stretch_of(at, stretch).alias("_stretch"),
        F.lit(1).cast("long").alias("_one"), units(F.col("amount")).alias("_units"), F.lit(True).alias("_own"),
    )
    narrow = own.where(known).select("user_id", "_at", "_stretch", "_one", "_units")
    leaves = F.col("_at") + F.lit(window + 1)
    after = stretch_of(leaves, stretch)
    # Each row leaves in the stretch of that moment; if it is the next one, it enters there first.
    marks = narrow.select("user_id", F.inline(F.filter(F.array(
        F.struct(leaves.alias("_at"), after.alias("_stretch"), (-F.col("_one")).alias("_one"),
                 (-F.col("_units")).alias("_units")),
        F.when(after > F.col("_stretch"), F.struct(
            F.col("_at").alias("_at"), after.alias("_stretch"), F.col("_one").alias("_one"),
            F.col("_units").alias("_units"))),
    ), lambda mark: mark.isNotNull())))
    both = own.unionByName(marks.withColumn("_own", F.lit(False)), allowMissingColumns=True)
    # Rows without a user or time meet nobody: they are spread by their transaction.
    spread = F.when(F.col("_stretch").isNull(), F.xxhash64("transaction_id"))
    sofar = (
        Window.partitionBy("user_id", "_stretch", "_spread").orderBy("_at")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    count = F.sum("_one").over(sofar)
    amount = F.sum("_units").over(sofar) / F.lit(float(UNITS))
    measured = both.withColumn("_spread", spread).withColumns({"_count": count, "_amount": amount})
    there = F.col("_at").isNotNull()
    return measured.where("_own").select(
        *df.columns,
        F.when(there, F.col("_count")).alias("velocity_count"),
        F.when(there, F.col("_amount")).alias("velocity_amount"),
        F.when(there, score(F.col("_count"), rule.limit)).alias("velocity_score"),
    )


def device_changes(df: DataFrame, stretch_seconds: int = 24 * 3600) -> DataFrame:
    """``df`` with previous_device, device_changed and device_is_new.

    A user's timeline goes by event_time, then transaction_id. The previous device is that of the
    user's last row before that has one; a change is a device other than it. A device is new on the
    first row of the timeline that has it, and the first device of a user is new and no change.
    Rows without a device change nothing and are not new; rows without a user or a time have nulls
    and are on no timeline. Of rows that agree in user, time and id, all or none are first.
    """
    known = F.col("user_id").isNotNull() & F.col("event_time").isNotNull()
    rows = df.select(
        "*", F.when(known, stretch_of(micros(F.col("event_time")), stretch_seconds)).alias("_stretch"),
        F.lit(ROW).alias("_kind"),
        F.when(F.col("device_id").isNotNull(), F.struct("event_time", "transaction_id")).alias("_place"),
    )
    # A row per user, stretch and device, with its last place there.
    devices = (
        rows.where(F.col("_stretch").isNotNull() & F.col("device_id").isNotNull())
        .groupBy("user_id", "_stretch", "device_id").agg(F.max("_place").alias("_last"))
    )
    of_device = Window.partitionBy("user_id", "device_id").orderBy("_stretch")
    seen = devices.withColumn("_nth", F.row_number().over(of_device)).where("_nth > 1") \
        .select("user_id", "_stretch", "device_id", F.lit(SEEN).alias("_kind"))
    lasts = devices.groupBy("user_id", "_stretch").agg(
        F.max_by("device_id", F.struct("_last", "device_id")).alias("_device"))
    stretches = rows.where("_stretch is not null").select("user_id", "_stretch").distinct()
    earlier = Window.partitionBy("user_id").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = stretches.join(lasts, ["user_id", "_stretch"], "left").select(
        "user_id", "_stretch", F.last("_device", ignorenulls=True).over(earlier).alias("device_id"),
        F.lit(CARRIED).alias("_kind"),
    ).where("device_id is not null")
    # What is carried over enters a stretch as rows of its own, before all others.
    both = rows.unionByName(carried, allowMissingColumns=True).unionByName(seen, allowMissingColumns=True)
    both = both.withColumn("_spread", F.when(F.col("_stretch").isNull(), F.xxhash64("transaction_id")))
    line = (
        Window.partitionBy("user_id", "_stretch", "_spread").orderBy("_kind", "event_time", "transaction_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    same = Window.partitionBy("user_id", "_stretch", "_spread", "device_id")
    found = both.withColumns({
        "_previous": F.last(F.when(F.col("_kind") != SEEN, F.col("device_id")), ignorenulls=True).over(line),
        "_known": F.max(F.col("_kind") == SEEN).over(same),
        "_first": F.min(F.when(F.col("_kind") == ROW, F.col("_place"))).over(same),
    }).where(F.col("_kind") == ROW)
    there = F.col("_stretch").isNotNull()
    changed = F.coalesce(F.col("device_id") != F.col("_previous"), F.lit(False))
    is_new = F.coalesce(~F.col("_known") & (F.col("_place") == F.col("_first")), F.lit(False))
    return found.select(
        *df.columns,
        F.when(there, F.col("_previous")).alias("previous_device"),
        F.when(there, changed).alias("device_changed"),
        F.when(there, is_new).alias("device_is_new"),
    )
