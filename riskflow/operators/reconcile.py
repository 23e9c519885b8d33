"""Whether the layers hold the same rows, date by date, from one pass over each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow import schemas
from riskflow.operators.timelines import UNITS, units

# Sums of doubles in another order differ by less than this share of the sum of their sizes.
TOLERANCE = 1e-9


def fingerprint(layer: DataFrame, name: str) -> DataFrame:
    """One row per date of a row-wise layer: layer, event_date, row_count, amount_units, row_hash.

    The hash adds up the 64-bit hashes of all bronze columns of each row, so it does not depend on
    the order of rows, and a row that is lost, repeated or altered changes it. Sums are whole
    numbers, added up before they are shuffled.
    """
    hashed = F.xxhash64(*schemas.BRONZE.names).cast("decimal(20,0)")
    return layer.groupBy("event_date").agg(
        F.count("*").alias("row_count"), F.sum(units(F.col("amount"))).alias("amount_units"),
        F.sum(hashed).cast("decimal(38,0)").alias("row_hash"),
    ).select(F.lit(name).alias("layer"), "event_date", "row_count", "amount_units", "row_hash")


def compare_layers(layers: dict[str, DataFrame]) -> DataFrame:
    """One row per date and pair of neighbouring layers: event_date, upstream, layer, rows_upstream,
    rows, amount_difference, status.

    Status is ``same``, ``rows differ`` (another number), or ``values differ`` (as many rows, but
    not the same ones). Rows without a date are compared as a date of their own. A date that only
    one of the two layers has, has no rows in the other.
    """
    names = list(layers)
    prints = reduce(DataFrame.unionByName, [fingerprint(df, name) for name, df in layers.items()])
    # A few rows per date and layer; every layer stands once as itself and once as an upstream.
    follower = dict(zip(names, names[1:]))
    as_upstream = prints.where(F.col("layer") != names[-1]).replace(follower, subset=["layer"])
    values = ("row_count", "amount_units", "row_hash")
    both = prints.where(F.col("layer") != names[0]).withColumn("_own", F.lit(True)).unionByName(
        as_upstream.withColumn("_own", F.lit(False)))
    sides = [F.max(F.when(F.col("_own") == own, F.col(v))).alias(f"{v}_{own}") for own in (True, False) for v in values]
    lined = both.groupBy("layer", "event_date").agg(*sides)
    own, up = (lambda v: F.coalesce(F.col(f"{v}_True"), F.lit(0))), (lambda v: F.coalesce(F.col(f"{v}_False"), F.lit(0)))
    status = (
        F.when(own("row_count") != up("row_count"), "rows differ")
        .when((own("row_hash") != up("row_hash")) | (own("amount_units") != up("amount_units")), "values differ")
        .otherwise("same")
    )
    before = F.create_map(*[F.lit(x) for pair in zip(names[1:], names) for x in pair])
    return lined.select(
        "event_date", before[F.col("layer")].alias("upstream"), "layer",
        up("row_count").cast("long").alias("rows_upstream"), own("row_count").cast("long").alias("rows"),
        ((own("amount_units") - up("amount_units")) / F.lit(float(UNITS))).alias("amount_difference"),
        status.alias("status"),
    )


def compare_daily(silver: DataFrame, spend: DataFrame, usage: DataFrame) -> DataFrame:
    """One row per date and daily table: event_date, layer, expected, found, status.

    ``spend`` and ``usage`` are the partials: the spend's sum has to be that of the amounts, the
    usage's number of ratios that of the rows with one; a sum may be off by rounding.
    """
    want = silver.groupBy("event_date").agg(
        F.coalesce(F.sum("amount"), F.lit(0.0)).alias("spend"), F.coalesce(F.sum(F.abs("amount")), F.lit(0.0)).alias("_size"),
        F.count("usage_cost_ratio").cast("double").alias("usage"),
    ).select("event_date", F.inline(F.array(
        F.struct(F.lit("spend").alias("layer"), F.col("spend").alias("expected"), F.col("_size").alias("_size")),
        F.struct(F.lit("usage").alias("layer"), F.col("usage").alias("expected"), F.lit(0.0).alias("_size")))))
    got = spend.groupBy("event_date").agg(F.coalesce(F.sum("spent_sum"), F.lit(0.0)).alias("found")) \
        .withColumn("layer", F.lit("spend")).unionByName(
            usage.groupBy("event_date").agg(F.sum("ratio_count").cast("double").alias("found"))
            .withColumn("layer", F.lit("usage")))
    named = got.select(F.col("event_date").alias("_date"), F.col("layer").alias("_layer"), "found")
    same = F.col("event_date").eqNullSafe(F.col("_date")) & (F.col("layer") == F.col("_layer"))
    found, expected = F.coalesce("found", F.lit(0.0)), F.coalesce("expected", F.lit(0.0))
    near = F.abs(found - expected) <= F.coalesce("_size", F.lit(0.0)) * TOLERANCE
    return want.join(named, same, "full").select(
        F.coalesce("event_date", "_date").alias("event_date"), F.coalesce("layer", "_layer").alias("layer"),
        expected.alias("expected"), found.alias("found"), F.when(near, "same").otherwise("differs").alias("status"))
