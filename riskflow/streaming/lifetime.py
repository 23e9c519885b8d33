"""Lifetime value per user: a table kept up batch by batch, of which only touched buckets change.

Users are dealt to buckets. A batch adds up its own rows per user, reads the last version of the
buckets that hold these users, merges, and writes those buckets into a folder of its own; other
buckets keep the version that an earlier batch wrote. The table is the last version of each bucket.
A replayed batch reads what was there before it and replaces its folder, so it changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.operators.timelines import UNITS, units
from riskflow.sources.tables import exists, table_or_empty

BUCKETS = 64
STATE = T.StructType([
    T.StructField("user_id", T.StringType()), T.StructField("transactions", T.LongType()),
    T.StructField("units", T.LongType()), T.StructField("first_time", T.TimestampType()),
    T.StructField("last_time", T.TimestampType()), T.StructField("batch_id", T.LongType()),
    T.StructField("bucket", T.IntegerType()),
])
INPUT = ("user_id", "amount", "event_time")


def added(rows: DataFrame, buckets: int) -> DataFrame:
    """What rows add per user; rows without a user are left out."""
    return rows.where("user_id is not null").groupBy("user_id").agg(
        F.count("*").alias("transactions"), F.sum(units(F.col("amount"))).alias("units"),
        F.min("event_time").alias("first_time"), F.max("event_time").alias("last_time"),
    ).withColumn("bucket", F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int"))


def merged(rows: DataFrame) -> DataFrame:
    return rows.groupBy("user_id", "bucket").agg(
        F.sum("transactions").alias("transactions"), F.sum("units").alias("units"),
        F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"),
    )


def versions(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The last version of each bucket, of batches before one (default: all that are whole)."""
    rows = table_or_empty(spark, path, STATE)
    if before is None:
        last = rows.agg(F.max("batch_id")).first()[0]
        if last is not None and not exists(spark, f"{path}/batch_id={last}/_SUCCESS"):
            before = last  # it is being written
    if before is not None:
        rows = rows.where(F.col("batch_id") < before)
    latest = rows.groupBy("bucket").agg(F.max("batch_id").alias("batch_id"))  # a row per bucket
    return rows.join(F.broadcast(latest), ["bucket", "batch_id"])


def write_batch(batch: DataFrame, batch_id: int, path: str, buckets: int = BUCKETS) -> list[int]:
    """Merge one batch into the table; returns the touched buckets."""
    spark = batch.sparkSession
    new = added(batch, buckets).persist()
    try:
        touched = sorted(r[0] for r in new.select("bucket").distinct().collect())  # so many at most
        if touched:
            old = versions(spark, path, batch_id).where(F.col("bucket").isin(touched))
            rows = merged(old.drop("batch_id").unionByName(new))
            rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket") \
                .parquet(f"{path}/batch_id={batch_id}")
    finally:
        new.unpersist()
    return touched


def lifetime(spark: SparkSession, path: str) -> DataFrame:
    """user_id, transactions, total_amount, mean_amount, first_time, last_time, value_per_day.

    The days are those from the first to the last transaction, both counted; null without a time.
    """
    total = F.col("units") / F.lit(float(UNITS))
    days = F.datediff("last_time", "first_time") + 1
    return versions(spark, path).select(
        "user_id", "transactions", total.alias("total_amount"),
        (total / F.col("transactions")).alias("mean_amount"), "first_time", "last_time",
        (total / days).alias("value_per_day"),
    )
