"""The registered queries: (session, data folder) to DataFrame, over whole tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow import schemas
from riskflow.functions.privacy import mask_card, mask_card_unanchored
from riskflow.operators import anomalies, joins, marts, quality
from riskflow.operators.bronze import pii_copy, to_bronze
from riskflow.operators.enrich import enrich
from riskflow.operators.geo import load_places, with_places
from riskflow.operators.habits import churn, visits
from riskflow.operators.layout import cluster_table, file_count, write_clustered
from riskflow.operators.timelines import VelocityRule, device_changes, velocity
from riskflow.operators.validation import schema_diff
from riskflow.plans import model, pipeline
from riskflow.session import scratch_dir
from riskflow.sources.feed import corrupt_rows, good_rows, read_feed
from riskflow.sources.lookups import (
    BROADCAST_LIMIT_BYTES, SPEC_BY_NAME, load_lookups, lookup_profile, read_lookup,
)
from riskflow.sources.tables import date_slice, event_dates, read_table, write_table
from riskflow.streaming import layers
from riskflow.streaming.layers import Pace, Store
from riskflow.streaming.sinks import await_all, overwrite_batch_table

SLICE_DAY = dt.date(2024, 1, 15)
LAST_DAY = dt.date(2024, 1, 17)
RESCALED_HIGH_RISK = 7.0
MICRO_BATCHES = 3
TIME_CUTS = (dt.datetime(2024, 1, 11, 5, 30), dt.datetime(2024, 1, 20, 12))
BATCH_BYTES = "2m"


def _plain_time(df: DataFrame) -> DataFrame:
    return df.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_bronze(model.raw(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str, only=None) -> DataFrame:
    """Silver with the joins that a query needs (default: all four)."""
    return enrich(_bronze(spark, sf_dir), model.lookups(spark, sf_dir, only), only)


def _rounded_spend(df: DataFrame) -> DataFrame:
    return df.withColumn("Total_spent_per_user", F.round("Total_spent_per_user", 2))


def _rounded_usage(df: DataFrame) -> DataFrame:
    return df.withColumn("average_usage_cost_ratio", F.round("average_usage_cost_ratio", 6))


def _rounded_report(df: DataFrame) -> DataFrame:
    return df.withColumn("violation_percent", F.round("violation_percent", 6))


# Bronze


def bronze(spark, sf_dir):
    return _plain_time(_bronze(spark, sf_dir))


def pii(spark, sf_dir):
    return pii_copy(model.raw(spark, sf_dir))


def mask_parity(spark, sf_dir):
    return _of_many_lengths(spark, sf_dir).select(
        "transaction_id", mask_card_unanchored(F.col("card_number")).alias("card_number")
    )


def mask_strict(spark, sf_dir):
    return _of_many_lengths(spark, sf_dir).select(
        "transaction_id", mask_card(F.col("card_number")).alias("card_number")
    )


def _of_many_lengths(spark, sf_dir):
    return model.of_many_lengths(model.raw(spark, sf_dir))


def _flawed(spark, sf_dir):
    return model.flawed(model.raw(spark, sf_dir))


# Silver


def silver(spark, sf_dir):
    return _plain_time(_silver(spark, sf_dir))


def silver_shuffled(spark, sf_dir):
    """All lookups joined by shuffle, on a feed with a hot user and rows without a user."""
    df = to_bronze(model.skewed(model.raw(spark, sf_dir)))
    return _plain_time(enrich(df, model.large_lookups(spark, sf_dir, df)))


def missing_flags(spark, sf_dir):
    flags = [spec.flag for spec in SPEC_BY_NAME.values()]
    return _silver(spark, sf_dir).groupBy(*flags).agg(F.count(F.lit(1)).alias("row_count"))


def lookup_check(spark, sf_dir):
    return lookup_profile(model.lookup_frames(spark, sf_dir)).drop("bytes")


def lookup_csv(spark, sf_dir):
    """The products lookup by way of CSV."""
    paths = model.write_lookups(spark, sf_dir, scratch_dir(spark, "lookups"))
    return read_lookup(spark, paths["products"], SPEC_BY_NAME["products"])


def lookup_scores(spark, sf_dir):
    """The addresses lookup by way of CSV, with scores that are no whole numbers."""
    path = f"{scratch_dir(spark, 'lookups')}/ip_risk"
    scores = model.lookup_frames(spark, sf_dir, ["ip_risk"])["ip_risk"].withColumn(
        "risk_score", F.col("risk_score") + 0.5)
    scores.write.option("header", True).csv(path)
    lookup = read_lookup(spark, path, SPEC_BY_NAME["ip_risk"])
    used = _bronze(spark, sf_dir).select("hash_ip").distinct()
    return lookup.join(used, F.col("ip_hash") == F.col("hash_ip")).drop("hash_ip")


def event_date_list(spark, sf_dir):
    return event_dates(_bronze(spark, sf_dir))


def day_slice(spark, sf_dir):
    """One date of a table partitioned by date."""
    path = scratch_dir(spark, "slice")
    write_table(_silver(spark, sf_dir), path)
    return _plain_time(date_slice(read_table(spark, path, schemas.SILVER), SLICE_DAY))


def schema_mismatches(spark, sf_dir):
    """Differences of two altered frames from their contracts, and how many rows the feed has.

    The silver frame gives its schema only, so its joins never run.
    """
    raw = model.raw(spark, sf_dir)
    altered = {
        "raw": (
            raw.withColumn("amount", F.col("amount").cast("string")).drop("session_id"),
            schemas.RAW,
        ),
        "silver": (
            _silver(spark, sf_dir).withColumn("plan_duration", F.col("plan_duration").cast("long"))
            .withColumnRenamed("risk_level", "risk").withColumn("further", F.lit(1)),
            schemas.SILVER,
        ),
    }
    reports = []
    for layer, (df, expected) in altered.items():
        found = [
            F.struct(
                F.lit(m.column).alias("column"), F.lit(m.expected).alias("expected"),
                F.lit(m.actual).cast("string").alias("actual"),
            )
            for m in schema_diff(df, expected)
        ]
        rows = raw.agg(F.count(F.lit(1)).alias("frame_rows"))
        reports.append(
            rows.select(F.lit(layer).alias("layer"), "frame_rows", F.inline(F.array(*found)))
        )
    return reports[0].unionByName(reports[1])


# Places of addresses


def _placed(spark, sf_dir, broadcast_limit):
    raw = model.odd_addresses(model.raw(spark, sf_dir))
    places = load_places(model.ranges(spark, sf_dir), scratch_dir(spark, "segments"), broadcast_limit, raw)
    return to_bronze(with_places(raw, places), keep=GEO_COLUMNS).select("transaction_id", "hash_ip", *GEO_COLUMNS)


GEO_COLUMNS = ("geo_country", "geo_region", "missing_geo")


def geo(spark, sf_dir):
    """The place of each transaction's address, found before the address is hashed."""
    return _placed(spark, sf_dir, BROADCAST_LIMIT_BYTES)


def geo_shuffled(spark, sf_dir):
    """The same with segments that are joined by shuffle."""
    return _placed(spark, sf_dir, 0)


# Timelines


VELOCITY = VelocityRule(window_seconds=3600, limit=5, stretch_seconds=6 * 3600)


def _skewed_bronze(spark, sf_dir):
    """Bronze with one user in a third of its rows and none in a tenth."""
    return to_bronze(model.skewed(model.raw(spark, sf_dir)))


def user_velocity(spark, sf_dir):
    found = velocity(_skewed_bronze(spark, sf_dir), VELOCITY)
    return _plain_time(found.select(*VELOCITY_COLUMNS))


VELOCITY_COLUMNS = ("transaction_id", "user_id", "event_time", "velocity_count", "velocity_amount",
                    "velocity_score")
DEVICE_COLUMNS = ("transaction_id", "user_id", "event_time", "device_id", "previous_device",
                  "device_changed", "device_is_new")


def device_change(spark, sf_dir):
    """On a feed with few devices, times of which many are equal, and rows without a device."""
    return _plain_time(device_changes(model.few_devices(_skewed_bronze(spark, sf_dir))).select(*DEVICE_COLUMNS))


# Gold


def user_spend(spark, sf_dir):
    """Needs no lookup column, so no join."""
    return _rounded_spend(marts.user_spend(_bronze(spark, sf_dir)))


def product_usage(spark, sf_dir):
    return _rounded_usage(marts.product_usage(_silver(spark, sf_dir, ["plans"])))


def risk_flag(spark, sf_dir):
    flagged = marts.flag_high_risk(_silver(spark, sf_dir, ["plans", "ip_risk"]))
    return flagged.select("transaction_id", "is_high_risk_txn")


def risk_alerts(spark, sf_dir):
    return _plain_time(marts.risk_alerts(_bronze(spark, sf_dir), model.lookups(spark, sf_dir)))


# Data quality


def _report(df, rules, layer):
    return _rounded_report(quality.dq_report(df, rules, layer, 0))


def dq_nulls(spark, sf_dir):
    return _report(_silver(spark, sf_dir), quality.null_rules(schemas.SILVER.names), "silver")


def dq_range(spark, sf_dir):
    return _report(model.raw(spark, sf_dir), quality.range_rules(), "bronze")


def dq_format(spark, sf_dir):
    raw = _of_many_lengths(spark, sf_dir)
    return _report(raw, quality.format_rules(quality.FORMATS), "bronze")


def dq_format_parity(spark, sf_dir):
    """The format rules on masked cards, every one of which fails."""
    masked = to_bronze(model.raw(spark, sf_dir), mask=mask_card_unanchored)
    return _report(masked, quality.format_rules(quality.FORMATS), "bronze")


def dq_custom(spark, sf_dir):
    df = _silver(spark, sf_dir, ["plans", "ip_risk"])
    return _report(df, quality.consistency_rules(), "silver")


def dq_custom_rescaled(spark, sf_dir):
    """The same rules with the score limit on the scale of the lookup."""
    df = _silver(spark, sf_dir, ["plans", "ip_risk"])
    return _report(df, quality.consistency_rules(RESCALED_HIGH_RISK), "silver")


def dq_bronze(spark, sf_dir):
    """On a feed with bad cards and nulls in every column, so that each rule has violations."""
    return _report(_flawed(spark, sf_dir), quality.raw_rules(), "bronze")


def dq_bronze_table(spark, sf_dir):
    """The same report from the bronze columns."""
    return _report(to_bronze(_flawed(spark, sf_dir)), quality.bronze_rules(), "bronze")


def dq_empty(spark, sf_dir):
    """Rows of the reports on all rows and on none: an empty batch has no report."""
    raw = model.raw(spark, sf_dir)
    reports = [
        quality.dq_report(df, quality.raw_rules(), layer, 0)
        for layer, df in (("all", raw), ("none", raw.where("transaction_id is null")))
    ]
    rows = reports[0].unionByName(reports[1]).groupBy("layer", "total_rows").agg(
        F.count(F.lit(1)).alias("report_rows"))
    return rows


def dq_silver(spark, sf_dir):
    return _report(_silver(spark, sf_dir), quality.silver_rules(), "silver")


# Feed files and streams


def quarantine(spark, sf_dir):
    """Corrupt lines of a feed in which some are cut short and some have a wrong type."""
    path = scratch_dir(spark, "feed")
    model.write_feed(spark, sf_dir, path, broken=True)
    return _ids_of(corrupt_rows(read_feed(spark, path)))


def _ids_of(lines):
    pattern = '"transaction_id":"([0-9]+)"'
    return lines.select(F.regexp_extract("corrupt_record", pattern, 1).alias("transaction_id"))


def quarantine_rest(spark, sf_dir):
    """What of the same feed goes on to bronze."""
    path = scratch_dir(spark, "feed")
    model.write_feed(spark, sf_dir, path, broken=True)
    return _plain_time(to_bronze(good_rows(read_feed(spark, path))))


def _run(spark, sf_dir, label, broken=False, silver=False, marts_wanted=(), dq=False,
         change=lambda rows: rows, broadcast_limit=BROADCAST_LIMIT_BYTES):
    """Run the streams that a query needs over a new feed folder, in several micro-batches."""
    root = scratch_dir(spark, label)
    files = model.write_feed(spark, sf_dir, f"{root}/feed", broken, change)
    store = Store(f"{root}/store", f"{root}/restricted")
    pace = Pace(max_files=-(-files // MICRO_BATCHES))
    pipeline.run_bronze(spark, f"{root}/feed", store, pace, dq=dq, keep_corrupt=broken)
    if silver or marts_wanted:
        paths = model.write_lookups(spark, sf_dir, f"{root}/lookups")
        pipeline.run_silver(spark, store, load_lookups(spark, paths, broadcast_limit),
                            _pace(spark, store, "bronze"), dq=dq)
    if marts_wanted:
        pipeline.run_gold(spark, store, _pace(spark, store, "silver"), wanted=marts_wanted)
    return store


def _pace(spark, store, table):
    """A third of the table's files per micro-batch."""
    files = spark.read.parquet(store.table(table)).select("_metadata.file_path").distinct().count()
    return Pace(max_files=-(-files // MICRO_BATCHES))


def stream_bronze(spark, sf_dir):
    store = _run(spark, sf_dir, "stream-bronze")
    return _plain_time(read_table(spark, store.table("bronze"), schemas.BRONZE))


def stream_bytes(spark, sf_dir):
    """Bronze in micro-batches limited by bytes."""
    root = scratch_dir(spark, "stream-bytes")
    model.write_feed(spark, sf_dir, f"{root}/feed", codec="none")
    store = Store(f"{root}/store")
    pipeline.run_bronze(spark, f"{root}/feed", store, Pace(max_bytes=BATCH_BYTES), dq=False,
                        keep_corrupt=False)
    return _plain_time(read_table(spark, store.table("bronze"), schemas.BRONZE))


def stream_named(spark, sf_dir):
    """A query with a name of its own, waited for with a time limit."""
    root = scratch_dir(spark, "stream-named")
    model.write_feed(spark, sf_dir, f"{root}/feed")
    store = Store(f"{root}/store")
    (query,) = layers.start_bronze(spark, f"{root}/feed", store)
    await_all([query], timeout=3600)
    return read_table(spark, store.table("bronze"), schemas.BRONZE).agg(
        F.lit(query.name).alias("query_name"), F.lit(query.isActive).alias("active"),
        F.count(F.lit(1)).alias("row_count"),
    )


def stream_late(spark, sf_dir):
    """Bronze in two runs, the second over files dated a month back."""
    root = scratch_dir(spark, "stream-late")
    store = Store(f"{root}/store")
    for label, part, days in (("first", "id % 2 = 0", 0), ("late", "id % 2 = 1", 30)):
        def half(rows, part=part):
            return rows.where(part.replace("id", "cast(transaction_id as bigint)"))

        model.write_feed(spark, sf_dir, f"{root}/{label}", change=half)
        model.move_files(spark, f"{root}/{label}", f"{root}/feed", label, days)
        pipeline.run_bronze(spark, f"{root}/feed", store, dq=False, keep_corrupt=False)
    return _plain_time(read_table(spark, store.table("bronze"), schemas.BRONZE))


def _sent_again(spark, sf_dir, label):
    """Bronze of a feed in two runs: a third of the transactions comes twice in the first, and every
    fifth again in the second, with some rows without an id, twice as well."""
    root = scratch_dir(spark, label)
    store = Store(f"{root}/store")
    number = F.substr("session_id", F.lit(2)).cast("long")

    def resent(share):
        def change(rows):
            lacking = F.when(number % 20 != 0, F.col("transaction_id"))
            return rows.where(share).withColumn("transaction_id", lacking)
        return change

    for name, share in (("first", F.lit(True)), ("twice", number % 3 == 0), ("later", number % 5 == 0)):
        model.write_feed(spark, sf_dir, f"{root}/{name}", change=resent(share))
        model.move_files(spark, f"{root}/{name}", f"{root}/feed", name, 0)
        if name != "first":
            pipeline.run_bronze(spark, f"{root}/feed", store, dq=False, keep_corrupt=False, audit=True,
                                repeats_within="30 days")
    return store


def stream_dedup(spark, sf_dir):
    """Transactions that landed, with the number of lines and files that they came in."""
    store = _sent_again(spark, sf_dir, "stream-dedup")
    audited = T.StructType(schemas.BRONZE.fields + schemas.AUDIT.fields)
    bronze = read_table(spark, store.table("bronze"), audited)
    sources = read_table(spark, store.table("sources"), schemas.SOURCES).groupBy("transaction_id").agg(
        F.count("*").alias("lines"), F.count_distinct("source_file").alias("files"))
    landed = bronze.select("transaction_id", "session_id", "event_time", "amount", "hash_ip",
                           F.col("source_file").isNotNull().alias("has_source"))
    return _plain_time(landed.join(sources, "transaction_id", "left"))


def stream_feed_counts(spark, sf_dir):
    """Lines and repeated lines of the same runs, added up over the batches."""
    counts = layers.read_feed_counts(spark, _sent_again(spark, sf_dir, "stream-counts"))
    return counts.agg(*[F.sum(name).alias(name) for name in ("lines", "corrupt_lines", "repeated_lines")])


def stream_drift(spark, sf_dir):
    """Keys and kinds of values of all batches, added up, against the declared columns."""
    root = scratch_dir(spark, "stream-drift")
    files = model.write_drifting_feed(spark, sf_dir, f"{root}/feed")
    store = Store(f"{root}/store")
    pipeline.run_bronze(spark, f"{root}/feed", store, Pace(max_files=-(-files // MICRO_BATCHES)), dq=False,
                        keep_corrupt=False, watch_drift=True)
    return layers.read_drift(spark, store).groupBy("column", "kind", "declared", "status").agg(
        F.sum("line_count").alias("line_count"))


def stream_merged(spark, sf_dir):
    """Bronze files of three schemas read as one: without a new key, with it, and with its wider type."""
    root = scratch_dir(spark, "stream-merged")
    store = Store(f"{root}/store")
    for name, more in (("old", ""), ("narrow", "visits int"), ("wide", "channel string, visits double")):
        model.write_drifting_feed(spark, sf_dir, f"{root}/{name}")
        model.move_files(spark, f"{root}/{name}", f"{root}/feed", name, 0)
        pipeline.run_bronze(spark, f"{root}/feed", store, dq=False, keep_corrupt=False,
                            more=T.StructType.fromDDL(more) if more else T.StructType())
    return layers.read_bronze(spark, store).groupBy("transaction_id", "user_id").agg(
        F.count("*").alias("row_count"), F.count("channel").alias("channels"),
        F.max("channel").alias("channel"), F.count("visits").alias("visit_rows"), F.sum("visits").alias("visits"))


def stream_geo(spark, sf_dir):
    """Places in the bronze stream."""
    root = scratch_dir(spark, "stream-geo")
    model.write_feed(spark, sf_dir, f"{root}/feed", change=model.odd_addresses)
    places = load_places(model.ranges(spark, sf_dir), f"{root}/segments")
    store = Store(f"{root}/store")
    pipeline.run_bronze(spark, f"{root}/feed", store, dq=False, keep_corrupt=False, places=places)
    bronze = read_table(spark, store.table("bronze"), T.StructType(schemas.BRONZE.fields + schemas.GEO.fields))
    return bronze.select("transaction_id", "hash_ip", *GEO_COLUMNS)


def _in_order_of_time(spark, sf_dir, label, change, follow):
    """Bronze in three runs, each over a third of the feed's time, ``follow`` after each of them."""
    root = scratch_dir(spark, label)
    store = Store(f"{root}/store")
    for number, (first, last) in enumerate(zip((None, *TIME_CUTS), (*TIME_CUTS, None))):
        def part(rows, first=first, last=last):
            rows, time = change(rows), F.col("event_time")
            rows = rows if first is None else rows.where(time >= F.lit(first))
            return rows if last is None else rows.where(time < F.lit(last))

        model.write_feed(spark, sf_dir, f"{root}/part{number}", change=part)
        model.move_files(spark, f"{root}/part{number}", f"{root}/feed", f"part{number}", 0)
        pipeline.run_bronze(spark, f"{root}/feed", store, dq=False, keep_corrupt=False)
        follow(store)
    return store


def stream_velocity(spark, sf_dir):
    """What the watermark has passed, after three runs that go on with the state of the last."""
    store = _in_order_of_time(
        spark, sf_dir, "stream-velocity", model.skewed,
        lambda store: pipeline.run_timelines(spark, store, rule=VELOCITY, wanted=("velocity",)))
    found = read_table(spark, store.table("velocity"), schemas.VELOCITY)
    return _plain_time(found.select(*VELOCITY_COLUMNS))


def stream_devices(spark, sf_dir):
    store = _in_order_of_time(
        spark, sf_dir, "stream-devices", lambda rows: model.few_devices(model.skewed(rows)),
        lambda store: pipeline.run_timelines(spark, store, wanted=("devices",)))
    found = read_table(spark, store.table("devices"), schemas.DEVICES)
    return _plain_time(found.select(*DEVICE_COLUMNS))


def stream_lifetime(spark, sf_dir):
    """Lifetime value after several batches."""
    root = scratch_dir(spark, "stream-lifetime")
    files = model.write_feed(spark, sf_dir, f"{root}/feed", change=model.skewed)
    store = Store(f"{root}/store")
    pipeline.run_bronze(spark, f"{root}/feed", store, Pace(max_files=-(-files // MICRO_BATCHES)), dq=False,
                        keep_corrupt=False)
    pipeline.run_timelines(spark, store, _pace(spark, store, "bronze"), wanted=("lifetime",))
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("first_time", "last_time")}
    return layers.read_lifetime(spark, store).withColumns(times)


def stream_silver_shuffled(spark, sf_dir):
    """Silver with all lookups joined by shuffle, on a feed with a hot user."""
    store = _run(spark, sf_dir, "stream-shuffled", silver=True, change=model.skewed,
                 broadcast_limit=0)
    return _plain_time(read_table(spark, store.table("silver"), schemas.SILVER))


def stream_alerts(spark, sf_dir):
    """The flagged rows of the stored table."""
    store = _run(spark, sf_dir, "stream-alerts", marts_wanted=("risk",))
    return _plain_time(layers.read_alerts(spark, store))


def _compacted(spark, sf_dir, name):
    """A daily table whose closed dates were folded, with batches before and after that, twice."""
    root = scratch_dir(spark, f"stream-compacted-{name}")
    store = Store(f"{root}/store")
    lookups = load_lookups(spark, model.write_lookups(spark, sf_dir, f"{root}/lookups"))
    number = F.col("transaction_id").cast("long")
    for part in range(2):
        model.write_feed(spark, sf_dir, f"{root}/part{part}", change=lambda rows, part=part: rows.where(number % 2 == part))
        model.move_files(spark, f"{root}/part{part}", f"{root}/feed", f"part{part}", 0)
        pipeline.run_bronze(spark, f"{root}/feed", store, dq=False, keep_corrupt=False)
        pipeline.run_silver(spark, store, lookups, dq=False)
        pipeline.run_gold(spark, store, _pace(spark, store, "silver"), wanted=(name,))
        if part == 0:
            layers.compact(spark, store, name, SLICE_DAY)
    layers.compact(spark, store, name, LAST_DAY)
    return store


def stream_compacted(spark, sf_dir):
    """Daily spend after the partials of closed dates were folded."""
    return _rounded_spend(layers.read_spend(spark, _compacted(spark, sf_dir, "spend")))


def stream_compacted_usage(spark, sf_dir):
    return _rounded_usage(layers.read_usage(spark, _compacted(spark, sf_dir, "usage")))


def stream_silver(spark, sf_dir):
    store = _run(spark, sf_dir, "stream-silver", silver=True)
    return _plain_time(read_table(spark, store.table("silver"), schemas.SILVER))


def stream_spend(spark, sf_dir):
    store = _run(spark, sf_dir, "stream-spend", marts_wanted=("spend",))
    return _rounded_spend(layers.read_spend(spark, store))


def stream_usage(spark, sf_dir):
    store = _run(spark, sf_dir, "stream-usage", marts_wanted=("usage",))
    return _rounded_usage(layers.read_usage(spark, store))


def _checked_metrics(metrics, silver):
    """Merged metrics, with the estimate of missing keys against the exact number: within four
    standard errors."""
    exact = silver.agg(*[
        F.count_distinct(F.when(F.col(spec.flag), F.col(spec.feed_key))).alias(spec.name) for spec in SPEC_BY_NAME.values()
    ]).select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("lookup"), F.col(name).alias("exact")) for name in SPEC_BY_NAME])))
    near = F.abs(F.col("missing_keys") - F.col("exact")) <= 4 * joins.SKETCH_ERROR * F.col("exact")
    return metrics.join(exact, "lookup").select(
        "lookup", "row_count", "missing_rows", "null_keys", F.round("hit_share", 9).alias("hit_share"),
        F.col("exact").alias("exact_missing_keys"), near.alias("estimate_is_near"))


def join_metric(spark, sf_dir):
    """Misses of each lookup, from the metrics of three parts of the rows."""
    silver = enrich(_skewed_bronze(spark, sf_dir), model.lookups(spark, sf_dir))
    number = F.col("transaction_id").cast("long")
    parts = [joins.join_metrics(silver.where(number % 3 == part)) for part in range(3)]
    merged = joins.merged_metrics(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    return _checked_metrics(merged, silver)


def stream_join_metrics(spark, sf_dir):
    """The same, kept per batch of the silver stream."""
    root = scratch_dir(spark, "stream-metrics")
    files = model.write_feed(spark, sf_dir, f"{root}/feed", change=model.skewed)
    store = Store(f"{root}/store")
    pipeline.run_bronze(spark, f"{root}/feed", store, Pace(max_files=-(-files // MICRO_BATCHES)), dq=False,
                        keep_corrupt=False)
    lookups = load_lookups(spark, model.write_lookups(spark, sf_dir, f"{root}/lookups"))
    pipeline.run_silver(spark, store, lookups, _pace(spark, store, "bronze"), dq=False, metrics=True)
    silver = read_table(spark, store.table("silver"), schemas.SILVER)
    return _checked_metrics(layers.read_join_metrics(spark, store), silver)


def user_visits(spark, sf_dir):
    """Visits on a feed with a hot user; some transactions share a time."""
    found = visits(model.few_devices(_skewed_bronze(spark, sf_dir)), VISIT_GAP)
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("visit_start", "visit_end")})


VISIT_GAP = 5 * 3600


def user_churn(spark, sf_dir):
    found = churn(_skewed_bronze(spark, sf_dir))
    return found.withColumns({c: F.round(c, 6) for c in ("mean_visit", "trend", "retention")})


def _checked_limits(sketches, rows):
    """The limits of each user, with whether each stands where it should among the user's amounts:
    within three times the error that a sketch states."""
    limits = anomalies.amount_limits(sketches)
    slack = F.when(F.col("amount_count") > anomalies.SKETCH_K, 3 * anomalies.RANK_ERROR).otherwise(0.0)
    below = {c: F.count_if(F.col("amount") < F.col(c)) for c in ("usual_amount", "high_amount")}
    upto = {c: F.count_if(F.col("amount") <= F.col(c)) for c in below}

    def near(name, rank):
        return (below[name] <= (rank + slack) * F.col("amount_count")) \
            & (upto[name] >= (rank - slack) * F.col("amount_count"))

    placed = rows.select("user_id", "amount").join(limits, "user_id")
    return placed.groupBy("user_id", "amount_count").agg(
        near("usual_amount", anomalies.USUAL).alias("usual_is_near"),
        near("high_amount", anomalies.HIGH).alias("high_is_near"))


def amount_quantiles(spark, sf_dir):
    """Quantiles of each user's amounts, a hot user among them, from the sketches of three parts."""
    bronze = _skewed_bronze(spark, sf_dir)
    number = F.col("transaction_id").cast("long")
    parts = [anomalies.amount_sketches(bronze.where(number % 3 == part)) for part in range(3)]
    return _checked_limits(anomalies.merged_sketches(parts[0].unionByName(parts[1]).unionByName(parts[2])), bronze)


def stream_quantiles(spark, sf_dir):
    """The same, kept per batch of the bronze stream."""
    root = scratch_dir(spark, "stream-quantiles")
    files = model.write_feed(spark, sf_dir, f"{root}/feed", change=model.skewed)
    store = Store(f"{root}/store")
    pipeline.run_bronze(spark, f"{root}/feed", store, Pace(max_files=-(-files // MICRO_BATCHES)), dq=False,
                        keep_corrupt=False)
    pipeline.run_timelines(spark, store, _pace(spark, store, "bronze"), wanted=("amounts",))
    return _checked_limits(layers.read_amounts(spark, store), read_table(spark, store.table("bronze"), schemas.BRONZE))


def _anomalies(spark, sf_dir, broadcast_limit):
    """Classes of all rows, on a feed with few devices; scores of addresses go to ten."""
    silver = enrich(model.few_devices(_bronze(spark, sf_dir)), model.lookups(spark, sf_dir, ["ip_risk"]), ["ip_risk"])
    limits = f"{scratch_dir(spark, 'limits')}/limits"
    anomalies.amount_limits(anomalies.amount_sketches(silver)).write.parquet(limits)
    return anomalies.classify(anomalies.signals(
        silver, spark.read.parquet(limits), ANOMALY_VELOCITY, broadcast_limit=broadcast_limit))


ANOMALY_VELOCITY = VelocityRule(window_seconds=3600, limit=2)


def anomaly_classes(spark, sf_dir):
    found = _anomalies(spark, sf_dir, BROADCAST_LIMIT_BYTES)
    return found.select("transaction_id", "amount_count", "usual_amount", "high_amount", "amount_is_high",
                        "anomaly_class")


def anomaly_shares(spark, sf_dir):
    """With limits joined by shuffle, but for users with a thousandth of the rows."""
    found = anomalies.class_shares(_anomalies(spark, sf_dir, 0))
    return found.withColumns({"share": F.round("share", 9), "amount": F.round("amount", 2)})


def stream_risk(spark, sf_dir):
    store = _run(spark, sf_dir, "stream-risk", marts_wanted=("risk",))
    return _plain_time(read_table(spark, store.table("risk"), schemas.RISK))


def stream_dq(spark, sf_dir):
    """Both reports of all micro-batches, added up by rule."""
    store = _run(spark, sf_dir, "stream-dq", silver=True, dq=True, change=model.flawed)
    return layers.read_dq(spark, store).groupBy("layer", "column", "check").agg(
        F.sum("violation_count").alias("violation_count"), F.sum("total_rows").alias("total_rows")
    )


def stream_pii(spark, sf_dir):
    root = scratch_dir(spark, "stream-pii")
    files = model.write_feed(spark, sf_dir, f"{root}/feed")
    store = Store(f"{root}/store", f"{root}/restricted")
    pace = Pace(max_files=-(-files // MICRO_BATCHES))
    pipeline.run_bronze(
        spark, f"{root}/feed", store, pace, dq=False, keep_corrupt=False, keep_pii=True
    )
    copy = spark.read.schema(schemas.PII).json(store.private("pii"))
    return copy.select("transaction_id", "ip_address", "card_number")


def stream_quarantine(spark, sf_dir):
    store = _run(spark, sf_dir, "stream-quarantine", broken=True)
    return _ids_of(spark.read.schema(schemas.QUARANTINE).json(store.private("quarantine")))


def stream_replay(spark, sf_dir):
    """Run all layers, then again over the same folders: the second run must add nothing."""
    store = _run(spark, sf_dir, "stream-replay", marts_wanted=("spend", "risk"))
    feed = store.root.removesuffix("/store") + "/feed"
    paths = store.root.removesuffix("/store") + "/lookups"
    again = load_lookups(spark, {name: f"{paths}/{name}" for name in SPEC_BY_NAME})
    await_all(layers.start_bronze(spark, feed, store))
    await_all(layers.start_silver(spark, store, again))
    await_all(layers.start_spend(spark, store) + layers.start_risk(spark, store))

    def rows(name, df):
        return df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))

    return (
        rows("bronze", read_table(spark, store.table("bronze"), schemas.BRONZE))
        .unionByName(rows("silver", read_table(spark, store.table("silver"), schemas.SILVER)))
        .unionByName(rows("risk", read_table(spark, store.table("risk"), schemas.RISK)))
        .unionByName(rows("spend", layers.read_spend(spark, store)))
    )


# Layout


def clustered(spark, sf_dir):
    """The flagged table after it was rewritten by date and user."""
    path = scratch_dir(spark, "clustered")
    write_table(marts.flag_high_risk(_silver(spark, sf_dir)), f"{path}/risk")
    cluster_table(spark, f"{path}/risk", f"{path}/by_user", schemas.RISK, "user_id")
    return _plain_time(read_table(spark, f"{path}/by_user", schemas.RISK))


def _clustered(spark, df, key):
    """Write a daily table and a clustered copy of it, and read the copy."""
    path = scratch_dir(spark, "clustered")
    write_table(df, f"{path}/daily")
    daily = read_table(spark, f"{path}/daily", df.schema)
    write_clustered(daily, f"{path}/by_key", key, file_count(daily))
    return read_table(spark, f"{path}/by_key", df.schema)


def dates_again(spark, sf_dir):
    """The flagged rows of some dates, worked on again and again replaced."""
    root = scratch_dir(spark, "dates")
    store = Store(f"{root}/store")
    write_table(_bronze(spark, sf_dir), store.table("bronze"))
    lookups = model.lookups(spark, sf_dir)
    for _ in range(2):
        pipeline.run_dates(spark, store, lookups, f"{root}/dates", SLICE_DAY, LAST_DAY)
    return _plain_time(read_table(spark, f"{root}/dates/risk", schemas.RISK))


def layout_again(spark, sf_dir):
    """The clustered gold tables after two runs, one date having grown in between."""
    root = scratch_dir(spark, "layout")
    store = Store(f"{root}/store")
    late = (F.col("event_date") == F.lit(SLICE_DAY)) & (F.col("transaction_id").cast("long") % 2 == 0)
    silver = _silver(spark, sf_dir)
    for batch, part in enumerate((silver.where(~late), silver.where(late))):
        write_table(marts.flag_high_risk(part), store.table("risk"))
        overwrite_batch_table(marts.spend_partial(part), store.partials("spend"), batch)
        overwrite_batch_table(marts.usage_partial(part), store.partials("usage"), batch)
        pipeline.run_layout(spark, store, f"{root}/clustered")

    def rows(name, schema, key, value):
        return read_table(spark, f"{root}/clustered/{name}", schema).select(
            F.lit(name).alias("table_name"), F.col(key).alias("key"), "event_date", value.alias("value"))

    key_date = T.StructType([f for f in schemas.SPEND_PARTIAL if f.name in ("user_id", "event_date")])
    spend = key_date.add("Total_spent_per_user", "double")
    usage = T.StructType([f for f in schemas.USAGE_PARTIAL if f.name in ("product_id", "event_date")]).add(
        "average_usage_cost_ratio", "double")
    return (
        rows("risk", schemas.RISK, "transaction_id", F.col("is_high_risk_txn").cast("double"))
        .unionByName(rows("spend", spend, "user_id", F.round("Total_spent_per_user", 2)))
        .unionByName(rows("usage", usage, "product_id", F.round("average_usage_cost_ratio", 6)))
    )


def _stored_layers(spark, sf_dir, label):
    """All layers as tables, of which silver lacks a row of one date, has one of another twice and
    one of a third with another amount; the daily tables are those of the whole silver."""
    root = scratch_dir(spark, label)
    store = Store(f"{root}/store")
    bronze = _bronze(spark, sf_dir)
    write_table(bronze, store.table("bronze"))
    silver = enrich(bronze, model.lookups(spark, sf_dir)).select(*schemas.SILVER.names)
    number = F.col("transaction_id").cast("long")
    copies = F.when(number == 500, 0).when(number == 700, 2).otherwise(1)
    altered = silver.withColumn("amount", F.when(number == 900, F.col("amount") + 1).otherwise(F.col("amount"))) \
        .withColumn("_copy", F.explode(F.array_repeat(F.lit(1), copies))).drop("_copy")
    write_table(altered, store.table("silver"))
    write_table(marts.flag_high_risk(read_table(spark, store.table("silver"), schemas.SILVER)), store.table("risk"))
    overwrite_batch_table(marts.spend_partial(silver), store.partials("spend"), 0)
    overwrite_batch_table(marts.usage_partial(silver), store.partials("usage"), 0)
    return store


def layer_check(spark, sf_dir):
    rows, _ = pipeline.check_layers(spark, _stored_layers(spark, sf_dir, "check"))
    return rows.withColumn("amount_difference", F.round("amount_difference", 4))


def daily_check(spark, sf_dir):
    _, daily = pipeline.check_layers(spark, _stored_layers(spark, sf_dir, "check-daily"))
    return daily.withColumns({c: F.round(c, 2) for c in ("expected", "found")})


def clustered_spend(spark, sf_dir):
    return _rounded_spend(_clustered(spark, marts.user_spend(_bronze(spark, sf_dir)), "user_id"))


def clustered_usage(spark, sf_dir):
    usage = marts.product_usage(_silver(spark, sf_dir, ["plans"]))
    return _rounded_usage(_clustered(spark, usage, "product_id"))


QUERIES = {
    "q_bronze": bronze,
    "q_pii_copy": pii,
    "q_mask_parity": mask_parity,
    "q_mask_strict": mask_strict,
    "q_silver": silver,
    "q_silver_shuffled": silver_shuffled,
    "q_missing_flags": missing_flags,
    "q_lookup_check": lookup_check,
    "q_lookup_csv": lookup_csv,
    "q_lookup_scores": lookup_scores,
    "q_event_dates": event_date_list,
    "q_date_slice": day_slice,
    "q_schema_diff": schema_mismatches,
    "q_geo": geo,
    "q_geo_shuffled": geo_shuffled,
    "q_velocity": user_velocity,
    "q_device_change": device_change,
    "q_join_metrics": join_metric,
    "q_visits": user_visits,
    "q_churn": user_churn,
    "q_amount_quantiles": amount_quantiles,
    "q_anomalies": anomaly_classes,
    "q_anomaly_shares": anomaly_shares,
    "q_user_spend": user_spend,
    "q_product_usage": product_usage,
    "q_risk_flag": risk_flag,
    "q_risk_alerts": risk_alerts,
    "q_dq_nulls": dq_nulls,
    "q_dq_range": dq_range,
    "q_dq_format": dq_format,
    "q_dq_format_parity": dq_format_parity,
    "q_dq_custom": dq_custom,
    "q_dq_custom_rescaled": dq_custom_rescaled,
    "q_dq_bronze": dq_bronze,
    "q_dq_bronze_table": dq_bronze_table,
    "q_dq_silver": dq_silver,
    "q_dq_empty": dq_empty,
    "q_quarantine": quarantine,
    "q_quarantine_rest": quarantine_rest,
    "q_stream_bronze": stream_bronze,
    "q_stream_bytes": stream_bytes,
    "q_stream_named": stream_named,
    "q_stream_late": stream_late,
    "q_stream_dedup": stream_dedup,
    "q_stream_feed_counts": stream_feed_counts,
    "q_stream_geo": stream_geo,
    "q_stream_drift": stream_drift,
    "q_stream_join_metrics": stream_join_metrics,
    "q_stream_merged": stream_merged,
    "q_stream_velocity": stream_velocity,
    "q_stream_devices": stream_devices,
    "q_stream_lifetime": stream_lifetime,
    "q_stream_quantiles": stream_quantiles,
    "q_stream_silver": stream_silver,
    "q_stream_silver_shuffled": stream_silver_shuffled,
    "q_stream_alerts": stream_alerts,
    "q_stream_compacted": stream_compacted,
    "q_stream_compacted_usage": stream_compacted_usage,
    "q_stream_spend": stream_spend,
    "q_stream_usage": stream_usage,
    "q_stream_risk": stream_risk,
    "q_stream_dq": stream_dq,
    "q_stream_pii": stream_pii,
    "q_stream_quarantine": stream_quarantine,
    "q_stream_replay": stream_replay,
    "q_dates_again": dates_again,
    "q_layout_again": layout_again,
    "q_layer_check": layer_check,
    "q_daily_check": daily_check,
    "q_clustered": clustered,
    "q_clustered_spend": clustered_spend,
    "q_clustered_usage": clustered_usage,
}
