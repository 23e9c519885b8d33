"""Known totals of a sample feed that is not part of this repository.

Set RISKFLOW_SAMPLE_FEED to its folder of two NDJSON files and RISKFLOW_SAMPLE_LOOKUPS to the
folder with its three CSV lookups; without them this file is not collected. The sample has no users
lookup, so one is taken from the feed: per user the least (country, user_status).
"""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from riskflow.operators import marts, quality
from riskflow.operators.bronze import to_bronze
from riskflow.operators.enrich import enrich
from riskflow.plans.pipeline import run_bronze, run_gold, run_silver
from riskflow.sources.feed import corrupt_rows, good_rows, read_feed
from riskflow.sources.lookups import SPEC_BY_NAME, check_lookups, read_lookup
from riskflow.streaming import layers
from riskflow.streaming.layers import Pace, Store

FEED, LOOKUPS = os.environ["RISKFLOW_SAMPLE_FEED"], os.environ["RISKFLOW_SAMPLE_LOOKUPS"]


@pytest.fixture(scope="module")
def sample_lookups(spark):
    frames = {"users": (
        spark.read.schema("user_id string, country string, user_status string").json(FEED)
        .groupBy("user_id").agg(F.min(F.struct("country", "user_status")).alias("u"))
        .select("user_id", "u.*")
    )}
    for name, pattern in (("products", "*product*"), ("plans", "*plan*"), ("ip_risk", "*ip*risk*")):
        (path,) = Path(LOOKUPS).glob(pattern)
        frames[name] = read_lookup(spark, str(path), SPEC_BY_NAME[name])
    return check_lookups(frames)


@pytest.fixture(scope="module")
def silver(spark, sample_lookups):
    return enrich(to_bronze(good_rows(read_feed(spark, FEED))), sample_lookups).cache()


def test_matches(spark, silver):
    assert corrupt_rows(read_feed(spark, FEED)).count() == 0
    assert silver.count() == 100
    levels = {r[0]: r[1] for r in silver.groupBy("risk_level").count().collect()}
    assert levels == {"low": 35, "medium": 40, "high": 25}
    row = silver.agg(
        *[F.count_if(F.col(spec.flag)).alias(spec.name) for spec in SPEC_BY_NAME.values()],
        F.count_if(F.col("usage_cost_ratio").isNull()).alias("no_ratio"),
        F.min("usage_cost_ratio").alias("low"), F.max("usage_cost_ratio").alias("high"),
    ).first()
    assert tuple(row)[:5] == (0, 0, 69, 0, 69)
    assert (row.low, row.high) == (0.2507502500833611, 4.856952317439147)


def test_marts(silver):
    assert marts.user_spend(silver).count() == 43
    assert marts.flag_high_risk(silver).where("is_high_risk_txn").count() == 0
    usage = {r.product_id: round(r.average_usage_cost_ratio, 9)
             for r in marts.product_usage(silver).collect()}
    assert usage == {
        "P101": 1.887851506, "P102": 1.989718795, "P103": 2.424391464, "P104": 3.477825942,
        "P105": 2.267422474, "P106": 2.515933883, "P107": 2.891630544,
    }


def test_reports(silver):
    report = quality.dq_report(silver, quality.silver_rules(), "silver", 0).collect()
    found = {(r.column, r.check): r.violation_count for r in report}
    assert found["referral_code", "null_check"] == 27
    assert found["amount", "range_check"] == 0
    assert found["usage_cost_ratio", "usage_cost_ratio_invalid"] == 69
    assert found["usage_cost_ratio", "high_risk_low_usage"] == 0
    assert found["amount", "amount_without_monthly_cost"] == 69


def test_streamed_file_by_file(spark, tmp_path, sample_lookups):
    store = Store(str(tmp_path / "store"), str(tmp_path / "restricted"))
    run_bronze(spark, FEED, store, Pace(max_files=1), timeout=600)
    run_silver(spark, store, sample_lookups, Pace(max_files=1), timeout=600)
    run_gold(spark, store, Pace(max_files=1), timeout=600)
    partials = spark.read.parquet(store.partials("spend"))
    assert partials.select("batch_id").distinct().count() == 2
    assert partials.count() == 63
    assert layers.read_spend(spark, store).count() == 43
