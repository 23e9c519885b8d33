"""A small feed and its lookups as files, with totals counted by hand."""

import json

import pytest

from riskflow.operators import marts, quality
from riskflow.operators.bronze import to_bronze
from riskflow.operators.enrich import enrich
from riskflow.plans.pipeline import run_bronze, run_gold, run_silver
from riskflow.sources.feed import corrupt_rows, good_rows, read_feed
from riskflow.sources.lookups import load_lookups
from riskflow.streaming import layers
from riskflow.streaming.layers import Pace, Store

# user, product, plan, amount, address, card, currency, day
FEED = {
    "one.json": [
        ("ann", "p1", "basic", 10.0, "192.0.2.1", "4000000000000001", "EUR", 4),
        ("ann", "p1", "basic", 30.0, "192.0.2.1", "4000000000000001", "EUR", 4),
        ("bob", "p2", "basic", 1.0, "192.0.2.1", "40000000000002", None, 4),
        ("bob", "p2", "none", -5.0, "192.0.2.2", "4000-1", "eur", 5),
    ],
    "two.json": [
        ("ann", "p1", "gift", 8.0, "192.0.2.9", None, "EUR", 4),
        ("cat", "p3", "basic", None, None, "4000000000000003", "EUR", 5),
        (None, "p1", "basic", 20.0, "192.0.2.1", "4000000000000004", "USD", 5),
    ],
}
LOOKUPS = {
    "users": "user_id,country,user_status\nann,Peru,active\nbob,Chad,banned\n",
    "products": "product_id,product_name,category,price\np1,Hammer,Tools,9.5\np2,Nail,Tools,0.1\n",
    "plans": "subscription_type,monthly_cost,churn_risk,plan_duration\nbasic,20,Low,1\ngift,0,High,3\n",
}


@pytest.fixture(scope="module")
def feed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("feed")
    number = 0
    for name, rows in FEED.items():
        lines = []
        for user, product, plan, amount, address, card, currency, day in rows:
            number += 1
            lines.append(json.dumps({
                "transaction_id": f"n{number}", "event_time": f"2023-03-0{day}T08:00:00Z",
                "user_id": user, "product_id": product, "subscription_type": plan,
                "amount": amount, "ip_address": address, "card_number": card, "currency": currency,
                "country": "not in the schema",
            }))
        (folder / name).write_text("\n".join(lines) + "\n")
    with (folder / "two.json").open("a") as file:
        file.write("[1, 2\n")
    return str(folder)


@pytest.fixture(scope="module")
def lookups(spark, tmp_path_factory):
    from hashlib import sha256
    folder = tmp_path_factory.mktemp("lookups")
    risk = "ip_hash,risk_level,risk_score,location\n" + "".join(
        f"{sha256(ip.encode()).hexdigest()},{level},{score},{place}\n"
        for ip, level, score, place in (("192.0.2.1", "high", 85.5, "North"), ("192.0.2.2", "low", 3, "South")))
    paths = {}
    for name, text in {**LOOKUPS, "ip_risk": risk}.items():
        paths[name] = str(folder / f"{name}.csv")
        (folder / f"{name}.csv").write_text(text)
    return load_lookups(spark, paths)


@pytest.fixture(scope="module")
def silver(spark, feed, lookups):
    return enrich(to_bronze(good_rows(read_feed(spark, feed))), lookups).cache()


def test_matches(spark, feed, silver):
    assert corrupt_rows(read_feed(spark, feed)).count() == 1
    rows = {r.transaction_id: r for r in silver.collect()}
    assert len(rows) == 7
    misses = {flag: {t for t, r in rows.items() if r[flag]} for flag in (
        "missing_user", "missing_product", "missing_subscription", "missing_ip")}
    assert misses == {"missing_user": {"n6", "n7"}, "missing_product": {"n6"},
                      "missing_subscription": {"n4"}, "missing_ip": {"n5", "n6"}}
    assert {t: r.usage_cost_ratio for t, r in rows.items()} == {
        "n1": 0.5, "n2": 1.5, "n3": 0.05, "n4": None, "n5": None, "n6": None, "n7": 1.0}
    assert rows["n1"].risk_score == 85.5
    assert [rows[f"n{i}"].card_number for i in range(1, 6)] == [
        "**** **** **** 0001", "**** **** **** 0001", "**** **** **** 0002", "****", None]


def test_marts(spark, feed, lookups, silver):
    spend = {(r.user_id, r.event_date.day): r.Total_spent_per_user
             for r in marts.user_spend(silver).collect()}
    assert spend == {("ann", 4): 48.0, ("bob", 4): 1.0, ("bob", 5): -5.0, ("cat", 5): None, (None, 5): 20.0}
    usage = {(r.product_id, r.event_date.day): r.average_usage_cost_ratio
             for r in marts.product_usage(silver).collect()}
    assert usage == {("p1", 4): 1.0, ("p2", 4): 0.05, ("p2", 5): None, ("p3", 5): None, ("p1", 5): 1.0}
    bronze = to_bronze(good_rows(read_feed(spark, feed)))
    assert [r.transaction_id for r in marts.risk_alerts(bronze, lookups).collect()] == ["n3"]


def test_reports(spark, feed, silver):
    raw = quality.dq_report(good_rows(read_feed(spark, feed)), quality.raw_rules(), "bronze", 0)
    found = {(r.column, r.check): r.violation_count for r in raw.collect()}
    assert found["amount", "range_check"] == 1 and found["amount", "null_check"] == 1
    assert found["card_number", "format_check for card_number"] == 1
    assert found["currency", "format_check for currency"] == 1
    assert found["referral_code", "null_check"] == 7
    report = quality.dq_report(silver, quality.silver_rules(), "silver", 0).collect()
    found = {r.check: r.violation_count for r in report if r.check != "null_check"}
    assert found["usage_cost_ratio_invalid"] == 3
    assert found["high_risk_low_usage"] == 1
    assert found["amount_without_monthly_cost"] == 1
    assert found["missing_currency_with_amount"] == 1


def test_streamed_file_by_file(spark, feed, lookups, silver, tmp_path):
    store = Store(str(tmp_path / "store"), str(tmp_path / "private"))
    counts = run_bronze(spark, feed, store, Pace(max_files=1), timeout=300)
    assert counts == {"lines": 8, "corrupt_lines": 1}
    run_silver(spark, store, lookups, Pace(max_files=1), timeout=300)
    run_gold(spark, store, Pace(max_files=1), timeout=300)
    assert sorted(map(str, layers.read_spend(spark, store).collect())) == sorted(
        map(str, marts.user_spend(silver).collect()))
    assert layers.read_alerts(spark, store).count() == 1
