import pytest

from riskflow import schemas
from riskflow.operators import quality
from riskflow.operators.bronze import to_bronze
from riskflow.operators.enrich import enrich
from riskflow.operators.quality import dq_report
from riskflow.plans import model

BAD_ROWS = [
    {},
    {"amount": 0.0, "currency": "usd"},
    {"amount": -1.0, "currency": "USDX"},
    {"amount": None, "currency": None},
    {"amount": 5.0, "currency": None},
    {"card_number": "123", "ip_address": None, "referral_code": None},
    {"card_number": None, "subscription_type": "gone"},
    {"card_number": "4000000000001234\n", "event_time": None},
    {"amount": 1.0, "subscription_type": "free"},
]


def violations(report):
    return {(r.column, r.check): r.violation_count for r in report.collect()}


def test_every_bronze_rule_fires_on_the_flawed_feed(spark):
    """So a rule that is broken turns the registered reports red."""
    raw = model.flawed(model.raw(spark, "/root/testdata/sf0.001"))
    for df, rules in ((raw, quality.raw_rules()), (to_bronze(raw), quality.bronze_rules())):
        report = quality.dq_report(df, rules, "bronze", 0).collect()
        assert len(report) == 18 and all(r.violation_count > 0 for r in report)


def test_bronze_report(raw):
    found = violations(dq_report(raw(*BAD_ROWS), quality.raw_rules(), "bronze", 4))
    assert len(found) == 18
    assert found["amount", "null_check"] == 1
    assert found["currency", "null_check"] == 2
    assert found["card_number", "null_check"] == 1
    assert found["ip_address", "null_check"] == 1
    assert found["event_time", "null_check"] == 1
    assert found["amount", "range_check"] == 2
    assert found["card_number", "format_check for card_number"] == 1
    assert found["currency", "format_check for currency"] == 2


def test_bronze_table_gives_the_same_report(raw):
    df = raw(*BAD_ROWS)
    on_raw = dq_report(df, quality.raw_rules(), "bronze", 4).collect()
    assert dq_report(to_bronze(df), quality.bronze_rules(), "bronze", 4).collect() == on_raw


@pytest.mark.parametrize("limit, expected", [(80.0, 0), (8.0, 4)])
def test_silver_report(raw, lookups, limit, expected):
    df = raw(*BAD_ROWS, {"amount": 1.0})
    report = dq_report(enrich(to_bronze(df), lookups), quality.silver_rules(limit), "silver", 0)
    found = violations(report)
    assert len(found) == 39
    assert found["usage_cost_ratio", "usage_cost_ratio_invalid"] == 5
    assert found["amount", "amount_without_monthly_cost"] == 1
    assert found["amount", "missing_currency_with_amount"] == 1
    # amounts 0, -1, 5 and 1 over a cost of 50, at score 9
    assert found["usage_cost_ratio", "high_risk_low_usage"] == expected


def test_shape_of_a_report(raw):
    report = dq_report(raw({}, {"amount": None}), quality.null_rules(["amount", "currency"]),
                       "bronze", 12)
    assert report.columns == schemas.DQ_REPORT.names
    assert [tuple(r) for r in report.collect()] == [
        ("bronze", 12, "amount", "null_check", 1, 2, 50.0, "fail"),
        ("bronze", 12, "currency", "null_check", 0, 2, 0.0, "pass"),
    ]


def test_empty_input_has_no_report(raw):
    assert dq_report(raw({}).where("false"), quality.raw_rules(), "bronze", 0).count() == 0
