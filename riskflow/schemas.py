"""Column names and types of every layer."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(text: str) -> T.StructType:
    schema = T.StructType()
    for line in text.split(","):
        name, kind = line.split()
        schema = schema.add(name, kind)
    return schema


# Names and types are the contract of the feed and of the tables.
RAW = _struct("""
    transaction_id string, event_time timestamp, user_id string, product_id string,
    subscription_type string, amount double, location string, ip_address string,
    device_id string, payment_method string, card_number string, currency string,
    is_new_user boolean, referral_code string, session_id string
""")

BRONZE = _struct("""
    transaction_id string, event_time timestamp, user_id string, product_id string,
    subscription_type string, amount double, location string, device_id string,
    payment_method string, currency string, is_new_user boolean, referral_code string,
    session_id string, hash_ip string, hash_card_number string, card_number string,
    event_date date
""")

# Columns that bronze has besides, where asked for: where a line came from, and its address's place.
AUDIT = _struct("source_file string, source_modified timestamp, ingested_at timestamp")
GEO = _struct("geo_country string, geo_region string, missing_geo boolean")
SOURCES = T.StructType(_struct("transaction_id string").fields + AUDIT.fields
                       + _struct("ingest_date date").fields)

SILVER = T.StructType(BRONZE.fields + _struct("""
    country string, user_status string, missing_user boolean,
    product_name string, category string, price double, missing_product boolean,
    monthly_cost double, churn_risk string, plan_duration integer, missing_subscription boolean,
    risk_level string, risk_score double, ip_risk_location string, missing_ip boolean,
    usage_cost_ratio double
""").fields)

RISK = T.StructType(SILVER.fields + _struct("is_high_risk_txn boolean").fields)

USERS = _struct("user_id string, country string, user_status string")
PRODUCTS = _struct("product_id string, product_name string, category string, price double")
PLANS = _struct(
    "subscription_type string, monthly_cost double, churn_risk string, plan_duration integer"
)
IP_RISK = _struct("ip_hash string, risk_level string, risk_score double, location string")

DQ_REPORT = _struct("""
    layer string, batch_id long, column string, check string, violation_count long,
    total_rows long, violation_percent double, status string
""")

PII = _struct("transaction_id string, ip_address string, card_number string, batch_id long")
FEED_COUNTS = _struct("lines long, corrupt_lines long, repeated_lines long, batch_id long")
QUARANTINE = _struct("corrupt_record string, source_file string")

# Per-batch partial aggregates behind the two daily tables.
SPEND_PARTIAL = _struct("user_id string, spent_sum double, batch_id long, event_date date")
USAGE_PARTIAL = _struct(
    "product_id string, ratio_sum double, ratio_count long, batch_id long, event_date date"
)

VELOCITY = _struct("""
    transaction_id string, user_id string, event_time timestamp, velocity_count long,
    velocity_amount double, velocity_score double, event_date date
""")
DEVICES = _struct("""
    transaction_id string, user_id string, event_time timestamp, device_id string,
    previous_device string, device_changed boolean, device_is_new boolean, event_date date
""")

DRIFT = _struct("""
    column string, kind string, declared string, line_count long, status string, batch_id long
""")
AMOUNT_SKETCHES = _struct("user_id string, amount_count long, amounts binary, batch_id long")
JOIN_METRICS = _struct("""
    lookup string, row_count long, missing_rows long, null_keys long, missing_keys binary,
    batch_id long
""")
