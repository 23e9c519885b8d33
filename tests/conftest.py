from __future__ import annotations

import datetime as dt
import hashlib
import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from riskflow import schemas  # noqa: E402
from riskflow.session import build_session  # noqa: E402
from riskflow.sources.lookups import SPEC_BY_NAME, check_lookups  # noqa: E402


# Totals of a sample that is not part of this repository; test_totals.py holds those of its own.
SAMPLES = ("RISKFLOW_SAMPLE_FEED", "RISKFLOW_SAMPLE_LOOKUPS")
collect_ignore = [] if all(os.environ.get(name) for name in SAMPLES) else ["test_samples.py"]


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set session settings for one test."""
    before = {}

    def set_conf(**conf):
        for key, value in conf.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, value)

    yield set_conf
    for key, value in before.items():
        spark.conf.set(key, value)


BASE_ROW = {
    "transaction_id": "t0", "event_time": dt.datetime(2024, 1, 2, 3, 4, 5), "user_id": "u1",
    "product_id": "p1", "subscription_type": "view", "amount": 10.0, "location": "City-1",
    "ip_address": "10.0.0.1", "device_id": "d1", "payment_method": "PayPal",
    "card_number": "4000000000001234", "currency": "USD", "is_new_user": True,
    "referral_code": "REF", "session_id": "s1",
}


@pytest.fixture
def raw(spark):
    """Feed rows from overrides of one good row."""
    def make(*overrides):
        rows = [
            tuple({**BASE_ROW, "transaction_id": f"t{i}", **o}[n] for n in schemas.RAW.names)
            for i, o in enumerate(overrides)
        ]
        return spark.createDataFrame(rows, schemas.RAW)

    return make


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


LOOKUP_ROWS = {
    "users": [("u1", "India", "active"), ("u2", "Canada", "banned")],
    "products": [("p1", "Toolkit", "Tools", 9.5), ("p2", "Plugin", "SDK", 0.0)],
    "plans": [("view", 50.0, "Low", 1), ("free", 0.0, "High", 12), ("odd", None, "High", 3)],
    "ip_risk": [(sha("10.0.0.1"), "high", 9.0, "Region-1"), (sha("10.0.0.2"), "low", 2.5, "Region-2")],
}


@pytest.fixture
def lookup_frames(spark):
    return {
        name: spark.createDataFrame(rows, SPEC_BY_NAME[name].schema)
        for name, rows in LOOKUP_ROWS.items()
    }


@pytest.fixture
def lookups(lookup_frames):
    return check_lookups(lookup_frames)
