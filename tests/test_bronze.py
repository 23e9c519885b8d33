import re

import pytest
from conftest import sha
from pyspark.sql import functions as F

from riskflow import schemas
from riskflow.functions.privacy import mask_card, mask_card_unanchored
from riskflow.operators.bronze import pii_copy, to_bronze
from riskflow.operators.enrich import enrich
from riskflow.operators.marts import flag_high_risk
from riskflow.operators.validation import schema_diff

MASKED = "**** **** **** "


@pytest.mark.parametrize("card, strict, parity", [
    ("1" * 8 + "2345", MASKED + "2345", "111111112345"),
    ("1" * 9 + "2345", MASKED + "2345", "1111111112345"),
    ("1" * 11 + "2345", MASKED + "2345", "111111111112345"),
    ("1" * 12 + "2345", MASKED + "2345", MASKED + "2345"),
    ("1" * 12 + "23456", MASKED + "3456", MASKED + "23456"),
    ("1" * 12 + "234567", MASKED + "4567", MASKED + "234567"),
    ("1" * 12 + "2345678", MASKED + "5678", MASKED + "2345678"),
    ("1" * 12 + "2345\n", MASKED + "2345", MASKED + "2345\n"),
    ("1" * 12 + "2345\r\n", MASKED + "2345", MASKED + "2345\r\n"),
    ("1" * 12 + "2345\u2028", MASKED + "2345", MASKED + "2345\u2028"),
    ("1" * 12 + "2345 ", "****", MASKED + "2345 "),
    ("1" * 20, "****", MASKED + "11111111"),
    ("12345678901", "****", "12345678901"),
    ("4000-0000-0000-1234", "****", "4000-0000-0000-1234"),
    ("", "****", ""),
    (None, None, None),
])
def test_masks(spark, raw, card, strict, parity):
    row = raw({"card_number": card}).select(
        mask_card(F.col("card_number")), mask_card_unanchored(F.col("card_number"))
    ).first()
    assert tuple(row) == (strict, parity)


def test_hashes_and_date(raw):
    good, empty = to_bronze(raw(
        {}, {"ip_address": None, "card_number": None, "event_time": None}
    )).orderBy("transaction_id").collect()
    assert good.hash_ip == sha("10.0.0.1")
    assert good.hash_card_number == sha("4000000000001234")
    assert str(good.event_date) == "2024-01-02"
    assert (empty.hash_ip, empty.hash_card_number, empty.card_number, empty.event_date) == (
        None, None, None, None)


def test_card_salt_changes_the_card_hash_only(raw):
    row = to_bronze(raw({}), card_salt="pepper").first()
    assert row.hash_card_number == sha("pepper4000000000001234")
    assert row.hash_ip == sha("10.0.0.1")


def test_schema(raw):
    bronze = to_bronze(raw({}))
    assert bronze.columns == schemas.BRONZE.names
    assert schema_diff(bronze, schemas.BRONZE) == []


def test_pii_copy_has_a_key(raw):
    assert pii_copy(raw({})).first() == ("t0", "10.0.0.1", "4000000000001234")


def test_no_layer_holds_clear_values(raw, lookups):
    cards = ["4000000000001234", "123456789012", "9" * 19, "12345678901234567890", "4000-1"]
    df = raw(*[{"card_number": c, "ip_address": f"10.0.0.{i}"} for i, c in enumerate(cards)])
    for layer in (to_bronze(df), flag_high_risk(enrich(to_bronze(df), lookups))):
        for row in layer.collect():
            for name, value in row.asDict().items():
                if isinstance(value, str) and not name.startswith("hash_"):
                    assert not re.search(r"\d{5}", value), name
                    assert "10.0.0." not in value, name
