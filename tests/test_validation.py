import pytest

from riskflow import schemas
from riskflow.operators.validation import Mismatch, SchemaMismatch, require_schema, schema_diff


def test_all_mismatches_are_named(raw):
    df = raw({}).selectExpr(
        "* except (user_id, amount)", "cast(amount as string) as amount", "1 as more"
    )
    assert schema_diff(df, schemas.RAW) == [
        Mismatch("user_id", "string", None), Mismatch("amount", "double", "string"),
    ]
    with pytest.raises(SchemaMismatch, match="user_id: .*no such column; amount: expected double"):
        require_schema(df, schemas.RAW, "raw")


def test_good_schema_passes(raw):
    df = raw({})
    assert require_schema(df, schemas.RAW, "raw") is df
