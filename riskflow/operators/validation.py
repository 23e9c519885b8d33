"""Comparison of a DataFrame's schema with a layer's contract."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import types as T


class Mismatch(NamedTuple):
    column: str
    expected: str
    actual: str | None


class SchemaMismatch(ValueError):
    def __init__(self, layer: str, mismatches: list[Mismatch]):
        self.mismatches = mismatches
        details = "; ".join(
            f"{m.column}: expected {m.expected}, found {m.actual or 'no such column'}"
            for m in mismatches
        )
        super().__init__(f"{layer} schema: {details}")


def schema_diff(df: DataFrame, expected: T.StructType) -> list[Mismatch]:
    """Every expected column that is absent or of another type; further columns are allowed."""
    actual = {field.name: field.dataType.simpleString() for field in df.schema.fields}
    return [
        Mismatch(field.name, field.dataType.simpleString(), actual.get(field.name))
        for field in expected.fields
        if actual.get(field.name) != field.dataType.simpleString()
    ]


def require_schema(df: DataFrame, expected: T.StructType, layer: str) -> DataFrame:
    mismatches = schema_diff(df, expected)
    if mismatches:
        raise SchemaMismatch(layer, mismatches)
    return df
