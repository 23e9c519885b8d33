"""How a feed's lines differ from the declared columns, and schemas that grow with it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Kinds of JSON values that a declared type takes as they are.
TAKES = {
    "string": ("string",), "timestamp": ("string",), "date": ("string",), "boolean": ("boolean",),
    "double": ("number", "integer"), "float": ("number", "integer"), "bigint": ("integer",), "int": ("integer",),
}
# Files with a column of the first type can be read as the second.
WIDER = (("int", "bigint"), ("int", "double"), ("float", "double"))


def kind_of(name: Column) -> Column:
    """string, integer, number, boolean, array, object or null, of the schema of a variant value."""
    return (
        F.when(name == "VOID", "null").when(name == "BIGINT", "integer")
        .when(name.startswith("DECIMAL") | name.isin("DOUBLE", "FLOAT"), "number")
        .when(name.startswith("ARRAY"), "array").when(name.startswith("OBJECT"), "object")
        .otherwise(F.lower(name))
    )


def drift(lines: DataFrame, declared: T.StructType, line_col: str = "value") -> DataFrame:
    """One row per key and kind of value in the lines: column, kind, declared, line_count, status.

    Status is ``new`` for a key that is not declared, ``other type`` for a value that its type does
    not take as it is, ``missing`` (a row without a kind) for a declared key that no line has, and
    ``as declared``. A null value has the kind ``null`` and fits any type; a repeated key makes
    the line no object. Lines that are no JSON object are one row without a column, status
    ``no object``; an empty input has no row at all. Counts are added up before they are shuffled,
    a row per key and kind.
    """
    parsed = lines.select(F.try_parse_json(F.col(line_col)).alias("v"))
    parsed = parsed.withColumn("_whole", F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False)))
    # One walk over a parsed line gives all its keys and values; a line that is no object gives one
    # row without a key.
    objects = parsed.select(F.when(F.col("_whole"), F.col("v")).alias("v"), "_whole")
    keys = lines.sparkSession.tvf.variant_explode_outer(F.col("v").outer())
    rows = objects.lateralJoin(keys).select(
        F.col("key").alias("column"), F.schema_of_variant("value").alias("_type"), "_whole")
    plain = ~F.col("column").contains("'")  # told as an object, whatever its value
    found = rows.where("column is not null or not _whole").select(
        "column", F.when(F.col("column").isNotNull(), F.when(plain, kind_of(F.col("_type"))).otherwise("object")).alias("kind"))
    counts = found.groupBy("column", "kind").agg(F.count("*").alias("line_count"))
    types = {f.name: f.dataType.simpleString() for f in declared}
    table = lines.sparkSession.createDataFrame(
        [(name, kind, list(TAKES.get(kind, ()))) for name, kind in types.items()],
        "name string, declared string, takes array<string>")
    joined = counts.join(F.broadcast(table), F.col("column") == F.col("name"), "left")  # a row per declared column
    status = (
        F.when(F.col("column").isNull(), "no object").when(F.col("name").isNull(), "new")
        .when((F.col("kind") == "null") | F.array_contains("takes", F.col("kind")), "as declared")
        .otherwise("other type")
    )
    report = joined.select("column", "kind", "declared", "line_count", status.alias("status"))
    known = F.when(F.col("column").isin(list(types)), F.col("column"))  # of the declared ones only
    # It reads all that the counts have, so that both share one shuffle and the lines are read once.
    lines_with_keys = F.sum(F.when(F.col("column").isNotNull() | F.col("kind").isNotNull(), F.col("line_count")))
    seen = counts.agg(F.collect_set(known).alias("_seen"), lines_with_keys.alias("_n"))
    lacking = table.join(F.broadcast(seen), F.lit(True)).where(
        (F.col("_n") > 0) & ~F.array_contains("_seen", F.col("name")))
    return report.unionByName(lacking.select(
        F.col("name").alias("column"), F.lit(None).cast("string").alias("kind"), "declared",
        F.lit(0).cast("long").alias("line_count"), F.lit("missing").alias("status")))


def widest(old: T.StructType, new: T.StructType) -> T.StructType:
    """A schema that reads files of both: all columns, each with the wider of its types.

    Raises for a column whose types have no common one that files of both can be read as.
    """
    def wider(a: T.DataType, b: T.DataType, name: str) -> T.DataType:
        if a == b:
            return a
        for x, y in ((a, b), (b, a)):
            if (x.simpleString(), y.simpleString()) in WIDER:
                return y
        raise ValueError(f"column {name}: {a.simpleString()} and {b.simpleString()} have no common type")

    def merged(out: T.StructType, field: T.StructField) -> T.StructType:
        if field.name not in out.names:
            return T.StructType(out.fields + [field])
        return T.StructType([
            T.StructField(f.name, wider(f.dataType, field.dataType, f.name)) if f.name == field.name else f
            for f in out.fields
        ])

    return reduce(merged, new.fields, old)


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
