"""Rewrite of a table into few files, sorted so that filters on date and key skip most of them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.sources.tables import CODEC, HASHES, packed, unpacked

ROWS_PER_FILE = 5_000_000
# Of rows as a shuffle holds them before it compresses them: what one task reads and sorts.
BYTES_PER_FILE = 1 << 30


def file_count(
    table: DataFrame, rows_per_file: int = ROWS_PER_FILE, bytes_per_file: int = BYTES_PER_FILE
) -> int:
    """Files for the rows of a stored table, each within both bounds.

    A row has eight bytes per column and those of its texts, which are added up in one pass.
    """
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in table.schema if f.dataType == T.StringType()]
    width = sum(texts, F.lit(8 * len(table.columns))).cast("long")
    rows, size = table.agg(F.count(F.lit(1)), F.sum(width)).first()
    return max(1, math.ceil(rows / rows_per_file), math.ceil((size or 0) / bytes_per_file))


def write_clustered(
    df: DataFrame, target: str, key: str, files: int, tie: str | None = None,
    replace_dates: bool = False,
) -> None:
    """Range-partition by date and key, sort, and write to ``target``, which must not exist yet.

    With ``replace_dates`` it may: the dates in ``df`` are replaced there and no other is touched.
    ``tie`` is a column that tells apart rows of one date and key; it lets the ranges cut through
    a key with very many rows, and is not written.
    """
    order = ["event_date", key] + ([tie] if tie else [])
    columns = [name for name in df.columns if name != tie]
    hashes = [name for name in HASHES if name in columns and name != key]
    ranged = packed(df, hashes).repartitionByRange(files, *order).sortWithinPartitions("event_date", key)
    (
        unpacked(ranged, hashes)
        .select(*columns)
        .write.mode("overwrite" if replace_dates else "errorifexists")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", CODEC)
        .partitionBy("event_date")
        .parquet(target)
    )


def cluster_table(
    spark: SparkSession, source: str, target: str, schema: T.StructType, key: str,
    rows_per_file: int = ROWS_PER_FILE, dates: Column | None = None,
) -> None:
    """Rewrite a layer table, or the dates in it that a condition names, into the same target.

    A row's position in its file serves as the tie.
    """
    table = spark.read.schema(schema).parquet(source)
    if dates is not None:
        table = table.where(dates)
    files = file_count(table, rows_per_file)
    table = table.select(*schema.names, F.col("_metadata.row_index").alias("_row_index"))
    write_clustered(table, target, key, files, "_row_index", replace_dates=dates is not None)
