"""Layer tables: Parquet folders partitioned by event_date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.sources.limits import limited


# Of the layers' Parquet files: half of a row is hashes, whose hex digits only an entropy coder halves.
CODEC = "zstd"
# Columns of the layers that hold hashes as hex digits.
HASHES = ("hash_ip", "hash_card_number")
# Spark settings that split hot dates and keys at run time, in batches and in streams.
ADAPTIVE_STREAMS = (
    "spark.sql.adaptive.enabled", "spark.sql.adaptive.streaming.stateless.enabled",
)


def require_adaptive(spark: SparkSession) -> None:
    """Refuse to start a stream that shuffles by date or key where nothing would split a hot one."""
    off = [name for name in ADAPTIVE_STREAMS if spark.conf.get(name) != "true"]
    if off:
        raise ValueError(f"set {' and '.join(off)} to true: hot dates and keys are split by it")


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, modified_after: dt.datetime | None = None
) -> DataFrame:
    """A layer table, or the files of it that were written after a time (UTC)."""
    reader = spark.read.schema(schema)
    if modified_after is not None:
        reader = reader.option("modifiedAfter", modified_after.strftime("%Y-%m-%dT%H:%M:%S.%f"))
    return reader.parquet(path).select(*schema.names)


def find_table(
    spark: SparkSession, path: str, schema: T.StructType, modified_after: dt.datetime | None = None
) -> DataFrame | None:
    """The same, None for a table that no job has written to yet."""
    try:
        return read_table(spark, path, schema, modified_after)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def table_or_empty(
    spark: SparkSession, path: str, schema: T.StructType, modified_after: dt.datetime | None = None
) -> DataFrame:
    found = find_table(spark, path, schema, modified_after)
    return spark.createDataFrame([], schema) if found is None else found


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place)


def stream_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files: int | None = None,
    max_bytes: int | str | None = None,
) -> DataFrame:
    """Tail a table that a file-sink stream writes; only committed files are seen.

    The table may be without files yet: its folder is made, so that a reader can start before the
    first batch is written. Such a reader cannot see from the folders that event_date is not in the
    files; it is declared last, where Spark puts such columns once there are folders.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).mkdirs(folder)
    fields = [f for f in schema.fields if f.name != "event_date"]
    declared = T.StructType(fields + [f for f in schema.fields if f.name == "event_date"])
    reader = limited(spark.readStream.schema(declared), max_files, max_bytes)
    return reader.parquet(path).select(*schema.names)


def date_slice(table: DataFrame, day: dt.date) -> DataFrame:
    """One event_date of a batch or streaming table; a partition filter when read from a table."""
    return table.where(F.col("event_date") == F.lit(day))


def event_dates(table: DataFrame) -> DataFrame:
    """The dates that a table holds, in order."""
    return table.select("event_date").distinct().orderBy("event_date")


def packed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Texts of lower-case hex digits as bytes, half as long in a shuffle; ``unpacked`` undoes it.

    Any other text is kept as it is, in a column beside.
    """
    digits = {name: F.lower(F.hex(F.unhex(name))) == F.col(name) for name in names}
    return df.select(
        *[F.when(digits[c], F.unhex(c)).alias(c) if c in digits else F.col(c) for c in df.columns],
        *[F.when(~F.coalesce(digit, F.lit(False)), F.col(name)).alias(f"_text_{name}") for name, digit in digits.items()],
    )


def unpacked(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({name: F.coalesce(F.lower(F.hex(name)), f"_text_{name}") for name in names}).drop(
        *[f"_text_{name}" for name in names])


def by_date(df: DataFrame) -> DataFrame:
    """Gather the rows of a date before a write, else every task writes a file per date it meets.

    Under adaptive execution the rebalance hint joins small dates into one task and splits a date
    that holds much of the data over many. In a stream this rests on ``ADAPTIVE_STREAMS``. Hashes,
    which no codec makes smaller, go through the shuffle as bytes.
    """
    hashes = [name for name in HASHES if name in df.columns]
    return unpacked(packed(df, hashes).hint("rebalance", "event_date"), hashes)


def by_date_parts(df: DataFrame, tie: str, parts: int = 16) -> DataFrame:
    """The same where adaptive execution is not at hand (a stream with state): a date's rows go to
    at most so many tasks, by a column that differs between rows."""
    return df.repartition("event_date", F.pmod(F.xxhash64(tie), F.lit(parts)))


def write_table(
    df: DataFrame, path: str, mode: str = "append", replace_dates: bool = False
) -> None:
    """Batch write, partitioned by event_date; ``replace_dates`` replaces those that ``df`` holds."""
    writer = by_date(df).write.mode("overwrite" if replace_dates else mode).option("compression", CODEC)
    if replace_dates:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("event_date").parquet(path)
