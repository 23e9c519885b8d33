"""Transaction feed: newline-delimited JSON with a declared schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.schemas import AUDIT, RAW
from riskflow.sources.limits import limited

CORRUPT = "_corrupt_record"
FEED = T.StructType(RAW.fields + [T.StructField(CORRUPT, T.StringType())])
# The file source skips files that are older than the newest one it has seen by more than this; a
# feed's late files and copies that keep their times are data all the same.
MAX_FILE_AGE = "36500d"
OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Batch read: the 15 feed columns plus the corrupt line, which is null for a good one.

    Keys outside the schema are dropped.
    """
    return spark.read.schema(FEED).options(**OPTIONS).json(path)


def stream_feed(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    max_bytes: int | str | None = None,
    max_file_age: str = MAX_FILE_AGE,
    archive: str | None = None,
    more: T.StructType = T.StructType(),
) -> DataFrame:
    """Streaming read of the same columns, with an optional limit on the size of a micro-batch.

    ``more`` are further keys to read; a value of the wrong type makes its line corrupt as well.

    ``archive`` moves files that were read to that folder, so that the next run lists fewer. Give
    it only where a single query reads the feed.
    """
    schema = T.StructType(RAW.fields + more.fields + FEED.fields[len(RAW):])
    reader = spark.readStream.schema(schema).options(**OPTIONS).option("maxFileAge", max_file_age)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return limited(reader, max_files, max_bytes).json(path)


def counted(feed: DataFrame) -> DataFrame:
    """The feed; a query that writes all its columns also counts lines and corrupt lines, which
    its progress shows as the observed metric ``feed``."""
    return feed.observe(
        "feed", F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("corrupt_lines"),
    )


def stream_lines(
    spark: SparkSession, path: str, max_files: int | None = None,
    max_bytes: int | str | None = None, max_file_age: str = MAX_FILE_AGE,
) -> DataFrame:
    """The feed's lines as they are: value."""
    reader = spark.readStream.option("maxFileAge", max_file_age)
    return limited(reader, max_files, max_bytes).text(path)


def _parsed_whole(names: Sequence[str] = RAW.names) -> Column:
    """True for every row, which the optimizer cannot tell.

    The JSON source parses only the columns that a query needs, so a query that leaves out a
    column with a wrong type would take that line for a good one. This condition needs them all,
    and every query agrees on the bad lines.
    """
    return F.hash(*names) <= F.lit(2**31 - 1)


def good_rows(feed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The feed columns, and those of ``keep``, of lines that are not corrupt."""
    return feed.where(F.col(CORRUPT).isNull() & _parsed_whole(_read(feed))).select(*RAW.names, *keep)


def _read(feed: DataFrame) -> list[str]:
    """The columns that were read from the lines."""
    return [name for name in feed.columns if name != CORRUPT and name not in AUDIT.names]


def with_source(feed: DataFrame) -> DataFrame:
    """The feed as it was read, with where each line came from and when it was taken.

    The time is that of the micro-batch, which a replay keeps.
    """
    return feed.select(
        "*", F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("source_modified"),
        F.current_timestamp().alias("ingested_at"),
    )


def once(rows: DataFrame, within: str) -> DataFrame:
    """A stream's rows (with ``source_file`` and ``ingested_at``) without those whose
    transaction_id came before, in the same batch or up to ``within`` earlier.

    Time is the time of arrival: an old transaction or a late file is never dropped for its age,
    and the ids are forgotten ``within`` after they came. Rows without an id are all kept: each has
    a key of its own, from its file, its batch and two numbers drawn for it.
    """
    own = F.concat_ws("|", "source_file", "ingested_at", F.rand(seed=31), F.rand(seed=37))
    keyed = rows.withColumn("_key", F.when(F.col("transaction_id").isNull(), own).otherwise(
        F.concat(F.lit("="), "transaction_id")))
    return keyed.withWatermark("ingested_at", within).dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def corrupt_rows(feed: DataFrame) -> DataFrame:
    """Lines that are no JSON object or hold a value of the wrong type, as they came, with the
    name of their file. Takes the feed as it was read."""
    return feed.where(F.col(CORRUPT).isNotNull() & _parsed_whole(_read(feed))).select(
        F.col(CORRUPT).alias("corrupt_record"), F.col("_metadata.file_name").alias("source_file")
    )
