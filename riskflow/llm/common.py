"""What the operators of this package share: tables, stored intermediate frames, held-out rows."""

from __future__ import annotations

import functools
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskflow.session import scratch_dir
from riskflow.sources.limits import parse_bytes

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@functools.lru_cache(maxsize=1)
def _package_archive() -> str:
    root = Path(__file__).resolve().parents[2]
    base = f"{tempfile.mkdtemp(prefix='riskflow-code-')}/riskflow-code"
    return shutil.make_archive(base, "zip", root, "riskflow")


# Texts go to Python in batches of about this size; the default of 64 MB, held several times over
# by each task and worker, is much of a small executor.
ARROW_BYTES = 8 << 20


def ship(spark: SparkSession) -> None:
    """Give the code of this package to the Python workers, as ``--py-files`` would, and have
    Arrow batches of moderate size."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    current = spark.conf.get(setting)
    if current.startswith("-") or parse_bytes(current) > ARROW_BYTES:
        spark.conf.set(setting, ARROW_BYTES)
    context = spark.sparkContext
    if not getattr(context, "_riskflow_shipped", False):
        context.addPyFile(_package_archive())
        context._riskflow_shipped = True


def with_code(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A query or stage that ships the package's code first."""
    @functools.wraps(function)
    def run(spark: SparkSession, *args) -> DataFrame:
        ship(spark)
        return function(spark, *args)

    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back, so that no later step computes it again.

    A lost executor costs its running tasks only; the lineage ends at the written table.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hinted(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` (narrow rows, cheap to count) marked for a broadcast if it has ``max_rows`` at most.

    Beyond that the mark is left out and the join shuffles.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and no other letter."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def id_remainder(id_col: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % mod


def hashed_sample(rows: DataFrame, group: str, id_col: str, per_group: int) -> DataFrame:
    """At most ``per_group`` rows of each group, those of the smallest hashed ids: (id, group, of).

    ``of`` is the number of rows of the group. The groups are few (labels, languages). A share of
    each group, by hash, a little more than needed, is kept before rows of a group meet in a task.
    """
    sizes = F.broadcast(rows.groupBy(group).agg(F.count("*").alias("of")))
    place = F.xxhash64(id_col)
    share = (F.lit(1.2 * per_group + 50) / F.col("of")) * float(1 << 64) - float(1 << 63)
    near = rows.select(id_col, group).join(sizes, group).where(place <= share)
    rank = F.row_number().over(Window.partitionBy(group).orderBy(place, id_col))
    return near.withColumn("__rank", rank).where(F.col("__rank") <= per_group).drop("__rank")


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(
    batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of each take about ``max_bytes``, one row at least.

    At their end the worker, which waits for its next task, gives unused memory back.
    """
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        at, n = 0, batch.num_rows
        rows = max(1, int(n * max_bytes / max(1, column.nbytes))) if n else 1
        while at < n:
            yield batch.slice(at, rows)
            at += rows
    pa.default_memory_pool().release_unused()
