"""How often the lookups of the enrichment had a row, in counts and sketches that add up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.sources.lookups import SPECS

# 2^14 registers: the standard error of a distinct count is 1.04 / 128, under one in a hundred.
SKETCH_BITS = 14
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)
# Silver columns that the metrics read.
INPUT = tuple(dict.fromkeys([spec.feed_key for spec in SPECS] + [spec.flag for spec in SPECS]))


def join_metrics(silver: DataFrame) -> DataFrame:
    """One row per lookup: lookup, row_count, missing_rows, null_keys, missing_keys (a sketch).

    ``missing_rows`` are those without a lookup row, rows without a key among them; the sketch
    holds the distinct keys that the lookup lacks. One aggregate over the columns of ``INPUT``; an
    empty input gives no row.
    """
    counted = [F.count(F.lit(1)).alias("row_count")]
    for spec in SPECS:
        key, missing = F.col(spec.feed_key), F.col(spec.flag)
        counted += [
            F.count_if(missing).alias(f"{spec.name}_missing"),
            F.count_if(missing & key.isNull()).alias(f"{spec.name}_null"),
            F.hll_sketch_agg(F.when(missing, key), SKETCH_BITS).alias(f"{spec.name}_keys"),
        ]
    rows = F.array(*[
        F.struct(F.lit(spec.name).alias("lookup"), F.col("row_count"),
                 F.col(f"{spec.name}_missing").alias("missing_rows"),
                 F.col(f"{spec.name}_null").alias("null_keys"), F.col(f"{spec.name}_keys").alias("missing_keys"))
        for spec in SPECS
    ])
    return silver.agg(*counted).where("row_count > 0").select(F.inline(rows))


def merged_metrics(metrics: DataFrame) -> DataFrame:
    """Metrics of several batches as one row per lookup, without a look at the rows again.

    hit_share is exact; missing_keys is an estimate with a standard error of ``SKETCH_ERROR`` of
    its value, exact for few keys.
    """
    return metrics.groupBy("lookup").agg(
        F.sum("row_count").alias("row_count"), F.sum("missing_rows").alias("missing_rows"),
        F.sum("null_keys").alias("null_keys"),
        F.hll_sketch_estimate(F.hll_union_agg("missing_keys")).alias("missing_keys"),
    ).withColumn("hit_share", 1 - F.col("missing_rows") / F.col("row_count"))
