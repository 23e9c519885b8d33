"""Shared helpers: bounded samples, checked broadcasts, held-out rows, stored frames."""

import zlib

from pyspark.sql import functions as F

from riskflow.llm.common import ascii_lower, hashed_sample, hinted, id_remainder, ship, stored


def test_samples_are_bounded_and_repeatable(spark):
    rows = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(
            F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("kind"))
    sample = hashed_sample(rows, "kind", "doc_id", 500)
    sizes = {r["kind"]: r["count"] for r in sample.groupBy("kind").count().collect()}
    assert set(sizes.values()) == {500} and len(sizes) == 8
    assert {r["kind"]: r["of"] for r in sample.select("kind", "of").distinct().collect()}["hot"] == 10_000
    again = hashed_sample(rows.repartition(5), "kind", "doc_id", 500)
    assert sample.exceptAll(again).isEmpty()
    few = hashed_sample(rows, "kind", "doc_id", 50_000)
    assert few.count() == 30_000
    assert hashed_sample(rows.limit(0), "kind", "doc_id", 5).isEmpty()


def test_only_small_frames_are_marked_for_a_broadcast(spark):
    def marked(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString().lower()

    assert marked(hinted(spark.range(10), 10)) and not marked(hinted(spark.range(11), 10))


def test_remainders_are_those_of_the_id_as_text(spark):
    rows = spark.range(200).select("id", id_remainder("id", 4).alias("r")).collect()
    assert all(r["r"] == zlib.crc32(str(r["id"]).encode()) % 4 for r in rows)
    null = spark.sql("select cast(null as bigint) as id").select(id_remainder("id", 4)).first()[0]
    assert null == 0


def test_only_letters_of_ascii_are_lowered(spark):
    texts = ["ABC xyz", "ÀÉ İ ABC", "", None, "ß Σ Z"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(ascii_lower(F.col("t"))).collect()]
    assert got == ["abc xyz", "ÀÉ İ abc", "", None, "ß Σ z"]


def test_stored_frames_have_no_lineage(spark):
    df = stored(spark.range(5).select(F.rand().alias("x")), "test")
    assert df.collect() == df.collect()
    assert "Range" not in df._jdf.queryExecution().toString()


def test_arrow_batches_only_get_smaller(spark, settings):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    settings(spark__sql__execution__arrow__maxBytesPerBatch="1m")
    ship(spark)
    assert spark.conf.get(setting) == "1m"
    settings(spark__sql__execution__arrow__maxBytesPerBatch="64m")
    ship(spark)
    assert spark.conf.get(setting) == str(8 << 20)
