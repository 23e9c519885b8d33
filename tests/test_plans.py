"""What the optimizer makes of the main queries."""

import datetime as dt
import re
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from riskflow import schemas
from riskflow.operators import marts, quality
from riskflow.operators.bronze import to_bronze
from riskflow.operators.enrich import enrich
from riskflow.operators.layout import cluster_table, file_count, write_clustered
from riskflow.plans import model, queries
from riskflow.sources.feed import CORRUPT, good_rows, read_feed
from riskflow.sources.lookups import check_lookups
from riskflow.sources.tables import by_date, date_slice, read_table, write_table
from riskflow.streaming.layers import Store, start_bronze
from riskflow.streaming.sinks import await_all

SF_DIR = "/root/testdata/sf0.001"


def plan(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


def test_report_reads_its_input_once(spark, capsys):
    text = plan(quality.dq_report(model.raw(spark, SF_DIR), quality.raw_rules(), "b", 0), capsys)
    assert len(re.findall(r"Scan parquet +\(", text.split("\n\n")[0])) == 1
    assert text.split("\n\n")[0].count("Exchange") == 1


def test_small_lookups_are_broadcast_and_the_feed_is_not_shuffled(spark, capsys):
    tree = plan(queries.silver(spark, SF_DIR), capsys).split("\n\n")[0]
    assert tree.count("BroadcastHashJoin LeftOuter") == 4
    assert "SortMergeJoin" not in tree and "Exchange hash" not in tree


def test_lookups_over_the_bound_are_not_broadcast(spark, capsys, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    frames = model.lookup_frames(spark, SF_DIR, ["products"])
    lookups = check_lookups(frames, broadcast_limit=100)
    tree = plan(enrich(queries._bronze(spark, SF_DIR), lookups, ["products"]), capsys)
    assert "BroadcastHashJoin" not in tree and "SortMergeJoin LeftOuter" in tree


def test_alerts_join_the_deciding_lookups_first(spark, capsys):
    """Plans and addresses as inner joins, users and products above them for the rows left."""
    tree = plan(queries.risk_alerts(spark, SF_DIR), capsys).split("\n\n")[0]
    joins = re.findall(r"BroadcastHashJoin (\w+)", tree)
    # The last inner join makes the users lookup of the test model.
    assert joins == ["LeftOuter", "LeftOuter", "Inner", "Inner", "Inner"]


def test_the_feed_is_read_with_all_its_columns(spark, tmp_path, capsys):
    """Else a line with a bad value in a column that a query leaves out would pass for a good one."""
    (tmp_path / "f.json").write_text("{}\n")
    good = good_rows(read_feed(spark, str(tmp_path))).select("user_id")
    text = plan(good, capsys)
    (columns,) = re.findall(r"ReadSchema: struct<(.*)>", text)
    assert [c.split(":")[0] for c in columns.split(",")] == [*schemas.RAW.names, CORRUPT]


def test_schema_check_runs_no_join(spark, capsys):
    assert "Join" not in plan(queries.schema_mismatches(spark, SF_DIR), capsys).split("\n\n")[0]


def test_marts_read_only_their_columns(spark, capsys):
    text = plan(queries.user_spend(spark, SF_DIR), capsys)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in text
    assert "Join" not in text
    tree = plan(queries.product_usage(spark, SF_DIR), capsys).split("\n\n")[0]
    assert tree.count("Join") == 1


def test_date_slice_prunes_partitions(spark, tmp_path, capsys):
    path = str(tmp_path / "silver")
    write_table(queries._silver(spark, SF_DIR), path)
    table = read_table(spark, path, schemas.SILVER)
    df = marts.user_spend(date_slice(table, dt.date(2024, 1, 15)))
    text = plan(df, capsys)
    assert re.search(r"PartitionFilters: .*event_date#\d+ = 2024-01-15", text)
    assert "ReadSchema: struct<user_id:string,amount:double>" in text


def test_written_table_has_few_files_per_date(spark, tmp_path):
    path = tmp_path / "bronze"
    spread = queries._bronze(spark, SF_DIR).repartition(8, "transaction_id")
    write_table(spread, str(path))
    dates = list(path.glob("event_date=*"))
    assert len(dates) == 30
    assert len(list(path.glob("event_date=*/*.parquet"))) == len(dates)


def test_a_hot_date_is_split_over_files(spark, tmp_path, settings):
    """In a batch write and in the bronze stream, one date with most rows goes to many tasks."""
    settings(spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB")
    hot = model.raw(spark, SF_DIR).withColumn(
        "event_time",
        F.when(F.col("transaction_id").cast("int") % 10 > 0, F.lit(dt.datetime(2024, 1, 15)))
        .otherwise(F.col("event_time")),
    ).repartition(8)
    write_table(to_bronze(hot), str(tmp_path / "batch"))
    hot.select(F.to_json(F.struct(*schemas.RAW.names)).alias("value")).write.text(
        str(tmp_path / "feed"))
    store = Store(str(tmp_path / "store"))
    await_all(start_bronze(spark, str(tmp_path / "feed"), store), 300)
    for table in (tmp_path / "batch", Path(store.table("bronze"))):
        files = {d.name: len(list(d.glob("*.parquet"))) for d in table.glob("event_date=*")}
        assert files.pop("event_date=2024-01-15") >= 4
        assert len(files) == 29 and sum(files.values()) < 2 * 29


def _skewed(spark):
    return spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("user_id"),
        F.lit(dt.date(2024, 1, 1)).alias("event_date"), F.lit(1.0).alias("spent"),
    )


def test_clustering_cuts_through_a_hot_key(spark, tmp_path, settings):
    settings(spark__sql__adaptive__enabled="false")
    source, target = str(tmp_path / "source"), str(tmp_path / "target")
    df = _skewed(spark)
    df.repartition(4).write.partitionBy("event_date").parquet(source)
    cluster_table(spark, source, target, df.schema, "user_id", rows_per_file=3_400)
    copy = spark.read.parquet(target)
    assert copy.columns == ["user_id", "spent", "event_date"]
    assert copy.count() == 20_000 and copy.where("user_id = 'hot'").count() == 6_667
    per_file = copy.groupBy(F.input_file_name().alias("f")).agg(
        F.count("*").alias("n"), F.min("user_id").alias("low"), F.max("user_id").alias("high"))
    files = sorted(per_file.collect(), key=lambda r: (r.low, r.high))
    assert len(files) == 6 and max(r.n for r in files) < 6_667
    assert all(a.high <= b.low for a, b in zip(files, files[1:]))


def test_clustering_refuses_an_existing_target(spark, tmp_path):
    target = str(tmp_path / "t")
    write_clustered(_skewed(spark), target, "user_id", files=2)
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        write_clustered(_skewed(spark), target, "user_id", files=2)


def test_files_are_bounded_by_bytes_too(spark):
    """Rows as wide as these fill a task long before the bound of rows."""
    rows = spark.range(1000).select("id", F.repeat(F.lit("x"), 1000).alias("text"), F.lit(None).cast("string").alias("no"))
    assert file_count(rows) == 1 and file_count(rows, rows_per_file=300) == 4
    assert file_count(rows, bytes_per_file=100 * (1000 + 3 * 8)) == 10
    assert file_count(rows.where("id < 0")) == 1


def test_hashes_are_shuffled_as_bytes(spark, tmp_path):
    """Half of their length; texts that are no lower-case hex digits come out as they went in."""
    texts = ["ab" * 32, "AB" * 32, "abc", "", None, "no hash", "0f", "é"]
    df = spark.createDataFrame([(i, a, texts[-1 - i]) for i, a in enumerate(texts)], "id long, hash_ip string, hash_card_number string") \
        .withColumn("event_date", F.lit("2024-01-01").cast("date"))
    moved = by_date(df)
    assert moved.schema == df.schema and sorted(moved.collect()) == sorted(df.collect())
    plan = moved._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("hex(") < plan.index("RebalancePartitions") < plan.index("unhex(")
    write_clustered(df, str(tmp_path / "out"), "id", 1)
    assert sorted(spark.read.schema(df.schema).parquet(str(tmp_path / "out")).collect()) == sorted(df.collect())


def test_the_feed_is_dealt_before_it_is_widened(spark, tmp_path):
    """The shuffle of a written feed has the narrow rows, and the rows are those of the view."""
    rows = model._dealt(spark, SF_DIR, 3)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("card_number") < plan.index("RepartitionByExpression") and "card_number" not in plan[plan.index("RepartitionByExpression"):]
    assert rows.exceptAll(model.raw(spark, SF_DIR)).isEmpty() and rows.count() == model.raw(spark, SF_DIR).count()
