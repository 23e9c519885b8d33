"""Transactions sent again, sources of rows, and counts of each."""

import datetime as dt
import json
from collections import Counter

import pytest
from conftest import BASE_ROW
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow import schemas
from riskflow.operators.geo import RANGES, load_places
from riskflow.plans.pipeline import run_bronze, run_gold, run_silver
from riskflow.sources.tables import read_table
from riskflow.streaming import layers
from riskflow.streaming.layers import Pace, Store

AUDITED = T.StructType(schemas.BRONZE.fields + schemas.AUDIT.fields)


def line(number, **overrides):
    row = {**BASE_ROW, "transaction_id": None if number is None else f"t{number}", **overrides}
    time = row["event_time"]
    return json.dumps({**row, "event_time": time.isoformat() if time else None})


class Intake:
    def __init__(self, spark, root):
        self.spark, self.feed, self.store = spark, root / "feed", Store(str(root / "store"), str(root / "private"))
        self.feed.mkdir()

    def run(self, name, lines, within="30 days", **options):
        (self.feed / name).write_text("\n".join(lines) + "\n")
        return run_bronze(self.spark, str(self.feed), self.store, Pace(max_files=1), dq=False, timeout=300,
                          audit=True, repeats_within=within, **options)

    def bronze(self):
        return read_table(self.spark, self.store.table("bronze"), AUDITED)

    def ids(self):
        return Counter(r.transaction_id for r in self.bronze().collect())

    def counts(self):
        rows = layers.read_feed_counts(self.spark, self.store).where("lines > 0").orderBy("batch_id").collect()
        return [(r.lines, r.corrupt_lines, r.repeated_lines) for r in rows]


@pytest.fixture
def intake(spark, settings, tmp_path):
    settings(spark__sql__shuffle__partitions="3")
    return Intake(spark, tmp_path)


def test_a_transaction_sent_twice_lands_once_with_both_sources(intake):
    old = dt.datetime(2001, 1, 1)
    intake.run("a.json", [line(1), line(2), line(1), "{broken", line(3, event_time=None)])
    assert intake.ids() == Counter({"t1": 1, "t2": 1, "t3": 1})
    counts = intake.run("b.json", [line(2), line(3, event_time=None), line(4, event_time=old), line(4, event_time=old)])
    assert intake.ids() == Counter({"t1": 1, "t2": 1, "t3": 1, "t4": 1})  # neither age nor a lost time drops one
    assert intake.counts() == [(5, 1, 1), (4, 0, 3)]
    assert counts == {"lines": 4, "corrupt_lines": 0}
    sources = read_table(intake.spark, intake.store.table("sources"), schemas.SOURCES).collect()
    files = Counter((r.transaction_id, r.source_file.rsplit("/", 1)[1]) for r in sources)
    assert files == Counter({("t1", "a.json"): 2, ("t2", "a.json"): 1, ("t3", "a.json"): 1,
                             ("t2", "b.json"): 1, ("t3", "b.json"): 1, ("t4", "b.json"): 2})
    landed = {r.transaction_id: r for r in intake.bronze().collect()}
    assert landed["t2"].source_file.endswith("a.json") and landed["t4"].source_file.endswith("b.json")
    assert all(r.source_modified and r.ingested_at for r in landed.values())


def test_rows_without_an_id_all_land(intake):
    intake.run("a.json", [line(None)] * 3 + [line(1)])
    intake.run("b.json", [line(None)] * 3 + [line(1)])
    assert intake.ids() == Counter({None: 6, "t1": 1})
    assert intake.counts() == [(4, 0, 0), (4, 0, 1)]


def test_ids_are_forgotten_after_the_time(intake):
    intake.run("a.json", [line(1)], within="1 second")
    intake.run("b.json", [line(2)], within="1 second")  # moves the watermark on
    intake.run("c.json", [line(1)], within="1 second")
    assert intake.ids()["t1"] == 2


def test_the_later_layers_take_an_audited_bronze_table(intake, lookups):
    intake.run("a.json", [line(1), line(1), line(2)])
    run_silver(intake.spark, intake.store, lookups, timeout=300)
    run_gold(intake.spark, intake.store, timeout=300, wanted=("spend",))
    assert read_table(intake.spark, intake.store.table("silver"), schemas.SILVER).count() == 2
    assert [r.Total_spent_per_user for r in layers.read_spend(intake.spark, intake.store).collect()] == [20.0]


def test_places_of_a_stream(intake, tmp_path):
    ranges = intake.spark.createDataFrame([("10.0.0.0/24", "a", "b"), ("10.0.0.2/32", "c", None)], RANGES)
    places = load_places(ranges, f"{tmp_path}/segments")
    intake.run("a.json", [line(1), line(2, ip_address="10.0.0.2"), line(3, ip_address="10.0.1.2"), line(4, ip_address=None)],
               places=places)
    df = intake.spark.read.schema(T.StructType(schemas.BRONZE.fields + schemas.GEO.fields)).parquet(intake.store.table("bronze"))
    got = {r.transaction_id: (r.geo_country, r.geo_region, r.missing_geo) for r in df.collect()}
    assert got == {"t1": ("a", "b", False), "t2": ("c", None, False), "t3": (None, None, True), "t4": (None, None, True)}
    assert "10.0.0.2" not in str(df.where(F.col("transaction_id") == "t2").collect())
