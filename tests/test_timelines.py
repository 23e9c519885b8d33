"""Velocity and device changes against plain loops, in batches and in streams."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskflow import schemas
from riskflow.operators.timelines import VelocityRule, device_changes, velocity
from riskflow.plans.pipeline import run_timelines
from riskflow.sources.tables import read_table, write_table
from riskflow.streaming import layers, timelines
from riskflow.streaming.layers import Store
from riskflow.streaming.sinks import await_all, start_table_sink
from riskflow.streaming.timelines import (
    STRETCH_PARTS, USER_PARTS, VELOCITY_STATE, stream_device_changes, stream_velocity,
)

FEED = "transaction_id string, user_id string, event_time timestamp, amount double, device_id string"
RULE = VelocityRule(window_seconds=600, limit=4, stretch_seconds=900)
START = dt.datetime(2024, 1, 1)


def feed(n, seed=1, hours=6.0):
    """A hot user, users without a name, equal times, microseconds, missing devices and amounts."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None])
        seconds = rng.choice([rng.uniform(0, hours * 3600), 60 * rng.randint(0, int(hours * 60))])
        time = None if rng.random() < 0.03 else START + dt.timedelta(microseconds=round(seconds * 1e6))
        rows.append((f"t{i:05d}", user, time, rng.choice([None, 1.25, -0.5, 100.1]), rng.choice(["x", "y", "z", None])))
    return rows


def plain_velocity(rows, rule=RULE):
    by_user = defaultdict(list)
    for row in rows:
        if row[1] is not None and row[2] is not None:
            by_user[row[1]].append(row)
    out = Counter()
    for row in rows:
        if row[1] is None or row[2] is None:
            out[row[0], None, None, None] += 1
            continue
        inside = [r for r in by_user[row[1]]
                  if row[2] - dt.timedelta(seconds=rule.window_seconds) <= r[2] <= row[2]]
        out[row[0], len(inside), round(sum(r[3] or 0 for r in inside), 4),
            min(100.0, round(100 * len(inside) / rule.limit, 6))] += 1
    return out


def plain_devices(rows):
    by_user = defaultdict(list)
    out = Counter()
    for row in rows:
        if row[1] is None or row[2] is None:
            out[row[0], None, None, None] += 1
        else:
            by_user[row[1]].append(row)
    for own in by_user.values():
        last, seen = None, {}
        for row in sorted(own, key=lambda r: (r[2], r[0])):
            device, place = row[4], (row[2], row[0])
            new = device is not None and seen.setdefault(device, place) == place
            out[row[0], last, device is not None and last is not None and device != last, new] += 1
            last = device if device is not None else last
    return out


def measured(df):
    return Counter((r.transaction_id, r.velocity_count, r.velocity_amount, r.velocity_score) for r in df.collect())


def changes(df):
    return Counter((r.transaction_id, r.previous_device, r.device_changed, r.device_is_new) for r in df.collect())


@pytest.mark.parametrize("stretch", [600, 900, 86_400])
def test_velocity_of_a_random_feed(spark, stretch):
    rows = feed(1500)
    rule = VelocityRule(600, 4, stretch)
    found = velocity(spark.createDataFrame(rows, FEED), rule)
    assert measured(found) == plain_velocity(rows, rule)
    assert found.columns[:5] == [c.split()[0] for c in FEED.split(", ")]


def test_velocity_ends_are_inside_and_times_may_be_old(spark):
    second = dt.timedelta(seconds=1)
    old = dt.datetime(1969, 12, 31, 23, 50)
    rows = [("t0", "u", old, 1.0, None), ("t1", "u", old + 600 * second, 2.0, None),
            ("t2", "u", old + 600 * second + dt.timedelta(microseconds=1), 4.0, None)]
    assert measured(velocity(spark.createDataFrame(rows, FEED), RULE)) == plain_velocity(rows)
    assert plain_velocity(rows)["t1", 2, 3.0, 50.0] == 1
    assert velocity(spark.createDataFrame([], FEED), RULE).collect() == []


def test_rules_that_make_no_sense():
    for bad in ({"window_seconds": 0}, {"limit": 0}, {"window_seconds": 60, "stretch_seconds": 59}):
        with pytest.raises(ValueError):
            VelocityRule(**bad)


@pytest.mark.parametrize("stretch", [300, 3600, 10**7])
def test_device_changes_of_a_random_feed(spark, stretch):
    rows = feed(1500, seed=2)
    found = device_changes(spark.createDataFrame(rows, FEED), stretch)
    assert changes(found) == plain_devices(rows)


def test_device_changes_across_empty_stretches_and_repeats(spark):
    day = dt.timedelta(days=1)
    rows = [("t0", "u", START, 1.0, "x"), ("t1", "u", START + 9 * day, 1.0, None),
            ("t2", "u", START + 20 * day, 1.0, "y"), ("t2", "u", START + 20 * day, 1.0, "y"),
            ("t3", "u", START + 20 * day, 1.0, "x"), ("t4", None, START, 1.0, "x")]
    found = changes(device_changes(spark.createDataFrame(rows, FEED), 3600))
    assert found["t0", None, False, True] == 1
    assert found["t1", "x", False, False] == 1
    # Rows that agree in all places are both first; which of them changes is open, one does.
    assert found["t2", "x", True, True] == 1 and found["t2", "y", False, True] == 1
    assert found["t3", "y", True, False] == 1 and found["t4", None, None, None] == 1
    assert device_changes(spark.createDataFrame([], FEED)).collect() == []


def test_a_hot_user_is_spread_over_tasks(spark, settings):
    """One user has all rows; no task of the running sum has many of them."""
    settings(spark__sql__shuffle__partitions="16", spark__sql__adaptive__enabled="false")
    df = spark.range(20_000).select(
        F.col("id").cast("string").alias("transaction_id"), F.lit("hot").alias("user_id"),
        F.timestamp_seconds(F.col("id") * 60).alias("event_time"), F.lit(1.0).alias("amount"),
        F.concat(F.lit("d"), F.col("id") % 50).alias("device_id"))
    for found, name in ((velocity(df, RULE), "velocity_count"), (device_changes(df, 6000), "device_is_new")):
        measured = found.select(F.spark_partition_id().alias("task"), F.col(name).cast("long").alias("value"))
        rows = measured.groupBy("task").agg(F.count("value").alias("n"), F.sum("value")).collect()
        sizes = [r["n"] for r in rows]
        assert len(sizes) >= 12 and max(sizes) < 20_000 / 4


class Timeline:
    """A stream over a folder to which rows are added."""

    def __init__(self, spark, root, name, transform):
        self.spark, self.root, self.name, self.transform = spark, root, name, transform

    def add(self, rows):
        self.spark.createDataFrame(rows, FEED).coalesce(1).write.mode("append").parquet(f"{self.root}/in")
        source = self.spark.readStream.schema(FEED).parquet(f"{self.root}/in")
        query = start_table_sink(self.transform(source), f"{self.root}/out", f"{self.root}/cp", self.name)
        await_all([query], 300)
        self.dropped = sum(o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators)
        return self.spark.read.parquet(f"{self.root}/out")


def passed(rows, minutes):
    known = [r for r in rows if r[1] is not None and r[2] is not None]
    last = max(r[2] for r in known) - dt.timedelta(minutes=minutes)
    last = last.replace(microsecond=last.microsecond // 1000 * 1000)
    return {r[0] for r in known if r[2] <= last}


@pytest.mark.parametrize("name", ["velocity", "devices"])
def test_streams_agree_with_batches_over_restarts(spark, settings, tmp_path, name):
    """Each run is a new query that goes on with the state of the one before; rows come up to an
    hour late, across the borders of stretches."""
    settings(spark__sql__shuffle__partitions="3")
    rows = sorted(feed(700, seed=5), key=lambda r: (r[2] or START))
    rng = random.Random(6)
    rows.sort(key=lambda r: (r[2] or START) + dt.timedelta(minutes=rng.uniform(0, 55)))
    timeline, plain, got = {
        "velocity": (lambda df: stream_velocity(df, RULE, "1 hour"), plain_velocity, measured),
        "devices": (lambda df: stream_device_changes(df, "1 hour"), plain_devices, changes),
    }[name]
    stream, sent = Timeline(spark, tmp_path, name, timeline), []
    for at in range(0, 700, 175):
        sent += rows[at:at + 175]
        found = got(stream.add(rows[at:at + 175]))
        ready = passed(sent, 60)
        assert stream.dropped == 0
        # Final rows never change: what is written equals the measure over the whole feed.
        assert found == Counter({k: n for k, n in plain(rows).items() if k[0] in ready})


def test_rows_behind_the_watermark_are_dropped_and_counted(spark, settings, tmp_path):
    settings(spark__sql__shuffle__partitions="2")
    stream = Timeline(spark, tmp_path, "late", lambda df: stream_velocity(df, RULE, "10 minutes"))
    minute = dt.timedelta(minutes=1)
    stream.add([("t0", "u", START, 1.0, None), ("t1", "u", START + 60 * minute, 1.0, None)])
    found = stream.add([("t2", "u", START + 49 * minute, 1.0, None), ("t3", "u", START + 55 * minute, 1.0, None),
                        ("t4", "u", START + 120 * minute, 1.0, None)])
    assert stream.dropped >= 1
    assert {r.transaction_id: r.velocity_count for r in found.collect()} == {"t0": 1, "t3": 1, "t1": 2}


def test_state_of_a_past_stretch_is_removed(spark, settings, tmp_path):
    settings(spark__sql__shuffle__partitions="2")
    stream = Timeline(spark, tmp_path, "state", lambda df: stream_velocity(df, RULE, "1 minute"))
    for hour in range(3):
        stream.add([(f"t{hour}-{i}", "u", START + dt.timedelta(hours=hour, minutes=i), 1.0, None) for i in range(30)])
    state = spark.read.format("statestore").option("stateVarName", "rows").load(f"{tmp_path}/cp")
    assert {r.key.stretch for r in state.collect()} <= {int((START + dt.timedelta(hours=2, minutes=m) - dt.datetime(1970, 1, 1))
                                                           .total_seconds() // RULE.stretch_seconds) for m in (0, 15, 30)}


@pytest.mark.parametrize("name, keys", [("velocity", 3 * STRETCH_PARTS), ("devices", USER_PARTS)])
def test_users_share_state_keys(spark, settings, tmp_path, name, keys):
    """Each key costs calls of its own, so their number must not follow that of the users."""
    settings(spark__sql__shuffle__partitions="2")
    stream = Timeline(spark, tmp_path, name, {
        "velocity": lambda df: stream_velocity(df, RULE, "1 hour"),
        "devices": lambda df: stream_device_changes(df, "1 hour")}[name])
    rows = [(f"t{i}", f"u{i}", START + dt.timedelta(seconds=i % 60), 1.0, "x") for i in range(3 * USER_PARTS)]
    stream.add([*rows, ("last", "u0", START + dt.timedelta(seconds=3630), 1.0, "x")])  # half of them wait
    state = spark.read.format("statestore").option("stateVarName", "rows").load(f"{tmp_path}/cp")
    assert 0 < state.select("key").distinct().count() <= keys


def test_times_of_many_users_do_not_overflow(monkeypatch):
    """Users are worked on in blocks whose numbers fit; blocks of one give the same."""
    rng = random.Random(8)
    rows = pa.Table.from_pylist([
        {"user_id": f"u{rng.randrange(9)}", "at": rng.randrange(-40, 40), "units": rng.randrange(5),
         "own": rng.random() < 0.8, "transaction_id": f"t{i}"} for i in range(300)], VELOCITY_STATE)
    whole = timelines._measured(rows, 7).to_pylist()
    plain = [(r["transaction_id"], [x["units"] for x in rows.to_pylist() if x["user_id"] == r["user_id"]
                                    and r["at"] - 7 <= x["at"] <= r["at"]]) for r in rows.to_pylist() if r["own"]]
    assert {r["transaction_id"]: (r["velocity_count"], r["units"]) for r in whole} == {
        t: (len(found), sum(found)) for t, found in plain}
    monkeypatch.setattr(timelines, "WIDEST", 1)
    assert timelines._measured(rows, 7).to_pylist() == whole


def test_job_over_the_bronze_table(spark, settings, tmp_path):
    settings(spark__sql__shuffle__partitions="2")
    store = Store(str(tmp_path / "store"))
    run_timelines(spark, store, timeout=300)  # nothing there yet
    rows = [("t0", "u", START, 1.0, "x"), ("t1", "u", START + dt.timedelta(minutes=5), 1.0, "y"),
            ("t2", "u", START + dt.timedelta(hours=3), 1.0, "y")]
    bronze = spark.createDataFrame(rows, FEED).withColumn("event_date", F.to_date("event_time"))
    lacking = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.BRONZE if f.name not in bronze.columns]
    write_table(bronze.select("*", *lacking).select(*schemas.BRONZE.names), store.table("bronze"))
    run_timelines(spark, store, timeout=300)
    found = read_table(spark, store.table("velocity"), schemas.VELOCITY)
    assert measured(found) == Counter({("t0", 1, 1.0, 20.0): 1, ("t1", 2, 2.0, 40.0): 1})
    devices = read_table(spark, store.table("devices"), schemas.DEVICES)
    assert changes(devices) == Counter({("t0", None, False, True): 1, ("t1", "x", True, True): 1})
    assert {q.name for q in layers.start_velocity(spark, store)} == {"velocity"}
