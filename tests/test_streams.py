"""Streams against the batch transforms, reruns, late files, replayed batches."""

import contextlib
import datetime as dt
import json
import os
import shutil
import threading
import time
from collections import Counter
from pathlib import Path

import pytest
from conftest import BASE_ROW, LOOKUP_ROWS
from pyspark.sql import functions as F

from riskflow import schemas
from riskflow.operators import marts, quality
from riskflow.operators.bronze import to_bronze
from riskflow.operators.enrich import enrich
from riskflow.plans import pipeline
from riskflow.plans.pipeline import (
    run_bronze, run_compact, run_gold, run_layout, run_silver, start_bronze_layer,
)
from riskflow.sources.feed import good_rows, read_feed
from riskflow.sources.limits import parse_bytes
from riskflow.sources.lookups import SPEC_BY_NAME, check_lookups
from riskflow.sources.tables import date_slice, event_dates, read_table, stream_table
from riskflow.streaming import layers
from riskflow.streaming.layers import Pace, Store
from riskflow.streaming.sinks import (
    await_all, overwrite_batch_table, start_batch_sink, start_table_sink,
)

ONE_FILE = Pace(max_files=1)
THREE_FILES = Pace(max_files=3)


def line(number, **overrides):
    row = {**BASE_ROW, "transaction_id": f"t{number}", **overrides}
    time = row["event_time"]
    return json.dumps({**row, "event_time": time.isoformat() if time else None})


def day(n):
    return dt.datetime(2024, 1, n, 12)


FILES = {
    "a.json": [line(1), line(2, user_id="u2", amount=None, event_time=day(3)),
               line(3, event_time=None), "{broken"],
    "b.json": [line(4, amount=30.0), line(5, user_id=None, subscription_type="gone"),
               line(6, user_id="u2", amount=None, event_time=day(3))],
    "c.json": [line(7, amount=2.0, subscription_type="free"), line(8, event_time=day(3)),
               json.dumps({"transaction_id": "t9", "amount": "n/a"})],
}


class Run:
    def __init__(self, spark, root, lookups):
        self.spark, self.lookups = spark, lookups
        self.feed, self.store = root / "feed", Store(str(root / "store"), str(root / "private"))
        self.feed.mkdir()

    def add(self, name, lines):
        (self.feed / name).write_text("\n".join(lines) + "\n")

    def all(self, **bronze):
        run_bronze(self.spark, str(self.feed), self.store, ONE_FILE, timeout=300, **bronze)
        run_silver(self.spark, self.store, self.lookups, THREE_FILES, timeout=300)
        run_gold(self.spark, self.store, THREE_FILES, timeout=300)

    def tables(self):
        spark, store = self.spark, self.store
        return {
            "bronze": read_table(spark, store.table("bronze"), schemas.BRONZE),
            "silver": read_table(spark, store.table("silver"), schemas.SILVER),
            "risk": read_table(spark, store.table("risk"), schemas.RISK),
            "spend": layers.read_spend(spark, store),
            "usage": layers.read_usage(spark, store),
        }

    def rows(self):
        return {name: Counter(map(_plain, df.collect())) for name, df in self.tables().items()}

    def batch_rows(self):
        bronze = to_bronze(good_rows(read_feed(self.spark, str(self.feed))))
        silver = enrich(bronze, self.lookups)
        want = {
            "bronze": bronze, "silver": silver.select(*schemas.SILVER.names),
            "risk": marts.flag_high_risk(silver).select(*schemas.RISK.names),
            "spend": marts.user_spend(silver), "usage": marts.product_usage(silver),
        }
        return {name: Counter(map(_plain, df.collect())) for name, df in want.items()}

    def forget_last_commit(self, query):
        """Make the query run its last micro-batch again."""
        commits = Path(self.store.checkpoint(query)) / "commits"
        last = max((p for p in commits.iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
        last.rename(commits.parent / f"moved-{last.name}")
        crc = commits / f".{last.name}.crc"
        if crc.exists():
            crc.rename(commits.parent / f"moved-{last.name}.crc")


def _plain(row):
    return tuple(round(v, 9) if isinstance(v, float) else v for v in row)


def new_run(spark, root, lookups):
    run = Run(spark, root, lookups)
    for name, lines in FILES.items():
        run.add(name, lines)
    return run


@pytest.fixture
def run(spark, tmp_path, lookups):
    return new_run(spark, tmp_path, lookups)


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    """A run that tests only read."""
    frames = {
        name: spark.createDataFrame(rows, SPEC_BY_NAME[name].schema)
        for name, rows in LOOKUP_ROWS.items()
    }
    run = new_run(spark, tmp_path_factory.mktemp("finished"), check_lookups(frames))
    run.all()
    return run


def test_stream_equals_batch_and_stays_so(run):
    run.all()
    rows = run.rows()
    assert rows == run.batch_rows()
    assert rows["bronze"].total() == 8
    # t1 and t4 of user u1 came in different files, as did the two rows of u2 without an amount
    spend = {(r[0], str(r[1])): r[2] for r in rows["spend"]}
    assert spend["u1", "2024-01-02"] == 10.0 + 30.0 + 2.0
    assert spend["u2", "2024-01-03"] is None
    assert spend[None, "2024-01-02"] == 10.0
    assert spend["u1", "None"] == 10.0

    run.all()
    assert run.rows() == rows

    run.add("d.json", [line(10, amount=7.0)])
    run.all()
    assert run.rows() == run.batch_rows() != rows

    before = run.rows()
    for query in ("bronze", "bronze_dq", "silver", "silver_dq", "risk", "spend", "usage"):
        run.forget_last_commit(query)
    reports = Counter(layers.read_dq(run.spark, run.store).collect())
    run.all()
    assert run.rows() == before
    assert Counter(layers.read_dq(run.spark, run.store).collect()) == reports


def test_reports_of_batches_add_up(finished):
    reports = layers.read_dq(finished.spark, finished.store)
    for layer, rules, table in (
        ("bronze", quality.bronze_rules(), "bronze"), ("silver", quality.silver_rules(), "silver"),
    ):
        mine = reports.where(f"layer = '{layer}'")
        found = {
            (r[0], r[1]): (r[2], r[3]) for r in mine.groupBy("column", "check")
            .sum("violation_count", "total_rows").collect()
        }
        whole = quality.dq_report(finished.tables()[table], rules, layer, 0).collect()
        assert found == {(r.column, r.check): (r.violation_count, r.total_rows) for r in whole}
    assert reports.where("layer = 'silver'").select("batch_id").distinct().count() > 1


def test_quarantine_and_pii(run):
    run.all(keep_pii=True)
    run.forget_last_commit("pii")
    run.forget_last_commit("quarantine")
    run.all(keep_pii=True)
    lines = run.spark.read.schema(schemas.QUARANTINE).json(run.store.private("quarantine"))
    assert sorted(r.source_file for r in lines.collect()) == ["a.json", "c.json"]
    pii = run.spark.read.schema(schemas.PII).json(run.store.private("pii")).collect()
    assert sorted(r.transaction_id for r in pii) == [f"t{i}" for i in range(1, 9)]
    assert {r.batch_id for r in pii} == {0, 1, 2}


def dated(path, days):
    """Set a file's time some days back."""
    then = path.stat().st_mtime - days * 86_400
    os.utime(path, (then, then))


def test_late_files_are_taken(run):
    """Bronze, quarantine and the clear-text copy, each on a file a month older than the last."""
    run.all(keep_pii=True)
    run.add("late.json", [line(20), line(21), "{cut"])
    dated(run.feed / "late.json", 30)
    counts = run_bronze(run.spark, str(run.feed), run.store, keep_pii=True, dq=False, timeout=300)
    assert counts == {"lines": 3, "corrupt_lines": 1}
    assert run.rows()["bronze"] == run.batch_rows()["bronze"]
    lines = run.spark.read.schema(schemas.QUARANTINE).json(run.store.private("quarantine"))
    assert sorted(r.source_file for r in lines.collect()) == ["a.json", "c.json", "late.json"]
    assert run.spark.read.json(run.store.private("pii")).count() == 10


def test_an_age_limit_can_be_set(run):
    run_bronze(run.spark, str(run.feed), run.store, dq=False, timeout=300)
    run.add("late.json", [line(20)])
    dated(run.feed / "late.json", 30)
    run_bronze(run.spark, str(run.feed), run.store, dq=False, timeout=300, max_file_age="7d")
    assert read_table(run.spark, run.store.table("bronze"), schemas.BRONZE).count() == 8


def test_a_clean_feed_is_parsed_once(spark, tmp_path, lookups):
    run = Run(spark, tmp_path, lookups)
    run.add("a.json", [line(1), line(2)])
    quarantine = Path(run.store.checkpoint("quarantine"))
    assert run_bronze(spark, str(run.feed), run.store, dq=False, timeout=300) == {
        "lines": 2, "corrupt_lines": 0}
    assert not quarantine.exists()
    run.add("b.json", [line(3), "{broken"])
    # Left out of this run, counted all the same, and taken up by the next one.
    assert run_bronze(spark, str(run.feed), run.store, dq=False, keep_corrupt=False, timeout=300) == {
        "lines": 2, "corrupt_lines": 1}
    assert not quarantine.exists()
    assert run_bronze(spark, str(run.feed), run.store, dq=False, timeout=300) == {
        "lines": 0, "corrupt_lines": 0}
    assert spark.read.json(run.store.private("quarantine")).count() == 1
    counts = spark.read.json(run.store.feed_counts()).agg({"lines": "sum", "corrupt_lines": "sum"})
    assert sorted(counts.first()) == [1, 4]


def test_counts_of_more_batches_than_are_remembered(run, settings):
    settings(spark__sql__streaming__numRecentProgressUpdates="2")
    for name in ("d.json", "e.json"):
        run.add(name, [line(70), "{cut"])

    def counts():
        rows = run.spark.read.json(run.store.feed_counts()).collect()
        return sorted((r.batch_id, r.lines) for r in rows), sum(r.corrupt_lines for r in rows)

    assert run_bronze(run.spark, str(run.feed), run.store, ONE_FILE, dq=False, keep_corrupt=False,
                      timeout=300) == {"lines": 14, "corrupt_lines": 4}
    found, corrupt = counts()
    assert ([b for b, _ in found], sum(n for _, n in found), corrupt) == ([0, 1, 2, 3, 4], 14, 4)
    for name in ("f.json", "g.json", "h.json"):
        run.add(name, [line(80)])
    pace = Pace(max_files=1, interval="1 second")
    with pytest.raises(TimeoutError):
        run_bronze(run.spark, str(run.feed), run.store, pace, dq=False, keep_corrupt=False, timeout=12)
    assert sum(n for _, n in counts()[0]) == 17


def test_private_sinks_need_a_restricted_folder(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    for sink in ({"keep_corrupt": True}, {"keep_corrupt": False, "keep_pii": True}):
        with pytest.raises(ValueError, match="restricted"):
            run_bronze(spark, str(tmp_path), store, **sink)
    assert not (tmp_path / "store").exists()


def test_limits():
    assert [parse_bytes(t) for t in ("500g", "1KB", 7, " 2 m ")] == [500 << 30, 1024, 7, 2 << 20]
    for wrong in ("0", "g", "-1", "1.5g", ""):
        with pytest.raises(ValueError):
            parse_bytes(wrong)
    with pytest.raises(ValueError, match="not by both"):
        Pace(max_files=1, max_bytes="1g")


def test_streams_that_shuffle_need_adaptive_execution(run, settings):
    settings(spark__sql__adaptive__streaming__stateless__enabled="false")
    with pytest.raises(ValueError, match="stateless"):
        run_bronze(run.spark, str(run.feed), run.store)


def test_interval_keeps_all_layers_running(run):
    """A file that comes while the queries run shows in the marts and in both reports."""
    spark, store = run.spark, run.store
    pace = Pace(interval="1 second")
    queries = start_bronze_layer(spark, str(run.feed), store, pace)
    queries += layers.start_silver(spark, store, run.lookups, pace)
    queries += layers.start_silver_dq(spark, store, pace) + layers.start_spend(spark, store, pace)

    def reported():
        rows = layers.read_dq(spark, store).where("check = 'range_check'").groupBy("layer") \
            .sum("total_rows").collect()
        return {r[0]: r[1] for r in rows}

    def wait_for(count):
        until = time.monotonic() + 120
        while time.monotonic() < until:
            with contextlib.suppress(Exception):  # a table or report not written yet
                spent = layers.read_spend(spark, store).where("user_id = 'late'").count()
                if spent == count - 8 and reported() == {"bronze": count, "silver": count}:
                    return True
            time.sleep(0.5)
        return False

    try:
        assert wait_for(8)
        run.add("d.json", [line(30, user_id="late")])
        assert wait_for(9)
        assert all(q.isActive for q in queries)
        assert spark.read.json(store.private("quarantine")).count() == 2
    finally:
        for q in queries:
            q.stop()


def test_hot_keys_are_those_of_the_new_files(run, lookup_frames, settings, monkeypatch):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    run.lookups = check_lookups(lookup_frames, broadcast_limit=0)
    for i in range(5):  # many users, none of them frequent among all rows
        run.add(f"old{i}.json", [line(1000 * i + n, user_id=f"x{n}") for n in range(1000, 2000)])
    run.all()
    monkeypatch.setattr(pipeline, "CLOCK_MARGIN", dt.timedelta(0))
    time.sleep(1.1)
    run.add("hot.json", [line(9000 + n, user_id="u2") for n in range(50)])
    run_bronze(run.spark, str(run.feed), run.store, dq=False, timeout=300)
    seen = {}
    start = layers.start_silver
    monkeypatch.setattr(layers, "start_silver", lambda spark, store, lookups, pace:
                        seen.update(lookups) or start(spark, store, lookups, pace))
    run_silver(run.spark, run.store, run.lookups, dq=False, timeout=300)
    assert seen["users"].heavy_keys == ("u2",)
    assert run.rows()["silver"] == run.batch_rows()["silver"]


def test_silver_finds_keys_that_came_after_the_near_ones(run, lookup_frames, settings, monkeypatch):
    """Lookups too large to broadcast: the feed's keys are not shuffled, later ones are joined all the same."""
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    spark, store = run.spark, run.store
    lookups = check_lookups(lookup_frames, broadcast_limit=0)
    run_bronze(spark, str(run.feed), store, ONE_FILE, dq=False, timeout=300)
    seen, started = [], layers.start_silver
    monkeypatch.setattr(layers, "start_silver", lambda spark, store, lookups, pace:
                        seen.append(lookups) or started(spark, store, lookups, pace))
    run_silver(spark, store, lookups, THREE_FILES, dq=False, timeout=300)
    assert len(seen) == 1 and all(lookup.near is not None for lookup in seen[0].values())
    run.add("late.json", [line(70, user_id="u3"), line(71, product_id="p2"), line(72, event_time=day(5))])
    run_bronze(spark, str(run.feed), store, dq=False, timeout=300)
    monkeypatch.setattr(pipeline, "with_near_keys", lambda *_: seen[0])  # as if these files came just after
    run_silver(spark, store, lookups, THREE_FILES, dq=False, timeout=300)
    assert len(seen) == 3 and all(lookup.near is None for lookup in seen[2].values())
    run.lookups = lookups
    found = read_table(spark, store.table("silver"), schemas.SILVER)
    assert Counter(map(_plain, found.collect())) == run.batch_rows()["silver"]


def test_only_changed_dates_are_laid_out_again(run, tmp_path):
    run.all()
    target = tmp_path / "clustered"
    run_layout(run.spark, run.store, str(target))

    def files():
        return {p.relative_to(target): p.stat().st_mtime_ns for p in target.rglob("*.parquet")}

    before = files()
    time.sleep(1.1)
    run.add("d.json", [line(40, event_time=day(3), amount=4.0)])
    run.all()
    run_layout(run.spark, run.store, str(target))
    after = files()
    untouched = [p for p in before if "event_date=2024-01-03" not in str(p)]
    assert untouched and all(after.get(p) == before[p] for p in untouched)
    assert any("event_date=2024-01-03" in str(p) for p in after.keys() - before.keys())
    for name in ("risk", "spend", "usage"):
        df = run.tables()[name]
        copy = read_table(run.spark, str(target / name), df.schema)
        assert Counter(map(_plain, copy.collect())) == run.rows()[name]


def test_a_layout_of_some_dates_is_no_complete_one(run, tmp_path):
    target = tmp_path / "clustered"
    third = F.col("event_date") == F.lit(dt.date(2024, 1, 3))

    def whole():
        for name in ("risk", "spend", "usage"):
            df = run.tables()[name]
            copy = read_table(run.spark, str(target / name), df.schema)
            assert Counter(map(_plain, copy.collect())) == run.rows()[name]

    run.all()
    run_layout(run.spark, run.store, str(target), dates=third)  # the first takes all dates
    whole()
    run.add("d.json", [line(41, amount=4.0), line(42, event_time=day(3))])
    run.all()
    for path in Path(run.store.root).rglob("*.parquet"):  # written by a clock ten minutes slow
        dated(path, 600 / 86_400)
    run_layout(run.spark, run.store, str(target), dates=third)
    run_layout(run.spark, run.store, str(target))
    whole()


def test_compaction_of_closed_dates(run):
    run.all()
    want = run.rows()
    run_compact(run.spark, run.store, dt.date(2024, 1, 3))
    assert run.rows() == want
    partials = layers.partials(run.spark, run.store, "spend").where("event_date = '2024-01-02'")
    assert partials.count() == partials.select("user_id").distinct().count()
    run.add("d.json", [line(50, amount=5.0), line(51, amount=6.0, event_time=day(3))])
    run.all()
    assert run.rows() == run.batch_rows()
    run_compact(run.spark, run.store, dt.date(2024, 1, 4))
    assert run.rows() == run.batch_rows()


def test_alerts_of_the_stored_table(run):
    run.add("e.json", [line(60, amount=0.5), line(61, amount=0.5, ip_address="10.0.0.2")])
    run.all()
    assert [r.transaction_id for r in layers.read_alerts(run.spark, run.store).collect()] == ["t60"]


def test_dates_and_slices(finished):
    silver = finished.tables()["silver"]
    dates = [r.event_date for r in event_dates(silver).collect()]
    assert dates == [None, dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    one = date_slice(silver, dt.date(2024, 1, 3))
    assert sorted(r.transaction_id for r in one.collect()) == ["t2", "t6", "t8"]
    stream = stream_table(finished.spark, finished.store.table("silver"), schemas.SILVER)
    await_all([start_table_sink(
        date_slice(stream, dt.date(2024, 1, 3)), finished.store.table("slice"),
        finished.store.checkpoint("slice"), "slice",
    )], 300)
    assert read_table(finished.spark, finished.store.table("slice"), schemas.SILVER).count() == 3


def test_layout_of_gold(finished, tmp_path):
    target = tmp_path / "clustered"
    run_layout(finished.spark, finished.store, str(target), rows_per_file=3)
    before = finished.rows()
    for name in ("risk", "spend", "usage"):
        df = finished.tables()[name]
        copy = read_table(finished.spark, str(target / name), df.schema)
        assert Counter(map(_plain, copy.collect())) == before[name]


def test_large_lookups_in_streams(run, lookup_frames, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    want = run.batch_rows()
    run.lookups = check_lookups(lookup_frames, broadcast_limit=0)
    run.all()
    assert run.rows() == want
    silver = Path(run.store.table("silver"))
    assert len(list(silver.glob("event_date=2024-01-03/*.parquet"))) <= 3


def test_empty_feed_file(run):
    run.add("e.json", [""])
    run.all(gather_dates=False)
    assert run.rows() == run.batch_rows()


def test_error_in_a_batch_fails_the_query_and_is_retried(run):
    run_bronze(run.spark, str(run.feed), run.store, dq=False, timeout=300)
    seen = []

    def write(batch, batch_id):
        seen.append((batch_id, batch.count()))
        if len(seen) == 1:
            raise RuntimeError("disk full")

    def start():
        bronze = stream_table(run.spark, run.store.table("bronze"), schemas.BRONZE)
        return start_batch_sink(bronze, write, run.store.checkpoint("x"), "x")

    with pytest.raises(Exception, match="disk full"):
        await_all([start()], 300)
    await_all([start()], 300)
    assert seen == [(0, 8), (0, 8)]


def test_time_limit(run):
    query = layers.start_bronze(run.spark, str(run.feed), run.store, Pace(interval="1 hour"))[0]
    with pytest.raises(TimeoutError, match="bronze"):
        await_all([query], 2)
    assert not query.isActive


def test_a_batch_that_commits_during_a_compaction_counts_once(run, monkeypatch):
    """The batch comes after the last one was looked up and before the partials are listed."""
    run.all()
    late = run.spark.createDataFrame([("u1", 11.0, dt.date(2024, 1, 2))], "user_id string, spent_sum double, event_date date")
    usage = run.spark.createDataFrame([("p1", 1.5, 1, dt.date(2024, 1, 2))],
                                      "product_id string, ratio_sum double, ratio_count long, event_date date")

    def spend():
        return {(r.user_id, r.event_date): r.Total_spent_per_user for r in layers.read_spend(run.spark, run.store).collect()}

    def counts():
        return {(r.product_id, r.event_date): r.ratio_count for r in layers.partials(run.spark, run.store, "usage")
                .groupBy("product_id", "event_date").agg(F.sum("ratio_count").alias("ratio_count")).collect()}

    key, product = ("u1", dt.date(2024, 1, 2)), ("p1", dt.date(2024, 1, 2))
    before, counted = spend(), counts()
    listed = layers.partials

    def meanwhile(spark, store, name, until=None):
        if until is not None:
            df = late if name == "spend" else usage
            overwrite_batch_table(df, store.partials(name), until + 1)
        return listed(spark, store, name, until)

    monkeypatch.setattr(layers, "partials", meanwhile)
    run_compact(run.spark, run.store, dt.date(2024, 1, 4))
    monkeypatch.undo()
    for _ in range(2):  # the second compaction folds the late batch
        assert spend() == {**before, key: before[key] + 11.0}
        assert counts() == {**counted, product: counted[product] + 1}
        run_compact(run.spark, run.store, dt.date(2024, 1, 4))
    # Neither an earlier date nor removed partials take a compaction back.
    run_compact(run.spark, run.store, dt.date(2024, 1, 2))
    shutil.rmtree(run.store.partials("spend"))
    run_compact(run.spark, run.store, dt.date(2024, 1, 4))
    assert {k: v for k, v in spend().items() if k[1]} == {k: v for k, v in {**before, key: before[key] + 11.0}.items() if k[1]}


def test_a_batch_without_its_success_mark_is_not_folded(run):
    run.all()
    want = run.rows()
    last = max(Path(run.store.partials("spend")).glob("batch_id=*"), key=lambda p: int(p.name[9:]))
    (last / "_SUCCESS").rename(last / "_moved")
    run_compact(run.spark, run.store, dt.date(2024, 1, 4))
    done = json.loads(next(Path(run.store.state("compacted-spend")).glob("part-*")).read_text())
    assert int(done["batch_id"]) == int(last.name[9:]) - 1
    assert run.rows() == want


def test_layers_start_in_any_order_on_an_empty_store(run, lookup_frames):
    """Gold and silver before bronze, with broadcast and shuffled lookups, all kept running."""
    pace = Pace(max_files=1, interval="1 second")
    want = run.batch_rows()
    jobs = [
        lambda: run_gold(run.spark, run.store, pace, timeout=300),
        lambda: run_silver(run.spark, run.store, check_lookups(lookup_frames, broadcast_limit=0), pace, timeout=300),
        lambda: run_bronze(run.spark, str(run.feed), run.store, pace, timeout=300),
    ]
    errors = []

    def keep(job):
        try:
            job()
        except Exception as error:  # stopped by the test, or told below
            errors.append(error)

    threads = [threading.Thread(target=keep, args=(job,)) for job in jobs]
    for thread in threads:
        thread.start()
        time.sleep(3)
    until = time.monotonic() + 240
    while time.monotonic() < until and not errors:
        with contextlib.suppress(Exception):  # tables that are not there yet
            if run.rows() == want:
                break
        time.sleep(1)
    quarantine = run.spark.read.schema(schemas.QUARANTINE).json(run.store.private("quarantine"))
    while time.monotonic() < until and quarantine.count() < 2:
        time.sleep(1)
    names, failed = {q.name for q in run.spark.streams.active}, list(errors)
    for query in run.spark.streams.active:
        with contextlib.suppress(Exception):  # a batch that is cut off may tell so
            query.stop()
    for thread in threads:
        thread.join(120)
    assert not failed, failed
    assert {"bronze", "silver", "risk", "spend", "usage"} <= names
    assert run.rows() == want
    assert quarantine.count() == 2


def test_a_clean_feed_is_parsed_once_with_an_interval(run):
    for name in FILES:
        (run.feed / name).unlink()
    run.add("z.json", [line(1), line(2)])
    with pytest.raises(TimeoutError):
        run_bronze(run.spark, str(run.feed), run.store, Pace(interval="1 second"), dq=False, timeout=12)
    assert not Path(run.store.private("quarantine")).exists()
    assert not Path(run.store.checkpoint("quarantine")).exists()
    assert read_table(run.spark, run.store.table("bronze"), schemas.BRONZE).count() == 2


def test_layout_takes_the_tables_that_exist(run, tmp_path):
    target = tmp_path / "clustered"
    run_layout(run.spark, run.store, str(target))  # none yet
    assert not target.exists()
    run_bronze(run.spark, str(run.feed), run.store, ONE_FILE, timeout=300)
    run_silver(run.spark, run.store, run.lookups, THREE_FILES, timeout=300)
    run_gold(run.spark, run.store, THREE_FILES, timeout=300, wanted=("usage",))
    run_layout(run.spark, run.store, str(target))
    assert {p.name for p in target.iterdir()} == {"usage"}
    run_gold(run.spark, run.store, THREE_FILES, timeout=300)
    run_layout(run.spark, run.store, str(target))
    for name in ("risk", "spend", "usage"):
        df = run.tables()[name]
        copy = read_table(run.spark, str(target / name), df.schema)
        assert Counter(map(_plain, copy.collect())) == run.rows()[name]
