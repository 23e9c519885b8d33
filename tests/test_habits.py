"""Visits, churn and join metrics against plain loops."""

import datetime as dt
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskflow import schemas
from riskflow.operators import joins
from riskflow.operators.habits import ChurnRule, churn, visits

FEED = "transaction_id string, user_id string, event_time timestamp, event_date date"
START = dt.datetime(2024, 1, 1, 12)


def feed(n=1200, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", None])
        time = None if rng.random() < 0.03 else START + dt.timedelta(minutes=10 * rng.randint(0, 3000))
        rows.append((f"t{i}", user, time, time.date() if time else None))
    return rows + [("once", "one-day", START, START.date())]


def timelines(rows):
    own = defaultdict(list)
    for _, user, time, _ in rows:
        if user is not None and time is not None:
            own[user].append(time)
    return {user: sorted(times) for user, times in own.items()}


def plain_visits(times, gap):
    runs = []
    for time in times:
        if runs and (time - runs[-1][-1]).total_seconds() < gap:
            runs[-1].append(time)
        else:
            runs.append([time])
    return runs


@pytest.mark.parametrize("stretch", [600, 7200, 10**8])
def test_visits_of_a_random_feed(spark, stretch):
    rows, gap = feed(), 1800
    found = Counter(map(tuple, visits(spark.createDataFrame(rows, FEED), gap, stretch).collect()))
    assert found == Counter((user, run[0], run[-1], len(run))
                            for user, times in timelines(rows).items() for run in plain_visits(times, gap))


def test_a_gap_itself_divides_visits(spark):
    rows = [("t0", "u", START, None), ("t1", "u", START + dt.timedelta(seconds=1800), None),
            ("t2", "u", START + dt.timedelta(seconds=3599), None)]
    found = sorted(map(tuple, visits(spark.createDataFrame(rows, FEED), 1800).collect()))
    assert [r[3] for r in found] == [1, 2]
    assert visits(spark.createDataFrame([], FEED)).collect() == []


def test_churn_of_a_random_feed(spark):
    rows = feed(seed=4)
    found = {r.user_id: r for r in churn(spark.createDataFrame(rows, FEED), ChurnRule(gone_days=3)).collect()}
    own = timelines(rows)
    today = max(times[-1] for times in own.values()).date()
    assert set(found) == set(own)
    for user, times in own.items():
        counts = Counter(t.date() for t in times)
        days = sorted(counts)
        best = run = 1
        for a, b in zip(days, days[1:]):
            run = run + 1 if (b - a).days == 1 else 1
            best = max(best, run)
        runs = plain_visits(times, 1800)
        r = found[user]
        assert (r.first_day, r.last_day, r.active_days, r.longest_streak) == (days[0], days[-1], len(days), best)
        assert (r.visits, round(r.mean_visit, 9)) == (len(runs), round(len(times) / len(runs), 9))
        assert (r.days_away, r.is_gone) == ((today - days[-1]).days, (today - days[-1]).days > 3)
        assert abs(r.retention - len(days) / ((today - days[0]).days + 1)) < 1e-12
        if len(days) == 1:
            assert r.trend is None
        else:
            slope = np.polyfit([(d - days[0]).days for d in days], [counts[d] for d in days], 1)[0]
            assert abs(r.trend - slope) < 1e-9
    assert found["one-day"].is_gone and found["one-day"].trend is None
    assert churn(spark.createDataFrame([], FEED)).collect() == []


def silver(spark, rows):
    lacking = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.SILVER if f.name not in joins.INPUT]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.SILVER if f.name in joins.INPUT)
    names = [f.name for f in schemas.SILVER if f.name in joins.INPUT]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema).select("*", *lacking)


def row(i, miss):
    return {"user_id": None if i % 10 == 0 else f"u{i}", "product_id": "p", "subscription_type": f"s{i % 3}", "hash_ip": f"h{i}",
            "missing_user": miss, "missing_product": False, "missing_subscription": i % 3 == 0, "missing_ip": True}


def test_join_metrics_add_up(spark):
    batches = [[row(i, i % 2 == 0) for i in range(start, start + 4000)] for start in (0, 2000, 6000)]
    parts = [joins.join_metrics(silver(spark, rows)) for rows in batches]
    merged = {r.lookup: r for r in joins.merged_metrics(parts[0].unionByName(parts[1]).unionByName(parts[2])).collect()}
    everything = [r for rows in batches for r in rows]
    users = merged["users"]
    assert (users.row_count, users.missing_rows, users.null_keys) == (12_000, 6000, 1200)
    assert users.hit_share == 0.5
    exact = len({r["user_id"] for r in everything if r["missing_user"] and r["user_id"]})
    assert exact == 4000 and abs(users.missing_keys - exact) <= 4 * joins.SKETCH_ERROR * exact
    assert (merged["products"].missing_rows, merged["products"].missing_keys, merged["products"].hit_share) == (0, 0, 1.0)
    assert merged["plans"].missing_keys == 1
    assert abs(merged["ip_risk"].missing_keys - 10_000) <= 4 * joins.SKETCH_ERROR * 10_000
    assert joins.join_metrics(silver(spark, [])).collect() == []
