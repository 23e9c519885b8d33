"""Places of addresses against a plain search over all ranges."""

import ipaddress
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskflow.operators import geo
from riskflow.operators.geo import (
    RANGES, SEGMENTS, address_number, load_places, network_ends, segments_of, with_places,
)
from riskflow.sources.lookups import BadLookup

RAW = "transaction_id string, ip_address string"


def text(number):
    return str(ipaddress.IPv4Address(number))


def ends(network):
    if "-" in network:
        return tuple(int(ipaddress.IPv4Address(part.strip())) for part in network.split("-"))
    own = ipaddress.ip_network(network, strict=False)
    return int(own[0]), int(own[-1])


def plain(number, ranges):
    """The place of the narrowest range; nulls count as least."""
    inside = [(last - first, first, (c is not None, c or ""), (r is not None, r or ""))
              for (first, last), c, r in ((ends(n), c, r) for n, c, r in ranges) if first <= number <= last]
    if not inside:
        return None, None, True
    _, _, country, region = min(inside)
    return country[1] if country[0] else None, region[1] if region[0] else None, False


def some_ranges(rng, n):
    out = []
    for i in range(n):
        kind, base = rng.random(), rng.choice([0x0A000000, 0x0A00FF00, 0xC0A80000]) + rng.randint(0, 4000)
        if kind < 0.3:
            network = f"{text(base)}/{rng.choice([8, 12, 15, 16, 17, 20, 24, 29, 32])}"
        else:
            last = base + rng.choice([0, 1, rng.randint(0, 300), rng.randint(0, 200_000)])
            network = f"{text(base)}{rng.choice(['-', ' - '])}{text(last)}"
        out.append((network, rng.choice([f"c{i}", f"c{i % 7}", None]), rng.choice([f"r{i % 5}", None])))
    return out + out[:5] + [(out[0][0], "again", "x")]


@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_random_ranges(spark, tmp_path, limit):
    rng = random.Random(limit + 7)
    ranges = some_ranges(rng, 120)
    marks = [e + d for n, _, _ in ranges for e in ends(n) for d in (-1, 0, 1)]
    numbers = marks + [rng.choice([0x0A000000, 0xC0A80000]) + rng.randint(0, 300_000) for _ in range(800)]
    numbers += [0x0A000101] * 900 + [0, 2**32 - 1]  # an address in a third of the rows
    rows = [(f"t{i}", text(n)) for i, n in enumerate(numbers)]
    raw = spark.createDataFrame(rows, RAW)
    places = load_places(spark.createDataFrame(ranges, RANGES), f"{tmp_path}/s", limit, raw)
    assert places.broadcast == (limit > 0)
    assert bool(places.heavy) == (limit == 0)
    got = Counter(map(tuple, with_places(raw, places).collect()))
    assert got == Counter((t, ip, *plain(n, ranges)) for (t, ip), n in zip(rows, numbers))


def test_segments_are_disjoint_and_whole(spark):
    ranges = [("0.0.0.0/0", "all", None), ("10.0.0.0/8", "ten", "a"), ("10.0.0.0-10.1.0.5", "b", "b"),
              ("10.0.255.255-10.1.0.0", "c", "c"), ("255.255.255.255/32", "end", None), ("0.0.0.0/32", "start", None)]
    segments = segments_of(spark.createDataFrame(ranges, RANGES).where("network != '0.0.0.0/0'"))
    rows = sorted((r.first, r.last, r.bucket) for r in segments.collect())
    assert all(a[1] < b[0] for a, b in zip(rows, rows[1:]))
    assert all(first >> 16 == last >> 16 == bucket for first, last, bucket in rows)
    total = sum(last - first + 1 for first, last, _ in rows)
    assert total == 2**24 + 2
    whole = segments_of(spark.createDataFrame([r for r in ranges if r[0] != "10.0.0.0/8"], RANGES))
    assert whole.agg(F.sum(F.col("last") - F.col("first") + 1)).first()[0] == 2**32


@pytest.mark.parametrize("ip, number", [
    ("0.0.0.0", 0), ("255.255.255.255", 2**32 - 1), ("10.0.0.1", 0x0A000001), ("010.0.0.1", 0x0A000001),
    ("256.0.0.1", None), ("1.2.3", None), ("1.2.3.4.5", None), ("1.2.3.4\n", None), (" 1.2.3.4", None),
    ("", None), (None, None), ("::1", None), ("a.b.c.d", None), ("1.2.3.٤", None), ("9999999999.1.1.1", None),
])
def test_address_number(spark, ip, number):
    df = spark.createDataFrame([(ip,)], "ip string")
    assert df.select(address_number(F.col("ip"))).first()[0] == number


@pytest.mark.parametrize("network", ["10.0.0.0", "10.0.0.0/33", "10.0.0.0/x", "10.0.0.5-10.0.0.4", "x-10.0.0.1", None, ""])
def test_malformed_ranges_are_refused(spark, network):
    with pytest.raises(BadLookup, match="not a range"):
        segments_of(spark.createDataFrame([(network, "a", "b")], RANGES))


def test_network_ends(spark):
    df = spark.createDataFrame([("10.1.2.3/24",), ("10.1.2.3/0",), ("10.1.2.3/32",)], "n string")
    first, last = network_ends(F.col("n"))
    assert [tuple(r) for r in df.select(first, last).collect()] == [ends(f"10.1.2.3/{b}") for b in (24, 0, 32)]


def test_no_ranges(spark, tmp_path):
    with pytest.raises(BadLookup, match="no ranges"):
        load_places(spark.createDataFrame([], RANGES), f"{tmp_path}/s")


def test_plans_have_no_nested_loops(spark, tmp_path, settings):
    settings(spark__sql__autoBroadcastJoinThreshold="-1")
    ranges = spark.createDataFrame([("10.0.0.0/8", "a", "b")], RANGES)
    raw = spark.createDataFrame([("t", "10.0.0.1")], RAW)
    for i, limit in enumerate((1 << 26, 0)):
        df = with_places(raw, load_places(ranges, f"{tmp_path}/{i}", limit, raw))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        assert ("BroadcastHashJoin" in plan) == (limit > 0)


def test_a_frequent_bucket_is_spread(spark, tmp_path, settings):
    """All rows have one address; its segments meet them in many tasks."""
    settings(spark__sql__shuffle__partitions="16", spark__sql__adaptive__enabled="false",
             spark__sql__autoBroadcastJoinThreshold="-1")
    raw = spark.range(8000).select(F.col("id").cast("string").alias("transaction_id"),
                                   F.when(F.col("id") % 4 != 0, "10.0.0.1").alias("ip_address"))
    ranges = spark.createDataFrame([("10.0.0.0/8", "a", "b"), ("10.0.0.0/31", "c", "d")], RANGES)
    df = with_places(raw, load_places(ranges, f"{tmp_path}/s", 0, raw))
    rows = df.select(F.spark_partition_id().alias("task"), "geo_country").groupBy("task").agg(
        F.count("*").alias("n"), F.count_if(F.col("geo_country") == "c").alias("c")).collect()
    assert sum(r.c for r in rows) == 6000
    assert len(rows) >= 12 and max(r.n for r in rows) < 2000
    assert geo.SALTS >= 16 and SEGMENTS.startswith("bucket")
