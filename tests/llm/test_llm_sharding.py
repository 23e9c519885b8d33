"""Sharding against a group-by-group packing, and the rules of its result."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from edge_rows import documents
from pyspark.sql import functions as F

from riskflow.llm import sharding
from riskflow.llm.queries import LLM_QUERIES
from riskflow.llm.sharding import Rooms, best_fit, nearly_equal, sharded, write_shards

SF_DIR = "/root/testdata/sf0.001"


def plain_best_fit(sizes, capacity):
    """One group after another into the fullest bin with room; the bins' loads."""
    loads = []
    for size in sorted(sizes, reverse=True):
        fitting = [(capacity - load, i) for i, load in enumerate(loads) if load + size <= capacity]
        if fitting:
            loads[min(fitting)[1]] += size
        else:
            loads.append(size)
    return loads


def loads_of(plan, shards):
    loads = [0] * shards
    for size, start, stop, shard in plan:
        loads[shard] += size * (stop - start)
    return loads


def test_the_tree_finds_the_tightest_room_and_stays_level():
    rng, rooms, keys = random.Random(1), Rooms(), set()
    for step in range(3000):
        if keys and rng.random() < 0.4:
            key = rng.choice(sorted(keys))
            rooms.remove(key)
            keys.remove(key)
        else:
            key = (rng.randint(0, 300) if step < 2000 else step, step)
            rooms.add(key)
            keys.add(key)
        size = rng.randint(0, 320)
        assert rooms.tightest(size) == min((k for k in keys if k[0] >= size), default=None)
        assert rooms.count == len(keys)

    def height(node):
        if node is None:
            return 0
        left, right = height(node.left), height(node.right)
        assert abs(left - right) < 2
        return 1 + max(left, right)

    height(rooms.root)


def test_best_fit_of_sizes_is_that_of_single_groups():
    rng = random.Random(2)
    for _ in range(300):
        sizes = [rng.randint(1, 60) for _ in range(rng.randint(1, 80))]
        counts, capacity = Counter(sizes), rng.randint(60, 200)
        falling = sorted(counts, reverse=True)
        found = best_fit(falling, [counts[s] for s in falling], capacity)
        loads = loads_of(found.plan, found.shards)
        assert sorted(loads) == sorted(plain_best_fit(sizes, capacity))
        assert max(loads) <= capacity
        for size in falling:  # each group once
            ranks = sorted(r for s, a, b, _ in found.plan if s == size for r in range(a, b))
            assert ranks == list(range(counts[size]))
        assert best_fit(falling, [counts[s] for s in falling], capacity, found.shards - 1) is None
    assert best_fit([10], [1], 9) is None


def test_equal_shards():
    rng = random.Random(3)
    for _ in range(200):
        shards = rng.randint(1, 16)
        counts = Counter(rng.randint(1, 400) for _ in range(rng.randint(200, 900)))
        falling = sorted(counts, reverse=True)
        plan = nearly_equal(np.array(falling), np.array([counts[s] for s in falling]), shards)
        loads, mean = loads_of(plan, shards), sum(s * n for s, n in counts.items()) / shards
        assert max(loads) - min(loads) <= max(0.02 * mean, falling[0]), loads


def test_a_group_over_its_share_has_a_shard_and_the_rest_is_equal():
    sizes, counts = np.array([1_000_000, 400_000, 30, 20, 7]), np.array([1, 2, 5000, 3000, 900])
    loads = loads_of(nearly_equal(sizes, counts, 16), 16)
    assert sorted(loads)[-3:] == [400_000, 400_000, 1_000_000]
    rest = sorted(loads)[:-3]
    assert max(rest) - min(rest) <= 30
    few = loads_of(nearly_equal(np.array([9, 5]), np.array([1, 1]), 4), 4)
    assert sorted(few) == [0, 0, 5, 9]


def check_rules(docs, rows, shards):
    """What holds of any result; returns the loads."""
    size = {t: len((t or "").encode()) + 1 for _, t in docs}
    want = Counter((i, size[t], zlib.crc32((t or "").encode())) for i, t in docs)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    home = defaultdict(set)
    for r in rows:
        home[r.text_key].add(r.shard)
    assert all(len(s) == 1 for s in home.values())
    assert len(home) == len({t or "" for _, t in docs})
    slots = defaultdict(list)
    loads = [0] * shards
    for r in rows:
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        loads[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return loads


def test_documents_with_a_hot_text_and_a_hot_id(spark, settings):
    settings(spark__sql__shuffle__partitions="7")
    rng = random.Random(4)
    docs = [(i, "x" * rng.randint(0, 300) + str(rng.randint(0, 800))) for i in range(3000)]
    docs += [(rng.randint(0, 10**6), "a copy of one text") for _ in range(1500)]
    docs += [(77, f"one id, text {i}") for i in range(1500)] + [(78, "same row")] * 900 + [(None, None)] * 40
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(9)
    loads = check_rules(docs, sharded(df, 16).collect(), 16)
    assert max(loads) - min(loads) < 20  # small groups fill all gaps
    assert max(loads) >= 19 * 1500


def test_ranks_of_hot_groups_over_many_partitions(spark, settings):
    settings(spark__sql__shuffle__partitions="11")
    df = spark.range(5000).select((F.col("id") % 3 == 0).cast("int").alias("size"), F.col("id").alias("key"))
    rows = sharding.numbered(df, "size", ["key"], "ranks").collect()
    for size in (0, 1):
        own = sorted((r.key, r["rank"]) for r in rows if r["size"] == size)
        assert [rank for _, rank in own] == list(range(len(own)))


def test_plan_joins_without_broadcast(spark, monkeypatch):
    docs = [(i, "y" * (i % 40)) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = sorted(sharded(df, 5).drop("text_key").collect())
    monkeypatch.setattr(sharding, "MAX_BROADCAST_ROWS", 0)
    monkeypatch.setattr(sharding, "HEAVY_SHARE", 2)
    assert sorted(sharded(df, 5).drop("text_key").collect()) == want


def test_edge_rows_names_and_empty_tables(spark):
    docs = documents(spark)
    check_rules([(r.doc_id, r.text) for r in docs.collect()], sharded(docs, 3).collect(), 3)
    assert sharded(docs.where("false"), 16).collect() == []
    one = sharded(docs.limit(1), 16).collect()
    assert [(r.shard, r.slot) for r in one] == [(0, 0)]
    with pytest.raises(ValueError):
        sharded(docs, 0)


def test_written_shards_hold_whole_documents(spark, tmp_path):
    docs = documents(spark)
    write_shards(docs, f"{tmp_path}/out", 4)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert Counter(map(tuple, back.select(*docs.columns).collect())) == Counter(map(tuple, docs.collect()))
    by_shard = {(r.doc_id, r.n_chars): r.shard for r in back.collect()}
    plan = sharded(docs, 4).select("doc_id", "shard").collect()
    assert all(by_shard[k] == s for k in by_shard for d, s in plan if d == k[0] and d not in (None, 1))


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    df = LLM_QUERIES["op12_sharding"](spark, SF_DIR)
    rows = df.withColumn("text_key", F.col("text_crc32")).collect()  # no two texts share it here
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}
    loads = check_rules(docs, rows, 16)
    counts = Counter()
    for _, text in docs:
        counts[text or ""] += len((text or "").encode()) + 1
    groups = sorted(counts.values(), reverse=True)
    assert sorted(loads) == sorted(loads_of(nearly_equal(
        np.array(sorted(set(groups), reverse=True)),
        np.array([groups.count(s) for s in sorted(set(groups), reverse=True)]), 16), 16))
    capacity = max(loads)  # no smaller one will do, unless a single group is that large
    assert len(plain_best_fit(groups, capacity)) <= 16
    assert capacity == groups[0] or len(plain_best_fit(groups, capacity - 1)) > 16
