"""SimHash fingerprints, links and components against brute force."""

import random
import re

import pytest
import xxhash
from edge_rows import ROWS, documents

from riskflow.llm.components import components
from riskflow.llm.queries import LLM_QUERIES
from riskflow.llm.simhash import links, near_duplicates, one_per_group

SF_DIR = "/root/testdata/sf0.001"


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, bits):
    """Least id reachable over fingerprints that differ in at most ``bits`` bits."""
    parent = {i: i for i in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(prints)
    for i in ids:
        for j in ids:
            if j < i and (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_query(spark):
    got = {r["doc_id"]: r for r in LLM_QUERIES["op5_simhash"](spark, SF_DIR).collect()}
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    prints = {r["doc_id"]: plain_print(r["text"]) for r in rows}
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {i: r["component_id"] for i, r in got.items()} == plain_components(prints, 2)


@pytest.mark.parametrize("bits", [0, 2, 4])
def test_links_of_close_fingerprints(spark, bits):
    rng = random.Random(7)
    prints = {}
    for seed in range(6):  # chains of fingerprints a few bits apart
        value = rng.getrandbits(64)
        for step in range(8):
            prints[seed * 8 + step] = value
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 4])):
                value ^= 1 << b
    frame = spark.createDataFrame(
        [(p - (1 << 64) if p >> 63 else p,) for p in set(prints.values())], "fingerprint long")
    found = {r["node"]: r["root"] for r in components(links(frame, bits)).collect()}
    want = plain_components(prints, bits)
    signed = {i: p - (1 << 64) if p >> 63 else p for i, p in prints.items()}
    for i in prints:
        for j in prints:
            same = found.get(signed[i], signed[i]) == found.get(signed[j], signed[j])
            assert same == (want[i] == want[j])


def test_odd_distances_are_refused(spark):
    with pytest.raises(ValueError):
        links(spark.range(1).withColumnRenamed("id", "fingerprint"), 3)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)]
    edges = spark.createDataFrame(chain + star + [(7, 7)], "u long, v long")
    found = {r["node"]: r["root"] for r in components(edges).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert components(edges.limit(0)).isEmpty()


def test_edge_rows(spark):
    found = near_duplicates(documents(spark)).collect()
    assert len(found) == len(ROWS)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[2]["fingerprint"] == by_id[3]["fingerprint"] == by_id[4]["fingerprint"] == 0
    assert {by_id[i]["component_id"] for i in (2, 3, 4)} == {2}
    assert by_id[8]["component_id"] == by_id[9]["component_id"] == 8
    assert by_id[None]["component_id"] is None
    assert near_duplicates(documents(spark, [])).isEmpty()


def test_one_row_of_each_group_stays(spark):
    docs = documents(spark)
    kept = one_per_group(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda i: (i is None, i))
    assert ids == [1, 2, 5, 6, 7, 8, 10, None]
    assert one_per_group(documents(spark, [])).isEmpty()


A = "the river runs past the old mill and on to the sea"
B = "seven grey lamps were lit above the harbour at night"
C = "no one had counted the apples in the cellar this year"


@pytest.mark.parametrize("rows, want", [
    # texts without an id, one of them twice
    ([(None, A), (None, B), (None, B), (4, C)], [(None, A), (None, B), (4, C)]),
    # a copy without an id beside a text that only a row without an id has
    ([(1, A), (None, A), (None, B), (None, C)], [(1, A), (None, B), (None, C)]),
    # one id with two texts, the first a copy of another document's
    ([(3, A), (7, A), (7, B), (7, B)], [(3, A), (7, B)]),
    ([(7, A), (7, B), (8, B), (None, None), (9, "")], [(7, A), (7, B), (9, "")]),
])
def test_null_and_repeated_ids_lose_no_group(spark, rows, want):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(map(str, map(tuple, one_per_group(docs).collect())))
    assert found == sorted(map(str, want))


def test_a_third_of_rows_without_an_id_stays(spark):
    docs = spark.range(300).selectExpr(
        "if(id % 3 = 0, null, id) as doc_id", "sha2(string(id), 512) as text")
    assert one_per_group(docs).count() == 300
    twice = docs.union(docs)
    assert one_per_group(twice).count() == 300


def test_one_of_several_texts_with_the_smallest_id_stays(spark):
    docs = spark.createDataFrame([(7, A), (7, A.upper()), (8, A)], "doc_id long, text string")
    rows = one_per_group(docs).collect()
    assert len(rows) == 1 and rows[0].doc_id == 7
