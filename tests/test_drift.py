"""Drift of a feed, schemas that grow, and files of unlike schemas read as one."""

import json
from collections import Counter

import pytest
from conftest import BASE_ROW
from pyspark.sql import types as T

from riskflow import schemas
from riskflow.operators.drift import ddl, drift, widest
from riskflow.plans.pipeline import run_bronze
from riskflow.streaming import layers
from riskflow.streaming.layers import Pace, Store

DECLARED = "id string, amount double, seen timestamp, n bigint, ok boolean, gone string"


def report(spark, lines):
    df = drift(spark.createDataFrame([(x,) for x in lines], "value string"), T.StructType.fromDDL(DECLARED))
    return Counter(map(tuple, df.collect()))


def test_every_kind_and_status(spark):
    lines = ['{"id":"a","amount":1,"n":1.5,"ok":"yes","extra":[1]}', '{"id":7,"amount":"x","n":3,"ok":true}',
             '{"id":null,"seen":"2024-01-01","seen.at":{"a":1},"extra":2.5}', '{"id":"b","a\'b":1}',
             "[1]", "{cut", "", None, "3", '{"id":1,"id":2}']
    assert report(spark, lines) == Counter({
        ("id", "string", "string", 2, "as declared"): 1, ("id", "integer", "string", 1, "other type"): 1,
        ("id", "null", "string", 1, "as declared"): 1, ("amount", "integer", "double", 1, "as declared"): 1,
        ("amount", "string", "double", 1, "other type"): 1, ("n", "number", "bigint", 1, "other type"): 1,
        ("n", "integer", "bigint", 1, "as declared"): 1, ("ok", "string", "boolean", 1, "other type"): 1,
        ("ok", "boolean", "boolean", 1, "as declared"): 1, ("seen", "string", "timestamp", 1, "as declared"): 1,
        ("extra", "array", None, 1, "new"): 1, ("extra", "number", None, 1, "new"): 1,
        ("seen.at", "object", None, 1, "new"): 1, ("a'b", "object", None, 1, "new"): 1,
        (None, None, None, 6, "no object"): 1, ("gone", None, "string", 0, "missing"): 1,
    })


def test_empty_and_objectless_feeds(spark):
    assert report(spark, []) == Counter()
    assert report(spark, ["[]", "x"]) == Counter({(None, None, None, 2, "no object"): 1})
    assert report(spark, ["{}"]) == Counter()


def test_a_line_is_parsed_once_and_walked_once(spark):
    """No value is looked up by its path, and no line is parsed again for each of its keys."""
    df = drift(spark.createDataFrame([('{"id":"a","more":1}',)], "value string"), T.StructType.fromDDL(DECLARED))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "variant_explode" in plan and "ReusedExchange" in plan
    assert "variant_get" not in plan.lower() and "variantget" not in plan.lower() and "json_object_keys" not in plan


def test_widest_schema(spark):
    def of(text):
        return T.StructType.fromDDL(text)

    assert widest(of("a int, b string"), of("c date, a bigint")) == of("a bigint, b string, c date")
    assert widest(of("a double"), of("a int")) == of("a double")
    assert widest(T.StructType(), of("a int")) == of("a int")
    assert T.StructType.fromDDL(ddl(of("a int, `b c` array<string>"))) == of("a int, `b c` array<string>")
    for old, new in (("a int", "a string"), ("a bigint", "a double"), ("a boolean", "a int")):
        with pytest.raises(ValueError, match="no common type"):
            widest(of(old), of(new))


def line(number, **more):
    return json.dumps({**BASE_ROW, "event_time": "2024-01-02T03:04:05", "transaction_id": f"t{number}", **more})


def test_batches_report_a_new_key_and_a_wider_type(spark, tmp_path):
    feed, store = tmp_path / "feed", Store(str(tmp_path / "store"), str(tmp_path / "private"))
    feed.mkdir()

    def run(name, lines, more=""):
        (feed / name).write_text("\n".join(lines) + "\n")
        run_bronze(spark, str(feed), store, Pace(max_files=1), dq=False, timeout=300, watch_drift=True,
                   more=T.StructType.fromDDL(more) if more else T.StructType())

    def found(batch):
        rows = layers.read_drift(spark, store).where(f"batch_id = {batch} and status != 'as declared'").collect()
        return {(r.column, r.kind, r.status, r.line_count) for r in rows}

    run("a.json", [line(1), line(2)])
    run("b.json", [line(3, channel="app", visits=1), line(4, amount="n/a", visits=2)])
    assert found(0) == set()
    assert found(1) == {("channel", "string", "new", 1), ("visits", "integer", "new", 2),
                        ("amount", "string", "other type", 1)}
    run("c.json", [line(5, channel="web", visits=3)], "channel string, visits int")
    run("d.json", [line(6, visits=2.5), line(7, visits="many")], "visits double")
    assert found(2) == set()
    assert found(3) == {("visits", "string", "other type", 1), ("channel", None, "missing", 0)}
    run("e.json", [line(8, channel="web", visits=4)])  # what was kept once is kept
    rows = {r.transaction_id: (r.channel, r.visits) for r in layers.read_bronze(spark, store).collect()}
    assert rows == {"t1": (None, None), "t2": (None, None), "t3": (None, None), "t5": ("web", 3.0),
                    "t6": (None, 2.5), "t8": ("web", 4.0)}
    quarantine = spark.read.schema(schemas.QUARANTINE).json(store.private("quarantine")).collect()
    assert sorted(json.loads(r.corrupt_record)["transaction_id"] for r in quarantine) == ["t4", "t7"]


def test_names_of_the_tables_are_refused(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    for bad in ("amount string", "country string", "geo_region string", "source_file string"):
        with pytest.raises(ValueError, match="use themselves"):
            layers.keep_more(spark, store, T.StructType.fromDDL(bad))
    with pytest.raises(ValueError, match="no common type"):
        layers.keep_more(spark, store, T.StructType.fromDDL("a int"))
        layers.keep_more(spark, store, T.StructType.fromDDL("a string"))
