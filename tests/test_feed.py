import json

from riskflow import schemas
from riskflow.plans import model
from riskflow.sources.feed import corrupt_rows, good_rows, read_feed

GOOD = {"transaction_id": "a", "event_time": "2025-06-11T22:03:03", "amount": 1.5,
        "is_new_user": True, "country": "not in the schema"}


def feed(spark, tmp_path, *lines):
    path = tmp_path / "feed.json"
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")
    return read_feed(spark, str(path))


def test_good_and_bad_lines(spark, tmp_path):
    wrong_type = {**GOOD, "transaction_id": "b", "amount": "much"}
    df = feed(spark, tmp_path, GOOD, wrong_type, '{"transaction_id": "c", ', "", "  ",
              [GOOD, GOOD], {"transaction_id": "d"})
    good = good_rows(df)
    assert good.schema == schemas.RAW
    assert [r.transaction_id for r in good.orderBy("transaction_id").collect()] == ["a", "a", "a", "d"]
    bad = corrupt_rows(df).collect()
    assert sorted(r.corrupt_record for r in bad) == sorted(
        [json.dumps(wrong_type), '{"transaction_id": "c", '])
    assert {r.source_file for r in bad} == {"feed.json"}


def test_a_query_of_few_columns_sees_the_same_bad_lines(spark, tmp_path):
    df = feed(spark, tmp_path, GOOD, {**GOOD, "amount": "much"}, "{")
    assert good_rows(df).select("transaction_id").count() == 1
    assert good_rows(df).count() == 1
    assert corrupt_rows(df).count() == 2


def test_microseconds_survive(spark, tmp_path):
    df = feed(spark, tmp_path, {**GOOD, "event_time": "2025-06-11T22:03:03.123456"})
    assert good_rows(df).first().event_time.microsecond == 123456


def test_a_written_feed_is_compressed(spark, tmp_path):
    """Files of whole lines, a fraction as long, with the same rows."""
    sf_dir, rows = "/root/testdata/sf0.001", {}
    for codec in ("none", model.FEED_CODEC):
        model.write_feed(spark, sf_dir, str(tmp_path / codec), codec=codec)
        rows[codec] = good_rows(read_feed(spark, str(tmp_path / codec)))
    model.write_feed(spark, sf_dir, str(tmp_path / "feed"))
    files = [p for p in (tmp_path / "feed").iterdir() if p.name.startswith("part-")]
    assert files and all(p.suffix == ".gz" for p in files)
    plain = sum(p.stat().st_size for p in (tmp_path / "none").iterdir() if p.name.startswith("part-"))
    assert sum(p.stat().st_size for p in files) < plain / 5
    assert rows["none"].count() == 1000 and rows["none"].exceptAll(rows[model.FEED_CODEC]).isEmpty()
    assert rows[model.FEED_CODEC].exceptAll(good_rows(read_feed(spark, str(tmp_path / "feed")))).isEmpty()
