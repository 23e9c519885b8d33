"""Toxicity, language, quality and URL filters: held-out accuracy and edge rows."""

import re

import numpy as np
import pytest
from edge_rows import ROWS, documents, labels
from pyspark.sql import functions as F

from riskflow.llm import language, quality, toxicity, urls
from riskflow.llm.common import id_remainder
from riskflow.llm.queries import LLM_QUERIES, URL_RULES

SF_DIR = "/root/testdata/sf0.01"
LARGER = "/root/testdata/sf0.1"
ALL = "true"


def held_out(spark, name, sf_dir, label):
    """Predictions beside their labels, of rows that nothing was learnt from."""
    rows = LLM_QUERIES[name](spark, sf_dir)
    known = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", label)
    assert rows.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    return rows.where("held_out").join(known, "doc_id").collect()


def test_toxicity_of_held_out_documents(spark):
    rows = held_out(spark, "op1_toxicity", LARGER, "toxic")
    toxic = [r for r in rows if r["toxic"] == 1]
    clean = [r for r in rows if r["toxic"] == 0]
    assert np.mean([r["predicted"] for r in toxic]) > 0.85
    assert np.mean([r["predicted"] for r in clean]) < 0.02
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


INSULTED = [
    (i, f"A plain line number {i % 9}. " + ("You are a zonk today. " if i % 2 else "") + "Good bye.",
     None, None, None) for i in range(200)
]


def test_toxic_sentences_are_located(spark):
    known = labels(spark, "toxic", [(i, i % 2) for i in range(200)])
    model = toxicity.train(documents(spark, INSULTED), known, ALL)
    rows = toxicity.with_scores(documents(spark, INSULTED), model).collect()
    for r in rows:
        text = INSULTED[r["doc_id"]][1]
        assert (r["score"] > 0.5) == (r["doc_id"] % 2 == 1)
        assert [text[s["start"]:s["end"]].strip() for s in r["sentences"]] == (
            ["You are a zonk today"] if r["doc_id"] % 2 else [])
    kept = toxicity.not_toxic(documents(spark, INSULTED), model, 0.3)
    assert kept.count() == 100 and kept.columns == documents(spark).columns


def test_a_longer_clean_text_scores_no_higher():
    model = toxicity.Model(-4.0, -1.0, {"zonk": 5.0})
    assert model.score("a b c. " * 5000)[0] == model.score("a")[0] == model.score("")[0]
    assert model.score("zonk. zonk")[0] > model.score("zonk")[0] > 0.9


@pytest.mark.parametrize("rows", [[], [(1, None), (None, 1)], [(1, 1)], [(3, 0)]])
def test_toxicity_without_both_labels_finds_nothing(spark, rows):
    model = toxicity.train(documents(spark), labels(spark, "toxic", rows), ALL)
    found = toxicity.with_scores(documents(spark), model).collect()
    assert len(found) == len(ROWS) and all(r["score"] < 0.3 for r in found)
    assert toxicity.with_scores(documents(spark, []), model).isEmpty()


def test_the_sample_of_labels_is_bounded(spark):
    known = labels(spark, "toxic", [(i, i % 2) for i in range(200)])
    rows = toxicity.labelled_sample(documents(spark, INSULTED), known, "toxic",
                                    id_remainder("doc_id", 4) != 2, toxicity.Sample(rows_per_class=20))
    assert {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()} == {0: 20, 1: 20}
    assert rows.where(id_remainder("doc_id", 4) == 2).isEmpty()
    weights = rows.groupBy("label").agg(F.sum("weight").alias("of")).collect()
    allowed = known.where(id_remainder("doc_id", 4) != 2).groupBy("toxic").count().collect()
    assert {r["label"]: round(r["of"]) for r in weights} == {r["toxic"]: r["count"] for r in allowed}


def test_language_of_held_out_documents(spark):
    rows = LLM_QUERIES["op6_language"](spark, SF_DIR).join(
        spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    own = [r for r in rows if r["held_out"] and r["lang"]]
    assert len(rows) == 1000 and np.mean([r["lang"] == r["lang_pred"] for r in own]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_edge_rows(spark):
    filters = language.train(documents(spark), ALL, language.Sizes(min_docs=1, max_chars=200_000))
    assert filters.languages == ["en", "fr", "la"]
    found = {r["doc_id"]: r for r in language.with_languages(documents(spark), filters).collect()}
    assert {i: found[i]["lang_pred"] for i in (2, 3, 4, 5, 6)} == {
        2: "und", 3: "und", 4: "und", 5: "la", 6: "fr"}
    assert language.with_languages(documents(spark), filters).count() == len(ROWS)
    assert language.with_languages(documents(spark, []), filters).isEmpty()
    nothing = language.train(documents(spark, []), ALL)
    assert {r["lang_pred"] for r in language.with_languages(documents(spark), nothing).collect()} == {"und"}


def test_filters_hold_all_they_were_given_and_few_others():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 63, 40_000).astype(np.uint64)
    for count in (3, 70):  # more than a word of languages
        numbers = np.arange(40_000) % count
        filters = language.Filters([f"l{i:02d}" for i in range(count)], numbers, codes,
                                   language.Sizes(rows=1 << 18))
        for n in (0, count - 1):
            own = codes[numbers == n]
            assert filters.counts(own)[n] == len(own)
        foreign = rng.integers(0, 1 << 63, 50_000).astype(np.uint64)
        assert np.allclose(filters.counts(foreign) / 50_000, filters.chance, atol=0.01)


def test_a_text_in_chunks_counts_as_a_whole(monkeypatch):
    text = "ab cd éf " * 50
    whole = language.gram_codes(text)
    filters = language.Filters(["a"], np.zeros(len(whole), int), whole, language.Sizes(rows=1 << 12))
    before = filters.predict(text)
    monkeypatch.setattr(language, "CHUNK_CHARS", 64)
    assert filters.predict(text) == before


def test_quality_of_held_out_documents(spark):
    rows = held_out(spark, "op8_quality", SF_DIR, "quality")
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(2)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y, quality.Fit(rounds=10))
    assert (1, 0) in model.pairs
    assert np.mean((model.score(x) >= 0.5) == y) > 0.95


def test_quality_of_edge_rows(spark):
    known = labels(spark, "quality", [(1, 1), (3, 0), (5, 0), (7, 1), (None, 1), (8, None)])
    rows = quality.scored(documents(spark), known, ALL).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    constant = quality.scored(documents(spark), known.limit(0), ALL).collect()
    assert len({round(r["score"], 9) for r in constant}) == 1
    assert quality.scored(documents(spark, []), known, ALL).isEmpty()


URLS = [
    (1, "http://a.ORG/x?y#z"), (2, "https://m.example.org/es/1"), (3, "http://example.org/en/17?x"),
    (4, "http://b.com/fr/1"), (5, "http://b.com/de/1#t"), (6, "http://www.com"), (7, "no scheme"),
    (8, None), (9, ""), (10, "x://y://z/p"), (11, "http://org/"), (12, "http://aorg/"),
    (13, "http://a.org?x/"), (14, "http://É.ORG/\nq"), (1, "http://a.ORG/x?y#z"), (None, "http://c.net/1"),
]


def plain_url(url):
    if not url or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in URL_RULES
            if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.name), default=None)


def test_urls_of_edge_rows(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string").selectExpr(
        "*", "'z' as host", "'z' as Score", "'z' as label", "'z' as features", "'z' as prediction",
        "'z' as probability")
    model = urls.train(urls.labelled_by_rules(pages, URL_RULES))
    rows = urls.judged(pages, URL_RULES, model).collect()
    assert len(rows) == len(URLS)
    for r in rows:
        host, path, rule = plain_url(r["url"])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule.name if rule else None)
        assert r["verdict"] == (rule.verdict if rule else "block" if r["score"] >= 0.5 else "allow")
    assert urls.judged(pages.limit(0), URL_RULES, model).isEmpty()


def test_urls_without_both_labels(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string")
    none = urls.train(urls.labelled_by_rules(pages.limit(0), URL_RULES))
    assert none == "allow"
    assert {r["verdict"] for r in urls.judged(pages, [], none).collect()} == {"allow"}


def test_url_query(spark):
    rows = LLM_QUERIES["op7_urls"](spark, SF_DIR)
    plan = rows._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    found = rows.collect()
    assert len(found) == len(pages)
    for r in found:
        host, path, rule = plain_url(pages[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule.name if rule else None)
    # Rules that the classifier learnt from are told again from the address alone.
    ruled = [r for r in found if r["rule"]]
    assert np.mean([(r["score"] >= 0.5) == (r["verdict"] == "block") for r in ruled]) > 0.95


def test_small_languages_and_long_texts_are_learnt_with_the_default_bounds(spark):
    english = [(i, f"the quick brown fox number {i} jumps over the lazy dog and the cat", "en") for i in range(20)]
    polish = [(100, "szybki brązowy lis przeskakuje nad leniwym psem oraz kotem", "pl")]
    german = [(200 + i, f"der schnelle braune Fuchs {i} springt über den faulen Hund und die Katze. " * 1900, "de")
              for i in range(5)]
    docs = spark.createDataFrame(english + polish + german, "doc_id long, text string, lang string")
    filters = language.train(docs, ALL)
    assert filters.languages == ["de", "en", "pl"]
    found = language.with_languages(docs, filters).collect()
    want = {r[0]: r[2] for r in english + polish + german}
    assert {r["doc_id"]: r["lang_pred"] for r in found} == want


def test_a_long_text_is_learnt_from_all_over():
    text = "".join(chr(97 + i % 26) for i in range(100_000))
    part = language._bounded(text, 1600)
    assert 1500 < len(part) < 1700 and part[:100] == text[:100] and text.find(part[-100:]) >= 0
    assert language._bounded("short", 1600) == "short"


def test_bounds_hold_for_rows_of_one_id(spark):
    """An id with a third of all rows is one training row."""
    hot = [(7, f"text {i % 50} of one id, idiot", "en") for i in range(3000)]
    rows = hot + [(100 + i, f"another text number {i}", "en") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
    ids = sorted({r[0] for r in rows})
    known = spark.createDataFrame([(i, int(i == 7 or i % 2), int(i == 7 or i % 2)) for i in ids],
                                  "doc_id long, toxic int, quality int")
    taken = toxicity.labelled_sample(docs, known, "toxic", ALL, toxicity.Sample(rows_per_class=2)).collect()
    assert len(taken) <= 4
    every = toxicity.labelled_sample(docs, known, "toxic", ALL, toxicity.Sample(rows_per_class=10_000)).collect()
    assert len(every) == len(ids) and [r["text"] for r in every if r["doc_id"] == 7] == [min(r[1] for r in hot)]
    sizes = language.Sizes(docs_per_language=2)
    assert language._sample(docs, ALL, sizes, "doc_id", "text", "lang").count() == 2
    whole = language._sample(docs, ALL, language.Sizes(docs_per_language=10_000), "doc_id", "text", "lang")
    assert whole.count() == len(ids) and whole.where("doc_id = 7").count() == 1
    seen = []
    measured = quality.with_measures(docs)

    def counted(x, y, how):
        seen.append(len(y))
        return real(x, y, how)

    real = quality.fit
    quality.fit = counted
    try:
        quality.train(measured, known, ALL, quality.Fit(max_rows=20))
    finally:
        quality.fit = real
    assert seen == [20]
