"""The pipeline's stages against brute force, and its registration."""

import corpus_pipeline
import pytest
from edge_rows import documents
from test_llm_decontaminate import brute as brute_hits
from test_llm_simhash import plain_components, plain_print
from test_llm_tokens import check_pieces
from tokenizers import Tokenizer

import __spark_entry__
from riskflow.llm.common import stored
from riskflow.llm.queries import LLM_QUERIES
from riskflow.llm.tokens import vocabulary_path
from riskflow.llm.toxicity import train, with_scores

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    """The input of each stage and the last one's result, as rows."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF_DIR), name))
    return out


def test_registered():
    names = list(__spark_entry__.queries())
    assert "pipeline" in names and set(LLM_QUERIES) <= set(names)
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash", "decontamination", "pii", "packing"]


def test_all_but_the_last_keep_the_columns(steps):
    assert all(df.columns == COLUMNS for df in steps[:-1])


def test_toxic_documents_go(spark, steps):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = train(steps[0], labels, corpus_pipeline.id_remainder("doc_id", 4) != 2)
    want = {r["doc_id"] for r in with_scores(steps[0], model).where("score < 0.3").collect()}
    assert {r["doc_id"] for r in steps[1].collect()} == want


def test_one_of_each_group_stays(steps):
    prints = {r["doc_id"]: plain_print(r["text"]) for r in steps[1].collect()}
    want = {i for i, root in plain_components(prints, 2).items() if i == root}
    assert [r["doc_id"] for r in steps[2].orderBy("doc_id").collect()] == sorted(want)


def test_contaminated_documents_go(spark, steps):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select(
        "item_id", "text").collect()]
    rows = steps[2].where("length(text) < 3000")
    want = {r["doc_id"] for r in rows.collect() if not brute_hits(r["text"], items)[1]}
    assert {r["doc_id"] for r in steps[3].where("length(text) < 3000").collect()} == want


def test_personal_data_is_masked(steps):
    before = {r["doc_id"]: r for r in steps[3].collect()}
    after = {r["doc_id"]: r for r in steps[4].collect()}
    assert before.keys() == after.keys()
    changed = [i for i in before if before[i]["text"] != after[i]["text"]]
    assert changed and all(after[i]["n_chars"] == len(after[i]["text"]) for i in changed)
    assert not any("@" in after[i]["text"] and ".com" in after[i]["text"] for i in changed)


def test_all_ids_are_packed(steps):
    texts = {r["doc_id"]: r["text"] for r in steps[4].collect()}
    check_pieces(steps[5].collect(), texts, Tokenizer.from_file(vocabulary_path()))


def test_stages_of_edge_rows(spark):
    docs = documents(spark, clashes=False)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), name)
    assert {r["doc_id"] for r in docs.collect()} >= {2, 5, 6, 7, None}
    empty = documents(spark, [], clashes=False)
    for name, stage in corpus_pipeline.STAGES:
        empty = stored(stage(spark, empty, SF_DIR), name)
    assert empty.isEmpty()
