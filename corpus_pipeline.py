"""A corpus cleaned and packed in stages, each one operator of ``riskflow.llm``.

A stage takes (spark, docs, sf_dir) and returns a frame, which is written before the next stage
reads it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskflow.llm.common import id_remainder, stored, table, with_code
from riskflow.llm.decontaminate import without_contaminated
from riskflow.llm.packing import pack
from riskflow.llm.pii import masked
from riskflow.llm.simhash import one_per_group
from riskflow.llm.tokens import vocabulary_path
from riskflow.llm.toxicity import not_toxic, train

TOXIC_FROM = 0.3
SHINGLE_WORDS, MAX_BITS = 3, 2
END_ID = 2


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold stay; null and empty texts do."""
    model = train(docs, table(spark, sf_dir, "labels"), id_remainder("doc_id", 4) != 2)
    return not_toxic(docs, model, TOXIC_FROM)


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: that of the smallest id."""
    return one_per_group(docs, shingle=SHINGLE_WORDS, max_bits=MAX_BITS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind; all documents stay."""
    return masked(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's ids with an end id, packed into sequences of 4096; a row per piece."""
    return pack(docs, vocabulary_path(), END_ID)


STAGES = [(stage.__name__, with_code(stage))
          for stage in (toxicity, simhash, decontamination, pii, packing)]
# Training and hashing have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of ``documents`` after all stages."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
