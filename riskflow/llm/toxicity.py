"""Toxicity by multiple-instance learning over sentences.

A document is a bag of sentences. Each sentence has a probability from a logistic model over its
distinct words and their first letters (compounds share a stem). A document's score is the
noisy-or of its sentences: one minus the product of the chances that each is clean, and that no
cause outside the known words made the label (the leak). The model is trained from document labels
alone; the sentences that carry a score are then located in the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import hashed_sample, slices, stored

WORD = re.compile(r"\w+")
BREAK = re.compile(r"[.!?\n]+")
MIN_SENTENCE = 0.3
EDGE = 1e-9
STEMS = (4, 5)


def features(text: str) -> set[str]:
    """The distinct words of a text and their stems."""
    words = set(WORD.findall(text.lower()))
    return words.union(*({w[:n] for w in words} for n in STEMS))


@dataclass(frozen=True)
class Sample:
    """Bound of the training rows: at most so many labelled rows of each class, by hashed id, of
    texts up to ``max_chars`` characters. Words are in ``min_docs`` of them at least and have a
    likelihood ratio of ``min_ratio``, which is beyond chance; ``max_words`` of them at most."""

    rows_per_class: int = 4_000
    max_chars: int = 200_000
    min_docs: int = 4
    min_ratio: float = 20.0
    max_words: int = 2_000


@dataclass
class Model:
    """Log-odds of a sentence with known words: ``bias`` plus their weights. ``leak``: log-odds that
    a document is labelled whatever its sentences."""

    leak: float
    bias: float
    weights: dict[str, float]

    def sentences(self, text: str) -> Iterator[tuple[int, int, float]]:
        """(start, end, probability) of the sentences that hold a known word."""
        if self.weights.keys().isdisjoint(features(text)):
            return
        at = 0
        for stop in [m.span() for m in BREAK.finditer(text)] + [(len(text), len(text))]:
            known = self.weights.keys() & features(text[at:stop[0]])
            if known:
                z = self.bias + sum(self.weights[w] for w in sorted(known))
                yield at, stop[0], float(1 / (1 + np.exp(-np.clip(z, -50, 50))))
            at = stop[1]

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """Noisy-or over all sentences, and those with a known word (others have no part)."""
        found = list(self.sentences(text))
        hazard = np.log1p(np.exp(self.leak))
        hazard -= sum(np.log1p(-min(p, 1 - EDGE)) for _, _, p in found)
        return float(1 - np.exp(-hazard)), found


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, allowed: Column | str,
                    sample: Sample, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bounded training rows: doc_id, text, label, weight (rows of the class per row taken).

    ``labels`` has one row per document at most (of repeated rows the larger label counts). Of
    documents with one id the least text is taken, so the bound holds for rows as well.
    """
    known = labels.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")
    ).where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)) \
        .groupBy("doc_id").agg(F.max("label").alias("label")).where(allowed)
    chosen = hashed_sample(known, "label", "doc_id", sample.rows_per_class).select(
        "doc_id", "label", (F.col("of") / F.least("of", F.lit(sample.rows_per_class))).alias("weight")
    )
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return stored(
        texts.join(F.broadcast(chosen), "doc_id").where(F.char_length("text") <= sample.max_chars)
        .groupBy("doc_id", "label", "weight").agg(F.min("text").alias("text"))
        .select("doc_id", "text", "label", "weight"), "labelled-sample"
    )


def _left(n: int):
    return lambda word: F.left(word, F.lit(n))


def _vocabulary(rows: DataFrame, sample: Sample) -> list[str]:
    """The words that speak for the label most, by the likelihood ratio of their documents."""
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return []
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)\w+"), F.lit(0)))
    stems = [F.transform(words, _left(n)) for n in STEMS]
    words = rows.select("label", F.explode(F.array_distinct(F.concat(words, *stems))).alias("word"))
    one, zero = F.col("one"), F.col("zero")
    with_word = one + zero

    def term(seen: Column, margin: Column, of: int) -> Column:
        return F.when(seen > 0, seen * F.log(seen * (n0 + n1) / (margin * of))).otherwise(0.0)

    without = (n0 + n1) - with_word
    ratio = 2 * (term(one, with_word, n1) + term(zero, with_word, n0)
                 + term(n1 - one, without, n1) + term(n0 - zero, without, n0))
    best = (
        words.groupBy("word").agg(F.sum("label").alias("one"), F.sum(1 - F.col("label")).alias("zero"))
        .where(one + zero >= sample.min_docs).where(one * n0 > zero * n1)
        .select("word", ratio.alias("ratio"))
        .where(F.col("ratio") >= sample.min_ratio)
        .orderBy(F.col("ratio").desc(), "word").limit(sample.max_words)
    )
    return sorted(r["word"] for r in best.collect())


def _bags(rows: DataFrame, words: list[str]) -> pd.DataFrame:
    """Per training document its label, weight, and the known words of its sentences."""
    index = {w: i for i, w in enumerate(words)}

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for text in part["text"]:
                sets = [sorted(index[w] for w in index.keys() & features(s))
                        for s in BREAK.split(text)]
                known = [s for s in sets if s]
                out.append(([len(s) for s in known], [i for s in known for i in s]))
            yield pd.DataFrame({
                "doc_id": part["doc_id"], "label": part["label"], "weight": part["weight"],
                "sizes": [o[0] for o in out], "words": [o[1] for o in out],
            })

    schema = "doc_id long, label int, weight double, sizes array<int>, words array<int>"
    bags = rows.mapInPandas(run, schema).toPandas()
    return bags.sort_values("doc_id", kind="stable", ignore_index=True)


def train(docs: DataFrame, labels: DataFrame, allowed: Column | str, sample: Sample | None = None, *,
          label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
          rounds: int = 300, rate: float = 0.1, spread: float = 2.0) -> Model:
    """Fit the noisy-or likelihood of document labels by gradient steps on a bounded sample.

    ``allowed`` says by doc_id which labels may be used. Without labels of both classes the model
    is constant: no document is toxic. ``spread`` is the prior deviation of a weight.
    """
    sample = sample or Sample()
    rows = labelled_sample(docs, labels, label, allowed, sample, id_col=id_col, text_col=text_col)
    words = _vocabulary(rows, sample)
    if not words:
        return Model(-20.0, 0.0, {})
    bags = _bags(rows, words)
    y, weight = bags["label"].to_numpy(float), bags["weight"].to_numpy()
    weight = weight / weight.sum()
    sizes = np.array([n for s in bags["sizes"] for n in s], dtype=np.int64)
    word = np.array([i for s in bags["words"] for i in s], dtype=np.int64)
    sentence = np.repeat(np.arange(len(sizes)), sizes)
    doc = np.repeat(np.arange(len(bags)), bags["sizes"].map(len))
    theta = np.concatenate(([-4.0, -4.0], np.zeros(len(words))))  # leak, bias, weights
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        z = theta[1] + np.bincount(sentence, theta[2 + word], minlength=len(sizes))
        hazard = np.bincount(doc, np.logaddexp(0, z), minlength=len(bags))
        hazard += np.logaddexp(0, theta[0])
        # Loss: the hazard of a clean document, minus log(1 - exp(-hazard)) of a toxic one.
        slope = weight * np.where(y > 0, -1 / np.expm1(np.clip(hazard, 1e-6, 50)), 1.0)
        push = slope[doc] / (1 + np.exp(-z))
        gradient = np.empty_like(theta)
        gradient[0] = slope.sum() / (1 + np.exp(-theta[0]))
        gradient[1] = push.sum()
        gradient[2:] = np.bincount(word, push[sentence], minlength=len(words))
        gradient[2:] += theta[2:] / (spread**2 * len(bags))
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        theta -= rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return Model(float(theta[0]), float(theta[1]), dict(zip(words, theta[2:].tolist(), strict=True)))


SCORED = "score double, sentences array<struct<start:int,end:int,score:double>>"


def with_scores(docs: DataFrame, model: Model, *, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """doc_id, score, sentences (start, end, score of those of ``MIN_SENTENCE`` or more) of every row.

    Null and empty texts score the leak alone; repeated rows each have their row; an empty table gives none.
    Positions count code points. Other columns are not read.
    """
    def run(batches):
        import pyarrow as pa

        for batch in slices(batches, "text"):
            scored = [model.score(t or "") for t in batch.column("text").to_pylist()]
            located = [[{"start": a, "end": b, "score": p} for a, b, p in found if p >= MIN_SENTENCE]
                       for _, found in scored]
            kind = pa.list_(pa.struct(
                [("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([s for s, _ in scored], pa.float64()),
                 pa.array(located, kind)], names=["doc_id", "score", "sentences"],
            )

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    ).mapInArrow(run, f"doc_id long, {SCORED}")


def not_toxic(docs: DataFrame, model: Model, threshold: float, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, with all their columns."""
    def run(batches):
        import pyarrow as pa

        for batch in slices(batches, text_col):
            keep = [model.score(t or "")[0] < threshold for t in batch[text_col].to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
