"""Language identification with bit-sliced Bloom filters over character n-grams.

Each language has a Bloom filter of the n-grams that are typical of it, and all filters lie in one
table: row i holds bit i of every language's filter as the bits of a word. Looking an n-gram up is
one AND of its rows and gives all languages that contain it at once. A document's languages are
counted over its n-grams, what each filter would count by chance is taken off, and the language
with the largest share left decides.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.common import hashed_sample, slices, stored

UNKNOWN = "und"
GRAM = 4
WORD_BITS = 64
CHUNK_CHARS = 1 << 20
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5],
               dtype=np.uint64)


@dataclass(frozen=True)
class Sizes:
    """Bounds of what is learnt: documents per language (by hashed id), ``max_chars`` characters of
    each (spread evenly over a longer text), n-grams per language, and the table's rows and hashes
    per n-gram. An n-gram is in ``min_docs`` documents of a language at least, or in one where the
    sample has under ``few_docs`` of it."""

    docs_per_language: int = 2_000
    max_chars: int = 100_000
    grams_per_language: int = 20_000
    min_docs: int = 2
    few_docs: int = 50
    rows: int = 1 << 20
    hashes: int = 3


def gram_codes(text: str) -> np.ndarray:
    """A 64-bit code of each run of ``GRAM`` characters of the lower-cased text, spaces around it.

    Characters that are no letters count as one space each.
    """
    lowered = text.lower()
    if not text.isascii():
        lowered = "".join(c if c.isalpha() else " " for c in lowered)
    points = np.frombuffer(f" {lowered} ".encode("utf-32-le"), np.uint32).astype(np.uint64)
    ascii_other = (points < 128) & ((points < 97) | (points > 122))
    points[ascii_other] = 32
    if len(points) < GRAM:
        return np.empty(0, dtype=np.uint64)
    codes = np.zeros(len(points) - GRAM + 1, dtype=np.uint64)
    blank = np.ones(len(codes), dtype=bool)
    for k in range(GRAM):
        part = points[k:k + len(codes)]
        codes = (codes << np.uint64(16)) ^ part  # 16 bits a character; rarer ones overlap
        blank &= part == 32
    return codes[~blank]


def _has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


class Filters:
    """The bit-sliced filters of some languages, built from (language number, code) pairs."""

    def __init__(self, languages: list[str], numbers: np.ndarray, codes: np.ndarray, sizes: Sizes):
        self.languages, self.sizes = languages, sizes
        self.words = max(1, -(-len(languages) // WORD_BITS))
        self.table = np.zeros((sizes.rows, self.words), dtype=np.uint64)
        word, bit = np.divmod(numbers.astype(np.int64), WORD_BITS)
        for row in self._rows(codes):
            np.bitwise_or.at(self.table, (row, word), np.uint64(1) << bit.astype(np.uint64))
        fill = np.array([self._bit(self.table, n).mean() for n in range(len(languages))])
        self.chance = fill**sizes.hashes  # a foreign n-gram's share of false positives

    def _rows(self, codes: np.ndarray) -> Iterator[np.ndarray]:
        for k in range(self.sizes.hashes):
            mixed = (codes ^ MIX[(k + 1) % 4]) * MIX[k % 4]
            mixed ^= mixed >> np.uint64(29)
            mixed *= MIX[(k + 2) % 4]
            yield (mixed >> np.uint64(32)).astype(np.int64) % self.sizes.rows

    @staticmethod
    def _bit(masks: np.ndarray, number: int) -> np.ndarray:
        return (masks[:, number // WORD_BITS] >> np.uint64(number % WORD_BITS)) & np.uint64(1)

    def counts(self, codes: np.ndarray) -> np.ndarray:
        """How many of the codes each language holds."""
        masks = None
        for row in self._rows(codes):
            found = self.table[row]
            masks = found if masks is None else masks & found
        if self.words == 1:  # languages that occur together are counted together
            kinds, times = np.unique(masks[:, 0], return_counts=True)
            bits = (kinds[:, None] >> np.arange(len(self.languages), dtype=np.uint64)) & np.uint64(1)
            return times @ bits.astype(np.int64)
        return np.array([self._bit(masks, n).sum() for n in range(len(self.languages))])

    def predict(self, text: str) -> tuple[str, float]:
        """Language and its share of the corrected counts; ties go to the name that sorts first."""
        if not self.languages or not _has_letter(text):
            return UNKNOWN, 0.0
        total, counts = 0, np.zeros(len(self.languages))
        for at in range(0, len(text), CHUNK_CHARS):  # a chunk's last n-grams reach into the next
            codes = gram_codes(text[at:at + CHUNK_CHARS + GRAM - 1])
            total += len(codes)
            counts += self.counts(codes)
        real = np.clip((counts - total * self.chance) / (1 - self.chance), 0, None)
        best = int(real.argmax())
        every = real.sum()
        return self.languages[best], float(real[best] / every) if every else 1 / len(real)


SPREAD = 16  # pieces that stand for a long text


def _bounded(text: str, max_chars: int) -> str:
    """The text, or ``SPREAD`` pieces of it at even distances."""
    if len(text) <= max_chars:
        return text
    size = max(1, max_chars // SPREAD)
    return " ".join(text[at:at + size] for at in range(0, len(text) - size + 1, -(-len(text) // SPREAD)))


def _sample(docs: DataFrame, allowed: Column | str, sizes: Sizes, id_col: str, text_col: str,
            lang_col: str) -> DataFrame:
    """Bounded training rows: the same number per language at most, by hashed id.

    Of rows with one id and language the one of the least hash counts, before any are ranked. Rows
    without an id, a language or a text are not learnt from.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.col(lang_col).cast("string").alias("lang")) \
        .where(allowed).where("doc_id is not null and lang is not null and text is not null") \
        .withColumn("key", F.xxhash64("text"))
    one = rows.groupBy("doc_id", "lang").agg(F.min("key").alias("key"))
    chosen = hashed_sample(one, "lang", "doc_id", sizes.docs_per_language).select("doc_id", "lang")
    chosen = stored(one.join(F.broadcast(chosen), ["doc_id", "lang"]), "language-sample")
    return rows.join(F.broadcast(chosen), ["doc_id", "lang", "key"]) \
        .groupBy("doc_id", "lang", "key").agg(F.min("text").alias("text"))


def train(docs: DataFrame, allowed: Column | str, sizes: Sizes | None = None, *, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> Filters:
    """Fill the filters with each language's n-grams of the most documents of a bounded sample.

    ``allowed`` says by doc_id which rows may be learnt from; rows without an id, a language or a
    text are not. Without any such row every prediction is ``UNKNOWN``. Every language with a text
    that has a letter is learnt, whatever the number or length of its documents.
    """
    sizes = sizes or Sizes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            langs, codes = [], []
            for text, lang in zip(batch["text"].to_pylist(), batch["lang"].to_pylist(), strict=True):
                own = np.unique(gram_codes(_bounded(text, sizes.max_chars)))
                langs.extend(itertools.repeat(lang, len(own)))
                codes.append(own)
            merged = np.concatenate(codes) if codes else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(merged.view(np.int64))], names=["lang", "code"]
            )

    sample = stored(_sample(docs, allowed, sizes, id_col, text_col, lang_col).select("text", "lang"),
                    "language-texts")
    least = sample.groupBy("lang").agg(F.when(F.count("*") < sizes.few_docs, 1).otherwise(sizes.min_docs)
                                       .alias("least"))  # a row per language
    grams = sample.mapInArrow(run, "lang string, code long") \
        .groupBy("lang", "code").agg(F.count("*").alias("n")) \
        .join(F.broadcast(least), "lang").where(F.col("n") >= F.col("least"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    kept = grams.withColumn("rank", rank).where(F.col("rank") <= sizes.grams_per_language) \
        .select("lang", "code").toPandas()
    languages = sorted(kept["lang"].unique())
    numbers = kept["lang"].map({name: i for i, name in enumerate(languages)}).to_numpy()
    return Filters(languages, numbers, kept["code"].to_numpy().astype(np.int64).view(np.uint64), sizes)


def with_languages(docs: DataFrame, filters: Filters, *, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of every row's whole text.

    Null, empty and letterless texts are ``UNKNOWN`` with score 0. Repeated rows each have their
    row; an empty table gives none; other columns, the language's among them, are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)  # sizes.rows words, 8 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [shared.value.predict(t or "") for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([x[0] for x in found], pa.string()),
                 pa.array([x[1] for x in found], pa.float64())], names=["doc_id", "lang_pred", "score"],
            )

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    ).mapInArrow(run, "doc_id long, lang_pred string, score double")
