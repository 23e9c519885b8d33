"""Documents with every awkward case, shared by the tests of this folder."""

from __future__ import annotations

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "lorem ipsum dolor sit amet. " * 4000

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog. You idiot clown.", "en", "a", 60),
    (1, "The quick brown fox jumps over the lazy dog. You idiot clown.", "en", "a", 60),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, "   \n\t ", "en", None, 6),
    (None, "A text without an id, mail me@example.com now", "en", "a", 45),
    (5, LONG, "la", "a", len(LONG)),
    (6, "é" * 5000, "fr", "a", 5000),
    (7, "4111 1111 1111 1111 and +49 30 1234567 and 10.0.0.1", None, "b", 52),
    (8, "x", "en", "a", 1),
    (9, "x", "en", "a", 1),
    (10, "a\x1cb <|endoftext|> İ ﬁ ½", "en", "a", 24),
]
# Names that the operators use themselves.
CLASHES = ("score", "fingerprint", "doc", "term", "position", "label", "weight", "part", "chunk",
           "blocks", "root", "rows", "measures", "hash", "rank", "copies", "n_words", "lang_pred",
           "host", "path", "rule", "verdict", "word", "items")


def documents(spark, rows=None, clashes: bool = True):
    df = spark.createDataFrame(ROWS if rows is None else rows, SCHEMA)
    return df.select("*", *[F.lit("z").alias(c) for c in CLASHES]) if clashes else df


def labels(spark, column: str, rows):
    return spark.createDataFrame(rows, f"doc_id long, {column} int").select(
        "*", F.lit("z").alias("text"), F.lit("z").alias("weight")
    )
