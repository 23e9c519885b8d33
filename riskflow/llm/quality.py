"""Document quality by a generalised additive model with pairwise interactions.

Measures of a text fall into bins; a score is the sum of one table entry per measure and one per
chosen pair of measures, through a sigmoid. The tables are learnt by cyclic boosting: each round
takes the measures in turn and adds a small tree's leaf values to that measure's table, then does
the same with trees over two measures for the pairs that explain most of what is left.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import hashed_sample, slices, stored

MEASURES = (
    "log_chars", "log_words", "word_length", "longest_word", "upper", "digit", "space", "symbol",
    "exclaim", "stop_mark", "comma", "pipe", "other_mark", "non_ascii", "distinct_words",
    "repeated_next", "short_words", "distinct_lines", "line_words", "top_word", "marked_words",
)
# Classes of bytes: 0 other letters and control, then the ones below.
UPPER, LOWER, DIGIT, SPACE, EXCLAIM, STOP, COMMA, PIPE, MARK, HIGH = range(1, 11)


def _byte_classes() -> np.ndarray:
    table = np.zeros(256, dtype=np.uint8)
    table[33:127] = MARK
    for first, last, kind in (("A", "Z", UPPER), ("a", "z", LOWER), ("0", "9", DIGIT)):
        table[ord(first):ord(last) + 1] = kind
    for chars, kind in ((" \t\n\r\f\v", SPACE), ("!", EXCLAIM), (".?:;", STOP), (",", COMMA), ("|", PIPE)):
        table[[ord(c) for c in chars]] = kind
    table[128:] = HIGH
    return table


CLASSES = _byte_classes()


def measures(text: str) -> list[float]:
    """The values named in ``MEASURES``; all zero for a text without words."""
    words = text.split()
    if not words:
        return [0.0] * len(MEASURES)
    n = len(words)
    raw = np.frombuffer(text.encode(), np.uint8)
    share = np.bincount(CLASSES[raw], minlength=11) / len(raw)
    lengths = np.fromiter(map(len, words), np.int64, n)
    seen: dict[str, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    lines = text.split("\n")
    ends = "".join([w[-1] if w[-1] < "\x7f" else "a" for w in words])
    last = CLASSES[np.frombuffer(ends.encode(), np.uint8)]
    return [
        np.log1p(len(text)), np.log1p(n), lengths.mean(), lengths.max(), share[UPPER], share[DIGIT],
        share[SPACE], share[[EXCLAIM, PIPE, MARK]].sum(), share[EXCLAIM], share[STOP],
        share[COMMA], share[PIPE], share[MARK], share[HIGH], len(seen) / n,
        sum(map(str.__eq__, words, words[1:])) / n, (lengths <= 3).mean(),
        len(set(lines)) / len(lines), np.log1p(n / len(lines)), max(seen.values()) / n,
        (last >= EXCLAIM).mean(),
    ]


def with_measures(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the array of measures of every row's whole text; a null text counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [measures(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.list_(pa.float64()))],
                names=["doc_id", "measures"],
            )

    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    ).mapInArrow(run, "doc_id long, measures array<double>")


@dataclass(frozen=True)
class Fit:
    """``max_rows`` bounds the training rows, taken by hashed id; the rest shapes the trees."""

    max_rows: int = 30_000
    bins: int = 32
    rounds: int = 120
    pair_rounds: int = 60
    pairs: int = 6
    pair_bins: int = 8
    rate: float = 0.1
    leaves: int = 4
    ridge: float = 5.0


@dataclass
class Model:
    """Edges of each measure's bins, one table per measure and one per pair of measures."""

    intercept: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pair_edges: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of rows of measures: bin look-ups and additions."""
        z = np.full(len(x), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            z += table[np.searchsorted(edges, x[:, j])]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            z += table[np.searchsorted(self.pair_edges[i], x[:, i]),
                       np.searchsorted(self.pair_edges[j], x[:, j])]
        return 1 / (1 + np.exp(-z))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    return g * g / (h + ridge)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Leaf values per bin of a tree of at most ``leaves`` leaves over sums of slopes and curvatures."""
    cuts = [0, len(g)]
    sums_g, sums_h = np.concatenate(([0], np.cumsum(g))), np.concatenate(([0], np.cumsum(h)))
    while len(cuts) <= leaves:
        best, at = 1e-9, None
        for a, b in zip(cuts, cuts[1:]):
            mid = np.arange(a + 1, b)
            if not len(mid):
                continue
            left_g, left_h = sums_g[mid] - sums_g[a], sums_h[mid] - sums_h[a]
            all_g, all_h = sums_g[b] - sums_g[a], sums_h[b] - sums_h[a]
            gain = _gain(left_g, left_h, ridge) + _gain(all_g - left_g, all_h - left_h, ridge) \
                - _gain(all_g, all_h, ridge)
            k = int(gain.argmax())
            if gain[k] > best:
                best, at = gain[k], int(mid[k])
        if at is None:
            break
        cuts = sorted([*cuts, at])
    out = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:]):
        out[a:b] = (sums_g[b] - sums_g[a]) / (sums_h[b] - sums_h[a] + ridge)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """Leaf values of the best tree with one cut of the rows and one of the columns, and its gain."""
    def corner(x: np.ndarray) -> np.ndarray:
        return np.cumsum(np.cumsum(x, axis=0), axis=1)

    cg, ch = corner(g), corner(h)
    if min(g.shape) < 2:
        return np.zeros_like(g), 0.0
    parts = []
    for c in (cg, ch):
        top, left, full = c[:-1, -1:], c[-1:, :-1], c[-1, -1]
        a = c[:-1, :-1]
        parts.append((a, top - a, left - a, full - top - left + a))
    gain = sum(_gain(x, y, ridge) for x, y in zip(*parts, strict=True)) - _gain(cg[-1, -1], ch[-1, -1], ridge)
    r, c = np.unravel_index(int(gain.argmax()), gain.shape)
    values = [x[r, c] / (y[r, c] + ridge) for x, y in zip(*parts, strict=True)]
    out = np.empty_like(g)
    out[:r + 1, :c + 1], out[:r + 1, c + 1:] = values[0], values[1]
    out[r + 1:, :c + 1], out[r + 1:, c + 1:] = values[2], values[3]
    return out, float(gain[r, c])


def fit(x: np.ndarray, y: np.ndarray, how: Fit | None = None) -> Model:
    """Learn the tables from rows of measures and labels 0 or 1; one class alone gives a constant."""
    how = how or Fit()
    rate = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
    width = x.shape[1]
    edges = [_edges(x[:, j], how.bins) for j in range(width)] if len(x) else [np.empty(0)] * width
    coarse = [_edges(x[:, j], how.pair_bins) for j in range(width)] if len(x) else edges
    tables = [np.zeros(len(e) + 1) for e in edges]
    model = Model(float(np.log(rate / (1 - rate))), edges, tables, coarse, [], [])
    if len(np.unique(y)) < 2:
        return model
    bins = [np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)]
    wide = [np.searchsorted(e, x[:, j]) for j, e in enumerate(coarse)]
    z = np.full(len(x), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(how.rounds):
        for j, table in enumerate(tables):
            g, h = slopes()
            step = how.rate * _tree(np.bincount(bins[j], g, len(table)),
                                    np.bincount(bins[j], h, len(table)), how.leaves, how.ridge)
            table += step
            z += step[bins[j]]

    def grid(i: int, j: int, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
        shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
        at = wide[i] * shape[1] + wide[j]
        sums = (np.bincount(at, v, shape[0] * shape[1]).reshape(shape) for v in (g, h))
        return _pair_tree(*sums, how.ridge)

    g, h = slopes()
    gains = sorted(((grid(i, j, g, h)[1], i, j) for i in range(width) for j in range(i)), reverse=True)
    model.pairs = [(i, j) for gain, i, j in gains[:how.pairs] if gain > 0]
    model.pair_tables = [np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1)) for i, j in model.pairs]
    for _ in range(how.pair_rounds):
        for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
            step = how.rate * grid(i, j, *slopes())[0]
            table += step
            z += step[wide[i], wide[j]]
    return model


def train(measured: DataFrame, labels: DataFrame, allowed: Column | str, how: Fit | None = None, *,
          label: str = "quality", id_col: str = "doc_id") -> Model:
    """Fit the model on at most ``how.max_rows`` labelled rows, those of the smallest hashed ids.

    ``measured`` is the frame of ``with_measures``; ``allowed`` says by doc_id which labels may be
    used. Of repeated labels of an id the larger counts, and of repeated documents the least
    measures, so the bound holds for rows as well; null ids and labels do not count.
    """
    how = how or Fit()
    known = labels.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")
    ).where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)) \
        .groupBy("doc_id").agg(F.max("label").alias("label")).where(allowed)
    taken = hashed_sample(known.withColumn("one", F.lit(1)), "one", "doc_id", how.max_rows)
    taken = known.join(F.broadcast(taken.select("doc_id")), "doc_id")
    rows = measured.join(F.broadcast(taken), "doc_id").groupBy("doc_id", "label").agg(
        F.min("measures").alias("measures")).toPandas()
    rows = rows.sort_values("doc_id", kind="stable")
    x = np.array(rows["measures"].to_list(), dtype=float).reshape(-1, len(MEASURES))
    return fit(x, rows["label"].to_numpy(float), how)


def with_scores(measured: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every measured row, a batch at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("measures").flatten().to_numpy().reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"]
            )

    return measured.mapInArrow(run, "doc_id long, score double")


def scored(docs: DataFrame, labels: DataFrame, allowed: Column | str, how: Fit | None = None, *,
           label: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measure every row once, learn from the allowed labels, and score every row.

    Null and empty texts have measures of zero and score as such; repeated rows each have their
    row; an empty table gives none; other columns are not read.
    """
    measured = stored(with_measures(docs, id_col=id_col, text_col=text_col), "measures")
    return with_scores(measured, train(measured, labels, allowed, how, label=label, id_col=id_col))
