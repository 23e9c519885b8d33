"""Whitening against exact fractions and numpy."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskflow.llm import whitening
from riskflow.llm.queries import LLM_QUERIES
from riskflow.llm.whitening import eigenpairs, whiten

SF_DIR = "/root/testdata/sf0.001"
NAN, INF = float("nan"), float("inf")


def spectrum(values, seed=1):
    rng = np.random.default_rng(seed)
    q, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
    a = (q * np.array(values, dtype=float)) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("values", [
    range(1, 65), [1] * 8, [5, 5, 5, 4, 4, 1, 1e-9, 0], [1 + 1e-9 * i for i in range(16)],
    [1, 1 + 1e-13, 1 + 2e-13, 0.5], [1 + 1e-6, 1, 1 - 1e-6, *np.linspace(0.1, 0.5, 40)], [3], [0, 0, 0],
    [1e12, 1e12 - 1, 1, 1e-3], [-2, 1, 1, 3], [1e-200, 2e-200],
])
def test_eigenpairs_to_double_precision(values):
    a = spectrum(list(values))
    found, vectors = eigenpairs(a)
    largest = max(np.abs(a).max(), 1e-300)
    fine = a.astype(np.longdouble)
    assert np.abs(vectors @ vectors.T - np.eye(len(a))).max() < 1e-12
    assert np.abs(fine @ vectors.T - vectors.T * found).max() < 1e-14 * len(a) * largest
    assert (np.diff(found) <= 1e-13 * largest).all()
    assert np.allclose(found.astype(float), np.linalg.eigvalsh(a)[::-1], atol=1e-13 * largest * len(a), rtol=0)


def test_clusters_are_solved_apart(monkeypatch):
    """Gaps far below what float32 tells apart; the vectors match a solver in double."""
    a = spectrum([2, 1 + 4e-8, 1 + 2e-8, 1, 0.5, 0.25])
    calls = []
    monkeypatch.setattr(whitening, "_within", lambda *args, own=whitening._within: calls.append(1) or own(*args))
    _, vectors = eigenpairs(a)
    want = np.linalg.eigh(a)[1].T[::-1]
    assert calls
    assert np.abs(np.abs((vectors.astype(float) * want).sum(axis=1)) - 1).max() < 1e-12
    assert np.abs(vectors @ vectors.T - np.eye(6)).max() < 1e-16
    assert np.abs((vectors @ a @ vectors.T)[~np.eye(6, dtype=bool)]).max() < 1e-16


def test_refinement_is_of_the_float32_start(monkeypatch):
    a = spectrum([4, 3, 2, 1])
    start = np.linalg.eigh(a.astype(np.float32))[1].astype(float)
    assert np.abs(start.T @ start - np.eye(4)).max() > 1e-9
    x = whitening.refined(a, start)
    assert np.abs(x.T @ x - np.eye(4)).max() < 1e-15


def plain(rows, scale=256):
    """Usable rows as whole vectors, and the exact fit."""
    used = []
    for i, v in rows:
        if v is not None and all(x is not None and np.isfinite(x) for x in v):
            used.append((i, [int(np.floor(scale * float(x))) for x in v]))
    width = max((len(v) for _, v in used), default=0)
    used = [(i, tuple(v + [0] * (width - len(v)))) for i, v in used]
    fit = sorted(set(v for _, v in used))
    n = len(fit)
    sums = [sum(v[j] for v in fit) for j in range(width)]
    cov = np.array([[float(sum((v[i] - Fraction(sums[i], n)) * (v[j] - Fraction(sums[j], n)) for v in fit) / n)
                     for j in range(width)] for i in range(width)])
    return used, fit, n, sums, cov


def check(rows, found, model, components=4):
    used, fit, n, sums, cov = plain(rows)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1].T
    assert (model.n, list(model.sums)) == (n, sums)
    k = min(components, len(sums))
    assert np.allclose(model.values, values[:k], rtol=1e-12, atol=1e-12 * values[0])
    assert np.allclose(model.explained, values[:k] / values.sum(), rtol=1e-10)
    got = sorted((r.vec_id, r.deviation, *r.whitened) for r in found.collect())
    signs = np.sign((model.components * vectors[:k]).sum(axis=1))
    want = sorted((i, sum((n * x - s) ** 2 for x, s in zip(v, sums)),
                   *(((np.array(v) - np.array(sums) / n) @ vectors[:k].T) / np.sqrt(values[:k]) * signs))
                  for i, v in used)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert np.allclose([g[2:] for g in got], [w[2:] for w in want], atol=1e-9)
    assert model.error < 1e-9


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").select(
        "*", F.lit("z").alias("vector"), F.lit(1).alias("deviation"))


def test_rows_repeats_and_unusable_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6) * (1, 2, 3, 4, 5, 6)]) for i in range(300)]
    rows += [(1, rows[0][1])] * 500 + [(2, rows[5][1])]  # a vector in half of all rows counts once
    rows += [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [NAN] * 6), (903, [INF] + [0.0] * 5)]
    rows += [(904, [0.0] * 6), (905, [-0.0] * 6), (906, [0.5, 0.25])]
    found, model = whiten(frame(spark, rows).repartition(6))
    check(rows, found, model)


def test_close_eigenvalues_and_large_components(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x * 3000)) for x in rng.normal(size=5)]) for i in range(400)]
    found, model = whiten(frame(spark, rows))
    check(rows, found, model)


def test_sums_beyond_doubles_are_exact(spark):
    rows = [(i, [float(2**22 + i), float(-(2**22) + 3 * i % 7), 1.0]) for i in range(64)]
    found, model = whiten(frame(spark, rows).repartition(3), 2)
    used, fit, n, sums, cov = plain(rows)
    assert list(model.sums) == sums
    assert np.allclose(model.values, np.linalg.eigvalsh(cov)[::-1][:2], rtol=1e-9)
    got = {r.vec_id: r.deviation for r in found.collect()}
    assert got == {i: sum((n * x - s) ** 2 for x, s in zip(v, sums)) for i, v in used}


def test_no_variance_few_dimensions_and_empty_tables(spark):
    same = [(i, [1.0, 2.0, 3.0]) for i in range(4)]
    found, model = whiten(frame(spark, same))
    assert [(r.deviation, r.whitened) for r in found.collect()] == [(0, [None] * 3)] * 4
    assert model.error is None and model.n == 1
    line = [(i, [float(i), 0.0]) for i in range(5)]
    found, model = whiten(frame(spark, line))
    rows = found.collect()
    assert all(r.whitened[1] is None and r.whitened[0] is not None for r in rows)
    assert list(model.explained) == [1.0, 0.0] and model.error < 1e-12
    assert whiten(frame(spark, []))[0].collect() == []
    assert whiten(frame(spark, [(1, []), (2, None)]))[0].collect() == []


def test_a_deviation_beyond_a_long_is_an_error(spark):
    rows = [(0, [3e15]), (1, [-3e15])]
    with pytest.raises(Exception, match="beyond a long"):
        whiten(frame(spark, rows))[0].collect()


def test_query(spark):
    df = LLM_QUERIES["op11_whitening"](spark, SF_DIR)
    rows = df.collect()
    source = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    used, fit, n, sums, cov = plain(source)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1].T
    assert {(r.n, r.identity_error < 1e-9) for r in rows} == {(n, True)}
    assert len(rows) == 4 * len(used)
    vector = dict(used)
    signs = {}
    for r in rows:
        v, k = np.array(vector[r.vec_id]), r.component - 1
        assert r.deviation == sum((n * int(x) - s) ** 2 for x, s in zip(v, sums))
        want = (v - np.array(sums) / n) @ vectors[k] / np.sqrt(values[k])
        signs.setdefault(k, np.sign(want * r.whitened))
        assert abs(r.whitened - signs[k] * want) < 1e-9
        assert abs(r.explained - values[k] / values.sum()) < 1e-9
