"""Whitening against numpy on whole matrices, and the refinement on matrices with known eigenvectors."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from callmill.llm import queries, whitening

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, vectors, ids=None):
    rows = [(i if ids is None else ids[i], v, 0) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def plain(vectors, components=8):
    x = np.array([[int(np.floor(1024 * float(np.float32(c)))) + 100000 for c in v] for v in vectors], object)
    n, s = len(x), x.sum(axis=0)
    off = n * x - s
    v = np.array([[float(Fraction(int(e), n**3)) for e in row] for row in off.T @ off])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    white = (off / n).astype(float) @ u[:, :components] / np.sqrt(e[:components])
    return n, (off * off).sum(axis=1), white, e[:components] / e.sum()


def check(got, vectors, components, close=1e-9):
    n, deviation, white, explained = plain(vectors, components)
    assert len(got) == n * components
    for r in got:
        assert (r.n, r.deviation) == (n, deviation[r.vec_id])
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
        assert r.identity_error < 1e-9
    for k in range(components):
        mine = np.array([r.whitened for r in sorted(got, key=lambda r: r.vec_id) if r.component == k + 1])
        assert min(np.abs(mine - white[:, k]).max(), np.abs(mine + white[:, k]).max()) < close


def test_the_table(spark):
    vectors = [r.embedding for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").orderBy("vec_id").collect()]
    check(queries.op13_embedding_whitening(spark, SF_DIR).collect(), vectors, 8)


def test_few_entries_and_large_ones(spark):
    r = np.random.default_rng(3)
    vectors = (r.normal(size=(50, 3)) * [1, 300, 1e4]).astype(np.float32).tolist()
    check(whitening.whiten(frame(spark, vectors)).collect(), vectors, 3, close=1e-6)
    # The squares exceed a long, the components stay.
    vectors = (r.normal(size=(50, 3)) * [1, 1e4, 1e8]).astype(np.float32).tolist()
    got = whitening.whiten(frame(spark, vectors)).collect()
    assert len(got) == 150 and all(r.deviation is None and r.identity_error < 1e-6 for r in got)


def test_unsound_vectors_are_dropped(spark):
    r = np.random.default_rng(4)
    good = r.normal(size=(30, 4)).astype(np.float32).tolist()
    bad = [None, [], [1.0, None, 2.0, 3.0], [float("nan")] * 4, [float("inf"), 0.0, 0.0, 0.0], [1e20, 0.0, 0.0, 0.0], [1.0, 2.0]]
    clashing = {name: F.lit(1) for name in ("n", "i", "j", "total", "whitened", "component", "at", "d", "a.b")}
    got = whitening.whiten(frame(spark, good + bad).withColumns(clashing)).collect()
    check(got, good, 4)


def test_no_vectors_and_no_variance(spark):
    assert whitening.whiten(frame(spark, [[1.0, 2.0]]).filter("false")).count() == 0
    assert whitening.whiten(frame(spark, [None, [float("nan")]])).count() == 0
    assert whitening.whiten(frame(spark, [[1.0, 2.0]] * 5)).count() == 0
    line = whitening.whiten(frame(spark, [[1.0, 2.0], [2.0, 4.0], [2.0, 4.0]], ids=[None, 3, 3])).collect()
    assert {(r.vec_id, r.component) for r in line} == {(None, 1), (3, 1)} and len(line) == 3
    assert {round(r.explained, 9) for r in line} == {1.0}


def test_one_vector_for_a_third_of_all_rows(spark):
    r = np.random.default_rng(5)
    vectors = r.normal(size=(60, 10)).astype(np.float32).tolist()
    vectors += [vectors[0]] * 30
    check(whitening.whiten(frame(spark, vectors)).collect(), vectors, 8)


def test_sums_beyond_a_double_are_exact(spark):
    """Products of large entries pass the integers that a double holds."""
    r = np.random.default_rng(6)
    vectors = (r.integers(0, 2**28, size=(40, 3))).astype(np.float32).tolist()
    rows = whitening.sound(frame(spark, vectors))
    n, sums, scaled = whitening.covariance(rows)
    x = np.array([[int(np.floor(1024 * c)) + 100000 for c in v] for v in vectors], object)
    assert (n, sums) == (40, x.sum(axis=0).tolist())
    off = 40 * x - x.sum(axis=0)
    assert (scaled * 40 == off.T @ off).all()


def matrix(values, seed=1):
    """A symmetric matrix in extended precision with these eigenvalues, and its eigenvectors."""
    n = len(values)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(n, n)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q + q @ ((np.eye(n) - q.T @ q) / 2)
    a = (q * np.array(values, np.longdouble)) @ q.T
    return (a + a.T) / 2, q


@pytest.mark.parametrize(
    "values, close",
    [
        (np.linspace(1, 0.05, 20), 1e-16),
        # A cluster that float32 cannot tell apart, and that double precision hardly can.
        (np.concatenate((0.9 + 1e-5 * np.arange(5)[::-1], np.linspace(0.5, 0.05, 15))), 1e-13),
        (np.concatenate((0.9 + 1e-9 * np.arange(5)[::-1], 0.3 + 1e-7 * np.arange(5)[::-1], np.linspace(0.2, 0.05, 10))), 1e-9),
    ],
)
def test_refinement_finds_known_eigenvectors(values, close):
    a, q = matrix(values)
    start = np.linalg.eigh(a.astype(np.float32))[1]
    assert np.abs(start.T @ start - np.eye(len(a))).max() > 1e-8
    found, x = whitening.refined(a, start)
    assert np.abs(found - values).max() < 1e-17
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-16
    for k in range(len(a)):
        assert min(np.abs(x[:, k] - q[:, k]).max(), np.abs(x[:, k] + q[:, k]).max()) < close


@pytest.mark.parametrize("values", [[0.5] * 6 + [0.1] * 6, [1, 0.5] + [0] * 10, [0] * 4])
def test_refinement_of_equal_eigenvalues(values):
    a, _ = matrix(values)
    found, x = whitening.refined(a, np.linalg.eigh(a.astype(np.float32))[1])
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-16
    assert np.abs(a @ x - x * found).max() < 1e-17
