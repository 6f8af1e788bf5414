"""Whitening of embeddings by the leading eigenvectors of their covariance, refined in mixed precision.

Vectors become integers, so their sums and products are exact: tasks add them up in blocks that a double holds without
rounding, after taking off the integer next to the mean, and Spark adds the blocks. What reaches the driver is one matrix of
dimension x dimension, whatever the number of vectors.

The matrix's eigenvectors are found in float32 and corrected by iterations of matrix multiplications in extended precision
(Ogita and Aishima): from how far X'X is from the identity and X'VX from a diagonal matrix follows a correction of all vectors at once. Where
eigenvalues are too close for it, the vectors of a cluster are turned among themselves by the eigenvectors of the small,
shifted and scaled matrix of that cluster, and the iterations go on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from callmill.llm.common import prepare, saved

# How an entry becomes an integer.
SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
# Entries beyond have no exact integer in a double.
LARGEST = float(2**40)
# Sums up to here are exact in a double.
EXACT = 2**53
# Rows that one matrix product takes.
BLOCK_ROWS = 4096
ITERATIONS = 30

PARTIAL = "i int, j int, total decimal(38,0)"
WHITENED = "vec_id long, deviation long, whitened array<double>"


@dataclass(frozen=True)
class Fit:
    """What whitening needs: size and integer sums of the fit list, components as columns, their eigenvalues, and the
    share of the trace that each explains."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray


def sound(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the vectors that remain."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    # A NaN is above any bound.
    whole = F.forall("embedding", lambda c: c.isNotNull() & (F.abs(c) < LARGEST / SCALE))
    rows = rows.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.coalesce(whole, F.lit(False)))
    lengths = rows.groupBy(F.size("embedding").alias("d")).agg(F.count("*").alias("n"))
    usual = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(F.size("embedding") == (usual.d if usual else 0))


def integers(column: pa.Array) -> np.ndarray:
    """The integers of a column of equally long vectors, one row for each."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    x = np.floor(SCALE * flat).astype(np.int64) + SHIFT
    return x.reshape(len(column), -1) if len(column) else x.reshape(0, 0)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        x = integers(batch.column("embedding"))
        for a in range(0, len(x), BLOCK_ROWS):
            yield x[a : a + BLOCK_ROWS]


def _partials(batches: Iterator[pa.RecordBatch], centre: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """The task's sums of entries, and of products of two centred entries if there is a centre.

    Products are summed in doubles while that is exact and in integers of any size beyond."""
    sums = total = None
    for x in _blocks(batches):
        added = x.sum(axis=0, dtype=np.int64).astype(object)
        sums = added if sums is None else sums + added
        if centre is not None:
            y = x - centre
            most = int(np.abs(y).max(initial=0))
            step = max(1, min(len(y), EXACT // max(most * most, 1)))
            for a in range(0, len(y), step):
                part = y[a : a + step]
                if most * most < EXACT:
                    z = part.astype(np.float64)
                    product = (z.T @ z).astype(np.int64).astype(object)
                else:
                    z = part.astype(object)
                    product = z.T @ z
                total = product if total is None else total + product
    if sums is None:
        return
    d = len(sums)
    if total is None:
        i, j, values = np.full(d, -1), np.arange(d), sums
    else:
        i, j = np.triu_indices(d)
        values = total[i, j]
    from decimal import Decimal

    yield pa.RecordBatch.from_arrays(
        [
            pa.array(i.astype(np.int32)),
            pa.array(j.astype(np.int32)),
            pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0)),
        ],
        names=["i", "j", "total"],
    )


def _summed(rows: DataFrame, centre: np.ndarray | None) -> dict[tuple[int, int], int]:
    """One number for each entry, or pair of entries, of a vector."""
    parts = rows.select("embedding").mapInArrow(lambda batches: _partials(batches, centre), PARTIAL)
    totals = parts.groupBy("i", "j").agg(F.sum("total").alias("total"))
    return {(r.i, r.j): int(r.total) for r in totals.collect()}


def covariance(rows: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """Size, integer sums, and n * n times the covariance, as integers of any size."""
    seen = Observation()
    sums = _summed(rows.observe(seen, F.count("*").alias("n")), None)
    n = seen.get["n"] if sums else 0
    s = [sums[-1, j] for j in range(len(sums))]
    if not n:
        return 0, [], np.zeros((0, 0), object)
    centre = np.array([(2 * v + n) // (2 * n) for v in s], np.int64)
    products = _summed(rows, centre)
    # What is left of the mean once its nearest integer is taken off.
    rest = np.array([v - n * int(c) for v, c in zip(s, centre)], object)
    scaled = np.zeros((len(s), len(s)), object)
    for (i, j), v in products.items():
        scaled[i, j] = scaled[j, i] = n * v - rest[i] * rest[j]
    return n, s, scaled


def _norm(m: np.ndarray) -> np.longdouble:
    """A bound of the spectral norm."""
    return np.longdouble(np.linalg.norm(m.astype(np.float64)))


def _correction(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.longdouble]:
    """(correction, eigenvalues, the distance below which two eigenvalues count as one) of approximate eigenvectors x."""
    r = np.eye(len(a), dtype=np.longdouble) - x.T @ x
    s = x.T @ (a @ x)
    s = (s + s.T) / 2  # else rounding, divided by small gaps, would cost orthogonality
    values = np.diag(s) / (1 - np.diag(r))
    apart = 2 * (_norm(s - np.diag(values)) + _norm(a) * _norm(r))
    gaps = values[None, :] - values[:, None]
    far = np.abs(gaps) > apart
    with np.errstate(divide="ignore", invalid="ignore"):
        e = np.where(far, (s + values[None, :] * r) / np.where(far, gaps, 1), r / 2)
    return e, values, apart


def _clusters(values: np.ndarray, apart: np.longdouble) -> list[np.ndarray]:
    """Indices of eigenvalues that follow each other within `apart`, where there is more than one."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > apart) + 1
    return [group for group in np.split(order, cuts) if len(group) > 1]


def refined(a: np.ndarray, x: np.ndarray, iterations: int = ITERATIONS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors) of the symmetric `a` from approximate eigenvectors, by falling eigenvalue.

    Everything is computed in extended precision but the eigenvectors of clusters: those take the matrix of the cluster, which is
    small, shifted by the mean eigenvalue and scaled, so a double's precision counts from the cluster's width.
    """
    a = a.astype(np.longdouble)
    x = x.astype(np.longdouble)
    least = np.finfo(np.longdouble).eps * len(a)
    before, stalled = np.inf, 0
    for turn in range(iterations):
        e, values, apart = _correction(a, x)
        x = x + x @ e
        moved = np.abs(e).max(initial=0)
        if turn + 1 < iterations:
            for group in _clusters(values, apart):
                own = x[:, group]
                shift = values[group].mean()
                inner = own.T @ (a @ own) - shift * (own.T @ own)
                inner = (inner + inner.T) / 2
                width = np.abs(inner).max()
                # Narrower than what the matrix itself can tell: any basis of the cluster is as good.
                if width <= least * np.abs(values).max():
                    continue
                turned = np.linalg.eigh((inner / width).astype(np.float64))[1].astype(np.longdouble)
                x[:, group] = own @ turned
                moved = max(moved, np.abs(np.abs(turned).max(axis=0) - 1).max())
        stalled = stalled + 1 if moved > before / 2 else 0
        if moved <= least or stalled == 3:
            break
        before = moved
    e, values, _ = _correction(a, x)
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


def fit(rows: DataFrame, components: int = COMPONENTS) -> Fit:
    """Covariance of the sound `rows` and its leading components. Components without variance are left out."""
    n, sums, scaled = covariance(rows)
    if not n:
        return Fit(0, (), np.zeros((0, 0)), np.zeros(0), np.zeros(0))
    # Two doubles hold what one long double does, and more than one double does.
    high = scaled.astype(np.float64)
    low = np.array([[float(v - int(h)) for v, h in zip(*row)] for row in zip(scaled, high)])
    v = (high.astype(np.longdouble) + low) / (np.longdouble(n) * n)
    trace = np.trace(v)
    if trace <= 0:
        return Fit(n, tuple(sums), np.zeros((len(sums), 0)), np.zeros(0), np.zeros(0))
    start = np.linalg.eigh((v / trace).astype(np.float32))[1]
    values, vectors = refined(v / trace, start)
    vectors = vectors / np.sqrt((vectors * vectors).sum(axis=0))
    real = int((values[:components] > 4 * np.finfo(np.longdouble).eps * len(sums)).sum())
    return Fit(
        n,
        tuple(sums),
        vectors[:, :real].astype(np.float64),
        (values[:real] * trace).astype(np.float64),
        values[:real].astype(np.float64),
    )


def project(rows: DataFrame, fitted: Fit) -> DataFrame:
    """vec_id, deviation and the whitened components of every sound row."""
    n, sums = fitted.n, np.array(fitted.sums, object)
    largest = max((abs(v) for v in fitted.sums), default=0)
    turn = fitted.components / np.sqrt(fitted.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = integers(batch.column("embedding"))
            if n * int(np.abs(x).max()) + largest < 2**62:
                off = n * x - sums.astype(np.int64)
            else:
                off = n * x.astype(object) - sums
            most = int(np.abs(off).max())
            if most * most * off.shape[1] < 2**63:
                deviation = pa.array((off * off).sum(axis=1).astype(np.int64))
            else:
                exact = [sum(int(v) * int(v) for v in row) for row in off]
                deviation = pa.array([v if v < 2**63 else None for v in exact], pa.int64())
            white = (off / n).astype(np.float64) @ turn
            lists = pa.FixedSizeListArray.from_arrays(pa.array(white.ravel()), white.shape[1]) if white.shape[1] else None
            cells = pa.array([[]] * len(white), pa.list_(pa.float64())) if lists is None else lists.cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), deviation, cells], names=["vec_id", "deviation", "whitened"]
            )

    return rows.mapInArrow(run, WHITENED)


def identity_error(white: DataFrame, components: int) -> float:
    """The largest absolute entry of the whitened components' covariance minus the identity."""
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    entry = lambda i: F.col("whitened")[i]
    if not pairs:
        return 0.0
    found = white.agg(*[F.covar_pop(entry(i), entry(j)).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(value - (i == j)) for (i, j), value in zip(pairs, found))


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per remaining vector and component: vec_id, component (from 1), n, deviation, whitened, explained,
    identity_error.

    Vectors that are null or empty, hold a null, NaN or infinite entry, or one of 2**30 and more, are dropped, and so are those of another
    length than most have (of the longer one on a tie). Null ids and repeated rows are kept, each with rows of its own.
    Components without variance are left out: a single vector, or equal ones alone, give no rows, and vectors of d entries d
    components at most. deviation is null where it exceeds a long. Of equal eigenvalues any basis is taken, the same for all rows. An
    empty table gives no rows; other columns are ignored.
    """
    prepare(vectors.sparkSession)
    rows = sound(vectors)
    fitted = fit(rows, components)
    white = saved(project(rows, fitted), "whitened")
    error = identity_error(white, len(fitted.eigenvalues))
    explained = F.array(*[F.lit(float(v)) for v in fitted.explained]).cast("array<double>")
    return white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
