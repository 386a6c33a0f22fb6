"""Principal components and whitened coordinates of embeddings, by incremental eigendecomposition.

A task goes through its vectors one by one.  A vector moves the mean and adds one centred
outer product to the scatter matrix, so its eigenvalues are the roots of the secular
equation ``1 + rho * sum(z_i^2 / (d_i - t)) = 0``; entries of z that are nothing and equal
d_i are deflated before.  The spectra of the tasks are combined the same way, in levels: a
spectrum enters another as one outer product per eigenvector and one for the distance of
the means.  The result spans the space to some digits; Rayleigh-Ritz passes over all
vectors (centre, project, sum outer products, diagonalise, turn) take it to double
precision and measure what is left.

Vectors are fitted as whole numbers, each distinct one once; sums and deviations are
exact.  Only matrices of the vectors' width reach the driver.

Vectors that are null, hold null or non-finite entries, or entries of 2^24 or more in
magnitude take no part, nor do those whose length is not the commonest one (the longer
of two).  Repeated rows count once in the fit and each has its rows in the result; a null
id stays.  A component without variance has a null ``whitened``.  A deviation beyond
a long is null.  Equal eigenvalues have some orthonormal basis.  An empty table, or one
of empty vectors, gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import same, share, shared_value, stored

#: Entries become floor(GRAIN * c) + SHIFT.
GRAIN, SHIFT = 64, 1_000_000
LARGEST = float(1 << 24)
#: Spectra combined by one task, and passes of the refinement at most.
FAN_IN, PASSES = 8, 6
EPS = np.finfo(float).eps


class Spectrum:
    """Mean and eigendecomposition of the scatter matrix of the vectors seen."""

    def __init__(self, width: int) -> None:
        self.n = 0
        self.mean = np.zeros(width)
        self.values = np.zeros(width)
        self.vectors = np.eye(width)

    def add(self, x: np.ndarray) -> None:
        """One vector: a centred rank-one update."""
        away = x - self.mean
        self.n += 1
        self.mean += away / self.n
        self.update(away, (self.n - 1) / self.n)

    def combine(self, other: Spectrum) -> None:
        """Another spectrum, by one update per eigenvector and one for the means."""
        if not other.n:
            return
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.update(vector, value)
        both = self.n + other.n
        away = other.mean - self.mean
        self.update(away, self.n * (other.n / both))
        self.mean += away * (other.n / both)
        self.n = both

    def update(self, x: np.ndarray, rho: float) -> None:
        """Adds ``rho * x x'`` to the scatter matrix."""
        z = x @ self.vectors
        size = rho * (z @ z)
        if not size > 0:
            return
        d, q = self.values, self.vectors
        tiny = 8 * EPS * max(d[-1], size)
        # Equal eigenvalues: a reflection leaves one of them all of z.
        gaps = np.diff(d) <= tiny
        if gaps.any():
            z, q = z.copy(), q.copy()
            for run in np.split(np.arange(len(d)), np.flatnonzero(~gaps) + 1):
                if len(run) > 1:
                    part = z[run]
                    norm = np.linalg.norm(part)
                    mirror = part.copy()
                    mirror[-1] += norm if part[-1] >= 0 else -norm
                    length = mirror @ mirror
                    if length > 0:
                        q[:, run] -= np.outer(q[:, run] @ mirror, mirror * (2 / length))
                        z[run] = 0
                        z[run[-1]] = -norm if part[-1] >= 0 else norm
        live = np.flatnonzero(np.abs(z) * np.sqrt(rho * size) > tiny)
        if not len(live):
            return
        values, turn = rank_one(d[live], z[live], rho)
        new_d = d.copy()
        new_d[live] = values
        new_q = q.copy()
        new_q[:, live] = q[:, live] @ turn
        order = np.argsort(new_d, kind="stable")
        self.values, self.vectors = new_d[order], new_q[:, order]


def rank_one(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of ``diag(d) + rho * z z'``, d rising and distinct, z without zeros.

    Root i lies between d_i and d_(i+1).  It is sought as its distance from the nearer of
    the two, by steps of a two-pole model of the equation, halving the bracket where a
    step leaves it.
    """
    k = len(d)
    weight = rho * z * z
    upper = np.append(d[1:], d[-1] + weight.sum())
    middle = (d + upper) / 2
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        at_middle = 1 + (weight / (d - middle[:, None])).sum(1)
        right = at_middle < 0
        right[-1] = False
        origin = np.where(right, upper, d)
        poles = d - origin[:, None]  # row i: the poles seen from the origin of root i
        low = np.where(right, middle - upper, 0.0)
        high = np.where(right, 0.0, np.where(at_middle < 0, upper - d, middle - d))
        low[-1] = middle[-1] - d[-1] if at_middle[-1] < 0 else 0.0
        left_pole, right_pole = d - origin, upper - origin
        below = np.tri(k, dtype=bool)
        # First guess: the two poles beside the root exactly, the others as seen from the middle.
        gap, after = upper - d, np.append(weight[1:], 0.0)
        rest = at_middle - weight / (d - middle) - after / (upper - middle)
        rest[-1] = at_middle[-1] - weight[-1] / (d[-1] - middle[-1])
        at = _root(rest, np.where(right, -1, 1) * rest * gap + weight + after, np.where(right, -after, weight) * gap, right)
        at = np.where((at > low) & (at < high), at, (low + high) / 2)
        for _ in range(80):
            apart = poles - at[:, None]
            terms = weight / apart
            slopes = terms / apart
            f = 1 + terms.sum(1)
            low = np.where(f < 0, at, low)
            high = np.where(f >= 0, at, high)
            noise = EPS * k * (1 + np.abs(terms).sum(1))
            found = (np.abs(f) <= noise) | (high - low <= 2 * EPS * np.abs(at))
            if found.all():
                break
            psi, phi = np.where(below, slopes, 0).sum(1), np.where(below, 0, slopes).sum(1)
            a, b = left_pole - at, right_pole - at
            c = f - a * psi - b * phi
            g = (a + b) * f - a * b * (psi + phi)
            h = a * b * f
            to = at + _root(c, g, h, False)
            at = np.where(found, at, np.where((to >= low) & (to <= high), to, (low + high) / 2))
        values = origin + at
        # z is made anew from the roots found, so that the eigenvectors are orthogonal.
        apart = at[:, None] - poles  # row j, column i: root j less pole i
        ratio = apart / np.where(np.eye(k, dtype=bool), 1, d[:, None] - d)
        made = np.sqrt(np.abs(np.prod(ratio, axis=0))) * np.sign(z)
        vectors = made / -apart
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    return values, vectors.T


def _root(a: np.ndarray, b: np.ndarray, c: np.ndarray, larger) -> np.ndarray:
    """The root of ``a t^2 - b t + c`` that lies between the poles, without cancellation."""
    root = np.sqrt(np.maximum(b * b - 4 * a * c, 0))
    small = np.where(b <= 0, (b - root) / (2 * a), 2 * c / (b + root))
    large = np.where(b < 0, 2 * c / (b - root), (b + root) / (2 * a))
    return np.where(larger, large, small)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id and x, the entries as whole numbers less SHIFT, of the rows that take part."""
    entries = F.col("embedding").cast("array<double>")
    good = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    rows = embeddings.filter(F.col("embedding").isNotNull() & good).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(entries, lambda c: F.when(F.abs(c) < LARGEST, F.floor(c * GRAIN)).try_cast("int")).alias("x"),
    )
    return rows.filter(F.size("x") > 0)


def sums_of(fit: DataFrame, width: int) -> tuple[int, np.ndarray]:
    """Number of vectors and their exact sums."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(width, np.int64)
        for b in batches:
            x = _matrix(b.column(0), width)
            n, total = n + len(x), total + x.sum(0, dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-1, width), pa.int32()), pa.array([n, *total.tolist()], pa.int64())], ["at", "s"]
        )

    rows = fit.select("x").mapInArrow(summed, "at int, s long").groupBy("at").agg(F.sum("s").alias("s")).collect()
    found = {r["at"]: r["s"] for r in rows}
    return found.get(-1, 0), np.array([found.get(i, 0) for i in range(width)], object)


SPECTRUM_TYPE = "at long, n long, mean array<double>, d array<double>, q array<double>"


def _spectrum_row(at: int, s: Spectrum) -> dict:
    return {"at": at, "n": s.n, "mean": s.mean.tolist(), "d": s.values.tolist(), "q": s.vectors.ravel().tolist()}


def _spectrum(row) -> Spectrum:
    out = Spectrum(len(row["mean"]))
    out.n, out.mean, out.values = int(row["n"]), np.array(row["mean"], float), np.array(row["d"], float)
    out.vectors = np.array(row["q"], float).reshape(len(out.mean), -1)
    return out


def incremental(fit: DataFrame, width: int) -> Spectrum:
    """The spectrum of all vectors: one per task, then combined in levels."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        found = Spectrum(width)
        for b in batches:
            for x in _matrix(b.column(0), width).astype(float):
                found.add(x)
        if found.n:
            yield pa.RecordBatch.from_pylist([_spectrum_row(TaskContext.get().partitionId(), found)], schema=arrow)

    arrow = pa.schema(
        [("at", pa.int64()), ("n", pa.int64()), *[(c, pa.list_(pa.float64())) for c in ("mean", "d", "q")]]
    )

    def combined(key, rows):
        import pandas as pd

        spectra = [_spectrum(row) for _, row in rows.sort_values("at").iterrows()]
        return pd.DataFrame([_spectrum_row(key[0], reduce(lambda a, b: a.combine(b) or a, spectra))])

    spectra = stored(fit.select("x").mapInArrow(partial, SPECTRUM_TYPE))
    last = spectra.agg(F.max("at")).first()[0]
    while last:
        spectra = spectra.groupBy(F.expr(f"at div {FAN_IN}").alias("to")).applyInPandas(combined, SPECTRUM_TYPE)
        last //= FAN_IN
    return _spectrum(spectra.first())


def projected_covariance(fit: DataFrame, mean: np.ndarray, basis: np.ndarray, n: int) -> np.ndarray:
    """Covariance (divisor n) of the centred vectors in the coordinates of ``basis``."""
    width = len(mean)
    shared = share(fit.sparkSession, same, (mean, basis))
    upper = np.triu_indices(width)

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, turn = shared_value(shared)
        total = np.zeros((width, width))
        for b in batches:
            p = (_matrix(b.column(0), width) - centre) @ turn
            total += p.T @ p
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(upper[0])), pa.int32()), pa.array(total[upper])], ["at", "s"]
        )

    rows = fit.select("x").mapInArrow(outer, "at int, s double").groupBy("at").agg(F.sum("s").alias("s")).collect()
    out = np.zeros((width, width))
    for r in rows:
        i, j = upper[0][r["at"]], upper[1][r["at"]]
        out[i, j] = out[j, i] = r["s"] / n
    return out


def left_over(covariance: np.ndarray, most: int | None = None) -> float:
    """Largest entry of the whitened covariance less the identity, over components with variance."""
    e = np.diag(covariance)[:most]
    with_variance = np.flatnonzero(varies(np.diag(covariance))[:most])
    if not len(with_variance):
        return 0.0
    scale = np.sqrt(e[with_variance])
    white = covariance[np.ix_(with_variance, with_variance)] / np.outer(scale, scale)
    return float(np.abs(white - np.eye(len(scale))).max())


def varies(e: np.ndarray) -> np.ndarray:
    return e > max(e.max(initial=0), 0) * len(e) * EPS * 64


def refine(fit: DataFrame, mean: np.ndarray, basis: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rayleigh-Ritz passes: the basis turned to the components, and their measured covariance."""
    best, least = None, np.inf
    for _ in range(PASSES):
        basis = np.linalg.qr(basis)[0]
        covariance = projected_covariance(fit, mean, basis, n)
        left = left_over(covariance)
        if left < least:
            best, least = (basis, covariance), left
        if left <= 1e-12 or left > least:
            break
        basis = basis @ np.linalg.eigh(covariance)[1][:, ::-1]
    basis, covariance = best
    order = np.argsort(-np.diag(covariance), kind="stable")
    return basis[:, order], covariance[np.ix_(order, order)]


RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whiten(embeddings: DataFrame, most: int = 16) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error, as told at the top."""
    spark = embeddings.sparkSession
    rows = whole_vectors(embeddings)
    lengths = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if lengths is None:
        return spark.createDataFrame([], RESULT)
    width = lengths["width"]
    rows = rows.filter(F.size("x") == width)
    fit = stored(rows.select("x").distinct())
    n, sums = sums_of(fit, width)
    mean = np.array([float(s) / n for s in sums])
    basis, covariance = refine(fit, mean, incremental(fit, width).vectors[:, ::-1], n)
    e = np.maximum(np.diag(covariance), 0)
    kept = min(most, width)
    error = left_over(covariance, kept)
    trace = float(e.sum())
    with np.errstate(divide="ignore"):
        scale = np.where(varies(e), 1 / np.sqrt(e), np.nan)[:kept]
    explained = (e / trace if trace > 0 else np.full(width, np.nan))[:kept]
    shared = share(spark, same, (sums, mean, basis[:, :kept] * scale, explained))

    def coordinates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, centre, turn, part = shared_value(shared)
        small = np.array([abs(s) < 1 << 62 for s in sums]).all() and sums.astype(np.int64)
        for b in batches:
            x = _matrix(b.column(1), width)
            white = ((x - centre) @ turn).ravel()
            # In machine words where they hold the sum of squares, else in Python's numbers.
            reach = n * float(np.abs(x).max(initial=0)) + max(map(abs, map(float, sums)))
            if width * reach * reach < 2.0**62:
                away = ((x * np.int64(n) - small) ** 2).sum(1).tolist()
            else:
                away = [sum((n * v - s) ** 2 for v, s in zip(r, sums.tolist())) for r in x.tolist()]
                away = [a if a < 1 << 63 else None for a in away]
            k = turn.shape[1]
            repeat = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(pa.array(repeat)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(repeat), n, np.int64)),
                    pa.array(away, pa.int64()).take(pa.array(repeat)),
                    pa.array(white, mask=np.isnan(white)),
                    pa.array(np.tile(part, len(x)), mask=np.isnan(np.tile(part, len(x)))),
                    pa.array(np.full(len(repeat), error)),
                ],
                [c.split()[0] for c in RESULT.split(", ")],
            )

    return rows.mapInArrow(coordinates, RESULT)
