"""Embedding whitening: an eigendecomposition that grows vector by vector, and the projection of every row on it.

Every partition of the distinct vectors keeps a *spectrum*: count, mean, eigenvalues and eigenvectors of its centred
scatter. A vector is a centred rank-one update of it: with the scatter's eigenvalues d and the vector's coordinates z in
its eigenvectors, the new eigenvalues are the roots of the secular equation 1 + sum(z_i^2 / (d_i - x)) = 0,
one in each gap of d; where a coordinate vanishes or two eigenvalues agree, that pair is deflated. Two spectra are
combined by the same update, once for every eigenvector of one of them and once for the distance of their means;
spectra meet in rounds of ``FAN`` so that no task gathers all. A last pass over the partitions projects the vectors on the
eigenvectors found and solves the small projected problem (Rayleigh-Ritz), which removes what rounding the updates gathered.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.common import Shared, stored

SCALE, SHIFT = 64, 1_000_000  # an entry c becomes the whole number floor(SCALE * c) + SHIFT
LARGEST = float(1 << 46)  # entries beyond would leave the whole numbers that a double holds
FAN = 16  # spectra that one task combines
EPS = np.finfo(np.float64).eps


def _secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(z2 / (d - x)) for ascending, distinct d and z2 > 0, as (nearest pole, offset from it).

    The j-th root lies between d[j] and the next pole (the last one up to d[-1] + sum(z2)). Offsets from the nearer pole keep full relative
    precision; each is found by interpolation with one pole on either side, inside a bracket that is bisected whenever a step leaves it.
    """
    k = len(d)
    upper = np.append(d[1:], d[-1] + z2.sum())
    gap = upper - d
    middle = 1 + (z2 / (d[None, :] - (d + gap / 2)[:, None])).sum(1)
    left = middle >= 0
    left[-1] = True  # no pole lies above the last root
    at = np.where(left, np.arange(k), np.minimum(np.arange(k) + 1, k - 1))
    far = d[None, :] - d[at][:, None]  # poles seen from each root's own pole
    low = np.where(left, np.where(middle >= 0, 0.0, gap / 2), -gap / 2)
    high = np.where(left, np.where(middle >= 0, gap / 2, gap), 0.0)
    x = (low + high) / 2
    below = np.tril(np.ones((k, k), bool))  # poles at or under the root
    done = np.zeros(k, bool)
    for _ in range(80):
        part = z2 / (far - x[:, None])
        value = 1 + part.sum(1)
        low, high = np.where(value < 0, x, low), np.where(value < 0, high, x)
        done |= (np.abs(value) <= 8 * EPS * (1 + np.abs(part).sum(1))) | (high - low <= 2 * EPS * np.abs(x))
        if done.all():
            break
        slope = part / (far - x[:, None])
        a, b = np.where(below, slope, 0).sum(1), np.where(below, 0, slope).sum(1)  # the slopes of both sides
        p, q = np.diagonal(far) - x, np.append(far[np.arange(k - 1), np.arange(1, k)], np.inf) - x
        # c + a p^2 / (p - y) + b q^2 / (q - y) = 0 agrees with the function in value and slope
        with np.errstate(all="ignore"):
            c = value - p * a - np.where(np.isinf(q), 0, q * b)
            last = p - a * p * p / -c  # one pole only
            mid = c * (p + q) + a * p * p + b * q * q
            root = np.sqrt(np.maximum(mid * mid - 4 * c * (p * q * c + a * p * p * q + b * q * q * p), 0))
            both = np.where(mid >= 0, mid + root, mid - root)
            y1, y2 = both / (2 * c), 2 * (p * q * c + a * p * p * q + b * q * q * p) / both
            step = np.where(np.isinf(q), last, np.where((x + y1 > low) & (x + y1 < high), y1, y2))
        new = x + step
        done |= np.abs(step) <= 2 * EPS * np.abs(x)
        x = np.where(done, x, np.where((new > low) & (new < high), new, (low + high) / 2))
    return at, x


class Spectrum:
    """Count, mean and eigenpairs (values ascending, vectors in columns) of the centred scatter of some vectors."""

    def __init__(self, dim: int):
        self.n, self.mean, self.values, self.vectors = 0, np.zeros(dim), np.zeros(dim), np.eye(dim)

    def add(self, x: np.ndarray) -> None:
        """One more vector."""
        apart = x - self.mean
        if self.n:
            self.rank_one(apart * np.sqrt(self.n / (self.n + 1)))
        self.n += 1
        self.mean = self.mean + apart / self.n

    def merge(self, other: Spectrum) -> None:
        """The vectors of ``other`` too: its eigenpairs one after the other, then the distance of the means."""
        if not other.n:
            return
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                self.rank_one(vector * np.sqrt(value))
        n, apart = self.n + other.n, other.mean - self.mean
        if self.n:
            self.rank_one(apart * np.sqrt(self.n * (other.n / n)))
        self.mean = self.mean + apart * (other.n / n)
        self.n = n

    def rank_one(self, v: np.ndarray) -> None:
        """The scatter plus v v'."""
        d, q = self.values, self.vectors
        z = q.T @ v
        size = z @ z
        if not size > 0:
            return
        tol = 8 * EPS * max(abs(d[-1]), size)
        # deflation: of two equal eigenvalues a rotation leaves one coordinate, a vanishing coordinate leaves its pair as it is
        rows = np.flatnonzero(np.abs(z) * np.sqrt(size) > tol)
        if len(rows) > 1 and np.diff(d[rows]).min() <= tol:
            kept = rows[0]
            for i in rows[1:]:
                if d[i] - d[kept] <= tol:
                    r = np.hypot(z[kept], z[i])
                    c, s = z[i] / r, z[kept] / r
                    q[:, [kept, i]] = q[:, [kept, i]] @ np.array([[c, s], [-s, c]])
                    z[kept], z[i] = 0.0, r
                kept = i
            rows = rows[np.abs(z[rows]) * np.sqrt(size) > tol]
        if not len(rows):
            return
        poles = d[rows]
        at, offset = _secular_roots(poles, z[rows] ** 2)
        # coordinates for which the roots found are exact, so that the new eigenvectors are orthogonal
        root_less_pole = (poles[at] - poles[:, None]) + offset[None, :]  # row: pole, column: root
        k = len(rows)
        under = poles[None, :] - poles[:, None]
        ratio = np.ones((k, k))
        for_lower = np.tril(np.ones((k, k), bool), -1)
        np.divide(root_less_pole, under, out=ratio, where=for_lower)  # roots under the pole against their own poles
        for_upper = np.triu(np.ones((k, k), bool))[:, : k - 1]
        np.divide(root_less_pole[:, :-1], under[:, 1:], out=ratio[:, :-1], where=for_upper)
        exact = np.sqrt(np.abs(ratio[:, :-1].prod(1) * root_less_pole[:, -1]))
        turn = exact[:, None] / -root_less_pole * np.where(z[rows] < 0, -1.0, 1.0)[:, None]
        turn /= np.sqrt((turn * turn).sum(0))
        q[:, rows] = q[:, rows] @ turn
        d[rows] = poles[at] + offset
        order = np.argsort(d, kind="stable")
        self.values, self.vectors = np.maximum(d[order], 0), q[:, order]


@dataclass(frozen=True)
class Basis:
    """What a row needs to be whitened: exact sums, and the components with their eigenvalues, largest first."""

    n: int
    sums: np.ndarray  # whole numbers, one per dimension
    values: np.ndarray
    vectors: np.ndarray  # a component per column
    total: float  # the trace of the covariance
    error: float = 0.0

    def apart(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exactly."""
        most = int(np.abs(x).max(initial=0)) * self.n + int(np.abs(self.sums).max(initial=0))
        return x * self.n - self.sums if most < 1 << 63 else x.astype(object) * self.n - self.sums.astype(object)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Coordinates of x less the mean in the components, one column each."""
        return (self.apart(x) / self.n).astype(np.float64) @ self.vectors


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, x): the rows that can take part, entries as whole numbers."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > LARGEST))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), F.coalesce(~bad, F.lit(False)).alias("fit"))
    rows = rows.where("fit").select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE) + SHIFT).alias("x"))
    shapes = rows.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    return rows.where(F.size("x") == (shapes[0].dim if shapes else 0))


def _matrix(pdf: pd.DataFrame, column: str) -> np.ndarray:
    return np.array(pdf[column].tolist())


def _spectra(fit: DataFrame, dim: int) -> DataFrame:
    """One spectrum per partition, with the exact sums of its vectors."""

    def run(batches):
        s, sums = Spectrum(dim), np.zeros(dim, object)
        for pdf in batches:
            x = _matrix(pdf, "x").astype(np.int64)
            for i in range(0, len(x), 1024):
                sums = sums + x[i : i + 1024].sum(0).astype(object)
            for row in x.astype(np.float64):
                s.add(row)
        if s.n:
            yield _row(s, sums, 0)

    return fit.select("x").mapInPandas(run, _SPECTRUM)


_SPECTRUM = "id long, n long, sums array<long>, mean array<double>, eigenvalues array<double>, eigenvectors array<double>"


def _row(s: Spectrum, sums: np.ndarray, id: int) -> pd.DataFrame:
    return pd.DataFrame({"id": [id], "n": [s.n], "sums": [[int(c) for c in sums]], "mean": [s.mean.tolist()], "eigenvalues": [s.values.tolist()], "eigenvectors": [s.vectors.ravel().tolist()]})


def _combined(spectra: DataFrame, dim: int) -> DataFrame:
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        total, sums = Spectrum(dim), np.zeros(dim, object)
        for r in pdf.sort_values("n", ascending=False, kind="stable").itertuples():
            s = Spectrum(dim)
            s.n, s.mean, s.values, s.vectors = r.n, np.array(r.mean), np.array(r.eigenvalues), np.array(r.eigenvectors).reshape(dim, dim)
            if total.n:
                total.merge(s)
            else:
                total = s
            sums = sums + np.array([int(c) for c in r.sums], object)
        return _row(total, sums, key[0])

    return spectra.groupBy("id").applyInPandas(run, _SPECTRUM)


def _second_moments(fit: DataFrame, basis: Shared, columns: int, scaled: bool) -> np.ndarray:
    """Mean of y y' over the fit list, y being the projections (over the roots of the eigenvalues, if ``scaled``).

    Every partition adds up its own matrix; entries are summed by Spark, so the driver sees one matrix.
    """

    def run(batches):
        total = np.zeros((columns, columns))
        for pdf in batches:
            for i in range(0, len(pdf), 4096):
                y = basis.value.project(_matrix(pdf.iloc[i : i + 4096], "x").astype(np.int64))
                y = y / np.sqrt(basis.value.values) if scaled else y
                total += y.T @ y
        yield pd.DataFrame({"i": np.arange(columns * columns), "s": total.ravel()})

    sums = fit.select("x").mapInPandas(run, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect()
    out = np.zeros(columns * columns)
    for r in sums:
        out[r.i] = r.s
    return out.reshape(columns, columns) / basis.value.n


def fit_basis(fit: DataFrame, components: int) -> Basis | None:
    """The covariance's components over the rows x of ``fit``: combined spectra, then Rayleigh-Ritz over all rows.

    Components whose eigenvalue is lost in rounding (rank deficiency) are left out. Their signs make the entry of
    largest size positive. None if ``fit`` has no rows or dimensions.
    """
    spark = fit.sparkSession
    first = fit.select(F.size("x").alias("dim")).first()
    if first is None or first.dim == 0:
        return None
    dim = first.dim
    spectra = stored(_spectra(fit, dim), "spectra")
    count = spectra.count()
    while count > 1:
        numbered = spectra.withColumn("id", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(-(-count // FAN))))
        spectra = stored(_combined(numbered, dim), "spectra")
        count = spectra.count()
    s = spectra.first()
    found = np.array(s.eigenvectors).reshape(dim, dim)[:, ::-1]
    basis = Basis(s.n, np.array(s.sums, np.int64), np.ones(dim), np.linalg.qr(found)[0], 0.0)
    shared = Shared(spark, basis)
    ritz = _second_moments(fit, shared, dim, False)
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    values, vectors = values[::-1], basis.vectors @ turn[:, ::-1]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(0), np.arange(dim)] < 0, -1.0, 1.0)
    keep = min(components, int((values > dim * 64 * EPS * max(values[0], 0)).sum())) if values[0] > 0 else 0
    basis = Basis(s.n, basis.sums, values[:keep], vectors[:, :keep], float(values.sum()))
    if keep == 0:
        return basis
    error = np.abs(_second_moments(fit, Shared(spark, basis), keep, True) - np.eye(keep)).max()
    return Basis(basis.n, basis.sums, basis.values, basis.vectors, basis.total, float(error))


def whiten(vectors: DataFrame, components: int = 16) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): every row on each of the first components.

    ``vectors`` has vec_id and embedding; an entry c counts as floor(64 c) + 1000000. The covariance is that of the
    distinct vectors (n of them, with sums S). ``deviation`` is the sum of (n x - S)^2, exact as long as it fits a long (beyond, an
    error, not a wrong number); ``whitened`` is x - S/n on the component, over the root of its eigenvalue; ``explained`` the
    eigenvalue's share of the trace; ``identity_error`` the largest difference of the whitened covariance, measured over all distinct vectors,
    from the identity. Rows take part unless their vector is null, empty, has another length than most (ties: the
    shortest), or holds a null, a NaN or an entry beyond 2^46 in size. Repeated rows come out as often as
    they stand, a null vec_id as null. Components without spread (fewer distinct vectors than dimensions) are left
    out, so one distinct vector, or an empty table, gives an empty result. Extra columns are ignored.
    """
    rows = stored(whole_vectors(vectors), "whole")
    # repeated vectors meet before the shuffle; a hot vector is one row of each task
    fit = stored(rows.select("x").distinct(), "fit")
    basis = fit_basis(fit, components)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if basis is None or not len(basis.values):
        return vectors.sparkSession.createDataFrame([], schema)
    shared = Shared(vectors.sparkSession, basis)

    def run(batches):
        b = shared.value
        k = len(b.values)
        for pdf in batches:
            for i in range(0, len(pdf), 1024):
                part = pdf.iloc[i : i + 1024]
                x = _matrix(part, "x").astype(np.int64)
                apart = b.apart(x)
                # squares of whole numbers: in 64 bits where the sum must fit, else in Python's
                small = apart.dtype != object and float(np.abs(apart).max()) ** 2 * apart.shape[1] < 2.0**62
                square = (apart * apart).sum(1) if small else [sum(int(c) * int(c) for c in row) for row in apart]
                white = b.project(x) / np.sqrt(b.values)
                yield pd.DataFrame(
                    {
                        "vec_id": part.vec_id.astype("Int64").repeat(k).array,
                        "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(part)),
                        "n": b.n,
                        "deviation": np.repeat(np.array(square, dtype=object if not small else np.int64), k),
                        "whitened": white.ravel(),
                        "explained": np.tile(b.values / b.total, len(part)),
                        "identity_error": b.error,
                    }
                )

    return rows.mapInPandas(run, schema)
