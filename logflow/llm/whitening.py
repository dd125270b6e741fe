"""Embedding whitening (11): pivoted Cholesky, then one-sided Jacobi.

Entries become whole numbers, x = floor(64 c) + 1000000.  The fit list has
each distinct vector once; its centred scatter is factored by Cholesky with
diagonal pivots, P V P' = L L', and one-sided Jacobi rotates the columns of
the triangular factor itself until they are orthogonal.  Their squared norms
are the eigenvalues of V, the normalised columns (rows back in place) its
components; neither V' V nor a general eigenvalue routine is needed.

Distinct vectors, sums and scatter are Spark aggregates; only numbers by
dimension or by pair of dimensions reach the driver.  Vectors are centred on
the rounded mean before they are multiplied, so the scatter is a sum of whole
numbers: it is exact, and the same however the rows are dealt or a lost task is
repeated.  The rest of the mean (at most 1/2) is taken off in fractions.

Rows whose vector is null or holds a null or non-finite entry are left out, as
are entries beyond 2^46, which have no exact x.  Vectors of another length
than most rows (ties: the longer) are left out; empty vectors too.  A null
vec_id is kept.  Repeated vectors count once in the fit list and each get their
rows.  Components belong to eigenvalues above ``RANK_TOLERANCE`` of the trace:
a table of one distinct vector, or an empty one, has none and gives no row.
Equal eigenvalues take the basis that Jacobi finds; signs make the largest
entry positive.  A deviation that does not fit a long is null.  Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logflow.llm._common import stored

SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 46)
RANK_TOLERANCE = 1e-12
#: Sums of whole numbers up to this are exact in doubles.
EXACT = 1 << 53


def whole(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id_col``, x (binary, little-endian 64-bit) of the rows that count."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda c: F.coalesce(F.abs(c.cast("double")) < LARGEST, F.lit(False)))
    rows = vectors.where(v.isNotNull() & (F.size(v) > 0) & finite).select(F.col(id_col), v.alias("v"))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    rows = rows.where(F.size("v") == (sizes[0].d if sizes else 0))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = [(np.floor(np.asarray(v, dtype=np.float64) * SCALE).astype("<i8") + SHIFT).tobytes() for v in pdf["v"]]
            yield pd.DataFrame({id_col: pdf[id_col], "x": x})

    return rows.mapInPandas(run, f"{id_col} {dict(vectors.dtypes)[id_col]}, x binary")


def _matrix(blobs: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), dtype="<i8").reshape(len(blobs), -1)


def _total(fit: DataFrame, part, value: str) -> dict[tuple[int, int], object]:
    """Sums over all tasks of the entries (i, j, value) that ``part`` makes
    of an iterator of matrices; (d + 1) d entries at most come back."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = part(_matrix(pdf["x"]) for pdf in batches if len(pdf))
        if found:
            yield pd.DataFrame(found, columns=["i", "j", "value"])

    rows = fit.mapInPandas(run, f"i int, j int, value {value}").groupBy("i", "j").agg(F.sum("value").alias("value"))
    return {(r.i, r.j): r.value for r in rows.collect()}


def pivoted_cholesky(a: np.ndarray, tolerance: float = RANK_TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """Triangular factor (d x rank) and pivots of a symmetric matrix without
    negative eigenvalues: a[pivots][:, pivots] = L L'."""
    a, d = a.copy(), len(a)
    pivots, l = np.arange(d), np.zeros((d, d))
    limit = tolerance * max(np.trace(a), 0.0) / max(d, 1)
    rest = np.diag(a).copy()
    for k in range(d):
        p = k + int(np.argmax(rest[k:]))
        if rest[p] <= limit:
            return l[:, :k], pivots
        for m in (pivots, rest):
            m[[k, p]] = m[[p, k]]
        l[[k, p]] = l[[p, k]]
        l[k, k] = np.sqrt(rest[k])
        below = slice(k + 1, d)
        l[below, k] = (a[pivots[below], pivots[k]] - l[below, :k] @ l[k, :k]) / l[k, k]
        rest[below] -= l[below, k] ** 2
    return l, pivots


def one_sided_jacobi(l: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """``l`` with its columns rotated until each two are orthogonal.  A round
    rotates disjoint pairs together; d - 1 rounds (a sweep) meet all pairs."""
    a, n = l.copy(), l.shape[1]
    if n < 2:
        return a
    seats = list(range(n + n % 2))
    for _ in range(sweeps):
        worst = 0.0
        for _ in range(len(seats) - 1):
            half = len(seats) // 2
            pairs = [(p, q) for p, q in zip(seats[:half], reversed(seats[half:])) if p < n and q < n]
            p, q = (np.asarray(s) for s in zip(*pairs))
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            size = np.sqrt(xx * yy)
            off = np.divide(np.abs(xy), size, out=np.zeros_like(size), where=size > 0)
            worst = max(worst, off.max())
            turn = off > 1e-16
            zeta = np.divide(yy - xx, 2 * xy, out=np.zeros_like(xy), where=turn)
            t = np.where(turn, np.where(zeta < 0, -1, 1) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta)), 0.0)
            c = 1 / np.sqrt(1 + t * t)
            a[:, p], a[:, q] = c * x - c * t * y, c * t * x + c * y
            seats = [seats[0], seats[-1], *seats[1:-1]]
        if worst < 1e-15:
            break
    return a


@dataclass
class Whitening:
    """n vectors of the fit list, exact sums by dimension, trace of V, and
    the components (columns) by falling eigenvalue."""
    n: int
    sums: list[int]
    trace: float
    eigenvalues: np.ndarray
    components: np.ndarray

    def __post_init__(self) -> None:
        mean = [Fraction(s, self.n) for s in self.sums] if self.n else []
        self.centre = np.asarray([round(m) for m in mean], dtype=np.int64)
        self.rest = np.asarray([float(m - round(m)) for m in mean])
        # n x - S = n (x - centre) - offset
        self.offset = [s - self.n * int(c) for s, c in zip(self.sums, self.centre)]

    def whitened(self, x: np.ndarray, k: int) -> np.ndarray:
        """Rows of x, centred, projected and scaled to variance 1."""
        return ((x - self.centre) - self.rest) @ self.components[:, :k] / np.sqrt(self.eigenvalues[:k])

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact."""
        z = x - self.centre
        reach = self.n * (int(np.abs(z).max(initial=0)) + 1)
        if reach * reach * max(x.shape[1], 1) < 1 << 63:
            t = self.n * z - np.asarray(self.offset, dtype=np.int64)
            return (t * t).sum(axis=1).tolist()
        t = [sum((self.n * a - o) ** 2 for a, o in zip(row, self.offset)) for row in z.tolist()]
        return [v if v < 1 << 63 else None for v in t]


def fit_whitening(fit: DataFrame) -> Whitening:
    """Whitening of a table of distinct x vectors (column ``x``, as ``whole``
    makes them)."""
    first = fit.first()
    if first is None:
        return Whitening(0, [], 0.0, np.zeros(0), np.zeros((0, 0)))
    d = len(first.x) // 8

    def sums(parts: Iterator[np.ndarray]) -> list[tuple[int, int, int]]:
        n, total = 0, np.zeros(d, dtype=object)
        for x in parts:
            n, total = n + len(x), total + x.astype(object).sum(axis=0)
        return [(-1, -1, n), *((-1, j, int(v)) for j, v in enumerate(total))] if n else []

    found = {k: int(v) for k, v in _total(fit, _decimals(sums), "decimal(38,0)").items()}
    n = found.pop((-1, -1))
    s = [found[-1, j] for j in range(d)]
    centre = np.asarray([round(Fraction(v, n)) for v in s], dtype=np.int64)
    upper = np.triu_indices(d)

    def scatter(parts: Iterator[np.ndarray]) -> list[tuple[int, int, int]]:
        total, any_ = np.zeros(len(upper[0]), dtype=object), False
        for x in parts:
            any_, z = True, x - centre
            reach = int(np.abs(z).max())
            step = max(1, EXACT // max(reach * reach, 1))
            if reach * reach < EXACT:  # whole numbers, exact in doubles
                for k in range(0, len(z), step):
                    part = z[k:k + step].astype(np.float64)
                    total = total + (part.T @ part)[upper].astype(np.int64).astype(object)
            else:
                part = z.astype(object)
                total = total + (part.T @ part)[upper]
        return [(int(i), int(j), int(v)) for i, j, v in zip(*upper, total)] if any_ else []

    found = {k: int(v) for k, v in _total(fit, _decimals(scatter), "decimal(38,0)").items()}
    # off the rounded mean: subtract the rest, exactly
    rest = [Fraction(v, n) - int(c) for v, c in zip(s, centre)]
    v = np.zeros((d, d))
    for (i, j), total in found.items():
        v[i, j] = v[j, i] = float(Fraction(total, n) - rest[i] * rest[j])
    factor, pivots = pivoted_cholesky(v)
    turned = np.zeros((d, factor.shape[1]))
    turned[pivots] = one_sided_jacobi(factor)
    e = (turned * turned).sum(axis=0)
    order = np.argsort(-e, kind="stable")
    order = order[e[order] > RANK_TOLERANCE * np.trace(v)]
    parts = turned[:, order] / np.sqrt(e[order])
    parts *= np.where(parts[np.abs(parts).argmax(axis=0), np.arange(len(order))] < 0, -1.0, 1.0) if len(order) else 1.0
    return Whitening(n, s, float(np.trace(v)), e[order], parts)


def _decimals(part):
    """``part`` with values that Arrow takes as decimals."""
    from decimal import Decimal
    return lambda rows: [(i, j, Decimal(v)) for i, j, v in part(rows)]


def identity_error(fit: DataFrame, w: Whitening, k: int) -> float:
    """Largest absolute entry of the covariance of the whitened fit list
    minus the identity, measured on the rows."""
    def moments(parts: Iterator[np.ndarray]) -> list[tuple[int, int, float]]:
        total = None
        for x in parts:
            y = w.whitened(x, k)
            part = np.vstack([y.sum(axis=0), y.T @ y])
            total = part if total is None else total + part
        return [] if total is None else [(i - 1, j, float(total[i, j])) for i in range(k + 1) for j in range(k)]

    if not k:
        return 0.0
    found = _total(fit, moments, "double")
    mean = np.asarray([found[-1, j] for j in range(k)]) / w.n
    cov = np.asarray([[found[i, j] for j in range(k)] for i in range(k)]) / w.n - np.outer(mean, mean)
    return float(np.abs(cov - np.eye(k)).max())


def whiten(vectors: DataFrame, *, components: int = 16, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """For each row that counts and each component: ``id_col``, component, n,
    deviation, whitened, explained, identity_error."""
    rows = whole(vectors, id_col, vector_col)
    fit = stored(rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies")).select("x"), "fit-list")
    w = fit_whitening(fit)
    k = min(components, len(w.eigenvalues))
    error = identity_error(fit, w, k)
    explained = w.eigenvalues[:k] / w.trace if k else np.zeros(0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf) or not k:
                continue
            x, m = _matrix(pdf["x"]), len(pdf)
            yield pd.DataFrame({
                id_col: pdf[id_col].repeat(k), "component": np.tile(np.arange(1, k + 1), m), "n": w.n,
                "deviation": pd.array(w.deviation(x), dtype="Int64").repeat(k), "whitened": w.whitened(x, k).ravel(),
                "explained": np.tile(explained, m), "identity_error": error})

    return rows.mapInPandas(run, f"{id_col} {dict(vectors.dtypes)[id_col]}, component int, n long, deviation long, "
                                 "whitened double, explained double, identity_error double")
