"""Embedding whitening by pivoted Cholesky and one-sided Jacobi, on exact moments.

A vector's entries become integers x = floor(scale * c) + shift. The model is
fitted on the distinct x vectors (one hash aggregate on packed bytes, combined
before its shuffle, so copies of one vector never gather in a task):

1. their number and sums, then the products of x - m, where m is the integer
   part of the mean. Tasks multiply limbs of 21 bits in double precision, where
   such products are exact, and Spark adds the tasks' sums as decimals, so the
   scatter around the true mean is an exact integer whatever the partitioning.
2. the covariance V, rounded once, is factored as P V P' = L L' with the largest
   remaining diagonal entry as the next pivot,
3. one-sided Jacobi rotates pairs of columns of the triangular factor itself
   until all are orthogonal. As V is then (LJ)(LJ)', the squared column norms are
   its eigenvalues and the normalised columns its components. Each round takes
   disjoint pairs, so it is a few array operations.

Only numbers of dimensions squared reach the driver, whatever the row count.

Defined results: rows whose vector is null, holds null or non-finite entries, or
has another length than most vectors have (of equally frequent lengths, the
longest), are dropped. Ids may be null or repeat: each row left gives its own
rows. 64 c saturates at 2**61. A table without spread, or with a single distinct
vector, has no component and gives no rows; so does an empty table. Components
whose variance is below ``RANK`` of the largest are left out, as rounding rules
them; equal eigenvalues leave their components' directions open, with the same
choice for all rows. ``deviation`` is null where it does not fit a long;
``deviation_exact`` has 38 digits. Very long vectors cost their length squared on
the driver and in a task. Extra columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import pin

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
MOST = 1 << 61  # largest absolute x less the shift
LIMB = 21  # bits of a limb: products of two and the sums of a chunk of them are exact in double precision
CHUNK = 1 << 10  # rows whose products are added in double precision
RANK = 1e-11
SWEEPS = 60
LONG = (1 << 63) - 1
WHITENED = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
            "identity_error double, deviation_exact decimal(38,0)")
EXACT = pa.decimal128(38, 0)


def integers(c: np.ndarray) -> np.ndarray:
    """x of finite entries."""
    c = np.floor(c.astype(np.float64) * SCALE)
    return np.clip(c, -float(MOST), float(MOST)).astype(np.int64) + SHIFT


def packed(x: np.ndarray) -> list[bytes]:
    """Each row as bytes: entries less the shift, 16 bits each if all of the row fit, else 64."""
    x = x - SHIFT
    small = (np.abs(x) < 1 << 15).all(axis=1)
    short, wide = x.astype("<i2"), x.astype("<i8")
    return [(short if s else wide)[i].tobytes() for i, s in enumerate(small.tolist())]


def unpacked(keys: list[bytes], dims: int) -> np.ndarray:
    out = np.empty((len(keys), dims), dtype=np.int64)
    for i, k in enumerate(keys):
        out[i] = np.frombuffer(k, "<i2" if len(k) == 2 * dims else "<i8")
    return out + SHIFT


def limbs(y: np.ndarray) -> list[np.ndarray]:
    """y as a sum of limbs times powers of 2**LIMB; the last one has the sign."""
    if not y.size or np.abs(y).max() < 1 << LIMB:
        return [y]
    low = (1 << LIMB) - 1
    return [y & low, y >> LIMB & low, y >> 2 * LIMB]


def vectors_of(rows: DataFrame, vector_col: str, dims: int) -> DataFrame:
    """``rows`` with a usable vector."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    return rows.where(v.isNotNull() & (F.size(v) == dims)).where(finite)


def dimensions(rows: DataFrame, vector_col: str) -> int:
    v = F.col(vector_col)
    top = (rows.where(v.isNotNull()).groupBy(F.size(v).alias("size")).count()
           .orderBy(F.desc("count"), F.desc("size")).first())
    return top["size"] if top else 0


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def distinct_vectors(rows: DataFrame, vector_col: str, dims: int) -> DataFrame:
    """(key): each distinct x vector once, packed; written to the shared folder, as it is read three times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(packed(integers(matrix(b.column(0), dims))), pa.binary())], ["key"])

    return pin(rows.select(vector_col).mapInArrow(run, "key binary").distinct(), "vectors")


def totals(vectors: DataFrame, dims: int, of: Callable[[np.ndarray], Iterator[tuple[tuple[int, int], np.ndarray]]],
           exact: bool = True) -> dict[tuple[int, int, int], int]:
    """Sums over all vectors of the matrices that ``of`` gives for a chunk, as {(2 * power + kind, i, j): entry}.

    ``of`` yields ((kind, power), matrix): kind 0 is a row of sums, kind 1 a symmetric matrix, power that of
    2**LIMB. Each task adds its chunks' matrices and sends every entry once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        for b in batches:
            keys = b.column(0).to_pylist()
            for at in range(0, len(keys), CHUNK):
                for name, m in of(unpacked(keys[at:at + CHUNK], dims)):
                    m = np.rint(m).astype(np.int64).astype(object) if exact else m
                    held[name] = held[name] + m if name in held else m
        cols: list[list] = [[], [], [], []]
        for (kind, power), m in held.items():
            i, j = np.triu_indices(*m.shape[:1], m=m.shape[1]) if kind else (np.zeros(m.shape[1], int), np.arange(m.shape[1]))
            for c, v in zip(cols, ([2 * power + kind] * len(i), i.tolist(), j.tolist(), m[i, j].tolist()), strict=True):
                c += v
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int32()) for c in cols[:3]), pa.array(cols[3], EXACT if exact else pa.float64())],
            ["kind", "i", "j", "value"])

    kind = "decimal(38,0)" if exact else "double"
    got = (vectors.mapInArrow(run, f"kind int, i int, j int, value {kind}")
           .groupBy("kind", "i", "j").agg(F.sum("value").alias("value")).collect())
    return {(r["kind"], r["i"], r["j"]): int(r["value"]) if exact else r["value"] for r in got}


def sums_of(x: np.ndarray) -> Iterator:
    """Column sums by limb, and the number of rows as a further column."""
    for p, part in enumerate(limbs(x)):
        yield (0, p), part.sum(axis=0, keepdims=True)
    yield (0, 9), np.array([[len(x)]])


def products_of(centre: np.ndarray) -> Callable[[np.ndarray], Iterator]:
    def run(x: np.ndarray) -> Iterator:
        parts = [p.astype(np.float64) for p in limbs(x - centre)]
        for p, a in enumerate(parts):
            for q, b in enumerate(parts):
                yield (1, p + q), a.T @ b
    return run


def pivoted_cholesky(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order): v[order][:, order] = L L' with L lower triangular, as many columns as v has rank."""
    left, order = v.diagonal().copy(), np.arange(len(v))
    factor = np.zeros(v.shape)
    least = len(v) * np.finfo(float).eps * left.max(initial=0.0)
    for k in range(len(v)):
        p = k + int(np.argmax(left[order[k:]]))
        order[[k, p]] = order[[p, k]]
        pivot, below = order[k], order[k + 1:]
        if left[pivot] <= least:
            return factor[order, :k], order
        factor[pivot, k] = np.sqrt(left[pivot])
        factor[below, k] = (v[below, pivot] - factor[below, :k] @ factor[pivot, :k]) / factor[pivot, k]
        left[below] -= factor[below, k] ** 2
    return factor[order], order


def rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of n columns as rounds of disjoint pairs."""
    ring, out = [*range(n), *([-1] if n % 2 else [])], []
    for _ in range(len(ring) - 1):
        pairs = [(a, b) for a, b in zip(ring[:len(ring) // 2], reversed(ring[len(ring) // 2:]), strict=True) if a >= 0 and b >= 0]
        out.append((np.array([a for a, _ in pairs]), np.array([b for _, b in pairs])))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out if n > 1 else []


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """``factor`` times a rotation, its columns orthogonal to working precision."""
    w = factor.copy()
    eps = np.finfo(float).eps
    for _ in range(SWEEPS):
        turned = False
        for p, q in rounds(w.shape[1]):
            a, b = w[:, p], w[:, q]
            aa, bb, ab = (a * a).sum(axis=0), (b * b).sum(axis=0), (a * b).sum(axis=0)
            do = np.abs(ab) > eps * np.sqrt(aa * bb)
            if not do.any():
                continue
            turned = True
            p, q, a, b, aa, bb, ab = p[do], q[do], a[:, do], b[:, do], aa[do], bb[do], ab[do]
            zeta = (bb - aa) / (2 * ab)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            c = 1 / np.hypot(1.0, t)
            w[:, p], w[:, q] = c * a - c * t * b, c * t * a + c * b
        if not turned:
            break
    return w


@dataclass
class Whitening:
    """A fitted model: exact moments of the distinct vectors, and components as rows."""

    n: int
    sums: list[int]
    centre: np.ndarray
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0

    def offsets(self) -> list[int]:
        """Sums of x - centre."""
        return [s - self.n * int(m) for s, m in zip(self.sums, self.centre, strict=True)]

    def project(self, x: np.ndarray) -> np.ndarray:
        """(x - mean) on each component, over the component's standard deviation."""
        rest = np.array([d / self.n for d in self.offsets()])
        return ((x - self.centre) - rest) @ (self.components / np.sqrt(self.eigenvalues)[:, None]).T

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sums over the dimensions of (n x - sums) ** 2, exact: with y = x - centre, of (n y - offset) ** 2."""
        y, d = x - self.centre, self.offsets()
        high, far = int(np.abs(y).max(initial=0)), max(map(abs, d), default=0)
        y = y if high * max(high, far) * len(d) < LONG and far < LONG else y.astype(object)
        yy, yd, dd = (y * y).sum(axis=1).tolist(), (y * np.array(d, dtype=y.dtype)).sum(axis=1).tolist(), sum(k * k for k in d)
        return [self.n * self.n * a - 2 * self.n * b + dd for a, b in zip(yy, yd, strict=True)]


def fit(rows: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The model of the distinct vectors; None without any."""
    dims = dimensions(rows, vector_col)
    vectors = distinct_vectors(vectors_of(rows, vector_col, dims), vector_col, dims) if dims else None
    got = totals(vectors, dims, sums_of) if dims else {}
    n = got.pop((18, 0, 0), 0)
    if not n:
        return None
    sums = [sum(got.get((2 * p, 0, j), 0) << LIMB * p for p in range(3)) for j in range(dims)]
    model = Whitening(n, sums, np.array([s // n for s in sums], dtype=np.int64), np.zeros(0), np.zeros((0, dims)), 0.0)
    got = totals(vectors, dims, products_of(model.centre))
    d, v = model.offsets(), np.zeros((dims, dims))
    for i in range(dims):
        for j in range(i, dims):
            whole = sum(got.get((2 * p + 1, i, j), 0) << LIMB * p for p in range(5))
            v[i, j] = v[j, i] = (n * whole - d[i] * d[j]) / (n * n)
    model.trace = float(v.trace())
    factor, order = pivoted_cholesky(v)
    turned = one_sided_jacobi(factor)
    norms = np.sqrt((turned * turned).sum(axis=0))
    by = np.argsort(-norms, kind="stable")
    by = by[norms[by] ** 2 > RANK * (norms.max(initial=0) ** 2)][:components]
    model.eigenvalues = norms[by] ** 2
    model.components = np.zeros((len(by), dims))
    model.components[:, order] = (turned[:, by] / norms[by]).T
    if len(by):
        model.identity_error = identity_error(vectors, dims, model)
    return model


def identity_error(vectors: DataFrame, dims: int, model: Whitening) -> float:
    """Largest absolute entry of the whitened distinct vectors' covariance minus the identity."""
    k = len(model.eigenvalues)

    def mean_of(x: np.ndarray) -> Iterator:
        yield (0, 0), model.project(x).sum(axis=0, keepdims=True)

    got = totals(vectors, dims, mean_of, exact=False)
    mean = np.array([got[0, 0, j] / model.n for j in range(k)])

    def squares_of(x: np.ndarray) -> Iterator:
        w = model.project(x) - mean
        yield (1, 0), w.T @ w

    got = totals(vectors, dims, squares_of, exact=False)
    return max(abs(value / model.n - (i == j)) for (_, i, j), value in got.items())


def whiten(rows: DataFrame, model: Whitening | None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable vector and component: see ``WHITENED``."""
    spark = rows.sparkSession
    if model is None or not len(model.eigenvalues):
        return spark.createDataFrame([], WHITENED)
    dims, k = model.components.shape[1], len(model.eigenvalues)
    explained = model.eigenvalues / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                b = whole.slice(at, CHUNK)
                x = integers(matrix(b.column(1), dims))
                own = model.deviations(x)
                take = pa.array(np.repeat(np.arange(len(x)), k))
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(take), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * k, model.n)),
                    pa.array([v if v <= LONG else None for v in own], pa.int64()).take(take),
                    pa.array(model.project(x).ravel()), pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(x) * k, model.identity_error)),
                    pa.array([v if v < 10 ** 38 else None for v in own], EXACT).take(take)],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_exact"])

    usable = vectors_of(rows, vector_col, dims)
    return usable.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col)).mapInArrow(run, WHITENED)
