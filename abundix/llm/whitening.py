"""Whitening of embeddings along the leading eigenvectors of their covariance, found by spectrum slicing.

Entries become whole numbers, so counts, sums and products are exact and do not depend on the order in which
tasks finish: each task multiplies its part of the distinct vectors, shifted by the rounded mean, and Spark adds
the parts up.  The driver only sees one matrix of the vectors' dimension, however many vectors there are.

Eigenpairs of the covariance V are taken from its spectrum slice by slice:

1. *Counts.*  The factorisation P(V - sI)P' = LDL' with 1x1 and 2x2 pivots has as many positive pivots as V
   has eigenvalues above s (Sylvester's law of inertia).  Bisection on these counts encloses eigenvalue k in an
   interval with k - 1 eigenvalues above and, unless some are equal, no other within.
2. *Rayleigh quotient iteration* from the middle of the interval converges cubically to the eigenvector; if it
   leaves the interval, the interval is halved and it starts again.  Vectors found before are projected out.
3. *Certificate.*  Counts just above and just below the eigenvalue must enclose number k.

Defined cases: rows whose vector is null or holds null, NaN or infinite entries have no result; a shorter vector
is filled up with zeros to the longest one's length; equal vectors count once in the fit, and each of their
rows has a result, also rows that share an id or have none; directions without variance (up to rounding) are no
components, so fewer than ``COMPONENTS`` may come out, none at all for an empty table or equal vectors; entries
beyond the range of long count as its ends; a deviation beyond that range is null; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from abundix.llm import textbytes
from abundix.session import cut_lineage

COMPONENTS = 4
SCALE = 256

_EPS = float(np.finfo(np.float64).eps)
_LIMB = 62
_SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


class Whitening(NamedTuple):
    """What a fit has found: ``n`` distinct vectors, their sums per dimension, eigenpairs by falling eigenvalue (vectors
    as rows), V's trace, and the largest entry by which the covariance of the whitened vectors departs from the identity."""

    n: int
    total: list[int]
    eigenvalues: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def whole_numbers(embedding: Column) -> Column:
    """The entries as whole numbers of 1/256; null if an entry is missing or not finite."""
    finite = F.forall(embedding, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return F.when(finite, F.transform(embedding, lambda c: F.floor(c.cast("double") * SCALE).cast("long")))


def inertia(matrix: np.ndarray) -> tuple[int, int]:
    """How many eigenvalues of a symmetric matrix are positive, and how many negative, from its LDL' pivots."""
    a = matrix.copy()
    n, k, above, below = len(a), 0, 0, 0
    bound = (1 + 17**0.5) / 8  # keeps the growth of entries smallest

    def swap(i: int, j: int) -> None:
        if i != j:
            a[[i, j]] = a[[j, i]]
            a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        size = 1
        here = abs(a[k, k])
        column = np.abs(a[k + 1 :, k])
        largest = column.max() if len(column) else 0.0
        if here == 0 and largest == 0:
            k += 1
            continue
        if here < bound * largest:
            r = k + 1 + int(column.argmax())
            others = np.abs(a[r, k:])
            others[r - k] = 0
            widest = others.max()
            if here * widest < bound * largest * largest:
                if abs(a[r, r]) >= bound * widest:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    size = 2
        pivot = a[k : k + size, k : k + size].copy()
        rest = a[k + size :, k : k + size].copy()
        if size == 1:
            above += int(pivot[0, 0] > 0)
            below += int(pivot[0, 0] < 0)
            a[k + 1 :, k + 1 :] -= rest * (rest.T / pivot[0, 0])
        else:  # such a block has one eigenvalue on either side of zero
            above, below = above + 1, below + 1
            a[k + 2 :, k + 2 :] -= rest @ np.linalg.solve(pivot, rest.T)
        k += size
    return above, below


class _Spectrum:
    """Counts of eigenvalues above shifts, each worked out once."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.size = len(matrix)
        self.norm = float(np.abs(matrix).sum(axis=1).max(initial=0))
        self.rounding = 4 * _EPS * max(self.size, 1) * self.norm
        self.seen: dict[float, int] = {}

    def above(self, shift: float) -> int:
        if shift not in self.seen:
            self.seen[shift] = inertia(self.matrix - shift * np.eye(self.size))[0]
        return self.seen[shift]

    def enclose(self, k: int) -> tuple[float, float]:
        """The narrowest known interval around eigenvalue ``k``."""
        low = max((s for s, c in self.seen.items() if c >= k), default=-self.norm - self.rounding)
        high = min((s for s, c in self.seen.items() if c < k), default=self.norm + self.rounding)
        return low, high

    def halve(self, k: int) -> tuple[float, float]:
        low, high = self.enclose(k)
        self.above((low + high) / 2)
        return self.enclose(k)

    def isolate(self, k: int) -> tuple[float, float]:
        """An interval with eigenvalue ``k`` and, unless some are equal up to rounding, no other."""
        low, high = self.enclose(k)
        while high - low > self.rounding and (low not in self.seen or high not in self.seen or self.seen[low] - self.seen[high] > 1):
            low, high = self.halve(k)
        return low, high


def _iterate(spectrum: _Spectrum, shift: float, found: list[np.ndarray]) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from the eigenvalue next to ``shift``, orthogonal to the vectors found before."""
    v = np.cos(np.arange(1, spectrum.size + 1) * 2.3 + len(found))
    quotient = shift
    best = (np.inf, shift, v)
    for step in range(60):
        for _ in range(2):
            for u in found:
                v = v - (u @ v) * u
        v = v / np.linalg.norm(v)
        if step > 1:  # the first steps stay at the shift, so that the start does not matter
            quotient = float(v @ spectrum.matrix @ v)
            error = float(np.linalg.norm(spectrum.matrix @ v - quotient * v))
            if error >= best[0] / 2:
                break
            best = (error, quotient, v)
        shifted = spectrum.matrix - quotient * np.eye(spectrum.size)
        try:
            v = np.linalg.solve(shifted, v)
        except np.linalg.LinAlgError:
            v = np.linalg.solve(shifted + spectrum.rounding * np.eye(spectrum.size), v)
        if not np.isfinite(v).all():
            break
    return best[1], best[2]


def leading_eigenpairs(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest positive eigenvalues of a covariance matrix and their unit vectors (rows), certified by counts."""
    spectrum = _Spectrum(matrix.astype(np.float64))
    exact = matrix.astype(np.longdouble)
    values: list[float] = []
    found: list[np.ndarray] = []
    if spectrum.size == 0 or spectrum.norm == 0:
        return np.zeros(0), np.zeros((0, spectrum.size))
    for k in range(1, min(count, spectrum.above(spectrum.rounding)) + 1):
        low, high = spectrum.isolate(k)
        while True:
            value, v = _iterate(spectrum, (low + high) / 2, found)
            slack = 2 * spectrum.rounding
            if low - slack <= value <= high + slack and spectrum.above(value + slack) < k <= spectrum.above(value - slack):
                break
            if high - low <= spectrum.rounding:
                raise ArithmeticError(f"eigenvalue {k} can't be told from its neighbours")
            low, high = spectrum.halve(k)
        v = v if v[np.abs(v).argmax()] > 0 else -v
        wide = v.astype(np.longdouble)
        values.append(float(wide @ exact @ wide / (wide @ wide)))
        found.append(v)
    return np.array(values), np.array(found).reshape(len(found), spectrum.size)


def _rows(column: pa.Array, dimension: int) -> np.ndarray:
    """A column of lists as a matrix; shorter lists are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy()
    values = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == dimension).all():
        return values.reshape(len(lengths), dimension)
    out = np.zeros((len(lengths), dimension), dtype=np.int64)
    out[np.arange(dimension) < lengths[:, None]] = values
    return out


def _largest(x: np.ndarray) -> int:
    return max(-int(x.min()), int(x.max())) if x.size else 0


def _shifted(x: np.ndarray, times: int, less: list[int]) -> np.ndarray:
    """``times * x - less`` without overflow: as Python's integers where 64 bits might not do."""
    if _largest(x) * times + max(map(abs, less), default=0) < 1 << 62:
        return x * np.int64(times) - np.array(less, dtype=np.int64)
    return x.astype(object) * times - np.array(less, dtype=object)


def _gram(y: np.ndarray) -> np.ndarray:
    """Exact sums of products of the columns, as Python's integers."""
    out = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    size = _largest(y)
    step = (1 << 53) // max(1, size * size)
    if step < 16:
        wide = y.astype(object)
        return wide.T.dot(wide)
    for low in range(0, len(y), step):
        part = y[low : low + step].astype(np.float64)
        out += (part.T @ part).astype(np.int64).astype(object)
    return out


def _limbs(i: int, j: int, value: int) -> dict:
    return {"i": i, "j": j, "high": value >> _LIMB, "low": value & ((1 << _LIMB) - 1)}


_LIMB_SCHEMA = "i int, j int, high decimal(38,0), low decimal(38,0)"
_LIMB_ARROW = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("high", pa.decimal128(38, 0)), ("low", pa.decimal128(38, 0))])


def _added_up(parts: DataFrame) -> dict[tuple[int, int], int]:
    """The sums per place; at most as many as the matrix has places."""
    sums = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    return {(r.i, r.j): (int(r.high) << _LIMB) + int(r.low) for r in sums.collect()}


def _totals(vectors: DataFrame, dimension: int) -> tuple[int, list[int]]:
    """The number of vectors and their sum per dimension (place ``(-1, -1)`` counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dimension, dtype=object)
        for batch in batches:
            x = _rows(batch.column(0), dimension)
            small = _largest(x) * len(x) < 1 << 62
            n, total = n + len(x), total + (x if small else x.astype(object)).sum(axis=0).astype(object)
        rows = [_limbs(-1, -1, n), *(_limbs(i, i, int(t)) for i, t in enumerate(total))] if n else []
        yield pa.RecordBatch.from_pylist(rows, schema=_LIMB_ARROW)

    sums = _added_up(vectors.mapInArrow(textbytes.freeing(run), _LIMB_SCHEMA))
    return sums.get((-1, -1), 0), [sums.get((i, i), 0) for i in range(dimension)]


def _covariance(vectors: DataFrame, n: int, total: list[int]) -> np.ndarray:
    """The covariance (divisor n), every entry the exact quotient's nearest double."""
    dimension = len(total)
    middle = [(2 * t + n) // (2 * n) for t in total]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products = np.zeros((dimension, dimension), dtype=object)
        for batch in batches:
            products += _gram(_shifted(_rows(batch.column(0), dimension), 1, middle))
        rows = [_limbs(i, j, int(products[i, j])) for i in range(dimension) for j in range(i, dimension)] if products.any() else []
        yield pa.RecordBatch.from_pylist(rows, schema=_LIMB_ARROW)

    sums = _added_up(vectors.mapInArrow(textbytes.freeing(run), _LIMB_SCHEMA))
    left = [t - n * m for t, m in zip(total, middle)]
    out = np.zeros((dimension, dimension))
    for i in range(dimension):
        for j in range(i, dimension):
            out[i, j] = out[j, i] = (n * sums.get((i, j), 0) - left[i] * left[j]) / (n * n)
    return out


def _project(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """n times the centred vectors, and the whitened ones."""
    apart = _shifted(x, model.n, model.total)
    scale = (model.vectors / np.sqrt(model.eigenvalues)[:, None]).T
    return apart, (apart.astype(np.float64) / model.n) @ scale


def _identity_error(vectors: DataFrame, model: Whitening) -> float:
    k, dimension = len(model.eigenvalues), len(model.total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k + 1, k))
        for batch in batches:
            w = _project(_rows(batch.column(0), dimension), model)[1]
            sums += np.vstack([w.T @ w, w.sum(axis=0)])
        i, j = np.indices(sums.shape, dtype=np.int32)
        yield pa.record_batch({"i": i.ravel(), "j": j.ravel(), "value": sums.ravel()})

    parts = vectors.mapInArrow(textbytes.freeing(run), "i int, j int, value double")
    sums = np.zeros((k + 1, k))
    for r in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        sums[r.i, r.j] = r.value
    mean = sums[k] / model.n
    return float(np.abs(sums[:k] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def fit(embeddings: DataFrame, components: int = COMPONENTS, embedding: str = "embedding") -> Whitening:
    """The leading components of the distinct vectors of ``embeddings``."""
    x = embeddings.select(whole_numbers(F.col(embedding)).alias("x")).where(F.col("x").isNotNull())
    vectors = cut_lineage(x.distinct())
    dimension = vectors.agg(F.max(F.size("x")).alias("d")).first().d or 0
    n, total = _totals(vectors, dimension)
    if n == 0 or dimension == 0:
        return Whitening(n, total, np.zeros(0), np.zeros((0, dimension)), 0.0, 0.0)
    matrix = _covariance(vectors, n, total)
    values, found = leading_eigenpairs(matrix, components)
    model = Whitening(n, total, values, found, float(matrix.trace()), 0.0)
    return model._replace(identity_error=_identity_error(vectors, model)) if len(values) else model


def whiten(embeddings: DataFrame, model: Whitening, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    ``deviation`` is the exact sum over the dimensions of (n * x - total)^2.
    """
    rows = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), whole_numbers(F.col(embedding)).alias("x")).where(F.col("x").isNotNull())
    k, dimension = len(model.eigenvalues), len(model.total)
    if k == 0:
        return embeddings.sparkSession.createDataFrame([], _SCHEMA)
    explained = model.eigenvalues / model.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart, whitened = _project(_rows(batch.column(1), dimension), model)
            wide = _largest(apart) ** 2 * dimension >= 1 << 63
            squares = (apart.astype(object) if wide else apart) ** 2
            deviation = [d if d < 1 << 63 else None for d in squares.sum(axis=1).tolist()]
            n = len(deviation)
            every = np.repeat(np.arange(n), k)
            yield pa.record_batch(
                {
                    "vec_id": batch.column(0).take(pa.array(every)),
                    "component": np.tile(np.arange(1, k + 1, dtype=np.int32), n),
                    "n": np.full(n * k, model.n),
                    "deviation": pa.array(deviation, pa.int64()).take(pa.array(every)),
                    "whitened": whitened.ravel(),
                    "explained": np.tile(explained, n),
                    "identity_error": np.full(n * k, model.identity_error),
                }
            )

    return rows.mapInArrow(textbytes.freeing(run), _SCHEMA)
