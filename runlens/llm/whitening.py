"""Whitening of embeddings along the leading principal components.

1. Components become whole numbers, and their sums are exact. Covariances are sums of products of whole
   numbers centred at the rounded mean, taken per task as a matrix product and added up exactly; what
   the rounding leaves is corrected in whole numbers, so that an entry is rounded once. Only sums, as many as
   the covariance has entries, reach the driver, whatever the number of rows.
2. Spectrum slicing finds the leading eigenvalues: an LDL^T factorisation of the covariance less a shift
   has as many positive pivots as there are eigenvalues above the shift, so bisecting on these counts
   isolates each eigenvalue, or a cluster that doubles cannot part.
3. Rayleigh quotient iteration from the isolated interval converges cubically to the eigenvector, held
   orthogonal to those already found. Counts on both sides of the result certify its number.
4. Every row is centred, projected and scaled in its task. The covariance of the whitened rows is measured
   again, over all rows.

Edge cases. Vectors that are null, empty, or hold a null or non-finite component take no part; a null
vec_id does. Where lengths differ, those of the most frequent length take part (of equally frequent ones
the longest). Entries beyond 2^45 after scaling are held there, so that sums stay exact. Repeated rows and
ties count each; equal eigenvalues get some orthonormal basis. Components without variance cannot be
whitened and are left out, so there are fewer if the rows span fewer dimensions, and none for one row.
Deviations beyond 64 bits are held at the limit of a long. Empty table: no rows. Other columns are not read.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runlens.llm.batches import bounded
from runlens.llm.topk import valid

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LIMIT = 2**45
_EXACT = 2.0**53
_LONGEST = 2**63 - 1


@dataclass
class Whitening:
    """What the driver knows of the fitted rows: whole numbers exact, the rest in doubles."""

    rows: int
    centre: np.ndarray  # of every dimension, the rounded mean, int64
    rest: list[int]  # sum of what is above the centre, exact
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # unit eigenvectors, one a row
    trace: float
    identity_error: float = float("nan")


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part, whatever their length."""
    return vectors.where(valid(F.col("embedding"))).select("vec_id", F.col("embedding").cast("array<double>").alias("v"))


def _whole(column: pa.Array) -> np.ndarray:
    """The vectors of a batch as whole numbers, one a row."""
    flat = np.floor(np.clip(column.flatten().to_numpy(zero_copy_only=False), -LIMIT, LIMIT) * SCALE)
    return (np.clip(flat, -LIMIT, LIMIT).astype(np.int64) + SHIFT).reshape(len(column), -1)


def _products(y: np.ndarray) -> np.ndarray:
    """y^T y, exact."""
    peak = float(np.abs(y).max(initial=0))
    if peak * peak * len(y) < _EXACT:
        z = y.astype(np.float64)
        return (z.T @ z).astype(np.int64).astype(object)
    z = y.astype(object)
    return z.T.dot(z)


def _summed(rows: DataFrame, kind: str, part: Callable[[np.ndarray], np.ndarray], exact: bool) -> dict[int, int | float]:
    """Sums over all rows of the numbers that ``part`` makes of a batch, by their place."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = part(_whole(batch.column("v")))
                total = found if total is None else total + found
        if total is not None:
            value = pa.array([str(t) for t in total]) if exact else pa.array(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), value], names=["place", "value"])

    found = rows.select("v").mapInArrow(sums, f"place long, value {'string' if exact else 'double'}")
    added = found.groupBy("place").agg(F.sum(F.col("value").cast(kind)).alias("value"))
    return {r.place: int(r.value) if exact else r.value for r in added.collect()}  # as many as a batch gives


def _of_length(vectors: DataFrame) -> tuple[DataFrame, int]:
    """The rows of the most frequent length, and that length, 0 if there is none."""
    rows = usable(vectors)
    length = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("v") == (length.d if length else 0)), length.d if length else 0


def negative_pivots(matrix: np.ndarray) -> int:
    """Negative eigenvalues of a symmetric matrix, counted on the pivots of its LDL^T factorisation with
    1 x 1 and 2 x 2 pivots chosen as Bunch and Kaufman do."""
    a, n = matrix.copy(), len(matrix)
    alpha = (1 + 17**0.5) / 8
    negative = k = 0

    def swap(i: int, j: int) -> None:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]

    while k < n:
        below = np.abs(a[k + 1 :, k])
        most = below.max(initial=0.0)
        size = 1
        if most > 0 and abs(a[k, k]) < alpha * most:
            r = k + 1 + int(below.argmax())
            others = np.abs(a[r, k:])
            others[r - k] = 0
            widest = others.max()
            if abs(a[k, k]) * widest < alpha * most * most:
                if abs(a[r, r]) >= alpha * widest:
                    swap(k, r)
                else:
                    swap(k + 1, r)
                    size = 2
        if size == 1:
            pivot = a[k, k]
            negative += pivot < 0
            if pivot != 0:
                c = a[k + 1 :, k].copy()
                a[k + 1 :, k + 1 :] -= np.outer(c, c / pivot)
        else:  # such a pivot has one eigenvalue of either sign
            negative += 1
            c = a[k + 2 :, k : k + 2].copy()
            a[k + 2 :, k + 2 :] -= c @ np.linalg.solve(a[k : k + 2, k : k + 2], c.T)
        k += size
    return int(negative)


def _solve(matrix: np.ndarray, shift: float, right: np.ndarray) -> np.ndarray:
    """(matrix - shift)^-1 right, scaled; the shift is moved by rounding errors where it is an eigenvalue."""
    step = np.finfo(float).eps * max(abs(shift), np.abs(matrix).max(), np.finfo(float).tiny)
    for moved in (0.0, step, -4 * step):
        try:
            found = np.linalg.solve(matrix - (shift + moved) * np.eye(len(matrix)), right)
        except np.linalg.LinAlgError:
            continue
        length = np.linalg.norm(found)
        if np.isfinite(length) and length > 0:
            return found / length
    raise ArithmeticError("the shifted covariance could not be solved")


def leading_eigenpairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors as rows) of the ``k`` largest eigenvalues of a positive semidefinite matrix, fewer
    if it has fewer above rounding errors."""
    n = len(matrix)
    norm = float(np.abs(matrix).sum(axis=1).max(initial=0.0))
    noise = 4 * n * np.finfo(float).eps * norm
    above = {-noise - norm * 1e-3: n, norm * (1 + 1e-3): 0}  # eigenvalues above a shift

    def count(shift: float) -> int:
        if shift not in above:
            above[shift] = n - negative_pivots(matrix - shift * np.eye(n))
        return above[shift]

    def interval(number: int) -> tuple[float, float]:
        return (max(s for s, c in above.items() if c >= number), min(s for s, c in above.items() if c < number))

    chance = np.random.default_rng(0)
    values, vectors = [], []
    for number in range(1, min(k, n) + 1):
        if norm == 0 or count(noise) < number:
            break

        def free(x: np.ndarray) -> np.ndarray:
            for _ in range(2):
                for known in vectors:
                    x = x - known * (known @ x)
            return x / np.linalg.norm(x)

        while True:
            low, high = interval(number)
            alone = above[low] == number and above[high] == number - 1
            closed = high - low <= noise
            if alone or closed:
                x = free(chance.standard_normal(n))
                value = (low + high) / 2
                for _ in range(3):  # towards the eigenvectors within the interval
                    x = free(_solve(matrix, value, x))
                value, error = float(x @ matrix @ x), np.inf
                for _ in range(0 if closed else 30):
                    residual = float(np.linalg.norm(matrix @ x - value * x))
                    if residual >= error / 2:
                        break
                    error = residual
                    x = free(_solve(matrix, value, x))
                    value = float(x @ matrix @ x)
                if closed or (low <= value <= high and count(value - noise) >= number > count(value + noise)):
                    break
            count((low + high) / 2)
        values.append(value)
        vectors.append(x)
    return np.array(values), np.array(vectors).reshape(len(vectors), n)


def _whitened(model: Whitening, x: np.ndarray) -> np.ndarray:
    mean = np.array([r / model.rows for r in model.rest])
    return ((x - model.centre) - mean) @ model.vectors.T / np.sqrt(model.values)


def _deviations(model: Whitening, x: np.ndarray) -> np.ndarray:
    """Sums over the dimensions of (rows * x - sum)^2, exact, then held within a long."""
    y, rest = x - model.centre, np.array(model.rest, object)
    peak, most = int(np.abs(y).max(initial=0)), max(map(abs, model.rest))
    if (model.rows * peak + most) ** 2 * len(model.rest) <= _LONGEST:
        return ((model.rows * y - rest.astype(np.int64)) ** 2).sum(axis=1)
    y = y if max(peak, most) * peak * len(model.rest) <= _LONGEST else y.astype(object)
    own, cross = (y * y).sum(axis=1), y @ (rest.astype(np.int64) if y.dtype != object else rest)
    exact = model.rows**2 * own.astype(object) - 2 * model.rows * cross.astype(object) + int((rest * rest).sum())
    return np.array([min(e, _LONGEST) for e in exact], np.int64)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all usable rows of ``vectors`` (vec_id, embedding); None if there are none."""
    rows, d = _of_length(vectors)
    if not d:
        return None
    sums = _summed(rows, "decimal(38,0)", lambda x: np.append(x.astype(object).sum(axis=0), len(x)), True)
    n = sums[d]
    centre = [(2 * sums[i] + n) // (2 * n) for i in range(d)]
    rest = [sums[i] - n * c for i, c in enumerate(centre)]
    at = np.array(centre, np.int64)
    upper = np.triu_indices(d)
    products = _summed(rows, "decimal(38,0)", lambda x: _products(x - at)[upper], True)
    covariance = np.zeros((d, d))
    for place, (i, j) in enumerate(zip(*map(np.ndarray.tolist, upper))):
        covariance[i, j] = covariance[j, i] = (n * products[place] - rest[i] * rest[j]) / n**2
    values, axes = leading_eigenpairs(covariance, components)
    model = Whitening(n, at, rest, values, axes, float(np.trace(covariance)))
    k = len(values)

    def moments(x: np.ndarray) -> np.ndarray:
        w = _whitened(model, x)
        return np.append(w.sum(axis=0), (w.T @ w).ravel())

    if k:
        found = _summed(rows, "double", moments, False)
        mean = np.array([found[i] for i in range(k)]) / n
        measured = np.array([found[k + i] for i in range(k * k)]).reshape(k, k) / n - np.outer(mean, mean)
        model.identity_error = float(np.abs(measured - np.eye(k)).max())
    return model


def _rows(batches: Iterator[pa.RecordBatch], model: Whitening) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            x = _whole(batch.column("v"))
            w = _whitened(model, x)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]), pa.array(np.ascontiguousarray(w).ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(_deviations(model, x)), lists], names=["vec_id", "deviation", "whitened"])


def transform(vectors: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened): every usable row of the fitted length, projected on all components."""
    rows = usable(vectors).where(F.size("v") == len(model.centre))
    kind = dict(vectors.dtypes)["vec_id"]
    return rows.mapInArrow(partial(_rows, model=model), f"vec_id {kind}, deviation long, whitened array<double>")
