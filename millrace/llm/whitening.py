"""Whitening of embeddings by Jacobi-Davidson: the covariance is never formed, Spark only multiplies by it.

The eigenvectors belong to the covariance of the distinct whole-number vectors. Multiplying a block of directions by
it is one Spark job: each task centres its vectors with exact whole numbers, multiplies, and returns one partial row
for each dimension, which Spark adds up; the driver only holds a few vectors of one entry a dimension. Around that
product runs a block Jacobi-Davidson iteration. Each round takes Ritz pairs of the subspace, locks the leading ones
whose residual is at rounding level, and widens the subspace by corrections of the others: solutions of the correction
equation projected on the complement of all locked and active vectors, by a few steps of MINRES that advance all
columns with one product a step.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import stored

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Entries of this size and more have no exact scaled whole number; such vectors take no part.
LARGEST = 1 << 46
#: A residual of so many units of rounding of the largest eigenvalue is double precision.
ROUNDING = 256 * np.finfo(np.float64).eps
GUARD, INNER_STEPS, ROUNDS = 4, 8, 200
LOW_BITS = 26

Product = Callable[[np.ndarray], np.ndarray]


def _lengths(columns: np.ndarray) -> np.ndarray:
    return np.sqrt((columns * columns).sum(axis=0))


def _outside(columns: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """What of the columns lies outside the spans of orthonormal bases."""
    for _ in range(2):  # twice is enough for full orthogonality
        for basis in bases:
            columns = columns - basis @ (basis.T @ columns)
    return columns


def _orthonormal(columns: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns add to the bases; columns that add nothing are left out."""
    found: list[np.ndarray] = []
    for column in columns.T:
        before = np.sqrt(column @ column)
        if not before > 0 or not np.isfinite(before):
            continue
        own = np.array(found).T if found else np.zeros((len(column), 0))
        rest = _outside((column / before)[:, None], *bases, own)[:, 0]
        size = np.sqrt(rest @ rest)
        if size > 1e-10:
            found.append(_outside((rest / size)[:, None], *bases, own)[:, 0])
            found[-1] /= np.sqrt(found[-1] @ found[-1])
    return np.array(found).T if found else np.zeros((columns.shape[0], 0))


def _minres(product: Product, shift: np.ndarray, right: np.ndarray, project: Callable[[np.ndarray], np.ndarray],
            steps: int) -> np.ndarray:
    """Columns t with P (A - shift) P t = right, by ``steps`` of MINRES; all columns share each product."""
    size = _lengths(right)
    live = size > 0
    v = np.where(live, right / np.where(live, size, 1), 0)
    v_before, w, w_before = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    t, eta, beta = np.zeros_like(v), size.copy(), np.zeros(len(size))
    c, c_before = np.ones(len(size)), np.ones(len(size))
    s, s_before = np.zeros(len(size)), np.zeros(len(size))
    first = size.copy()
    for _ in range(steps):
        if not live.any():
            break
        image = np.zeros_like(v)
        image[:, live] = product(v[:, live])
        image = project(image - v * shift)
        alpha = (v * image).sum(axis=0)
        after = image - alpha * v - beta * v_before
        beta_after = _lengths(after)
        delta = c * alpha - c_before * s * beta
        rho1 = np.sqrt(delta * delta + beta_after * beta_after)
        rho2, rho3 = s * alpha + c_before * c * beta, s_before * beta
        live &= rho1 > 0
        safe = np.where(rho1 > 0, rho1, 1)
        c_before, c = c, np.where(live, delta / safe, c)
        s_before, s = s, np.where(live, beta_after / safe, s)
        w_before, w = w, np.where(live, (v - rho3 * w_before - rho2 * w) / safe, w)
        t = t + np.where(live, c * eta * w, 0)
        eta = np.where(live, -s * eta, eta)
        live &= (beta_after > 1e-14 * first) & (np.abs(eta) > 1e-12 * first)
        v_before, v = v, np.where(live, after / np.where(beta_after > 0, beta_after, 1), 0)
        beta = beta_after
    return t


def leading_pairs(product: Product, size: int, wanted: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit eigenvectors of a symmetric operator on ``size``
    dimensions that is known by its products with blocks of columns."""
    wanted = min(wanted, size)
    block = min(size, wanted + GUARD)
    basis = _orthonormal(np.random.default_rng(seed).standard_normal((size, block)))
    image = product(basis)
    locked, largest = np.zeros((size, 0)), 0.0
    for _ in range(ROUNDS):
        inner = basis.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        residual = _outside(image - basis * values, locked)
        largest = max(largest, float(np.abs(values).max(initial=0)))
        good = _lengths(residual) <= ROUNDING * largest
        count = int(np.argmin(good)) if not good.all() else len(good)
        count = min(count, wanted - locked.shape[1])
        locked = np.hstack([locked, basis[:, :count]])
        basis, image, values, residual = basis[:, count:], image[:, count:], values[count:], residual[:, count:]
        if locked.shape[1] == wanted:
            break
        if basis.shape[1] > 4 * block:  # thick restart
            basis, image = basis[:, :2 * block], image[:, :2 * block]
        active = slice(0, min(block, wanted - locked.shape[1] + GUARD))
        complement = (locked, basis[:, active])
        correction = _minres(product, values[active], -_outside(residual[:, active], *complement),
                             lambda columns: _outside(columns, *complement), INNER_STEPS)
        more = _orthonormal(correction, locked, basis)
        if not more.shape[1]:  # nothing to add but rounding: fresh products of the same subspace
            basis = _orthonormal(basis, locked)
            image = product(basis)
            continue
        basis, image = np.hstack([basis, more]), np.hstack([image, product(more)])
    else:
        raise ArithmeticError(f"{locked.shape[1]} of {wanted} eigenvectors reached double precision")
    image = product(locked)
    values = (locked * image).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    vectors = locked[:, order]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(wanted)])
    return values[order], vectors * np.where(sign < 0, -1.0, 1.0)


class Centred:
    """Whole-number vectors less their exact mean ``total / n``."""

    def __init__(self, n: int, total: list[int]):
        self.n = n
        self.base = np.array([t // n for t in total], dtype=np.int64)
        self.rest = np.array([t % n for t in total], dtype=np.int64)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.base) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - total)**2, exactly; none where that exceeds a long."""
        about = ((self(x) * self.n) ** 2).sum(axis=1)
        small = about < 2.0 ** 61
        out: list[int | None] = [None] * len(x)
        part = self.n * (x[small] - self.base) - self.rest
        for row, value in zip(np.flatnonzero(small).tolist(), (part * part).sum(axis=1).tolist()):
            out[row] = value
        for row in np.flatnonzero(~small).tolist():
            value = sum((self.n * (a - b) - c) ** 2 for a, b, c in zip(x[row].tolist(), self.base.tolist(), self.rest.tolist()))
            out[row] = value if value < 1 << 63 else None
        return out


def _rows(column: pa.Array, size: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _added(fit: DataFrame, size: int, out: int, kind: str, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all vectors of ``part``, which makes an (entries x ``out``) array of a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = part(_rows(batch.column(0), size))
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total), dtype=np.int32)), *[pa.array(c) for c in total.T]],
                ["entry", *[f"v{i}" for i in range(out)]])

    fields = ", ".join(f"v{i} {kind}" for i in range(out))
    rows = fit.mapInArrow(run, f"entry int, {fields}").groupBy("entry").agg(
        *[F.sum(f"v{i}").alias(f"v{i}") for i in range(out)]).orderBy("entry").toArrow()
    return np.column_stack([rows[f"v{i}"].to_numpy() for i in range(out)])


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
           vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: one row a vector and component.

    An entry c becomes the whole number floor(64 c) + 1000000. The covariance is that of the distinct whole-number
    vectors. Vectors that are null, empty, or hold a null, non-finite or giant (2**46 or more) entry are left out, and
    so are vectors of another length than the most frequent one (the longer of two as frequent ones). A row without id
    stays, repeated rows stay repeated; they enter the covariance once. Directions without variance have no whitened
    value: a component is given only if its eigenvalue is above rounding, so n distinct vectors give n - 1 components
    at most and a single one gives no rows. A deviation beyond the range of long is null. Other columns are ignored.
    """
    spark = vectors.sparkSession
    kind = vectors.select(id_col).schema[0].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    entries = F.col("entries")
    usable = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("entries")).where(
        entries.isNotNull() & F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float(LARGEST)))))
    sizes = usable.where(F.size(entries) > 0).groupBy(F.size(entries).alias("size")).count()
    common = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    if common is None:
        return spark.createDataFrame([], schema)
    size = common["size"]
    whole = usable.where(F.size(entries) == size).select(
        "id", F.transform(entries, lambda c: F.floor(c * F.lit(float(SCALE))) + F.lit(OFFSET)).alias("x"))
    fit = stored(whole.select("x").distinct(), "whole-vectors")

    low = (1 << LOW_BITS) - 1  # sums of the high and the low bits stay in range
    sums = _added(fit, size, 3, "long", lambda x: np.column_stack(
        [(x >> LOW_BITS).sum(axis=0), (x & low).sum(axis=0), np.full(size, len(x))]))
    n = int(sums[0, 2])
    centre = Centred(n, [(int(high) << LOW_BITS) + int(rest) for high, rest, _ in sums])

    def product(columns: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            c = centre(x)
            return c.T @ (c @ columns)

        return _added(fit, size, columns.shape[1], "double", part) / n

    trace = float(_added(fit, size, 1, "double", lambda x: (centre(x) ** 2).sum(axis=0)[:, None]).sum()) / n
    values, directions = leading_pairs(product, size, components)
    given = values > size * ROUNDING * max(values[0], 0)
    values, directions = values[given], directions[:, given]
    k = len(values)
    if not k:
        return spark.createDataFrame([], schema)
    scaled = directions / np.sqrt(values)
    mean = _added(fit, size, 1, "double", lambda x: (centre(x) @ scaled).sum(axis=0)[:, None])[:, 0] / n

    def squares(x: np.ndarray) -> np.ndarray:
        z = centre(x) @ scaled - mean
        return z.T @ z

    error = float(np.abs(_added(fit, size, k, "double", squares) / n - np.eye(k)).max())
    explained = values / trace

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = batch.num_rows
            if not count:
                continue
            x = _rows(batch.column(1), size)
            z = centre(x) @ scaled
            deviation = pa.array(centre.deviation(x), pa.int64())
            take = pa.array(np.repeat(np.arange(count), k))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(take), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)),
                pa.array(np.full(count * k, n, dtype=np.int64)), deviation.take(take), pa.array(z.reshape(-1)),
                pa.array(np.tile(explained, count)), pa.array(np.full(count * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return whole.mapInArrow(rows, schema)
