"""Embedding whitening: leading eigenvectors of the covariance by a block Jacobi-Davidson method.

Entries become whole numbers, x = floor(256 * entry). The *fit list* holds each distinct x vector once;
its size n and sums S per dimension are exact whole numbers. The covariance V (divisor n) is never
formed: a product V u is one pass over the fit list in which every task centres its rows
(x - S/n) and returns the sum of centred row times (centred row . u) for a block of vectors u. Task sums are
added up in the order of the partitions, first within groups of them, so what reaches the
driver is a block of dimension x vectors for the square root of their number.

1. Rayleigh-Ritz in the subspace spanned so far gives the wanted Ritz pairs (e, u) and residuals V u - e u.
2. Pairs whose residual is at double precision, with all larger ones, are locked.
3. For every open pair the projected correction equation (I - QQ')(V - e)(I - QQ') t = -r, with Q the
   locked vectors and u, is solved roughly by MINRES. The inner steps of all open pairs share their
   passes. The corrections widen the subspace, which restarts from its best Ritz vectors when full.

Small state (dimension x a few dozen numbers) lives in the driver; it depends on the dimension, not on the rows.
A lost executor repeats its tasks of one pass; nothing else is held between passes but the staged fit list.

Defined results: rows whose vector is NULL or holds a NULL or non-finite entry, or one whose 256-fold leaves
+-2^53, are dropped; so are vectors whose length is not the most frequent one (of equally frequent ones the
longest). Repeated rows and ids are separate rows of the result, but one vector of the fit list. Components
whose eigenvalue is zero to double precision have no whitened value and are left out, so one distinct
vector, empty vectors, or no rows at all give no rows. ``deviation`` is NULL where it leaves the long range.
The sign of a component makes its largest entry positive.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelftide.llm.common import Scratch

COMPONENTS = 4
SCALE = 256
# Ritz pairs are locked once |V u - e u| <= TOLERANCE * largest eigenvalue.
TOLERANCE = 3e-15
# Steps of the inner solver between two widenings of the subspace.
INNER_STEPS = 6
# The subspace restarts beyond so many vectors.
SUBSPACE = 40
# Largest whole number that every step of the way is exact for.
_LIMIT = float(1 << 53)


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x): valid rows with their entries as whole numbers, 8 bytes each, little-endian."""
    entries = F.col(vector_col).cast("array<double>")
    scaled = F.transform(entries, lambda c: F.floor(F.lit(SCALE) * c))
    valid = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < _LIMIT / SCALE))
    kept = rows.where(F.col(vector_col).isNotNull() & valid)
    return _as_bytes(kept.select(F.col(id_col).cast("long").alias("vec_id"), scaled.cast("array<long>").alias("x")))


def _as_bytes(rows: DataFrame) -> DataFrame:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x")
            offsets = np.asarray(x.offsets) - x.offsets[0].as_py()
            values = np.ascontiguousarray(np.asarray(x.flatten()), "<i8")
            data = pa.BinaryArray.from_buffers(pa.binary(), len(x), [None, pa.py_buffer((offsets * 8).astype(np.int32)), pa.py_buffer(values)])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), data], ["vec_id", "x"])

    return rows.mapInArrow(pack, "vec_id long, x binary")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The rows of a column of equally long byte strings as int64."""
    start, stop = column.offset, column.offset + len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[start : stop + 1]
    return np.frombuffer(column.buffers()[2], "<i8", len(column) * dim, offsets[0]).reshape(-1, dim)


def _task_sums(fit: DataFrame, tasks: int, dim: int, work: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...], kind: str) -> np.ndarray:
    """The sum over all rows of ``work`` (rows of a batch -> array of ``shape``), added in a fixed order."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(shape, kind)
        for batch in batches:
            if batch.num_rows:
                total += work(_matrix(batch.column("x"), dim))
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["part", "total"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = sorted((p, t) for b in batches for p, t in zip(b.column("part").to_pylist(), b.column("total").to_pylist(), strict=True))
        if parts:
            total = sum(np.frombuffer(t, kind) for _, t in parts)
            yield pa.RecordBatch.from_arrays([pa.array([parts[0][0]], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["part", "total"])

    sums = fit.select("x").mapInArrow(partial, "part long, total binary")
    if tasks > 64:
        groups = int(np.ceil(np.sqrt(tasks)))
        sums = sums.repartition(groups, "part").mapInArrow(add, "part long, total binary")
    rows = sorted((r["part"], bytes(r["total"])) for r in sums.collect())
    return sum((np.frombuffer(t, kind) for _, t in rows), np.zeros(int(np.prod(shape)), kind)).reshape(shape)


@dataclass(frozen=True)
class Whitening:
    """What a row needs to be whitened, and what is known of the fit list."""

    n: int
    sums: tuple[int, ...]
    eigenvalues: tuple[float, ...]
    components: tuple[tuple[float, ...], ...]
    trace: float
    identity_error: float


def _orthonormal(block: np.ndarray, against: np.ndarray, floor: float = 1e-10) -> np.ndarray:
    """Columns of ``block`` made orthonormal to ``against`` and each other, twice; what is left of a
    column with less than ``floor`` of its length is dropped."""
    basis = against
    for column in block.T:
        length = np.linalg.norm(column)
        if not np.isfinite(length) or length == 0:
            continue
        v = column / length
        for _ in range(2):
            v = v - basis @ (basis.T @ v)
            left = np.linalg.norm(v)
            if left < floor:
                break
            v = v / left
        else:
            basis = np.column_stack([basis, v])
    return basis[:, against.shape[1] :]


def _corrections(apply: Callable[[np.ndarray], np.ndarray], shifts: np.ndarray, spaces: list[np.ndarray], residuals: np.ndarray, steps: int) -> np.ndarray:
    """MINRES on the projected correction equation of every open pair side by side: each step is one
    product with the block of their Lanczos vectors. The small least-squares problem
    over the Lanczos matrix gives the iterate of least residual."""
    count = residuals.shape[1]
    projected = [lambda t, q=q: t - q @ (q.T @ t) for q in spaces]
    basis = [[p(-residuals[:, k])] for k, p in enumerate(projected)]
    length = [float(np.linalg.norm(b[0])) for b in basis]
    for k in range(count):
        basis[k][0] = basis[k][0] / (length[k] or 1.0)
    diagonal: list[list[float]] = [[] for _ in range(count)]
    beside: list[list[float]] = [[] for _ in range(count)]
    live = [k for k in range(count) if length[k]]
    for _ in range(steps):
        if not live:
            break
        image = apply(np.column_stack([basis[k][-1] for k in live]))
        for at, k in enumerate(list(live)):
            v = basis[k][-1]
            w = projected[k](image[:, at] - shifts[k] * v)
            diagonal[k].append(float(v @ w))
            for _ in range(2):
                for b in basis[k]:
                    w = w - (b @ w) * b
            beside[k].append(float(np.linalg.norm(w)))
            if beside[k][-1] <= 1e-13 * max(1.0, abs(diagonal[k][0])):
                live.remove(k)
            else:
                basis[k].append(w / beside[k][-1])
    out = np.zeros_like(residuals)
    for k in range(count):
        m = len(diagonal[k])
        if not m:
            continue
        lanczos = np.zeros((m + 1, m))
        lanczos[range(m), range(m)] = diagonal[k]
        lanczos[range(1, m + 1), range(m)] = beside[k]
        lanczos[range(m - 1), range(1, m)] = beside[k][: m - 1]
        y = np.linalg.lstsq(lanczos, length[k] * np.eye(m + 1)[0], rcond=None)[0]
        out[:, k] = projected[k](np.column_stack(basis[k][:m]) @ y)
    return out


def jacobi_davidson(apply: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, tolerance: float = TOLERANCE, inner_steps: int = INNER_STEPS, subspace: int = SUBSPACE) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues (falling) and unit eigenvectors (columns) of a symmetric positive
    semidefinite operator that is known by its products with blocks of vectors only.

    Ends when all wanted residuals are within the tolerance, or when rounding lets them fall no further."""
    wanted = min(wanted, dim)
    space = _orthonormal(np.random.default_rng(7).standard_normal((dim, min(dim, 2 * wanted + 2))), np.empty((dim, 0)))
    image = apply(space)
    best, stalled = np.inf, 0
    while True:
        small = space.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(values)[::-1]
        values, turn = values[order], turn[:, order]
        vectors, products = space @ turn[:, :wanted], image @ turn[:, :wanted]
        residuals = products - vectors * values[:wanted]
        largest = max(values[0], 0.0)
        sizes = np.linalg.norm(residuals, axis=0)
        # A pair is locked only together with all larger ones, so that none is passed over.
        open_pairs = np.flatnonzero(np.maximum.accumulate(sizes > tolerance * largest))
        stalled = stalled + 1 if sizes.max() > best / 2 else 0
        best = min(best, sizes.max())
        settled = best <= 1e3 * tolerance * largest and stalled >= 3
        if not len(open_pairs) or settled or space.shape[1] == dim and stalled:
            return values[:wanted], vectors
        locked = vectors[:, : open_pairs[0]]
        spaces = [_orthonormal(vectors[:, [k]], locked) for k in open_pairs]
        spaces = [np.column_stack([locked, q]) for q in spaces]
        if space.shape[1] + len(open_pairs) > min(subspace, dim) and space.shape[1] > 3 * wanted:
            keep = turn[:, : 2 * wanted]
            space, image = space @ keep, image @ keep
            fixed = _orthonormal(space, np.empty((dim, 0)))
            # Rounding is not carried over a restart: products are taken anew.
            space, image = fixed, apply(fixed)
        wide = _orthonormal(_corrections(apply, values[open_pairs], spaces, residuals[:, open_pairs], inner_steps), space)
        if not wide.shape[1]:
            wide = _orthonormal(residuals[:, open_pairs], space, 1e-6)
        if not wide.shape[1]:
            return values[:wanted], vectors
        space, image = np.column_stack([space, wide]), np.column_stack([image, apply(wide)])


def fit_whitening(fit: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening:
    """``fit``: distinct vectors of ``dim`` whole numbers as bytes ``x``."""
    split = lambda x: np.vstack([x >> 26, x & ((1 << 26) - 1)])
    halves = lambda x: np.vstack([half.sum(axis=0) for half in np.split(split(x), 2)])
    # High and low parts apart: neither sum leaves 64 bits below 2^36 rows.
    tasks = fit.rdd.getNumPartitions()
    counted = _task_sums(fit, tasks, dim, lambda x: np.vstack([halves(x), np.full((1, dim), len(x))]), (3, dim), "int64")
    high, low, rows = counted.tolist() if dim else ([], [], [0])
    n = rows[0]
    if not n:
        return Whitening(0, (), (), (), 0.0, 0.0)
    sums = [h * (1 << 26) + s for h, s in zip(high, low, strict=True)]
    # Whole part and rest of S/n apart: x minus the whole part is exact.
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - whole).astype(float) - rest

    def apply(block: np.ndarray) -> np.ndarray:
        def product(x: np.ndarray) -> np.ndarray:
            c = centred(x)
            return c.T @ (c @ block)

        return _task_sums(fit, tasks, dim, product, block.shape, "float64") / n

    trace = float(_task_sums(fit, tasks, dim, lambda x: (centred(x) ** 2).sum(axis=0), (dim,), "float64").sum() / n)
    if trace == 0:
        return Whitening(n, tuple(sums), (), (), 0.0, 0.0)
    values, vectors = jacobi_davidson(apply, dim, components)
    real = values > dim * np.finfo(float).eps * trace
    values, vectors = values[real], vectors[:, real]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), range(vectors.shape[1])])

    def moments(x: np.ndarray) -> np.ndarray:
        w = centred(x) @ vectors / np.sqrt(values)
        return np.vstack([w.T @ w, w.sum(axis=0)])

    count = len(values)
    total = _task_sums(fit, tasks, dim, moments, (count + 1, count), "float64") / n
    covariance = total[:count] - np.outer(total[count], total[count])
    error = float(np.abs(covariance - np.eye(count)).max()) if count else 0.0
    return Whitening(n, tuple(sums), tuple(values.tolist()), tuple(map(tuple, vectors.T.tolist())), trace, error)


_RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _deviations(x: np.ndarray, n: int, sums: np.ndarray, most: int) -> pa.Array:
    """Sums of (n*x - S)^2, exact. ``most`` bounds |n*x - S|; beyond 64 bits Python numbers take over."""
    if most * most * x.shape[1] < 1 << 63:
        d = n * x - sums.astype(np.int64)
        return pa.array((d * d).sum(axis=1), pa.int64())
    exact = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums.tolist(), strict=True)) for row in x]
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per valid row and component: vec_id, component (from 1), n, deviation, whitened, explained,
    identity_error."""
    scratch = Scratch(rows.sparkSession, "whitening")
    valid = scratch.stage(whole_vectors(rows, id_col, vector_col), "vectors")
    lengths = valid.groupBy((F.length("x") / 8).cast("int").alias("dim")).count()
    # One row per length of a vector; the most frequent length wins.
    top = lengths.orderBy(F.desc("count"), F.desc("dim")).first()
    dim = top["dim"] if top else 0
    if not dim:
        return scratch.finish(rows.sparkSession.createDataFrame([], _RESULT))
    valid = valid.where(F.length("x") == 8 * dim)
    # Equal vectors meet in partial aggregates first, so a vector of very many rows moves once per task.
    fit = scratch.stage(valid.select("x").distinct(), "fit")
    model = fit_whitening(fit, dim, components)
    n, sums = model.n, np.array(model.sums, object)
    values, vectors = np.array(model.eigenvalues), np.array(model.components).reshape(-1, dim).T
    whole = np.array([s // n for s in model.sums], np.int64)
    rest = np.array([(s % n) / n for s in model.sums])
    explained = values / model.trace if len(values) else values
    count, largest = len(values), max(map(abs, model.sums))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not count:
                continue
            x = _matrix(batch.column("x"), dim)
            white = ((x - whole).astype(float) - rest) @ vectors / np.sqrt(values)
            deviation = _deviations(x, n, sums, n * max(int(x.max()), -int(x.min())) + largest)
            each = np.repeat(np.arange(len(x)), count)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, count + 1), len(x)), pa.int32()),
                    pa.array(np.full(len(each), n), pa.int64()),
                    deviation.take(pa.array(each)),
                    pa.array(white.reshape(-1), pa.float64()),
                    pa.array(np.tile(explained, len(x)), pa.float64()),
                    pa.array(np.full(len(each), model.identity_error), pa.float64()),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return scratch.finish(valid.mapInArrow(project, _RESULT))
