"""Whitening of embeddings along the leading components of their covariance, found by FEAST.

The covariance is exact: entries become whole numbers, tasks sum products of entries centred by the
whole part of the mean, and only the d x d sums reach the driver (d: the length of a vector, so their
size does not depend on the number of rows). There the spectrum is cut into intervals by inertia
counts; in each, a rational filter (quadrature of shifted complex solves along a circle) keeps the
wanted invariant subspace, Rayleigh-Ritz extracts the components, and the count of Ritz values must
equal the inertia count, so none is missed.

Defined results: a null vector, or one that holds null or a non-finite entry, takes no part. A null id
keeps its rows, repeated rows repeat. Shorter vectors, empty ones included, count as continued by
zeros. 64 times an entry is held within +-2**61. Directions without variance, beyond rounding, are no
components, so equal vectors and an empty table give no rows. A deviation beyond a long is null.
Columns other than vec_id and embedding are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.session import stage

COMPONENTS = 32
SCALE = 64
SHIFT = 1_000_000
HELD = float(1 << 61)
#: An interval of the spectrum is cut until it holds so many components, and its ends lie this close.
BLOCK = 8
SPREAD = 8.0
NODES = 8
ITERATIONS = 30
#: Rows whose exact products are summed in one matrix product: 2**12 products below 2**40.
LIMB = 20
ROWS = 1 << 12


# -- the spectrum -------------------------------------------------------------------------------


def eigenvalues_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of the symmetric ``matrix`` exceed ``shift``: the positive inertia of the difference.

    An LDL factorisation with complete symmetric pivoting; a block of two is indefinite, so it holds
    one positive and one negative value.
    """
    a = matrix - shift * np.eye(len(matrix))
    growth = (1 + math.sqrt(17)) / 8
    positive = 0
    while len(a):
        diagonal = np.abs(a.diagonal())
        i = int(diagonal.argmax())
        off = np.abs(a - np.diag(a.diagonal()))
        r, c = divmod(int(off.argmax()), len(a))
        if max(diagonal[i], off[r, c]) == 0.0:
            break
        taken = [i] if diagonal[i] >= growth * off[r, c] else [r, c]
        positive += 1 if len(taken) == 2 or a[i, i] > 0 else 0
        rest = np.setdiff1d(np.arange(len(a)), taken)
        side = a[np.ix_(rest, taken)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(a[np.ix_(taken, taken)], side.T)
        a = (a + a.T) / 2
    return positive


def _clear(matrix: np.ndarray, at: float) -> bool:
    """Whether no eigenvalue lies next to ``at``, where counting could fall on either side."""
    return eigenvalues_above(matrix, at * (1 - 1e-8)) == eigenvalues_above(matrix, at * (1 + 1e-8))


def intervals(matrix: np.ndarray, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, count) of disjoint intervals that hold at least the ``wanted`` largest eigenvalues.

    Values within rounding of zero count as zero and are left out.
    """
    top = float(np.abs(matrix).sum(1).max()) * (1 + 1e-12)  # no eigenvalue is larger (Gershgorin)
    if not top:
        return []
    low, high = len(matrix) * np.finfo(float).eps * top, top * (1 + 1e-6)
    below = eigenvalues_above(matrix, low)
    wanted = min(wanted, below)
    if not wanted:
        return []
    while below > wanted + BLOCK and high > low * (1 + 1e-6):
        middle = math.sqrt(low * high)
        n = eigenvalues_above(matrix, middle)
        if n >= wanted:
            low, below = middle, n
        else:
            high = middle
    while not _clear(matrix, low):
        low *= 1 - 1e-6
    below = eigenvalues_above(matrix, low)

    done, open_ = [], [(low, top * (1 + 1e-6), below, 0)]
    while open_:
        a, b, above_a, above_b = open_.pop()
        n = above_a - above_b
        if not n:
            continue
        cut = None
        if (n > BLOCK or b > SPREAD * a) and b > a * (1 + 1e-5):
            tries = [a**t * b ** (1 - t) for t in (0.5, 0.41, 0.59, 0.33, 0.67)]
            cut = next((m for m in tries if _clear(matrix, m)), None)
        if cut is None:
            done.append((a, b, n))
        else:
            above = eigenvalues_above(matrix, cut)
            open_ += [(a, cut, above_a, above), (cut, b, above, above_b)]
    return done


def feast(matrix: np.ndarray, low: float, high: float, count: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues between ``low`` and ``high``, and their unit eigenvectors as columns."""
    d = len(matrix)
    size = float(np.abs(matrix).sum(1).max())
    x, w = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(0.5j * np.pi * (1 - x))  # the upper half circle; the lower one is its conjugate
    centre, radius = (low + high) / 2, (high - low) / 2
    shifted = (centre + radius * turn)[:, None, None] * np.eye(d) - matrix
    # Eigenvalues close to the interval slow the filter down; a larger subspace holds them too.
    for block in sorted({min(d, count + max(4, count // 2)), min(d, 3 * count + 8), d}):
        y, best = np.random.default_rng(seed).standard_normal((d, block)), math.inf
        for _ in range(ITERATIONS):
            solved = np.linalg.solve(shifted, np.broadcast_to(y.astype(complex), (NODES, *y.shape)))
            filtered = np.einsum("k,kij->ij", w * radius * turn, solved).real / 2
            q, sizes, _ = np.linalg.svd(filtered, full_matrices=False)
            q = q[:, sizes > sizes[0] * 1e-14]
            reduced = q.T @ matrix @ q
            values, turned = np.linalg.eigh((reduced + reduced.T) / 2)  # Rayleigh-Ritz on at most `block` directions
            y = q @ turned
            inside = np.flatnonzero((values > low) & (values < high))
            residuals = np.abs(matrix @ y - y * values).max(0)
            # Directions from outside may have a Ritz value in here, but not a small residual.
            taken = np.sort(inside[np.argsort(residuals[inside], kind="stable")][:count])
            if len(taken) == count:
                residual = float(residuals[taken].max())
                if residual <= 1e-15 * size or (residual <= 1e-12 * size and residual > best / 2):
                    return values[taken], y[:, taken]
                best = min(best, residual)
    raise ArithmeticError(f"inertia counts {count} eigenvalues between {low} and {high}, the projection did not converge on them")


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues above rounding, falling, and their unit eigenvectors as columns."""
    parts = [feast(matrix, *interval) for interval in intervals(matrix, wanted)]
    if not parts:
        return np.zeros(0), np.zeros((len(matrix), 0))
    values, vectors = np.concatenate([p[0] for p in parts]), np.hstack([p[1] for p in parts])
    order = np.argsort(-values, kind="stable")
    # Vectors of different intervals are orthogonal to rounding over their gap; larger ones keep their place.
    vectors = np.linalg.qr(vectors[:, order])[0]
    return values[order][:wanted], vectors[:, :wanted]


# -- the vectors --------------------------------------------------------------------------------


def whole_entries(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows of the column that take part, their entries floor(64 c) as longs, ``width`` of them)."""
    n = len(column)
    there = column.is_valid().to_numpy(zero_copy_only=False)
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    of_row = np.repeat(np.arange(n), sizes)
    sound = there & (np.bincount(of_row[~np.isfinite(values)], minlength=n) == 0)
    keep = sound[of_row]
    place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    rows = np.cumsum(sound) - 1
    entries = np.zeros((int(sound.sum()), width), np.int64)
    with np.errstate(over="ignore"):
        entries[rows[of_row[keep]], place[keep]] = np.clip(np.floor(SCALE * values[keep]), -HELD, HELD).astype(np.int64)
    return np.flatnonzero(sound), entries


def exact_gram(entries: np.ndarray) -> np.ndarray:
    """entries' * entries in whole numbers of any size: products of 20-bit parts are exact in doubles."""
    total = np.zeros((entries.shape[1],) * 2, object)
    for at in range(0, len(entries), ROWS):
        rest, limbs = entries[at : at + ROWS], []
        while np.abs(rest).max(initial=0) >> LIMB:
            limbs.append((rest & ((1 << LIMB) - 1)).astype(float))
            rest = rest >> LIMB
        limbs.append(rest.astype(float))
        for i, a in enumerate(limbs):
            for j, b in enumerate(limbs):
                total += (a.T @ b).astype(np.int64).astype(object) << (LIMB * (i + j))
    return total


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: ``sums`` are those of floor(64 c); components are columns of ``vectors``."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.values]

    def deviations(self, entries: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
        """n times the centred entries, and the exact sums of their squares."""
        reach = self.n * int(np.abs(entries).max(initial=0)) + max((abs(s) for s in self.sums), default=0)
        if reach**2 * max(1, len(self.sums)) < 1 << 63:
            apart = self.n * entries - np.array(self.sums, np.int64)
            return apart, (apart * apart).sum(1).tolist()
        apart = self.n * entries.astype(object) - np.array(self.sums, object)
        squares = (sum(int(v) ** 2 for v in row) for row in apart)
        return apart.astype(float), [s if s < 1 << 63 else None for s in squares]


def _per_task(vectors: DataFrame, work, schema: str) -> DataFrame:
    return vectors.select(F.col("embedding")).mapInArrow(work, schema)


def _sums(vectors: DataFrame, width: int) -> tuple[int, list[int]]:
    """The number of vectors that take part and the sums of their entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(width, object)
        for batch in batches:
            _, entries = whole_entries(batch.column(0), width)
            n += len(entries)
            # Two parts, so that no partial sum passes a long.
            sums += ((entries >> 30).sum(0).astype(object) << 30) + (entries & ((1 << 30) - 1)).sum(0).astype(object)
        made = [Decimal(int(v)) for v in (n, *sums)]
        yield pa.RecordBatch.from_arrays([pa.array(range(width + 1), pa.int32()), pa.array(made, pa.decimal128(38, 0))], ["i", "v"])

    rows = _per_task(vectors, run, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v")).collect()  # width + 1 rows
    found = {r["i"]: int(r["v"]) for r in rows}
    return found.get(0, 0), [found.get(i + 1, 0) for i in range(width)]


def _covariance(vectors: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The covariance, exact before its one division: n times the products of centred entries less their means' part."""
    width = len(sums)
    centre = [s // n for s in sums]
    i, j = np.triu_indices(width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width), object)
        for batch in batches:
            total += exact_gram(whole_entries(batch.column(0), width)[1] - np.array(centre, np.int64))
        made = pa.array([Decimal(int(v)) for v in total[i, j]], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), made], ["i", "j", "v"])

    rows = _per_task(vectors, run, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v"))
    left = [s - n * c for s, c in zip(sums, centre)]
    matrix = np.zeros((width, width))
    for r in rows.collect():  # half of width * width rows
        value = (n * int(r["v"]) - left[r["i"]] * left[r["j"]]) / (n * n)
        matrix[r["i"], r["j"]] = matrix[r["j"], r["i"]] = value
    return matrix


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Learn the whitening from every vector that takes part."""
    width = vectors.agg(F.max(F.size("embedding"))).first()[0] or 0
    width = max(0, width)
    n, sums = _sums(vectors, width)
    if not n or not width:
        return Whitening(n, tuple(sums), np.zeros(0), np.zeros((width, 0)), 0.0)
    matrix = _covariance(vectors, n, sums)
    values, found = leading(matrix, components)
    return Whitening(n, tuple(sums), values, found, float(matrix.trace()))


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation and the whitened coordinates (array of doubles) of every vector that takes part."""
    width = len(model.sums)
    project = model.vectors / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, entries = whole_entries(batch.column(1), width)
            apart, deviation = model.deviations(entries)
            made = (apart / model.n) @ project if len(rows) else np.zeros((0, project.shape[1]))
            ends = np.arange(len(rows) + 1, dtype=np.int32) * project.shape[1]
            coordinates = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(made).ravel()))
            ids = batch.column(0).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([ids, pa.array(deviation, pa.int64()), coordinates], ["vec_id", "deviation", "whitened"])

    picked = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return picked.mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, components: int) -> float:
    """The largest absolute entry of the covariance of ``whitened`` minus the identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares = 0, np.zeros(components), np.zeros((components, components))
        for batch in batches:
            rows = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, components)
            n += len(rows)
            sums += rows.sum(0)
            squares += rows.T @ rows  # coordinates are centred already
        made = np.concatenate([[n], sums, squares.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(made), dtype=np.int32)), pa.array(made)], ["i", "v"])

    total = whitened.select("whitened").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
    made = np.zeros(1 + components + components**2)
    for r in total.collect():  # one row per pair of components
        made[r["i"]] = r["v"]
    if not made[0]:
        return 0.0
    mean = made[1 : components + 1] / made[0]
    covariance = made[components + 1 :].reshape(components, components) / made[0] - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(components)).max())


def components_of(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for every vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    model = fit(embeddings, components)
    k = len(model.values)
    if not k:
        schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return embeddings.sparkSession.createDataFrame([], schema)
    rows = stage(whiten(embeddings, model), "whitened")
    error = identity_error(rows, k)
    explained = F.array(*[F.lit(v) for v in model.explained])
    each = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).cast(T.IntegerType()).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(explained, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
