"""Embedding whitening: leading principal components, scaled to unit variance.

Sums and then centred second moments are gathered in two passes over the vectors, merged
in bounded steps. The covariance of d dimensions is d x d, whatever the number of rows; its
leading eigenpairs are found on the driver: Householder reflections make it tridiagonal,
bisection on Sturm counts finds the eigenvalues, inverse iteration the eigenvectors, which
are made orthogonal within clusters of close eigenvalues. The components are broadcast and
every vector is projected where it lies.

Vectors of another length are a table of their own and get their own components.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subtide.llm.scratch import store

#: Partial matrices that are added in one task.
MERGE = 64
#: Rows that are turned into a dense matrix at once.
SLICE_ROWS = 4096
#: An integer entry beyond this is no entry: sums of products must fit.
LARGEST = 1 << 52
#: Eigenvalues this close, as a share of the matrix's norm, have vectors made orthogonal.
CLUSTER = 1e-3
EPS = np.finfo(np.float64).eps


# ---- eigenpairs of a symmetric matrix -----------------------------------------------

def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Diagonal, off-diagonal, and the Householder reflections (first row, unit vector)
    that make the symmetric matrix tridiagonal."""
    a = np.array(matrix, dtype=np.float64)
    n = len(a)
    reflections = []
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        tail = np.abs(x[1:]).max()
        if tail == 0:
            continue
        length = np.linalg.norm(x)
        x[0] += np.copysign(length, x[0])
        v = x / np.linalg.norm(x)
        reflections.append((k + 1, v))
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        w = p - v * (v @ p)
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1:, k] -= 2 * v * (v @ a[k + 1:, k])
        a[k, k + 1:] = a[k + 1:, k]
    return np.diagonal(a).copy(), np.diagonal(a, -1).copy(), reflections


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each number, how many eigenvalues of the tridiagonal matrix are less than it."""
    tiny = np.finfo(np.float64).tiny / EPS
    floor = max(tiny, EPS * EPS * max(np.abs(diagonal).max(), np.abs(off).max(initial=0)))
    q, counts = np.ones_like(at), np.zeros(len(at), dtype=np.int64)
    for a, b in zip(diagonal, np.concatenate([[0], off])):
        q = a - at - b * b / q
        q = np.where(np.abs(q) < floor, -floor, q)
        counts += q < 0
    return counts


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, largest first, each halved in on until no number lies
    between its bounds."""
    n = len(diagonal)
    reach = np.concatenate([[0], np.abs(off)]) + np.concatenate([np.abs(off), [0]])
    pad = 4 * EPS * np.abs(diagonal).max() + np.finfo(np.float64).tiny
    low = np.full(k, (diagonal - reach).min() - pad)
    high = np.full(k, (diagonal + reach).max() + pad)
    below = n - 1 - np.arange(k)  # so many eigenvalues are less than the wanted one
    while True:
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            return high
        less = sturm_counts(diagonal, off, middle)
        high, low = np.where(less > below, middle, high), np.where(less > below, low, middle)


def _solve_shifted(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, floor: float) -> np.ndarray:
    """x with (T - shift) x = right by elimination with row exchanges; pivots of no size
    become ``floor``."""
    n = len(diagonal)
    rows = np.zeros((n, 3))
    right = right.copy()
    now = np.array([diagonal[0] - shift, off[0] if n > 1 else 0.0, 0.0])
    for i in range(n - 1):
        after = np.array([off[i], diagonal[i + 1] - shift, off[i + 1] if i + 2 < n else 0.0])
        if abs(after[0]) > abs(now[0]):
            now, after = after, now
            right[i], right[i + 1] = right[i + 1], right[i]
        if now[0] == 0:
            now[0] = floor
        factor = after[0] / now[0]
        rows[i] = now
        right[i + 1] -= factor * right[i]
        now = np.array([after[1] - factor * now[1], after[2] - factor * now[2], 0.0])
    rows[n - 1] = now if abs(now[0]) > floor else (floor, 0, 0)
    x = np.zeros(n + 2)
    for i in range(n - 1, -1, -1):
        x[i] = (right[i] - rows[i, 1] * x[i + 1] - rows[i, 2] * x[i + 2]) / rows[i, 0]
        if abs(x[i]) > 1e150:  # a multiple serves as well
            x, right = x * 1e-150, right * 1e-150
    return x[:n]


def eigenvectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix as rows, for falling eigenvalues."""
    n = len(diagonal)
    norm = max(np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0), np.finfo(np.float64).tiny)
    rng = np.random.default_rng(0)
    found: list[np.ndarray] = []
    cluster = 0
    for i, value in enumerate(values):
        if i and values[i - 1] - value > CLUSTER * norm:
            cluster = i
        # copies of one value get shifts of their own
        shift = value - 4 * EPS * norm * (i - cluster)
        x = rng.standard_normal(n)
        for _ in range(5):
            for _ in range(2):
                for other in found[cluster:]:
                    x -= (other @ x) * other
            x /= np.linalg.norm(x)
            x = _solve_shifted(diagonal, off, shift, x, EPS * norm)
            x /= np.abs(x).max()
        for _ in range(2):
            for other in found[cluster:]:
                x -= (other @ x) * other
        found.append(x / np.linalg.norm(x))
    return np.array(found)


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as rows) of the k largest eigenvalues of a symmetric
    matrix, largest first; those that are zero to rounding are left out."""
    size = np.abs(matrix).max(initial=0)
    if not size > 0:
        return np.empty(0), np.empty((0, len(matrix)))
    diagonal, off, reflections = tridiagonal(matrix / size)
    values = leading_eigenvalues(diagonal, off, min(k, len(matrix)))
    values = values[values > len(matrix) * EPS * values[0]]
    vectors = eigenvectors(diagonal, off, values)
    for first, v in reversed(reflections):
        vectors[:, first:] -= 2 * np.outer(vectors[:, first:] @ v, v)
    return values * size, vectors


# ---- passes over the vectors ----------------------------------------------------------

def as_integers(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, x, dims): every entry c as floor(1024 c) + 100000. Vectors that are null or
    empty, or hold a null, a non-finite entry or one too large for its integer, are left out."""
    entry = F.col("entries")
    fine = F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST / 1024))
    kept = vectors.select(F.col(key).alias("vec_id"), F.col(vector).cast("array<double>").alias("entries")).filter(
        (F.size(entry) > 0) & F.coalesce(fine, F.lit(False))
    )
    return kept.select("vec_id", F.transform(entry, lambda c: F.floor(c * 1024) + 100_000).alias("x"), F.size(entry).alias("dims"))


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, np.ndarray, np.ndarray]]:
    """(batch, dims, rows of the batch of that length, their matrix), in small slices."""
    for whole in batches:
        for start in range(0, whole.num_rows, SLICE_ROWS):
            batch = whole.slice(start, SLICE_ROWS)
            lists = batch.column("x")
            flat, ends = lists.flatten().to_numpy(), np.cumsum(batch.column("dims").to_numpy().astype(np.int64))
            sizes = batch.column("dims").to_numpy()
            for dims in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == dims)
                yield batch, dims, rows, flat[(ends[rows] - dims)[:, None] + np.arange(dims)]


def sums(integers: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """For each length of vectors: their number, and the exact sum of each dimension as
    Python integers."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for _, dims, rows, x in _matrices(batches):
            high = x >> 26
            total = high.sum(axis=0).astype(object) * (1 << 26) + (x - (high << 26)).sum(axis=0).astype(object)
            n, before = held.get(dims, (0, 0))
            held[dims] = n + len(rows), before + total
        for dims, (n, total) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dims] * dims, pa.int32()), pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()),
                 pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))],
                names=["dims", "i", "n", "s"],
            )

    found: dict[int, tuple[int, np.ndarray]] = {}
    partials = integers.select("x", "dims").mapInArrow(partial, "dims int, i int, n long, s decimal(38,0)")
    merged = partials.groupBy("dims", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    for r in merged.collect():  # one row for each dimension, not for each vector
        n, total = found.setdefault(r.dims, (r.n, np.zeros(r.dims, dtype=object)))
        total[r.i] = int(r.s)
    return found


def centred(x: np.ndarray, n: int, total: np.ndarray) -> np.ndarray:
    """x minus the mean, from exact n x - total where that fits 64 bits."""
    if n * (int(np.abs(x).max(initial=0)) + 1) < 1 << 61:
        return (n * x - total.astype(np.int64)) / n
    return ((n * x.astype(object) - total) / n).astype(np.float64)


def moments(integers: DataFrame, fit: dict[int, tuple[int, np.ndarray]]) -> dict[int, np.ndarray]:
    """For each length of vectors their covariance, divisor n, centred before multiplying."""
    spark = integers.sparkSession
    given = spark.sparkContext.broadcast(fit)  # a number for each dimension

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for _, dims, _, x in _matrices(batches):
            c = centred(x, *given.value[dims])
            held[dims] = held.get(dims, 0) + c.T @ c
        for dims, matrix in held.items():
            yield as_rows(dims, matrix)

    def as_rows(dims: int, matrix: np.ndarray) -> pa.RecordBatch:
        lists = pa.ListArray.from_arrays(np.arange(0, dims * dims + 1, dims, dtype=np.int32), pa.array(matrix.ravel()))
        return pa.RecordBatch.from_arrays([pa.array([dims] * dims, pa.int32()), pa.array(range(dims), pa.int32()), lists], names=["dims", "i", "row"])

    def add(group: pa.Table) -> pa.Table:
        group = group.sort_by("part").combine_chunks()
        dims = group.column("dims")[0].as_py()
        total = group.column("row").combine_chunks().flatten().to_numpy().reshape(-1, dims).sum(axis=0)
        first = group.slice(0, 1)
        return first.set_column(first.schema.get_field_index("row"), "row", pa.array([total.tolist()], pa.list_(pa.float64())))

    kind = "part int, dims int, i int, row array<double>"
    now = store(
        integers.select("x", "dims").mapInArrow(partial, "dims int, i int, row array<double>").select(F.spark_partition_id().alias("part"), "dims", "i", "row"),
        "moments",
    )
    last = now.agg(F.max("part")).first()[0]
    while last:
        now = store(now.withColumn("part", F.floor(F.col("part") / MERGE).cast("int")).groupBy("part", "dims", "i").applyInArrow(add, kind), "moments")
        last //= MERGE
    found: dict[int, np.ndarray] = {}
    for r in now.collect():  # d rows of d numbers for vectors of d entries
        found.setdefault(r.dims, np.zeros((r.dims, r.dims)))[r.i] = r.row
    return {dims: (m + m.T) / (2 * fit[dims][0]) for dims, m in found.items()}


def squared_deviations(x: np.ndarray, n: int, total: np.ndarray) -> list[int | None]:
    """The sum over dimensions of (n x - total) squared, exact; None beyond 64 bits."""
    exact = n * x.astype(object) - total
    most = int(np.abs(exact).max(initial=0))
    if most * most * x.shape[1] < 1 << 63:
        return (exact.astype(np.int64) ** 2).sum(axis=1).tolist()
    return [s if s < 1 << 63 else None for s in (exact**2).sum(axis=1).tolist()]


def _pick(values: dict[int, list[float]] | dict[int, float], kind: str) -> Column:
    """The value of the row's number of dimensions."""
    if not values:
        return F.lit(None).cast(kind)
    pairs = [part for dims, v in values.items() for part in (F.lit(dims), F.lit(v).cast(kind))]
    return F.element_at(F.create_map(*pairs), F.col("dims"))


def whiten(vectors: DataFrame, components: int = 8, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """A row for each vector and component: vec_id, component (from 1), n, deviation,
    whitened, explained, identity_error.

    Entries become integers (see ``as_integers``). n counts the vectors fitted, deviation is
    the sum over dimensions of (n x - S) squared with S the sums (null beyond 64 bits),
    whitened the centred vector along the component over the component's standard
    deviation, explained the component's share of the variance, and identity_error the
    largest entry by which the whitened values' covariance misses the identity.

    Null vectors and such with null or non-finite entries are left out; rows with equal or
    null keys are kept. Vectors of different lengths are fitted apart, each with its own n
    and error. There are no more components than dimensions, and none without variance: one
    vector, or copies of one, give no row, and neither does an empty table.
    """
    spark = vectors.sparkSession
    integers = store(as_integers(vectors, key, vector), "integers")
    fit = sums(integers)
    covariance = moments(integers, fit)
    models: dict[int, np.ndarray] = {}
    explained: dict[int, list[float]] = {}
    for dims, matrix in covariance.items():
        values, directions = leading_components(matrix, components)
        models[dims] = directions / np.sqrt(values)[:, None]
        explained[dims] = (values / np.trace(matrix)).tolist()
    given = spark.sparkContext.broadcast((fit, models))  # for each length d, a few rows of d numbers

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, models = given.value
        for batch, dims, rows, x in _matrices(batches):
            projected = centred(x, *fit[dims]) @ models[dims].T
            k = projected.shape[1]
            lists = pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * k, pa.array(projected.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(rows)), pa.array([dims] * len(rows), pa.int32()),
                 pa.array([fit[dims][0]] * len(rows), pa.int64()), pa.array(squared_deviations(x, *fit[dims]), pa.int64()), lists],
                names=["vec_id", "dims", "n", "deviation", "projected"],
            )

    id_kind = dict(integers.dtypes)["vec_id"]
    projected = store(
        integers.mapInArrow(project, f"vec_id {id_kind}, dims int, n long, deviation long, projected array<double>"), "projected"
    )
    return projected.select(
        "vec_id", "dims", "n", "deviation", F.posexplode("projected").alias("place", "whitened"),
    ).select(
        "vec_id", (F.col("place") + 1).alias("component"), "n", "deviation", "whitened",
        F.element_at(_pick(explained, "array<double>"), F.col("place") + 1).alias("explained"),
        _pick(identity_errors(projected), "double").alias("identity_error"),
    )


def identity_errors(projected: DataFrame) -> dict[int, float]:
    """For each length of vectors, the largest absolute entry of the covariance of
    ``projected`` minus the identity; lengths without components are left out."""
    entry = F.col("projected")
    most = max((r.k for r in projected.groupBy(F.size("projected").alias("k")).agg(F.count("*")).collect()), default=0)
    pairs = [(i, j) for i in range(most) for j in range(i + 1)]
    if not pairs:
        return {}
    found = projected.groupBy("dims").agg(*[F.covar_pop(F.get(entry, i), F.get(entry, j)).alias(f"c{i}_{j}") for i, j in pairs])
    return {
        r.dims: max(abs(r[f"c{i}_{j}"] - (i == j)) for i, j in pairs if r[f"c{i}_{j}"] is not None)
        for r in found.collect() if r.c0_0 is not None
    }
