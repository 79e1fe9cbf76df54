"""Embedding whitening with a covariance found by polarisation.

Vectors become integers, ``floor(scale * c)``, so that everything up to the covariance
is exact. The fit list holds each distinct integer vector once: n vectors with sums S
per dimension. With the centred value ``n * x - S``, an integer again, one pass
aggregates the squares of every dimension and of the sum of every pair of dimensions.
Their differences recover all cross-covariances,

    2 * cov(i, j) = var(i + j) - var(i) - var(j),

which are rounded to doubles only when the matrix is assembled for ``eigh``.

Tasks square in 64-bit limbs of ``LIMB`` bits and hand on one row per pair of
dimensions and digit; the digits are added up in Spark. What reaches the driver, and is
sent to the tasks, has the size of the matrix and does not follow the number of rows.
Sums, pairs and projection are Arrow batches; the distinct vectors meet in one shuffle
that combines copies first.

Defined results: rows whose vector is null, empty or holds a null or non-finite entry
are left out, and so are rows of another dimension than most (of equally frequent ones
the smallest counts). An entry too large for a long becomes the nearest long. Null and
repeated keys stay, one set of rows per input row. A component without variance (up to
rounding) has a null whitened value; with no variance at all ``explained`` is null too.
``deviation`` is null past 38 digits. Fewer dimensions than components give fewer
components. Columns beside key and vector are not read. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerspark.session import materialize

COMPONENTS = 4
SCALE = 256.0
LIMB = 21
DIGIT = 40
# Values that one step works on: bounds the memory of a task for any dimension.
CHUNK = 1 << 20
# Integers up to here are added and squared in int64 limbs, larger ones as Python integers.
PLAIN = 1 << 61

Batches = Iterator[pa.RecordBatch]


def integer_vectors(rows: DataFrame, key: str, vector: str, scale: float = SCALE) -> DataFrame:
    """``vec_id, x`` of the rows that take part, written once."""
    vec = F.col(vector).cast("array<double>")
    bad = F.exists(vec, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    x = F.transform(vec, lambda c: F.floor(c * F.lit(scale)))
    slim = rows.filter(F.col(vector).isNotNull() & (F.size(vec) > 0) & ~bad)
    stored = materialize(slim.select(F.col(key).alias("vec_id"), x.alias("x")), "whiten-vectors")
    usual = stored.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    return stored.filter(F.size("x") == (usual["dim"] if usual else 0))


def matrix_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def chunks(x: np.ndarray) -> Iterator[np.ndarray]:
    step = max(1, CHUNK // max(1, x.shape[1]))
    for at in range(0, len(x), step):
        yield x[at : at + step]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S``, exact: int64 where that is wide enough, else Python integers."""
    largest = max(int(x.max(initial=0)), -int(x.min(initial=0)))
    if n * largest + max(map(abs, sums), default=0) < PLAIN:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def limbs(values: np.ndarray) -> list[np.ndarray]:
    """Parts of ``LIMB`` bits each, lowest first; the last one carries the sign."""
    bits = max(int(values.max(initial=0)), -int(values.min(initial=0))).bit_length() + 1
    parts = []
    for _ in range(-(-bits // LIMB) - 1):
        parts.append(values & ((1 << LIMB) - 1))
        values = values >> LIMB
    return [*parts, values]


def square_sums(values: np.ndarray) -> np.ndarray:
    """Exact sum of squares of each column, as Python integers."""
    if values.dtype == object:
        return (values * values).sum(axis=0)
    parts = limbs(values)
    total = np.zeros(values.shape[1], dtype=object)
    for a, left in enumerate(parts):
        for b, right in enumerate(parts[a:], a):
            product = np.einsum("ij,ij->j", left, right).astype(object)
            total += product << (LIMB * (a + b) + (a != b))
    return total


def column_sums(values: np.ndarray) -> np.ndarray:
    high = (values >> 32).sum(axis=0).astype(object)
    return (high << 32) + (values & 0xFFFFFFFF).sum(axis=0).astype(object)


DIGITS = "i int, j int, place int, digit long"


def digit_rows(sums: dict[tuple[int, int], int]) -> pa.RecordBatch:
    """Integers of any size as rows of signed digits, which Spark can add up."""
    out = []
    for (i, j), value in sums.items():
        place, sign, rest = 0, (value > 0) - (value < 0), abs(value)
        while rest:
            out.append((i, j, place, sign * (rest & ((1 << DIGIT) - 1))))
            rest >>= DIGIT
            place += 1
    columns = list(zip(*out)) or [()] * 4
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, kinds)], names=["i", "j", "place", "digit"]
    )


def totals(fit: DataFrame, of_chunk: Callable[[np.ndarray], Iterator[tuple[int, int, np.ndarray]]]) -> dict:
    """Exact totals over all vectors; ``of_chunk`` yields ``i, first j, values`` of a chunk."""

    def partial(batches: Batches) -> Batches:
        sums: dict[tuple[int, int], int] = {}
        for batch in batches:
            for x in chunks(matrix_of(batch.column(0))):
                for i, first, values in of_chunk(x):
                    for j, value in enumerate(values, first):
                        sums[i, j] = sums.get((i, j), 0) + int(value)
        yield digit_rows(sums)

    added = fit.mapInArrow(partial, DIGITS).groupBy("i", "j", "place")
    found: dict[tuple[int, int], int] = {}
    for i, j, place, digit in added.agg(F.sum(F.col("digit").cast("decimal(38,0)"))).collect():
        found[i, j] = found.get((i, j), 0) + (int(digit) << (DIGIT * place))
    return found


def covariance(fit: DataFrame, dim: int) -> tuple[int, list[int], np.ndarray]:
    """``n``, sums per dimension and the covariance matrix of the distinct vectors."""

    def counted(x: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        yield 0, 0, column_sums(x)
        yield 1, 0, np.array([len(x)])

    first = totals(fit, counted)
    n, sums = first.get((1, 0), 0), [first.get((0, i), 0) for i in range(dim)]

    def squared(x: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        c = centred(x, n, sums)
        for i in range(c.shape[1]):
            # The dimension itself, then its sum with each later one.
            yield i, i, square_sums(c[:, i : i + 1])
            yield i, i + 1, square_sums(c[:, i : i + 1] + c[:, i + 1 :])

    square = totals(fit, squared)
    matrix = np.zeros((dim, dim))
    for i in range(dim):
        matrix[i, i] = square.get((i, i), 0) / n**3
        for j in range(i + 1, dim):
            twice = square.get((i, j), 0) - square.get((i, i), 0) - square.get((j, j), 0)
            matrix[i, j] = matrix[j, i] = twice / (2 * n**3)
    return n, sums, matrix


def principal(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Largest eigenvalues, their unit vectors as columns, and each one's share of the trace."""
    size = np.abs(matrix).max(initial=0.0) or 1.0
    values, vectors = np.linalg.eigh(matrix / size)
    order = np.argsort(-values, kind="stable")[:count]
    values, vectors = values[order], vectors[:, order]
    # What rounding leaves of a variance of zero is no variance.
    values = np.where(values > len(matrix) * np.finfo(float).eps * values.max(initial=0.0), values, 0.0)
    trace = np.trace(matrix / size)
    return values * size, vectors, values / trace if trace else np.full(len(values), np.nan)


def project(
    rows: DataFrame, n: int, sums: list[int], values: np.ndarray, vectors: np.ndarray
) -> DataFrame:
    """``vec_id, deviation, w`` of each row; ``w`` has one whitened value per component."""
    live = values > 0
    scaled = np.divide(vectors, np.sqrt(np.where(live, values, 1.0)))
    kind, limit = rows.schema["vec_id"].dataType.simpleString(), 10**38

    def apply(batches: Batches) -> Batches:
        for batch in batches:
            deviations, whitened = [], []
            for x in chunks(matrix_of(batch.column(1))):
                c = centred(x, n, sums)
                deviations += [int(v) for v in square_sums(c.T)]
                flat = (c / n).astype(float) @ scaled
                whitened += [[float(v) if ok else None for v, ok in zip(line, live)] for line in flat]
            kept = [Decimal(v) if v < limit else None for v in deviations]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(kept, pa.decimal128(38, 0)), pa.array(whitened, pa.list_(pa.float64()))],
                names=["vec_id", "deviation", "w"],
            )

    return rows.select("vec_id", "x").mapInArrow(apply, f"vec_id {kind}, deviation decimal(38,0), w array<double>")


def identity_error(fitted: DataFrame, live: list[int]) -> float | None:
    """Largest entry of the whitened vectors' covariance minus the identity, over the fit list."""
    pairs = [(a, b) for a in live for b in live if a <= b]
    if not pairs:
        return None
    entries = [F.covar_pop(F.col("w")[a], F.col("w")[b]) for a, b in pairs]
    found = fitted.agg(F.array(*entries)).first()[0]
    return max(abs(v - (a == b)) for v, (a, b) in zip(found, pairs))


def whiten(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
    scale: float = SCALE,
) -> DataFrame:
    """One row per vector and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    stored = integer_vectors(rows, key, vector, scale)
    fit = materialize(stored.select("x").distinct(), "whiten-fit")
    one = fit.first()
    dim = len(one["x"]) if one else 0
    n, sums, matrix = covariance(fit, dim) if dim else (0, [], np.zeros((0, 0)))
    values, vectors, explained = principal(matrix, components)
    fitted = project(fit.select(F.lit(0).alias("vec_id"), "x"), n, sums, values, vectors)
    error = identity_error(fitted, [int(k) for k in np.flatnonzero(values > 0)])
    shares = F.array(*[F.lit(float(s) if s == s else None).cast("double") for s in explained])
    projected = project(stored, n, sums, values, vectors)
    exploded = projected.select("vec_id", "deviation", F.posexplode("w").alias("nth", "whitened"))
    return exploded.select(
        "vec_id",
        (F.col("nth") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares.cast("array<double>"), F.col("nth")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
