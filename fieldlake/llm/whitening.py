"""Embedding whitening from the exact characteristic polynomial of the integer scatter.

Vectors are put on an integer grid, so the scatter of the distinct ones is an integer matrix.
Tasks sum it exactly, and find its characteristic polynomial modulo one prime each, by
Hessenberg reduction; Chinese remaindering gives the polynomial itself. Its roots are real, so
the sign changes of a shifted polynomial count those above a point, and bisection isolates the
largest ones to any precision. Inverse iteration gives the null space at each root. What
reaches the driver has the size of the dimension squared, whatever the number of vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlake.llm.common import drop, prepare, stored
from fieldlake.llm.registry import query

SCALE = 256
COMPONENTS = 4
#: Relative precision of a root in bits, and the most that two neighbours are refined to;
#: neighbours that agree in so many bits count as one root of higher multiplicity.
BITS, MOST_BITS = 72, 576
#: Exact sums travel as digits in this base, so that sums of digits fit a long.
DIGIT_BITS = 32
EXACT = 1 << 53


def usable(vector: Column) -> Column:
    """Whether a vector and all its entries are there and finite."""
    return vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & (F.abs(c) < float("inf")))


def on_grid(vector: Column, scale: int, size: int) -> Column:
    """Entries times ``scale`` rounded down to longs, with zeros up to ``size`` entries."""
    entries = F.transform(vector, lambda c: F.floor(c.cast("double") * scale))
    return F.concat(entries, F.array_repeat(F.lit(0).cast("long"), F.lit(size) - F.size(vector)))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _peak(matrix: np.ndarray) -> int:
    return max(int(matrix.max(initial=0)), -int(matrix.min(initial=0)))


def exact_sums(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, sums of products) of a long matrix's columns, as unbounded integers.

    Blocks of rows are multiplied in float64 while every partial sum stays below 2**53.
    """
    size = matrix.shape[1]
    sums, products = np.zeros(size, object), np.zeros((size, size), object)
    peak = max(1, _peak(matrix))
    step = (EXACT - 1) // (peak * peak)
    if not step:
        large = matrix.astype(object)
        return large.sum(axis=0), large.T @ large
    for start in range(0, len(matrix), min(step, 1 << 16)):
        block = matrix[start : start + min(step, 1 << 16)].astype(np.float64)
        sums = sums + block.sum(axis=0).astype(np.int64).astype(object)
        products = products + (block.T @ block).astype(np.int64).astype(object)
    return sums, products


def _digits(value: int) -> list[int]:
    sign, value, out = (-1 if value < 0 else 1), abs(value), []
    while value:
        out.append(sign * (value & ((1 << DIGIT_BITS) - 1)))
        value >>= DIGIT_BITS
    return out


def _sums_kernel(size: int):
    """Digits of the count (-1, -1), the sums (-1, j) and the products (i, j) of a task's rows."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums, products = 0, np.zeros(size, object), np.zeros((size, size), object)
        for batch in batches:
            if batch.num_rows:
                some, pairs = exact_sums(_matrix(batch))
                count, sums, products = count + batch.num_rows, sums + some, products + pairs
        cells = {(-1, -1): count} | {(-1, j): int(sums[j]) for j in range(size)}
        cells |= {(i, j): int(products[i, j]) for i in range(size) for j in range(i, size)}
        rows = [(i, j, k, digit) for (i, j), value in cells.items() for k, digit in enumerate(_digits(value))]
        columns = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["i", "j", "place", "digit"])

    return kernel


@dataclass
class Scatter:
    """Count, sums, and ``count**2`` times the covariance of the fit list, all exact."""

    count: int
    sums: list[int]
    matrix: np.ndarray  # of unbounded integers


def scatter_of(fit: DataFrame, size: int) -> Scatter:
    """Exact scatter of the rows of ``fit`` (x); tasks send their sums, not their rows."""
    digits = fit.mapInArrow(_sums_kernel(size), "i long, j long, place long, digit long")
    total = digits.groupBy("i", "j", "place").agg(F.sum("digit").alias("digit")).toArrow()
    cells: dict[tuple[int, int], int] = {}
    for i, j, place, digit in zip(*[total.column(name).to_pylist() for name in ("i", "j", "place", "digit")]):
        cells[i, j] = cells.get((i, j), 0) + (digit << (DIGIT_BITS * place))
    count = cells.get((-1, -1), 0)
    sums = [cells.get((-1, j), 0) for j in range(size)]
    matrix = np.zeros((size, size), object)
    for i in range(size):
        for j in range(i, size):
            matrix[i, j] = matrix[j, i] = count * cells.get((i, j), 0) - sums[i] * sums[j]
    return Scatter(count, sums, matrix)


def _is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide every number below 2**32."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        power = pow(base, odd, n)
        if power not in (1, n - 1) and not any(pow(base, odd << k, n) == n - 1 for k in range(1, twos)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """The largest primes below 2**31 whose product is above ``bound``."""
    found, product, n = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def polynomial_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Characteristic polynomial modulo ``p`` (below 2**31), lowest power first.

    Row operations with their inverses on the columns bring the matrix to Hessenberg form,
    whose leading minors follow one from another.
    """
    h = (matrix % p).astype(np.int64)
    size = len(h)
    for k in range(1, size - 1):
        below = np.flatnonzero(h[k:, k - 1])
        if not len(below):
            continue
        pivot = k + below[0]
        h[[k, pivot]] = h[[pivot, k]]
        h[:, [k, pivot]] = h[:, [pivot, k]]
        factor = h[k + 1 :, k - 1] * pow(int(h[k, k - 1]), -1, p) % p
        h[k + 1 :] = (h[k + 1 :] - factor[:, None] * h[k] % p) % p
        h[:, k] = (h[:, k] + (h[:, k + 1 :] * factor % p).sum(axis=1)) % p
    minors = np.zeros((size + 1, size + 1), np.int64)
    minors[0, 0] = 1
    for k in range(1, size + 1):
        grown = np.roll(minors[k - 1], 1) - h[k - 1, k - 1] * minors[k - 1] % p
        chain, weights = 1, np.zeros(k - 1, np.int64)
        for back in range(1, k):
            chain = chain * int(h[k - back, k - back - 1]) % p
            weights[back - 1] = chain * int(h[k - 1 - back, k - 1]) % p
        grown = grown - (weights[:, None] * minors[: k - 1][::-1] % p).sum(axis=0)
        minors[k] = grown % p
    return minors[size]


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Characteristic polynomial of a positive semidefinite integer matrix, lowest power first.

    A coefficient is, but for its sign, a symmetric function of the eigenvalues, which is
    largest where all are equal; primes are taken until their product is beyond that. Every
    task takes some of the primes.
    """
    size, trace = len(matrix), int(matrix.trace())
    primes = primes_beyond(max(math.comb(size, k) * trace**k // size**k + 1 for k in range(size + 1)))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column("id").to_pylist()
            made = [polynomial_modulo(matrix, primes[n]).tolist() for n in numbers]
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(made, pa.list_(pa.int64()))], ["id", "rest"])

    parts = min(len(primes), 2 * spark.sparkContext.defaultParallelism)
    rests = spark.range(0, len(primes), 1, parts).mapInArrow(kernel, "id long, rest array<long>").toArrow()
    value, modulus = np.zeros(size + 1, object), 1
    signs = np.array([(-1) ** (size - j) for j in range(size + 1)], object)
    for number, rest in zip(rests.column("id").to_pylist(), rests.column("rest").to_pylist()):
        p = primes[number]
        step = (signs * np.array(rest, object) - value) * pow(modulus, -1, p) % p
        value, modulus = value + modulus * step, modulus * p
    return [int(s * v) for s, v in zip(signs, value)]


def roots_above(polynomial: list[int], point: int, shift: int = 0) -> int:
    """How many roots, with multiplicity, are above ``point / 2**shift``; all roots are real.

    By Descartes' rule, which is exact for real roots, on the polynomial moved to the point.
    """
    size = len(polynomial) - 1
    moved = [c << (shift * (size - j)) for j, c in enumerate(polynomial)]
    for done in range(size):
        for j in range(size - 1, done - 1, -1):
            moved[j] += point * moved[j + 1]
    signs = [c > 0 for c in moved if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


@dataclass
class Root:
    """A root in (low, high], both over ``2**shift``; ``place`` is 1 for the largest."""

    polynomial: list[int]
    place: int
    low: int
    high: int
    shift: int = 0

    def refine(self, bits: int) -> None:
        """Halve the interval until it is ``2**-bits`` of the root."""
        while (self.high - self.low) << bits > self.high:
            if self.high - self.low == 1:
                self.low, self.high, self.shift = 2 * self.low, 2 * self.high, self.shift + 1
            middle = (self.low + self.high) // 2
            if roots_above(self.polynomial, middle, self.shift) >= self.place:
                self.low = middle
            else:
                self.high = middle

    @property
    def ends(self) -> tuple[Fraction, Fraction]:
        return Fraction(self.low, 1 << self.shift), Fraction(self.high, 1 << self.shift)


def _apart(larger: Root, smaller: Root) -> bool:
    """Whether the gap is far wider than either interval, as inverse iteration needs it."""
    (low, high), (other_low, other_high) = larger.ends, smaller.ends
    return low > other_high and low - other_high > (1 << 40) * max(high - low, other_high - other_low)


def largest_roots(polynomial: list[int], count: int) -> list[list[Root]]:
    """The ``count`` largest positive roots and the next one, in groups of equal ones."""
    trace = -polynomial[-2] if len(polynomial) > 1 else 0
    positive = roots_above(polynomial, 0)
    roots = [Root(polynomial, place, 0, trace) for place in range(1, min(count + 1, positive) + 1)]
    for root in roots:
        root.refine(BITS)
    groups: list[list[Root]] = []
    for root in roots:
        if groups:
            before, bits = groups[-1][-1], BITS
            while not _apart(before, root) and bits < MOST_BITS:
                bits = min(2 * bits, MOST_BITS)
                before.refine(bits)
                root.refine(bits)
            if not _apart(before, root):
                groups[-1].append(root)
                continue
        groups.append([root])
    return groups


def _solve(matrix: np.ndarray, right: np.ndarray, least: Decimal) -> np.ndarray:
    """Solution by elimination with row exchanges; a pivot below ``least`` counts as ``least``."""
    a, b = matrix.copy(), right.copy()
    size = len(a)
    for k in range(size):
        pivot = k + max(range(size - k), key=lambda i: abs(a[k + i, k]))
        a[[k, pivot]], b[[k, pivot]] = a[[pivot, k]], b[[pivot, k]]
        if abs(a[k, k]) < least:
            a[k, k] = least
        factor = a[k + 1 :, k] / a[k, k]
        a[k + 1 :, k:] = a[k + 1 :, k:] - factor[:, None] * a[k, k:]
        b[k + 1 :] = b[k + 1 :] - factor[:, None] * b[k]
    for k in range(size - 1, -1, -1):
        b[k] = (b[k] - (a[k, k + 1 :, None] * b[k + 1 :]).sum(axis=0)) / a[k, k]
    return b


def _orthonormal(columns: np.ndarray) -> np.ndarray:
    out = columns.copy()
    for j in range(out.shape[1]):
        for _ in range(2):
            for i in range(j):
                out[:, j] = out[:, j] - out[:, i] * (out[:, i] * out[:, j]).sum()
        out[:, j] = out[:, j] / (out[:, j] * out[:, j]).sum().sqrt()
    return out


def components_at(matrix: np.ndarray, group: list[Root]) -> np.ndarray:
    """Orthonormal columns that span the null space at a group of equal roots.

    Inverse iteration in decimals of more than twice the root's precision. The entry of
    largest size is positive.
    """
    bits = max(max(1, root.high).bit_length() - max(1, root.high - root.low).bit_length() for root in group)
    with localcontext() as context:
        context.prec = 30 + int(2.2 * (bits + 64) * math.log10(2))
        value = sum((sum(root.ends) for root in group), Fraction(0)) / (2 * len(group))
        value = Decimal(value.numerator) / Decimal(value.denominator)
        size = len(matrix)
        moved = np.array([[Decimal(int(c)) for c in row] for row in matrix], object)
        moved[np.arange(size), np.arange(size)] -= value
        least = value.scaleb(-context.prec + 8)
        start = np.random.default_rng(11).integers(-1000, 1000, (size, len(group)))
        columns = _orthonormal(np.array([[Decimal(int(c)) for c in row] for row in start], object))
        for _ in range(4):
            columns = _orthonormal(_solve(moved, columns, least))
        out = columns.astype(np.float64)
    return out * np.sign(out[np.abs(out).argmax(axis=0), np.arange(len(group))])


@dataclass
class Whitening:
    """A fitted transform: ``(count * x - sums) @ directions`` are the whitened values."""

    scatter: Scatter
    directions: np.ndarray  # a unit component over the root of its scatter, per column
    explained: list[float]


def fit_whitening(spark: SparkSession, scatter: Scatter, components: int) -> Whitening:
    """The ``components`` largest components; fewer where the vectors span fewer dimensions."""
    columns, explained = [], []
    if scatter.count:
        trace = int(scatter.matrix.trace())
        polynomial = characteristic_polynomial(spark, scatter.matrix)
        for group in largest_roots(polynomial, components):
            if len(columns) >= components:
                break
            vectors = components_at(scatter.matrix, group)
            for root, vector in zip(group, vectors.T):
                value = sum(root.ends) / 2
                # the scatter may be beyond double range, its root is not
                columns.append(vector / (math.isqrt(int(value * (1 << 128))) / 2.0**64))
                explained.append(float(value / trace))
    size = len(scatter.sums)
    made = np.array(columns[:components]).T if columns else np.zeros((size, 0))
    return Whitening(scatter, made, explained[:components])


def _project_kernel(fitted: Whitening, keep: tuple[str, ...]):
    count, sums = fitted.scatter.count, fitted.scatter.sums
    largest = max((abs(s) for s in sums), default=0)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch)
            bound = count * _peak(x) + largest
            if len(sums) * bound * bound < 1 << 63:
                moved = count * x - np.array(sums, np.int64)
                deviation = pa.array((moved * moved).sum(axis=1)).cast(pa.decimal128(38, 0))
            else:
                moved = count * x.astype(object) - np.array(sums, object)
                exact = [int(v) for v in (moved * moved).sum(axis=1)]
                deviation = pa.array([Decimal(v) if v < 10**38 else None for v in exact], pa.decimal128(38, 0))
            whitened = moved.astype(np.float64) @ fitted.directions
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * whitened.shape[1])
            values = pa.ListArray.from_arrays(ends, pa.array(whitened.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, keep), deviation, values], [*keep, "deviation", "whitened"]
            )

    return kernel


def _project(rows: DataFrame, fitted: Whitening, keep: tuple[str, ...] = ()) -> DataFrame:
    kinds = "".join(f"{name} {dict(rows.dtypes)[name]}, " for name in keep)
    return rows.mapInArrow(_project_kernel(fitted, keep), f"{kinds}deviation decimal(38,0), whitened array<double>")


def _identity_error(fit: DataFrame, fitted: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    number = fitted.directions.shape[1]
    pairs = [(i, j) for i in range(number) for j in range(i, number)]
    projected = _project(fit, fitted).select(*[F.col("whitened")[i].alias(f"w{i}") for i in range(number)])
    cells = projected.agg(*[F.covar_pop(f"w{i}", f"w{j}") for i, j in pairs]).first()
    return max(abs(cell - (i == j)) for cell, (i, j) in zip(cells, pairs))


def whiten(
    rows: DataFrame,
    components: int = COMPONENTS,
    scale: int = SCALE,
    row_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error per row and component.

    Rows whose vector is null or holds null or non-finite entries are dropped. Entries become
    ``floor(scale * c)``, at the ends of long where they go beyond it. The fit list is each
    distinct grid vector once. Shorter vectors count as filled up with zeros, an empty one as
    zeros only. Repeated rows and rows of one id or of a null id are kept, each with the same
    values; equal eigenvalues get some orthonormal basis, the same for all rows. There are as
    many components as positive eigenvalues, so an empty table, or one with a single distinct
    vector, gives no row. ``deviation`` is a decimal, null from 10**38. Columns other than the
    two named are not read.

    The distinct vectors are stored in the shared folder while the transform is fitted.
    """
    spark = prepare(rows.sparkSession)
    named = rows.select(F.col(row_id).alias("vec_id"), F.col(vector).alias("vector"))
    named = named.filter(usable(F.col("vector")))
    size = named.agg(F.max(F.size("vector"))).first()[0] or 0
    gridded = named.select("vec_id", on_grid(F.col("vector"), scale, size).alias("x"))
    if size:
        fit, path = stored(gridded.select("x").distinct(), "grid-vectors")
        fitted = fit_whitening(spark, scatter_of(fit, size), components)
        error = _identity_error(fit, fitted) if fitted.explained else 0.0
        drop(spark, path)
    else:
        fitted, error = Whitening(Scatter(0, [], np.zeros((0, 0), object)), np.zeros((0, 0)), []), 0.0
    projected = _project(gridded, fitted, ("vec_id",))
    exploded = projected.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    shares = F.array(*[F.lit(share) for share in fitted.explained]).cast("array<double>")
    return exploded.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(fitted.scatter.count).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


@query()
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on the four largest components; a deviation beyond long is null."""
    found = whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))
