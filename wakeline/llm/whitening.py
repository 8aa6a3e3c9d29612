"""Whitening of embeddings through the exact characteristic polynomial of their scatter.

Vectors become whole numbers ``x = floor(64 c) + 1000000``. Tasks add up exact integer scatters (in 16-bit limbs, so that products are
exact in 64-bit floats), Spark adds those by entry. ``M = n * sum(x x') - S S'``, a matrix of whole numbers, is n**2 times the covariance.

1. Its characteristic polynomial modulo each of many 31-bit primes comes from a Hessenberg reduction, one task row a
   prime; Chinese remaindering gives the coefficients, whose size Maclaurin's inequality bounds by the trace.
2. All roots are real, so the sign changes of the polynomial moved to ``a`` count its roots above ``a`` exactly, with multiplicity.
   Bisection with these counts isolates the largest roots in whole numbers.
3. One task row a root narrows it to ``ROOT_BITS`` bits by the polynomial's sign and solves for its null space by inverse
   iteration in ``DIGITS`` decimal digits; equal roots share a block of orthogonal vectors.

The driver holds matrices and polynomials of the vectors' dimension, never rows of the table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.sources.scratch import materialise

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
ROOT_BITS = 160
DIGITS = 100
#: Entries stop at these whole numbers, far outside of any 32-bit float times 64 that is below 2**62.
LIMIT = 1 << 62
_LIMB = 16
_ROWS = 1 << 14
_FLUSH = 1 << 10


def usable(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    named = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    return named.where(F.col("vector").isNotNull() & F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))


def whole(vectors: pa.Array, dim: int) -> np.ndarray:
    """floor(64 c) of each entry as a 64-bit integer (without the offset); vectors shorter than ``dim`` end with zeros."""
    sizes = np.asarray(pa.compute.list_value_length(vectors), np.int64)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        value = np.clip(np.floor(SCALE * flat), -float(LIMIT), float(LIMIT)).astype(np.int64)
    if len(sizes) and (sizes == dim).all():
        return value.reshape(len(sizes), dim)
    out = np.zeros((len(sizes), dim), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(value)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = value
    return out


def limbs(y: np.ndarray) -> list[np.ndarray]:
    """y as 16-bit digits from low to high, the last one signed, as floats."""
    out = []
    while np.abs(y).max(initial=0) >= 1 << _LIMB - 1:
        out.append((y & (1 << _LIMB) - 1).astype(np.float64))
        y = y >> _LIMB
    return [*out, y.astype(np.float64)]


def _scatter(dim: int):
    """Sums of products of all pairs of entries and of a column of ones, by 16-bit shifts."""
    upper = np.triu_indices(dim + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        blocks = 0

        def emit() -> Iterator[pa.RecordBatch]:
            for shift, sums in total.items():
                value = sums[upper]
                some = value != 0
                columns = [pa.array(c[some].astype(np.int32)) for c in (*upper, np.full(len(value), shift))]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(value[some])], names=["i", "j", "shift", "value"])
            total.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                y = whole(batch.column("vector").slice(at, _ROWS), dim)
                digits = limbs(np.column_stack([y, np.ones(len(y), np.int64)]))
                for k, a in enumerate(digits):
                    for m, b in enumerate(digits):
                        # Below 2**32 * _ROWS: exact in 53 bits.
                        product = (a.T @ b).astype(np.int64)
                        total[k + m] = total.get(k + m, 0) + product
                blocks += 1
                if blocks % _FLUSH == 0:
                    yield from emit()
        yield from emit()

    return run


def exact_scatter(rows: DataFrame, dim: int) -> tuple[int, list[int], list[list[int]]]:
    """n, S and M = n * sum(x x') - S S' of whole vectors, in Python integers."""
    parts = rows.select("vector").mapInArrow(_scatter(dim), "i int, j int, shift int, value long")
    # At most (dim + 1) * (dim + 2) / 2 rows for each of up to nine shifts.
    sums = parts.groupBy("i", "j", "shift").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    raw = [[0] * (dim + 1) for _ in range(dim + 1)]
    for r in sums:
        raw[r.i][r.j] += int(r.value) << _LIMB * r.shift
        if r.i != r.j:
            raw[r.j][r.i] = raw[r.i][r.j]
    n, s = raw[dim][dim], raw[dim][:dim]
    return n, s, [[n * raw[i][j] - s[i] * s[j] for j in range(dim)] for i in range(dim)]


# --- polynomial -----------------------------------------------------------------------


def is_prime(n: int) -> bool:
    """Miller-Rabin, exact below 3,215,031,751."""
    if n < 2 or n % 2 == 0:
        return n == 2
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if base % n and x not in (1, n - 1) and all((x := x * x % n) != n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_for(bound: int) -> list[int]:
    """Primes from 2**31 downwards whose product exceeds ``bound``."""
    found, product, candidate = [], 1, (1 << 31) - 1
    while product <= bound:
        if is_prime(candidate):
            found.append(candidate)
            product *= candidate
        candidate -= 2
    return found


def polynomial_mod(matrix: list[list[int]], p: int) -> np.ndarray:
    """Coefficients of det(z - matrix) modulo a prime below 2**31, from the constant up, by Hessenberg reduction."""
    h = np.array([[v % p for v in row] for row in matrix], np.int64).reshape(len(matrix), len(matrix))
    d = len(h)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            h[[k + 1, pivot]] = h[[pivot, k + 1]]
            h[:, [k + 1, pivot]] = h[:, [pivot, k + 1]]
        factor = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - factor[:, None] * h[k + 1]) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * factor % p).sum(1)) % p
    leading = np.zeros((d + 1, d + 1), np.int64)  # polynomials of the leading blocks
    leading[0, 0] = 1
    for k in range(d):
        weight, path = np.zeros(k + 1, np.int64), 1
        weight[k] = h[k, k]
        for i in range(k - 1, -1, -1):
            path = path * int(h[i + 1, i]) % p
            weight[i] = path * int(h[i, k]) % p
        leading[k + 1, 1:] = leading[k, :-1]
        leading[k + 1] = (leading[k + 1] - (weight[:, None] * leading[: k + 1] % p).sum(0)) % p
    return leading[d]


def coefficient_bound(trace: int, d: int) -> int:
    """No elementary symmetric function of d numbers that are not negative and add up to ``trace`` is larger."""
    return max(math.comb(d, k) * (trace**k // d**k + 1) for k in range(d + 1)) + 1


def characteristic(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(z - matrix), from the constant up, of a positive semidefinite matrix of whole numbers."""
    d = len(matrix)
    primes = primes_for(coefficient_bound(sum(matrix[i][i] for i in range(d)), d))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [polynomial_mod(matrix, p).tolist() for p in batch.column("prime").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("prime"), pa.array(found, pa.list_(pa.int64()))], names=["prime", "residues"])

    given = spark.createDataFrame([(p,) for p in primes], "prime long")
    rows = given.mapInArrow(run, "prime long, residues array<long>").collect()
    modulus = math.prod(primes)
    total = [0] * (d + 1)
    for r in rows:
        rest = modulus // r.prime
        part = rest * pow(rest, -1, r.prime)
        # Signs alternate: the residues of the elementary symmetric functions are not negative.
        total = [t + part * (c if (d - k) % 2 == 0 else -c) for k, (t, c) in enumerate(zip(total, r.residues))]
    return [t % modulus * (1 if (d - k) % 2 == 0 else -1) for k, t in enumerate(total)]


# --- roots ----------------------------------------------------------------------------


def roots_above(poly: list[int], a: int, bits: int) -> int:
    """How many roots of a polynomial with real roots only exceed a / 2**bits, with multiplicity."""
    d = len(poly) - 1
    c = [v << bits * (d - k) for k, v in enumerate(poly)]
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            c[k] += a * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:]))


def sign_at(poly: list[int], a: int, bits: int) -> int:
    value, scale = 0, 0
    for v in reversed(poly):
        value = value * a + (v << scale)
        scale += bits
    return (value > 0) - (value < 0)


@dataclass(frozen=True)
class Interval:
    """The roots number ``above`` + 1 to ``above`` + ``count`` lie in (low, high] / 2**bits."""

    low: int
    high: int
    bits: int
    above: int
    count: int

    def narrow(self) -> bool:
        return (self.high - self.low) << ROOT_BITS <= self.low


def isolate(poly: list[int], wanted: int) -> list[Interval]:
    """Intervals of the ``wanted`` largest positive roots: one root each, or roots that agree to ROOT_BITS bits."""
    zeros = next(k for k, v in enumerate(poly) if v)
    poly = poly[zeros:]
    d = len(poly) - 1
    if d == 0:
        return []
    top = -poly[-2] // poly[-1] + 1  # the sum of all roots, none of which is negative
    found, open_ = [], [Interval(0, top, 0, 0, d)]
    while open_:
        at = open_.pop()
        if at.count == 0 or at.above >= wanted:
            continue
        if at.count == 1 or at.narrow():
            found.append(at)
            continue
        low, high, bits = at.low, at.high, at.bits
        if high - low == 1:
            low, high, bits = low << 16, high << 16, bits + 16
        middle = (low + high) // 2
        more = roots_above(poly, middle, bits)  # roots above the middle
        open_.append(Interval(low, middle, bits, more, at.above + at.count - more))
        open_.append(Interval(middle, high, bits, at.above, more - at.above))
    return sorted(found, key=lambda i: i.above)


def refine(poly: list[int], at: Interval) -> Interval:
    """The interval of a single root, narrowed to ROOT_BITS bits by the polynomial's sign."""
    poly = poly[next(k for k, v in enumerate(poly) if v) :]
    while not at.narrow():
        low, high, bits = at.low, at.high, at.bits
        if high - low == 1:
            low, high, bits = low << 32, high << 32, bits + 32
        middle = (low + high) // 2
        sign = sign_at(poly, middle, bits)
        if sign == 0:
            fine = ROOT_BITS + 1
            return Interval((middle << fine) - 1, middle << fine, bits + fine, at.above, 1)
        # Right of all roots the sign is 1; each root changes it.
        right = (sign < 0) == (at.above % 2 == 0)
        at = Interval(middle, high, bits, at.above, 1) if right else Interval(low, middle, bits, at.above, 1)
    return at


# --- components -----------------------------------------------------------------------


def _factors(matrix: list[list[int]], shift: Decimal) -> tuple[np.ndarray, np.ndarray]:
    """LU factors of matrix - shift with row pivots; a pivot that vanishes becomes a tiny number."""
    d = len(matrix)
    a = np.array([[Decimal(v) for v in row] for row in matrix], object)
    a[np.arange(d), np.arange(d)] -= shift
    order = np.arange(d)
    tiny = shift * Decimal(10) ** (10 - DIGITS)
    for k in range(d):
        pivot = k + int(np.argmax(np.abs(a[k:, k])))
        if pivot != k:
            a[[k, pivot]], order[[k, pivot]] = a[[pivot, k]], order[[pivot, k]]
        if abs(a[k, k]) < tiny:
            a[k, k] = tiny
        a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
        a[k + 1 :, k + 1 :] = a[k + 1 :, k + 1 :] - a[k + 1 :, k, None] * a[k, None, k + 1 :]
    return a, order


def _solve(factors: np.ndarray, order: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = b[order].copy()
    d = len(x)
    for k in range(d):
        x[k + 1 :] = x[k + 1 :] - factors[k + 1 :, k] * x[k]
    for k in range(d - 1, -1, -1):
        x[k] = x[k] / factors[k, k]
        x[:k] = x[:k] - factors[:k, k] * x[k]
    return x


def null_space(matrix: list[list[int]], at: Interval) -> tuple[Decimal, list[np.ndarray]]:
    """The root in the middle of a narrow interval and orthonormal vectors of its null space, by inverse iteration."""
    d = len(matrix)
    with localcontext() as context:
        context.prec = DIGITS
        root = Decimal(at.low + at.high) / Decimal(1 << at.bits + 1)
        factors, order = _factors(matrix, root)
        # Fixed starts without symmetry; what matters is that none is orthogonal to the null space.
        block = [np.array([Decimal(((i + 1) * 2654435761 + (k + 1) * 40503 * (i + 7)) % 65521 + 1) for i in range(d)], object) for k in range(at.count)]
        for _ in range(4):
            done: list[np.ndarray] = []
            for vector in block:
                vector = _solve(factors, order, vector)
                for _ in range(2):
                    vector = vector / (vector * vector).sum().sqrt()
                    for other in done:
                        vector = vector - other * (other * vector).sum()
                done.append(vector / (vector * vector).sum().sqrt())
            block = done
        # Either sign would do: the largest entry is positive.
        return root, [v if v[int(np.argmax(np.abs(v)))] > 0 else -v for v in block]


@dataclass
class Whitening:
    n: int
    sums: list[int]  # of floor(64 c), per dimension
    vectors: np.ndarray  # dimension x components, unit length
    scaled: np.ndarray  # the same over sqrt(e)
    explained: list[float]

    @property
    def components(self) -> int:
        return len(self.explained)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The ``components`` largest components with a variance above zero of the rows of ``usable``."""
    spark = rows.sparkSession
    dim = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    n, sums, matrix = exact_scatter(rows, dim) if dim else (0, [], [])
    trace = sum(matrix[i][i] for i in range(dim))
    if not trace:
        return Whitening(n, sums, np.zeros((dim, 0)), np.zeros((dim, 0)), [])
    poly = characteristic(spark, matrix)
    given = [(str(i.low), str(i.high), i.bits, i.above, i.count) for i in isolate(poly, components)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                at = Interval(int(r["low"]), int(r["high"]), r["bits"], r["above"], r["count"])
                root, block = null_space(matrix, refine(poly, at) if at.count == 1 else at)
                with localcontext() as context:
                    context.prec = DIGITS
                    scale = Decimal(n) / root.sqrt()
                    out = [(at.above + k + 1, float(root / trace), [float(v) for v in x], [float(v * scale) for v in x]) for k, x in enumerate(block)]
                names = ["component", "explained", "unit", "scaled"]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=names)

    table = spark.createDataFrame(given, "low string, high string, bits long, above long, count long")
    found = table.mapInArrow(run, "component long, explained double, unit array<double>, scaled array<double>").collect()
    found = sorted(found, key=lambda r: r.component)[:components]
    return Whitening(
        n, sums, np.array([r.unit for r in found]).T, np.array([r.scaled for r in found]).T, [r.explained for r in found]
    )


# --- rows -----------------------------------------------------------------------------


def _centred(y: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * y - S, exact: 64-bit integers where they suffice, Python integers beyond."""
    if n * int(np.abs(y).max(initial=0)) + max(map(abs, sums), default=0) < 1 << 62:
        return n * y - np.array(sums, np.int64)
    return n * y.astype(object) - np.array(sums, object)


def _project(model: Whitening, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _centred(whole(batch.column("vector"), dim), model.n, model.sums)
            if y.dtype != object and dim * int(np.abs(y).max(initial=0)) ** 2 >= 1 << 63:
                squares = (y.astype(object) ** 2).sum(1)
            else:
                squares = (y**2).sum(1)
            deviation = pa.array([Decimal(int(v)) if v < 10**38 else None for v in squares], pa.decimal128(38, 0))
            white = (y / model.n).astype(np.float64) @ model.scaled
            ends = np.arange(len(y) + 1, dtype=np.int32) * model.components
            flat = pa.ListArray.from_arrays(pa.array(ends), pa.array(white.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), deviation, flat], names=["vec_id", "deviation", "whitened"])

    return run


def _columns(batch: pa.RecordBatch, size: int) -> np.ndarray:
    return batch.column("whitened").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, size)


def identity_error(rows: DataFrame, size: int, n: int) -> float:
    """Largest absolute entry of the covariance (divisor n, centred first) of ``whitened`` minus the identity."""
    if not size or not n:
        return 0.0

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            total += _columns(batch, size).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["i", "value"])

    means = rows.select("whitened").mapInArrow(sums, "i int, value double").groupBy("i").agg((F.sum("value") / n).alias("mean"))
    mean = np.array([r["mean"] for r in means.orderBy("i").collect()])
    place = np.indices((size, size)).reshape(2, -1)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            centred = _columns(batch, size) - mean
            total += centred.T @ centred
        columns = [pa.array(place[0].astype(np.int32)), pa.array(place[1].astype(np.int32)), pa.array(total.reshape(-1))]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "value"])

    entries = rows.select("whitened").mapInArrow(products, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value"))
    off = F.abs(F.col("value") / n - F.when(F.col("i") == F.col("j"), 1.0).otherwise(0.0))
    return entries.agg(F.max(off)).first()[0]


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation decimal(38,0), whitened, explained, identity_error: one row per vector and component.

    Rows whose vector is null or holds null or non-finite entries take no part; all others do, repeated rows and null ids included.
    Vectors shorter than the longest count as if zeros followed. Entries stop at 2**62 after scaling. Directions without
    variance have no component: equal vectors, a single one and an empty table give no rows. A deviation of more than 38 digits
    is null. Other columns are not read.
    """
    if components < 1:
        raise ValueError("components must be positive")
    rows = materialise(usable(vectors, id_col, vector), "vectors")
    model = fit(rows, components)
    dim = len(model.sums)
    kind = rows.schema["vec_id"].dataType.simpleString()
    white = rows.mapInArrow(_project(model, dim), f"vec_id {kind}, deviation decimal(38,0), whitened array<double>")
    stored = materialise(white if model.components else white.limit(0), "whitened")
    error = identity_error(stored, model.components, model.n)
    explained = F.array(*(F.lit(v) for v in model.explained)).cast("array<double>")
    return stored.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, "at").alias("explained"),
        F.lit(error).alias("identity_error"),
    )
