"""Whitening of embeddings by the exact characteristic polynomial of their scatter matrix.

Vectors become integers x. Spark sums n, S = sum x and Q = sum x x' over the distinct
x; M = n Q - S S' is then n^2 times their covariance, in whole numbers. Its
characteristic polynomial is computed modulo many primes, one prime at a time in Spark
tasks: M is brought to Hessenberg form, whose polynomial follows by a recurrence. The
Chinese remainder theorem gives the whole coefficients: Maclaurin's inequality bounds
them by the trace. All roots are real and none is negative, so the number of roots above
any fraction is exactly the number of sign changes after a Taylor shift; bisection with
whole numbers isolates the largest roots. Components come from the null space of
M - e I by inverse iteration in decimals of 120 digits.

What reaches the driver is d^2 sums and one polynomial for each prime (about
d * log2(trace) / 31 primes), whatever the number of vectors.
"""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Iterator
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.llm.common import land

#: Roots that differ by less than trace / 2^BITS count as one.
BITS = 192
DIGITS = 120
_EXACT = 1 << 53


def scaled(column: Column, scale: int) -> Column:
    """The vector in whole numbers, floor(scale * c); null if it is null, empty, or holds null, NaN or an infinity. Beyond the range of longs the ends stand."""
    odd = F.exists(column, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = F.transform(column, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")))
    return F.when(column.isNotNull() & (F.size(column) > 0) & ~odd, whole)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)


def sums(fit: DataFrame, d: int) -> tuple[int, list[int], list[list[int]]]:
    """n, S and Q of the vectors in column x. Batches are multiplied in doubles where every partial sum is below 2^53, else in whole numbers of any size."""
    pairs = [(i, j) for i in range(d) for j in range(i, d)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, square = 0, np.zeros(d, object), np.zeros((d, d), object)
        for batch in batches:
            x = _matrix(batch.column(0), d)
            if not len(x):
                continue
            most = max(abs(int(x.max())), abs(int(x.min())))
            exact = x.astype(np.float64 if most * most * len(x) < _EXACT else object)
            product, by_column = exact.T @ exact, exact.sum(axis=0)
            if exact.dtype != object:
                product, by_column = product.astype(np.int64), by_column.astype(np.int64)
            n, total, square = n + len(x), total + by_column.astype(object), square + product.astype(object)
        if n:
            values = [n, *total, *(square[i, j] for i, j in pairs)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))], names=["at", "part"])

    rows = fit.select("x").mapInArrow(run, "at int, part decimal(38,0)").groupBy("at").agg(F.sum("part").alias("value"))
    value = {r.at: int(r.value) for r in rows.collect()}  # 1 + d + d (d + 1) / 2 rows
    if not value:
        return 0, [0] * d, [[0] * d for _ in range(d)]
    square = [[0] * d for _ in range(d)]
    for k, (i, j) in enumerate(pairs):
        square[i][j] = square[j][i] = value[1 + d + k]
    return value[0], [value[1 + k] for k in range(d)], square


def is_prime(n: int) -> bool:
    """Miller-Rabin with bases that decide all numbers below 2^32."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7, 61)):
        return n in (2, 3, 5, 7, 61)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 7, 61):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """The largest primes below 2^31, as many as it takes for their product to exceed the bound."""
    out, product, p = [], 1, (1 << 31) - 1
    while product <= bound:
        if is_prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def polynomial_mod(m: np.ndarray, p: int) -> list[int]:
    """Coefficients of det(x I - m) modulo the prime p < 2^31, the constant one first."""
    a, d = m % p, len(m)
    for k in range(d - 2):
        rows = np.flatnonzero(a[k + 1:, k])
        if not len(rows):
            continue
        if rows[0]:
            at = [k + 1, k + 1 + int(rows[0])]
            a[at] = a[at[::-1]]
            a[:, at] = a[:, at[::-1]]
        ratio = a[k + 2:, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2:] = (a[k + 2:] - ratio[:, None] * a[k + 1] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2:] * ratio % p).sum(axis=1)) % p
    found = np.zeros((d + 1, d + 1), np.int64)  # polynomials of the leading blocks
    found[0, 0] = 1
    for k in range(1, d + 1):
        own = np.roll(found[k - 1], 1)
        own = (own - a[k - 1, k - 1] * found[k - 1] % p) % p
        below = 1
        for i in range(k - 1, 0, -1):
            below = below * int(a[i, i - 1]) % p
            if not below:
                break
            own = (own - below * int(a[i - 1, k - 1]) % p * found[i - 1] % p) % p
        found[k] = own
    return found[d].tolist()


def characteristic_polynomial(spark: SparkSession, m: list[list[int]]) -> list[int]:
    """Whole coefficients of det(x I - m), the constant one first, for a symmetric m without negative eigenvalues."""
    d = len(m)
    trace = sum(m[k][k] for k in range(d))
    # The k-th symmetric function of eigenvalues that are not negative is at most that of d times their mean.
    bound = max(math.comb(d, k) * trace ** k // d ** k + 1 for k in range(d + 1))
    primes = primes_beyond(2 * bound)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.array(m, object).reshape(d, d)
        for batch in batches:
            own = [primes[k] for k in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int64()), pa.array([polynomial_mod((whole % p).astype(np.int64), p) for p in own], pa.list_(pa.int64()))], names=["p", "coefficients"])

    parts = max(1, min(len(primes), spark.sparkContext.defaultParallelism))
    rows = spark.range(0, len(primes), 1, parts).mapInArrow(run, "p long, coefficients array<long>").collect()  # one row for each prime
    product = math.prod(primes)
    ones = [(product // r.p) * pow(product // r.p, -1, r.p) for r in rows]
    whole = [sum(r.coefficients[k] * one for r, one in zip(rows, ones, strict=True)) % product for k in range(d + 1)]
    return [c - product if c > product // 2 else c for c in whole]


def roots_above(polynomial: list[int], at: int, bits: int) -> int:
    """How many roots lie above at / 2^bits, each as often as it is a root; exact if all roots are real."""
    d = len(polynomial) - 1
    c = [x << (bits * (d - k)) for k, x in enumerate(polynomial)]  # roots times 2^bits
    for k in range(d):
        for i in range(d - 1, k - 1, -1):
            c[i] += at * c[i + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:], strict=False))


def largest_roots(polynomial: list[int], trace: int, k: int) -> list[tuple[int, int]]:
    """(at, bits) of the k largest roots that are not 0: each lies within (at, at + 1] / 2^bits, which is at most trace / 2^BITS wide."""
    out: list[tuple[int, int]] = []
    for which in range(1, min(k, roots_above(polynomial, 0, 0)) + 1):
        # The root is in (low, high] / 2^bits. Whole numbers first, then ever finer fractions.
        low, high, bits = 0, trace, 0
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if roots_above(polynomial, middle, bits) >= which else (low, middle)
        while bits < BITS - trace.bit_length():
            low, bits = 2 * low, bits + 1
            if roots_above(polynomial, low + 1, bits) >= which:
                low += 1
        out.append((low, bits))
    return out


def null_vector(m: list[list[int]], root: Decimal, before: list[list[Decimal]]) -> list[Decimal]:
    """A unit vector of the null space of m - root I, at right angles to those `before`."""
    d = len(m)
    with localcontext() as context:
        context.prec = DIGITS
        a = [[Decimal(x) for x in row] for row in m]
        for k in range(d):
            a[k][k] -= root
        tiny = max(max(map(abs, row)) for row in a).scaleb(-DIGITS) or Decimal(1).scaleb(-DIGITS)
        order = list(range(d))
        for k in range(d):
            at = max(range(k, d), key=lambda i: abs(a[i][k]))
            a[k], a[at], order[k], order[at] = a[at], a[k], order[at], order[k]
            pivot = a[k][k] if abs(a[k][k]) > tiny else tiny
            a[k][k] = pivot
            own = a[k]
            for i in range(k + 1, d):
                row = a[i]
                ratio = row[k] / pivot
                row[k] = ratio  # the lower factor takes the place of the zeros
                if ratio:
                    for j in range(k + 1, d):
                        row[j] -= ratio * own[j]

        def straight(v: list[Decimal]) -> list[Decimal]:
            for b in before:
                part = sum((x * y for x, y in zip(v, b, strict=True)), Decimal(0))
                v = [x - part * y for x, y in zip(v, b, strict=True)]
            length = sum((x * x for x in v), Decimal(0)).sqrt()
            return [x / length for x in v]

        v = straight([Decimal(1) + Decimal((k * k + 7 * k * len(before)) % 31) / 7 for k in range(d)])
        for _ in range(4):
            y = [v[order[k]] for k in range(d)]
            for k in range(d):
                y[k] -= sum((a[k][j] * y[j] for j in range(k)), Decimal(0))
            for k in range(d - 1, -1, -1):
                y[k] = (y[k] - sum((a[k][j] * y[j] for j in range(k + 1, d)), Decimal(0))) / a[k][k]
            v = straight(y)
        return v


@dataclasses.dataclass
class Whitening:
    """n and S of the fit list, unit components (rows), eigenvalues of n^2 times the covariance, and the trace of that."""

    n: int
    total: list[int]
    components: np.ndarray
    eigenvalues: list[float]
    trace: int

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact: longs where they fit, else whole numbers of any size."""
        most = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
        fits = self.n * most + max(map(abs, self.total), default=0) < 1 << 62
        return x * self.n - np.array(self.total, np.int64) if fits else x.astype(object) * self.n - np.array(self.total, object)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        """One row for each vector, one column for each component."""
        return centred.astype(np.float64) @ self.components.T / np.sqrt(np.array(self.eigenvalues))


def fit_components(spark: SparkSession, n: int, total: list[int], square: list[list[int]], k: int) -> Whitening:
    """The k components with the largest eigenvalues above 0, fewer if there are fewer."""
    d = len(total)
    m = [[n * square[i][j] - total[i] * total[j] for j in range(d)] for i in range(d)]
    trace = sum(m[i][i] for i in range(d))
    components: list[list[Decimal]] = []
    eigenvalues: list[float] = []
    if trace:
        with localcontext() as context:
            context.prec = DIGITS
            roots = [(Decimal(at) + Decimal("0.5")) / Decimal(2) ** bits for at, bits in largest_roots(characteristic_polynomial(spark, m), trace, k)]
        for root in roots:
            components.append(null_vector(m, root, components))
            eigenvalues.append(float(root))
    unit = np.array([[float(x) for x in v] for v in components], np.float64).reshape(len(components), d)
    for row in unit:
        row *= np.sign(row[np.argmax(np.abs(row))])
    return Whitening(n, total, unit, eigenvalues, trace)


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened fit list's covariance, less the identity. Tasks centre on their own means; their moments are merged."""
    k, d = model.components.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, moment = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = model.whitened(model.centred(_matrix(batch.column(0), d)))
            if len(w):
                n, mean, moment = _merged((n, mean, moment), (len(w), w.mean(axis=0), (w - w.mean(axis=0)).T @ (w - w.mean(axis=0))))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([mean.tolist()]), pa.array([moment.ravel().tolist()])], names=["n", "mean", "moment"])

    all_of = (0, np.zeros(k), np.zeros((k, k)))
    rows = fit.select("x").mapInArrow(run, "n long, mean array<double>, moment array<double>")
    for r in rows.toLocalIterator():  # a few numbers for each task
        all_of = _merged(all_of, (r.n, np.array(r.mean), np.array(r.moment).reshape(k, k)))
    return float(np.abs(all_of[2] / max(1, all_of[0]) - np.eye(k)).max()) if k else 0.0


def _merged(a: tuple, b: tuple) -> tuple:
    n, apart = a[0] + b[0], b[1] - a[1]
    return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)


def whiten(df: DataFrame, k: int = 4, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Per row and component (from 1, by falling eigenvalue): the id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, empty, or holds null, NaN or an infinity are left out, as
    are rows of another dimension than most have (of equally frequent ones the larger
    counts). Equal vectors count once in the fit. Components with eigenvalue 0 don't
    exist: n = 1 or equal vectors alone give no rows, nor does an empty table. Null
    ids stay null, repeated rows are whitened one by one, other columns are not read.
    deviation is null where it exceeds a long.
    """
    spark, kind = df.sparkSession, df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(id_col).alias("id"), scaled(F.col(vector_col), scale).alias("x")).filter("x IS NOT NULL")
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    schema = f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not sizes:
        return spark.createDataFrame([], schema)
    d = sizes[0].d
    rows = rows.filter(F.size("x") == d)
    fit = land(rows.select("x").distinct(), "fit-list")
    model = fit_components(spark, *sums(fit, d), k)
    found, error = len(model.eigenvalues), identity_error(fit, model)
    if not found:
        return spark.createDataFrame([], schema)
    explained = np.array(model.eigenvalues) / float(model.trace)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centred = model.centred(_matrix(batch.column(1), d))
            near = (centred.astype(np.float64) ** 2).sum(axis=1)
            if centred.dtype != object and (near < 2.0 ** 62).all():
                deviation = pa.array((centred * centred).sum(axis=1), pa.int64())
            else:
                exact = [sum(int(c) ** 2 for c in row) for row in centred]
                deviation = pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
            each = np.repeat(np.arange(len(centred)), found)
            m = len(each)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, found + 1, dtype=np.int32), len(centred))), pa.array(np.full(m, model.n, np.int64)), deviation.take(pa.array(each)),
                 pa.array(model.whitened(centred).ravel()), pa.array(np.tile(explained, len(centred))), pa.array(np.full(m, error))],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, schema)
