"""Operator 11: embedding whitening by an exact characteristic polynomial.

A vector's entries become integers x = floor(1024 c) + 100000.  Spark sums the
integers and their products exactly, so n^2 times the covariance is an integer
matrix, the scatter.  Its characteristic polynomial is exact too: tasks reduce
the scatter to Hessenberg form modulo one prime after another, and Chinese
remaindering joins the residues.  All roots are real, so the number of roots
above a point is exactly the number of sign changes of the polynomial's Taylor
shift to it (Descartes' bound is sharp there); halving intervals by these
counts isolates the largest roots with their multiplicities, which are then
narrowed to some 150 bits.  Components come from inverse iteration on the null
space of scatter - root, in decimals of ``DIGITS`` places.

The driver holds the scatter, the residues and the components: numbers that
depend on the dimension, never on the rows.

Defined results: a vector that is null, or holds a null or non-finite entry or
one whose x is no long, takes no part; nor do vectors of another length than
the commonest (of equally common ones the longer); a null id stays a row, and
repeated rows count as often as they come; components without variance are left
out, so that an empty table, a single vector or equal ones give no rows;
``deviation`` is null where it exceeds a long; other columns are ignored.
"""

from __future__ import annotations

import decimal
import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm.common import settled, work_folder

SCALE, SHIFT = 1024, 100_000       # of the contract
TOP = 8
LIMB = 30                          # bits of a summed limb
ROOT_BITS = 160
DIGITS = 120


# -- integer vectors ------------------------------------------------------

def integer_vectors(vectors: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places of the rows, floor(1024 c) as int64) of the vectors that take part."""
    lengths = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    for d in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == d)
        flat = vectors.take(pa.array(rows)).flatten().cast(pa.float64())
        c = flat.to_numpy(zero_copy_only=False).reshape(len(rows), int(d))       # a null is not a number here
        with np.errstate(over="ignore", invalid="ignore"):
            y = np.floor(c * SCALE)
            good = (np.abs(y) < 2.0 ** 62).all(axis=1)
        if good.any():
            yield int(d), rows[good], y[good].astype(np.int64)


def exact_products(y: np.ndarray) -> np.ndarray:
    """y' y as Python integers."""
    top = int(np.abs(y).max(initial=0))
    if top >= 1 << 26:
        z = y.astype(object)
        return z.T @ z
    step = max(1, (1 << 53) // max(1, top * top))          # sums below 2^53 are exact in doubles
    out = np.zeros((y.shape[1],) * 2, object)
    for i in range(0, len(y), step):
        f = y[i:i + step].astype(np.float64)
        out += (f.T @ f).astype(np.int64).astype(object)
    return out


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    sign, value, k = (-1 if value < 0 else 1), abs(value), 0
    while value:
        yield k, sign * (value & ((1 << LIMB) - 1))
        value, k = value >> LIMB, k + 1


@dataclass
class Moments:
    n: int
    sums: list[int]                # of floor(1024 c)
    scatter: list[list[int]]       # n sum(y y') - sum(y) sum(y)'


def moments(vectors: DataFrame, vec_col: str = "embedding") -> Moments | None:
    """Exact sums over all vectors that take part; None if there are none."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}
        for batch in batches:
            for d, _, y in integer_vectors(batch.column(0)):
                n, sums, products = held.get(d, (0, 0, 0))
                held[d] = (n + len(y), sums + y.astype(object).sum(axis=0), products + exact_products(y))
        for d, (n, sums, products) in held.items():
            values = [n, *sums, *(products[i, j] for i in range(d) for j in range(i, d))]
            rows = [(d, place, k, v) for place, value in enumerate(values) for k, v in _limbs(int(value))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.int64()))], ["d", "place", "limb", "v"])

    sums = (vectors.select(vec_col).mapInArrow(partial, "d int, place int, limb int, v long")
            .groupBy("d", "place", "limb").agg(F.sum("v").alias("v")))
    found = defaultdict(lambda: defaultdict(int))
    common = sums.filter("place = 0").groupBy("d").agg(
        F.sum(F.col("v").cast("decimal(38,0)") * F.pow(F.lit(2.0), F.lit(LIMB) * F.col("limb")).cast("decimal(38,0)"))
        .alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).select("d")
    for r in sums.join(F.broadcast(common), "d").collect():          # one length: d (d + 3) / 2 numbers
        found[r.d][r.place] += r.v << (LIMB * r.limb)
    if not found:
        return None
    (d, value), = found.items()
    n, s = value[0], [value[1 + i] for i in range(d)]
    scatter = [[0] * d for _ in range(d)]
    place = d
    for i in range(d):
        for j in range(i, d):
            place += 1
            scatter[i][j] = scatter[j][i] = n * value[place] - s[i] * s[j]
    return Moments(n, s, scatter)


# -- characteristic polynomial --------------------------------------------

def primes_below(top: int, count: int) -> list[int]:
    """The largest ``count`` primes below ``top`` (under 2^32, so four bases decide)."""
    def prime(n: int) -> bool:
        d, r = n - 1, 0
        while d % 2 == 0:
            d, r = d // 2, r + 1
        for a in (2, 3, 5, 7):
            x = pow(a, d, n)
            if x in (1, n - 1):
                continue
            if all((x := x * x % n) != n - 1 for _ in range(r - 1)):
                return False
        return True

    out, n = [], top - 1 - top % 2
    while len(out) < count:
        if prime(n):
            out.append(n)
        n -= 2
    return out


def hessenberg(a: np.ndarray, p: int) -> np.ndarray:
    """A similar matrix with zeros below the first subdiagonal, modulo p < 2^31."""
    a, d = a.copy(), len(a)
    for k in range(d - 2):
        below = np.flatnonzero(a[k + 1:, k])
        if not below.size:
            continue
        pivot = k + 1 + int(below[0])
        if pivot != k + 1:
            a[[k + 1, pivot]] = a[[pivot, k + 1]]
            a[:, [k + 1, pivot]] = a[:, [pivot, k + 1]]
        f = a[k + 2:, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2:] = (a[k + 2:] - f[:, None] * a[k + 1] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2:] * f % p).sum(axis=1)) % p
    return a


def polynomial_mod(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x - a) modulo p, the constant first."""
    h, d = hessenberg(a, p), len(a)
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for m in range(1, d + 1):
        new = np.roll(polys[m - 1], 1)
        new -= h[m - 1, m - 1] * polys[m - 1] % p
        chain, weights = 1, np.zeros(m, np.int64)
        for j in range(m - 1, 0, -1):                       # product of subdiagonals down to row j
            chain = chain * int(h[j, j - 1]) % p
            weights[j - 1] = int(h[j - 1, m - 1]) * chain % p
        new -= (weights[:, None] * polys[:m] % p).sum(axis=0) if m > 1 else 0
        polys[m] = new % p
    return polys[d]


def characteristic_polynomial(spark: SparkSession, matrix: list[list[int]]) -> list[int]:
    """Integer coefficients of det(x - matrix), the constant first, for a matrix without negative eigenvalues."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    # the k-th elementary symmetric value of d non-negative roots is at most C(d, k) (trace / d)^k
    bound = max(math.comb(d, k) * trace ** k // d ** k + 1 for k in range(d + 1))
    primes = primes_below(1 << 31, (2 * bound).bit_length() // 30 + 1)

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = np.array(matrix, object)
        for batch in batches:
            some = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int64()), pa.array([polynomial_mod((a % p).astype(np.int64), p).tolist() for p in some],
                                                      pa.list_(pa.int64()))], ["p", "c"])

    made = spark.createDataFrame([(p,) for p in primes], "p long").repartition(
        min(len(primes), max(1, spark.sparkContext.defaultParallelism)))
    rows = made.mapInArrow(residues, "p long, c array<long>").collect()     # d + 1 numbers a prime
    whole = math.prod(primes)
    out = [0] * (d + 1)
    for r in rows:
        rest = whole // r.p
        unit = rest * pow(rest, -1, r.p)
        for k, c in enumerate(r.c):
            out[k] += c * unit
    return [c - whole if 2 * c > whole else c for c in (c % whole for c in out)]


# -- roots ----------------------------------------------------------------

def roots_above(coefficients: list[int], at: int) -> int:
    """Number of roots above ``at`` of a polynomial with real roots only: sign changes of its shift."""
    c, d = list(reversed(coefficients)), len(coefficients) - 1        # the leading one first
    for stop in range(d, 0, -1):
        for i in range(1, stop + 1):
            c[i] += at * c[i - 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def _sign(coefficients: list[int], at: int) -> int:
    value = 0
    for c in reversed(coefficients):
        value = value * at + c
    return (value > 0) - (value < 0)


def largest_roots(coefficients: list[int], upper: int, count: int, bits: int = ROOT_BITS
                  ) -> tuple[list[tuple[int, int]], int]:
    """([(root times 2^s, multiplicity)] by falling root, s): positive roots, ``count`` of them at least if there are."""
    d, s = len(coefficients) - 1, max(0, bits - upper.bit_length())
    c = [x << (s * (d - k)) for k, x in enumerate(coefficients)]         # its roots are 2^s times as large
    top = upper << s
    out, found = [], 0
    todo = [(0, top, roots_above(c, 0), 0)]
    while todo and found < count:
        low, high, above_low, above_high = todo.pop()
        inside = above_low - above_high
        if not inside:
            continue
        if inside == 1:
            side = _sign(c, high)
            while side and high - low > 1:
                mid = (low + high) // 2
                here = _sign(c, mid)
                low, high = (low, mid) if here in (0, side) else (mid, high)
                if here == 0:
                    break
        if inside == 1 or high - low == 1:
            out.append((high, inside))
            found += inside
            continue
        mid = (low + high) // 2
        above_mid = roots_above(c, mid)
        todo += [(low, mid, above_low, above_mid), (mid, high, above_mid, above_high)]
    return out, s


# -- components -----------------------------------------------------------

def null_space(matrix: list[list[int]], root: Decimal, size: int) -> list[list[Decimal]]:
    """``size`` orthonormal vectors that matrix - root takes to nothing, by inverse iteration."""
    d = len(matrix)
    a = np.array([[Decimal(x) for x in row] for row in matrix], object)
    scale = max(abs(x) for x in a.flat)
    for i in range(d):
        a[i, i] -= root
    tiny, order = scale.scaleb(-DIGITS // 2), list(range(d))
    for k in range(d):
        pivot = k + int(np.argmax([abs(x) for x in a[k:, k]]))
        if pivot != k:
            a[[k, pivot]] = a[[pivot, k]]
            order[k], order[pivot] = order[pivot], order[k]
        if abs(a[k, k]) < tiny:
            a[k, k] = tiny
        if k + 1 < d:
            a[k + 1:, k] = a[k + 1:, k] / a[k, k]
            a[k + 1:, k + 1:] = a[k + 1:, k + 1:] - np.outer(a[k + 1:, k], a[k, k + 1:])

    def solve(b: list[Decimal]) -> list[Decimal]:
        x = [b[i] for i in order]
        for i in range(d):
            x[i] -= sum((a[i, j] * x[j] for j in range(i)), Decimal(0))
        for i in range(d - 1, -1, -1):
            x[i] = (x[i] - sum((a[i, j] * x[j] for j in range(i + 1, d)), Decimal(0))) / a[i, i]
        return x

    start = np.random.default_rng(d).integers(1, 1 << 30, (size, d)).tolist()      # any vectors in general position
    block = [[Decimal(v) for v in row] for row in start]
    for _ in range(3):
        done: list[list[Decimal]] = []
        for x in map(solve, block):
            for _ in range(2):
                for q in done:
                    share = sum(u * v for u, v in zip(q, x))
                    x = [v - share * u for u, v in zip(q, x)]
                norm = sum(v * v for v in x).sqrt()
                x = [v / norm for v in x]
            done.append(x)
        block = done
    return block


@dataclass
class Whitening:
    n: int
    sums: np.ndarray               # of floor(1024 c), int64 or Python integers
    axes: np.ndarray               # a row a component: unit vector / sqrt(scatter's eigenvalue)
    explained: list[float]

    def apply(self, y: np.ndarray) -> tuple[list[int | None], np.ndarray]:
        """(deviations, whitened values, a row a vector)."""
        far = self.n * int(np.abs(y).max(initial=0)) + max(map(abs, self.sums.tolist()), default=0)
        if far * far * y.shape[1] < 1 << 63:
            centred = self.n * y - self.sums.astype(np.int64)
            deviations = (centred * centred).sum(axis=1).tolist()
        else:
            centred = self.n * y.astype(object) - self.sums
            deviations = [v if v < 1 << 63 else None for v in (centred * centred).sum(axis=1).tolist()]
        return deviations, centred.astype(np.float64) @ self.axes.T


def fit(vectors: DataFrame, top: int = TOP, vec_col: str = "embedding") -> Whitening | None:
    """The whitening of all vectors that take part; None without any variance."""
    known = moments(vectors, vec_col)
    if known is None:
        return None
    unit = math.gcd(*(x for row in known.scatter for x in row))
    if not unit:
        return None
    matrix = [[x // unit for x in row] for row in known.scatter]
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    roots, s = largest_roots(characteristic_polynomial(vectors.sparkSession, matrix), trace, top)
    axes, explained = [], []
    with decimal.localcontext(decimal.Context(prec=DIGITS, Emax=decimal.MAX_EMAX, Emin=decimal.MIN_EMIN)):
        for scaled, size in roots:
            root = Decimal(scaled) / (Decimal(2) ** s)
            for v in null_space(matrix, root, size):
                lead = max(v, key=abs)
                norm = (root * unit).sqrt() * (1 if lead > 0 else -1)
                axes.append([float(x / norm) for x in v])
                explained.append(float(root / trace))
    sums = np.array(known.sums, object)
    return Whitening(known.n, sums, np.array(axes[:top]), explained[:top])


# -- Spark ----------------------------------------------------------------

RESULT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
          "identity_error double")


def whiten(vectors: DataFrame, top: int = TOP, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """A row for each vector that takes part and each of the ``top`` components."""
    spark = vectors.sparkSession
    some = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vec_col].alias("v"))
    model = fit(some, top, "v")
    if model is None:
        return spark.createDataFrame([], RESULT)
    k, width = len(model.axes), model.axes.shape[1]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, places, y in integer_vectors(batch.column(1)):
                if d == width:
                    deviations, w = model.apply(y)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(places)), pa.array(deviations, pa.int64()),
                         pa.FixedSizeListArray.from_arrays(pa.array(w.reshape(-1)), k).cast(pa.list_(pa.float64()))],
                        ["vec_id", "deviation", "w"])

    made = settled(some.mapInArrow(rows, "vec_id long, deviation long, w array<double>"),
                   work_folder(spark, "whitened"), "rows")
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    spread = made.agg(*(F.covar_pop(F.col("w")[i], F.col("w")[j]).alias(f"c{i}_{j}") for i, j in pairs)).first()
    error = max(abs(spread[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    return (made.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                    "whitened", F.lit(model.explained)[F.col("at")].alias("explained"),
                    F.lit(float(error)).alias("identity_error")))
