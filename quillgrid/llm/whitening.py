"""Whitening of embeddings by the exact characteristic polynomial of their scatter.

Entries are rounded down to a 64th, so that the scatter matrix of the different
vectors is a matrix of integers, added up by Spark without any rounding. Its
characteristic polynomial is found modulo many primes, one prime a row of a Spark
job, by reduction to Hessenberg form, and put together by Chinese remaindering.
All its roots are real, so Descartes' rule counts them exactly: they are isolated
and refined in integers. Inverse iteration in 120 decimal digits then gives the
null space of ``scatter - root`` for each root, again a row of a Spark job.

What reaches the driver is bounded by the number of dimensions: the scatter matrix,
the polynomial, the components. Work grows with the fourth power of the number of
dimensions; it is meant for some hundreds.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quillgrid.llm.common import shared_path

SCALE = 64
"""Levels an entry is rounded to within 1. A shift of all levels changes no result, so none is added."""
LARGEST = 2.0**34
"""Entries of this size or beyond count as not finite: their levels would not be exact."""
COMPONENTS = 16
DIGITS = 120
"""Decimal digits of inverse iteration."""
ROOT_BITS, EQUAL_BITS = 300, 200
"""Roots are refined to a width of 2 ** -ROOT_BITS of their size; those within 2 ** -EQUAL_BITS count as one repeated root."""


# ---- vectors as levels ------------------------------------------------------

def levels(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, y)``: the rows whose vector holds finite entries alone, as levels."""
    vector = F.col(f"`{vec_col}`")
    usable = vector.isNotNull() & (F.size(vector) > 0) & F.forall(
        vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < LARGEST)
    )
    level = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint"))
    return vectors.where(usable).select(F.col(f"`{id_col}`").alias("id"), level.alias("y"))


def matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    """The levels of a batch as rows of a matrix."""
    return batch.column(batch.schema.get_field_index("y")).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


# ---- scatter ------------------------------------------------------------------

def products(y: np.ndarray) -> np.ndarray:
    """``y.T @ y`` in whole numbers; floating point where it is exact."""
    most = int(np.abs(y).max(initial=0))
    if most * most * len(y) < 2**53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    wide = y.astype(object)
    return wide.T @ wide


def scatter_sums(different: DataFrame, size: int) -> DataFrame:
    """``(i, j, total)`` over the different vectors: products for ``j <= i``, sums of
    entries as ``j = -1``, and their number as ``i = j = -1``. Each task sends its
    sums once."""
    low_i, low_j = np.tril_indices(size)
    at_i = pa.array(np.concatenate([low_i, np.arange(size), [-1]]).astype(np.int32))
    at_j = pa.array(np.concatenate([low_j, np.full(size + 1, -1)]).astype(np.int32))
    kind = pa.decimal128(38, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, outer = 0, 0, 0
        for batch in batches:
            if batch.num_rows:
                y = matrix(batch, size)
                n, sums, outer = n + len(y), sums + y.sum(axis=0).astype(object), outer + products(y)
        if n:
            values = [*outer[low_i, low_j], *sums, n]
            yield pa.RecordBatch.from_arrays(
                [at_i, at_j, pa.array([Decimal(int(v)) for v in values], kind)], ["i", "j", "part"]
            )

    parts = different.select("y").mapInArrow(run, "i int, j int, part decimal(38,0)")
    return parts.groupBy("i", "j").agg(F.sum("part").alias("total"))


# ---- characteristic polynomial ----------------------------------------------

def is_prime(n: int) -> bool:
    """Miller and Rabin's test; these bases decide below 3 * 10**9."""
    if n < 2 or any(n % p == 0 for p in (2, 3, 5, 7)):
        return n in (2, 3, 5, 7)
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x in (1, n - 1):
            continue
        for _ in range(twos - 1):
            x = x * x % n
            if x == n - 1:
                break
        else:
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """Primes below 2**31, from the largest, whose product is beyond ``bound``."""
    found, product, at = [], 1, 2**31 - 1
    while product <= bound:
        if is_prime(at):
            found.append(at)
            product *= at
        at -= 2
    return found


def coefficient_bound(scatter: list[list[int]]) -> int:
    """No coefficient is larger: by Maclaurin's inequality the k-th one is at most
    binomial(d, k) times the k-th power of the mean root."""
    d = len(scatter)
    mean = -(-sum(scatter[i][i] for i in range(d)) // d)
    return max(math.comb(d, k) * mean**k for k in range(d + 1))


def polynomial_modulo(scatter: np.ndarray, p: int) -> list[int]:
    """Coefficients, from the constant one, of ``det(x - scatter)`` modulo a prime
    below 2**31, by similarity transforms to Hessenberg form."""
    a = (scatter % p).astype(np.int64)
    d = len(a)
    for m in range(1, d - 1):
        below = np.flatnonzero(a[m:, m - 1])
        if not len(below):
            continue
        pivot = m + int(below[0])
        if pivot != m:
            a[[pivot, m]] = a[[m, pivot]]
            a[:, [pivot, m]] = a[:, [m, pivot]]
        factors = a[m + 1:, m - 1] * pow(int(a[m, m - 1]), -1, p) % p
        a[m + 1:] = (a[m + 1:] - factors[:, None] * a[m] % p) % p
        a[:, m] = (a[:, m] + (a[:, m + 1:] * factors % p).sum(axis=1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        row = np.roll(polys[k - 1], 1) - a[k - 1, k - 1] * polys[k - 1] % p
        path = 1
        for i in range(1, k):
            path = path * int(a[k - i, k - i - 1]) % p
            if not path:
                break
            row = (row - path * int(a[k - i - 1, k - 1]) % p * polys[k - i - 1]) % p
        polys[k] = row % p
    return polys[d].tolist()


def combined(residues: dict[int, list[int]]) -> list[int]:
    """The integers between -P/2 and P/2 with these residues, P the product of the primes."""
    whole = math.prod(residues)
    totals = [0] * len(next(iter(residues.values())))
    for p, values in residues.items():
        unit = whole // p * pow(whole // p, -1, p)
        totals = [t + v * unit for t, v in zip(totals, values)]
    totals = [t % whole for t in totals]
    return [t - whole if 2 * t > whole else t for t in totals]


def characteristic_polynomial(spark: SparkSession, scatter: list[list[int]]) -> list[int]:
    """Exact coefficients of ``det(x - scatter)``, from the constant one to 1."""
    primes = primes_beyond(2 * coefficient_bound(scatter) + 1)
    numbers = np.array(scatter, dtype=object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [primes[i] for i in batch.column(0).to_pylist()]
            found = [polynomial_modulo(numbers, p) for p in own]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(found, pa.list_(pa.int64()))], ["p", "c"])

    parts = min(len(primes), spark.sparkContext.defaultParallelism)
    rows = spark.range(0, len(primes), 1, parts).mapInArrow(run, "p bigint, c array<bigint>").collect()
    return combined({r.p: r.c for r in rows})


# ---- roots ----------------------------------------------------------------------

def roots_above(poly: list[int], t: int, k: int) -> int:
    """How many roots, repeated ones counted so, lie above ``t / 2**k``: the changes of
    sign after a shift by it, which is exact where all roots are real."""
    d = len(poly) - 1
    c = [a << (k * (d - i)) for i, a in enumerate(poly)]
    for i in range(d):
        for j in range(d - 1, i - 1, -1):
            c[j] += t * c[j + 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def is_positive(poly: list[int], t: int, k: int) -> bool:
    """Whether the polynomial is positive at ``t / 2**k``."""
    value = 0
    for i, a in enumerate(reversed(poly)):
        value = value * t + (a << (k * i))
    return value > 0


def largest_roots(poly: list[int], wanted: int) -> list[tuple[int, int, int]]:
    """``(t, k, times)`` of the largest positive roots ``t / 2**k``, falling, with how
    often each is repeated, until ``wanted`` are told. All roots are real and none negative."""
    while not poly[0]:
        poly = poly[1:]
    top = (-poly[-2]).bit_length()  # no root is beyond the sum of all roots
    open_, found = [(0, 1, -top, len(poly) - 1, 0)], []  # roots in (low, low + 1] / 2**k, counts above both ends
    while open_ and sum(times for *_, times in found) < wanted:
        low, high, k, above_low, above_high = open_.pop()
        times = above_low - above_high
        if not times:
            continue
        narrow = low > 0 and low.bit_length() > EQUAL_BITS
        if times == 1 or narrow:
            found.append((*refined(poly, low, high, k, times), times))
            continue
        low, high, k = 2 * low, 2 * high, k + 1
        middle = low + 1
        above = roots_above(poly, middle, k) if k >= 0 else roots_above(poly, middle << -k, 0)
        open_ += [(low, middle, k, above_low, above), (middle, high, k, above, above_high)]
    return found


def refined(poly: list[int], low: int, high: int, k: int, times: int) -> tuple[int, int]:
    """The root within ``(low, high] / 2**k``, high = low + 1, in ``ROOT_BITS`` bits.
    Signs tell the side of a single root; the middle stands for a repeated one."""
    if k < 0:
        low, high = low << -k, high << -k
        k = 0
    if times > 1:
        return low + high, k + 1
    right = is_positive(poly, high, k)
    if not right and roots_above(poly, high, k) == roots_above(poly, high - 1, k) - 1:
        exact = 0
        for i, a in enumerate(reversed(poly)):
            exact = exact * high + (a << (k * i))
        if not exact:
            return high, k
    while not low or (low.bit_length() - (high - low).bit_length()) < ROOT_BITS:
        if high - low == 1:
            low, high, k = 2 * low, 2 * high, k + 1
        middle = (low + high) // 2
        if is_positive(poly, middle, k) == right:
            high = middle
        else:
            low = middle
    return low + high, k + 1


# ---- components -----------------------------------------------------------------

def null_space(scatter: list[list[int]], root: Decimal, times: int, seed: int) -> list[list[float]]:
    """``times`` orthogonal unit vectors that ``scatter - root`` maps to nothing, by
    inverse iteration. Their largest entry is positive."""
    with decimal.localcontext() as context:
        context.prec = DIGITS
        d = len(scatter)
        a = np.array([[Decimal(v) for v in row] for row in scatter], dtype=object)
        for i in range(d):
            a[i, i] -= root
        tiny = max(abs(root), Decimal(1)).scaleb(-DIGITS + 10)
        order = list(range(d))
        for k in range(d):
            pivot = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
            if pivot != k:
                a[[k, pivot]] = a[[pivot, k]]
                order[k], order[pivot] = order[pivot], order[k]
            if abs(a[k, k]) < tiny:
                a[k, k] = tiny
            a[k + 1:, k] = a[k + 1:, k] / a[k, k]
            a[k + 1:, k + 1:] -= np.outer(a[k + 1:, k], a[k, k + 1:])

        def solve(b: np.ndarray) -> np.ndarray:
            x = b[order]
            for k in range(1, d):
                x[k] -= (a[k, :k] * x[:k]).sum()
            for k in range(d - 1, -1, -1):
                x[k] = (x[k] - (a[k, k + 1:] * x[k + 1:]).sum()) / a[k, k]
            return x

        draw = np.random.default_rng(seed)
        found: list[np.ndarray] = []
        for _ in range(times):
            x = np.array([Decimal(int(v)) for v in draw.integers(1, 1000, d)], dtype=object)
            for _ in range(4):
                x = solve(x)
                for _ in range(2):
                    for other in found:
                        x = x - other * (x * other).sum()
                    x = x / (x * x).sum().sqrt()
            if x[max(range(d), key=lambda i: abs(x[i]))] < 0:
                x = -x
            found.append(x)
        return [[float(v) for v in x] for x in found]


# ---- model ------------------------------------------------------------------------

@dataclass(frozen=True)
class Whitening:
    """``n`` different vectors of ``size`` entries whose levels add up to ``sums``;
    eigenvalues of the covariance of levels, falling, with their share of its trace,
    and unit vectors as rows."""

    size: int
    n: int
    sums: list[int]
    values: list[float]
    shares: list[float]
    vectors: list[list[float]]
    identity_error: float = 0.0

    def deviations(self, y: np.ndarray) -> np.ndarray:
        """``n * y - sums``, whole numbers."""
        most = max(int(np.abs(y).max(initial=0)) * self.n, max(map(abs, self.sums)))
        kind = np.int64 if most < 2**61 else object
        return y.astype(kind) * self.n - np.array(self.sums, dtype=kind)

    def project(self, deviations: np.ndarray) -> np.ndarray:
        """One column for each component, of variance 1 over the fit list."""
        scaled = np.array(self.vectors).reshape(len(self.vectors), self.size) / np.sqrt(np.array(self.values))[:, None]
        return (deviations / self.n).astype(np.float64) @ scaled.T

    def squares(self, deviations: np.ndarray) -> list[int | None]:
        """The sum of squares of each row; NULL where it is beyond a long."""
        most = int(np.abs(deviations).max(initial=0))
        if most * most * self.size < 2**63:
            return (deviations.astype(np.int64) ** 2).sum(axis=1).tolist()
        sums = (deviations.astype(object) ** 2).sum(axis=1)
        return [int(v) if v < 2**63 else None for v in sums]


def fit(vectors: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Learn from every different vector; None if no vector is usable.

    Vectors must agree in size: those of another size than most different ones are
    not used. There are at most as many components as the scatter has rank, so none
    for vectors that are all equal.
    """
    spark = vectors.sparkSession
    path = shared_path(spark, "different-vectors")
    levels(vectors, vec_col, vec_col).select("y").distinct().write.parquet(path)
    different = spark.read.parquet(path)
    sizes = different.groupBy(F.size("y").alias("size")).count()
    most = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    if most is None:
        return None
    different = different.where(F.size("y") == most["size"])
    size = most["size"]
    totals = {(r.i, r.j): int(r.total) for r in scatter_sums(different, size).collect()}
    n, sums = totals[-1, -1], [totals[i, -1] for i in range(size)]
    scatter = [[n * totals[max(i, j), min(i, j)] - sums[i] * sums[j] for j in range(size)] for i in range(size)]
    trace = sum(scatter[i][i] for i in range(size))
    poly = characteristic_polynomial(spark, scatter)
    rank = size - next(i for i, a in enumerate(poly) if a)
    roots = largest_roots(poly, min(components, rank)) if rank else []
    with decimal.localcontext() as context:
        context.prec = DIGITS
        exact = [(Decimal(t) / Decimal(2) ** k, times) for t, k, times in roots]
        told = [(root / (n * n), root / trace) for root, times in exact for _ in range(times)][:components]
    bases = null_spaces(spark, scatter, exact)
    model = Whitening(
        size, n, sums, [float(e) for e, _ in told], [float(s) for _, s in told],
        [v for basis in bases for v in basis][:components],
    )
    return Whitening(**{**vars(model), "identity_error": identity_error(different, model)})


def null_spaces(spark: SparkSession, scatter: list[list[int]], roots: list[tuple[Decimal, int]]) -> list[list[list[float]]]:
    """The unit vectors of each root, worked out by tasks."""
    if not roots:
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.list_(pa.float64()))
        for batch in batches:
            ids = batch.column(0)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([null_space(scatter, *roots[i], seed=i) for i in ids.to_pylist()], kind)], ["id", "v"]
            )

    parts = min(len(roots), spark.sparkContext.defaultParallelism)
    rows = spark.range(0, len(roots), 1, parts).mapInArrow(run, "id bigint, v array<array<double>>").collect()
    return [r.v for r in sorted(rows, key=lambda r: r.id)]


def identity_error(different: DataFrame, model: Whitening) -> float:
    """The largest entry of the covariance of the whitened fit list minus the identity."""
    k = len(model.vectors)
    if not k:
        return 0.0
    at_i, at_j = np.indices((k, k + 1)).reshape(2, -1).astype(np.int32)  # the last column holds sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k + 1))
        for batch in batches:
            if batch.num_rows:
                w = model.project(model.deviations(matrix(batch, model.size)))
                total += np.column_stack([w.T @ w, w.sum(axis=0)])
        yield pa.RecordBatch.from_arrays([pa.array(at_i), pa.array(at_j), pa.array(total.ravel())], ["i", "j", "part"])

    parts = different.select("y").mapInArrow(run, "i int, j int, part double")
    total = np.zeros((k, k + 1))
    for r in parts.groupBy("i", "j").agg(F.sum("part").alias("total")).collect():
        total[r.i, r.j] = r.total
    mean = total[:, k] / model.n
    covariance = total[:, :k] / model.n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(vectors: DataFrame, model: Whitening | None, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(id_col, component, n, deviation, whitened, explained, identity_error)``: for
    each usable row and component its whitened coordinate.

    Rows drop out whose vector is NULL, empty, of another size than the model's, or
    holds NULL or an entry that is not finite or of size 2**34 or beyond. Rows that
    repeat give rows that repeat; a NULL id stays. ``deviation`` is exact, and NULL
    where it is beyond a long. No usable vectors, or equal ones only, give no rows.
    Other columns are not read.
    """
    kind = vectors.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField(id_col, kind), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
        ]
    )
    if model is None or not model.vectors:
        return vectors.sparkSession.createDataFrame([], schema)
    k, names, types = len(model.vectors), schema.fieldNames(), list(to_arrow_schema(schema).types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            deviations = model.deviations(matrix(batch, model.size))
            each, rows = np.repeat(np.arange(len(deviations)), k), len(deviations) * k
            arrays = [
                batch.column(0).take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(deviations))),
                pa.array(np.full(rows, model.n, np.int64)),
                pa.array(model.squares(deviations), pa.int64()).take(pa.array(each)),
                pa.array(model.project(deviations).ravel()),
                pa.array(np.tile(model.shares, len(deviations))),
                pa.array(np.full(rows, model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays([a.cast(t) for a, t in zip(arrays, types)], names)

    usable = levels(vectors, id_col, vec_col).where(F.size("y") == model.size)
    return usable.mapInArrow(run, schema)
