"""Embedding whitening (operator 13): principal components by an exact characteristic polynomial.

Entries become integers x = floor(64 c) + 1000000. With n vectors, sums S and G the sum of x x' the integer
scatter M = n G - S S' is n * n times the covariance (divisor n); it does not change when all x move by the
same, so it is summed from x - 1000000, exactly, task by task, and added up by Spark.

1. Polynomial: M is reduced to Hessenberg form modulo primes below 2^31, one prime a row of a Spark job, whose
   recurrence gives the characteristic polynomial modulo that prime. Its coefficients are at most
   C(d, k) (trace / d)^k (Maclaurin's inequality for roots >= 0); primes beyond twice that make Chinese
   remaindering, one coefficient a row, exact.
2. Roots: all are real, so the sign changes of the polynomial shifted by a count the roots above a exactly,
   with multiplicity (Budan). Each component's row isolates its root by bisection on that count, and then halves on
   the exact sign to ``ROOT_BITS`` bits. Roots that agree to ``SAME_BITS`` bits are one of higher multiplicity. The
   multiplicity of the root zero, so the rank, can be read from the coefficients.
3. Components: for each distinct root r, M - r is factored in integers of some 200 bits more than M, with full
   pivoting; back substitution through the factors from the start that Wilkinson gave, whose image is a unit
   vector at a vanishing pivot, is one step of inverse iteration and gives the null space. A multiple root's
   vectors are made orthogonal. The largest entry of a component is positive.

What passes the driver is d x d numbers, whatever the rows. Whitened values use doubles only from (n x - S) / n on.

Rows: vectors that are null, empty, hold null or non-finite entries, or entries whose x is no long, are left out.
Vectors of each length are a list of their own, with their own n, S and components. Components of variance zero (equal
vectors, fewer vectors than dimensions) have no rows. A ``deviation`` beyond a long is null. Repeated ids and rows count
as rows; other columns are ignored. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, isqrt, prod, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.shared import mapped

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
ROOT_BITS, SAME_BITS = 220, 180
#: Bits of the numbers in which sums travel, and vectors of one numpy step.
LIMB, STEP = 60, 4096


def shifted(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of ``batch`` and their x - SHIFT as long, for the vectors of each length that take part."""
    vectors = batch.column("vector").cast(pa.large_list(pa.float64()))
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    for d in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == d)
        for at in range(0, len(rows), STEP):
            part = rows[at : at + STEP]
            c = vectors.take(pa.array(part)).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)  # null entries: nan
            with np.errstate(invalid="ignore", over="ignore"):
                x = np.floor(c * SCALE)
                fits = np.all(np.abs(x) < 2.0**62, axis=1)
            if fits.any():
                yield part[fits], x[fits].astype(np.int64)


def gram(y: np.ndarray) -> np.ndarray:
    """The exact sum of y y' over rows of longs, as Python integers: limbs of 20 bits, whose products doubles add exactly."""
    limbs = []
    while np.abs(y).max(initial=0) >= 1 << 20:
        limbs.append((y & ((1 << 20) - 1)).astype(float))
        y = y >> 20
    limbs.append(y.astype(float))
    out = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    for i, a in enumerate(limbs):
        for j, b in enumerate(limbs):
            out += (a.T @ b).astype(np.int64).astype(object) << (20 * (i + j))
    return out


def _scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, list] = {}

    def out():
        for d, (n, s, g) in held.items():
            i, j = np.triu_indices(d)
            values = [n, *s.tolist(), *g[i, j].tolist()]
            mask = (1 << LIMB) - 1
            limbs = [pa.array([v & mask for v in values]), pa.array([v >> LIMB & mask for v in values]), pa.array([v >> 2 * LIMB for v in values], pa.int64())]
            at = [np.concatenate(x) for x in (([-1], np.full(d, -1), i), ([-1], np.arange(d), j))]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), d)), *(pa.array(x.astype(np.int64)) for x in at), *limbs], names=["d", "i", "j", "l0", "l1", "l2"])
        held.clear()

    for batch in batches:
        for rows, y in shifted(batch):
            d = y.shape[1]
            if d not in held and sum(k * k for k in held) > 1 << 22:
                yield from out()
            n, s, g = held.get(d, (0, 0, 0))
            held[d] = [n + len(rows), s + sum(y.astype(object)), g + gram(y)]
    yield from out()


def scatter_sums(vectors: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """By length: n, the sums and the scatter M, exact; ``vectors(vector)``."""
    parts = mapped(vectors.select("vector"), _scatter, "d long, i long, j long, l0 long, l1 long, l2 long")
    sums = parts.groupBy("d", "i", "j").agg(*(F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("l0", "l1", "l2"))).collect()
    n: dict[int, int] = {}
    s: dict[int, np.ndarray] = {}
    g: dict[int, np.ndarray] = {}
    for r in sums:
        value = int(r.l0) + (int(r.l1) << LIMB) + (int(r.l2) << 2 * LIMB)
        if r.j < 0:
            n[r.d] = value
        elif r.i < 0:
            s.setdefault(r.d, np.zeros(r.d, dtype=object))[r.j] = value
        else:
            m = g.setdefault(r.d, np.zeros((r.d, r.d), dtype=object))
            m[r.i, r.j] = m[r.j, r.i] = value
    return {d: (n[d], s[d], n[d] * g[d] - np.outer(s[d], s[d])) for d in n}


def _is_prime(p: int) -> bool:
    """Miller-Rabin; bases 2, 3, 5, 7 are proof below 3215031751."""
    d, r = p - 1, 0
    while not d & 1:
        d, r = d >> 1, r + 1
    for a in (2, 3, 5, 7):
        x = pow(a, d, p)
        if x not in (1, p - 1) and all((x := x * x % p) != p - 1 for _ in range(r - 1)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """Primes below 2^31, from the largest, whose product exceeds ``bound``."""
    out, product, p = [], 1, (1 << 31) - 1
    while product <= bound:
        if _is_prime(p):
            out.append(p)
            product *= p
        p -= 2
    return out


def polynomial_mod(m: np.ndarray, p: int) -> np.ndarray:
    """Coefficients (constant first) of det(x - m) modulo ``p``, by Hessenberg reduction."""
    a = (m % p).astype(np.int64)
    d = len(a)
    for k in range(d - 2):
        found = np.flatnonzero(a[k + 1 :, k])
        if not len(found):
            continue
        q = k + 1 + found[0]
        a[[k + 1, q]] = a[[q, k + 1]]
        a[:, [k + 1, q]] = a[:, [q, k + 1]]
        factor = a[k + 2 :, k] * pow(int(a[k + 1, k]), -1, p) % p
        a[k + 2 :] = (a[k + 2 :] - factor[:, None] * a[k + 1] % p) % p
        a[:, k + 1] = (a[:, k + 1] + (a[:, k + 2 :] * factor % p).sum(axis=1)) % p
    chain = np.zeros((d + 1, d + 1), dtype=np.int64)  # row k: the polynomial of the leading k x k block
    chain[0, 0] = 1
    for k in range(d):
        t, weight = 1, np.zeros(k, dtype=np.int64)
        for i in range(k - 1, -1, -1):
            t = t * int(a[i + 1, i]) % p
            weight[i] = int(a[i, k]) * t % p
        own = np.roll(chain[k], 1) - a[k, k] * chain[k] % p
        chain[k + 1] = (own - (weight[:, None] * chain[:k] % p).sum(axis=0)) % p
    return chain[d]


def chinese(residues: list[tuple[int, int]]) -> int:
    """The integer of least absolute value with the given (prime, residue) pairs."""
    x, m = 0, 1
    for p, r in residues:
        x += m * ((r - x) * pow(m, -1, p) % p)
        m *= p
    return x - m if 2 * x > m else x


def characteristic_polynomial(spark: SparkSession, m: np.ndarray) -> list[int]:
    """Coefficients (constant first) of det(x - m) for a positive semidefinite integer matrix."""
    d, trace = len(m), int(sum(m.diagonal()))
    mean = trace // d + 1
    primes = primes_beyond(2 * max(comb(d, k) * mean**k for k in range(d + 1)) + 1)

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column("prime").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(d + 1)), pa.array(np.full(d + 1, p)), pa.array(polynomial_mod(m, p))], names=["power", "prime", "residue"])

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [str(chinese([(x["prime"], x["residue"]) for x in r])) for r in batch.column("r").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("power"), pa.array(values, pa.string())], names=["power", "value"])

    found = mapped(_dealt(spark, [(p,) for p in primes], "prime long"), residues, "power long, prime long, residue long")
    found = mapped(found.groupBy("power").agg(F.collect_list(F.struct("prime", "residue")).alias("r")), combine, "power long, value string")
    return [int(v) for _, v in sorted((r.power, r.value) for r in found.collect())]


def _dealt(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows of much work each, over as many partitions as there are cores for."""
    return spark.createDataFrame(rows, schema).repartition(max(1, min(len(rows), spark.sparkContext.defaultParallelism)))


def roots_above(poly: list[int], a: int, s: int) -> int:
    """How many roots exceed a / 2^s > 0, with multiplicity; all roots must be real."""
    d = len(poly) - 1
    power, c = 1, []
    for k, v in enumerate(poly):
        c.append(v * power << s * (d - k))  # the polynomial in units of a / 2^s, to be shifted by one
        power *= a
    signs = []
    for k in range(d + 1):
        total = 0
        for i in range(d, k - 1, -1):
            total += c[i]
            c[i] = total
        if total:
            signs.append(total > 0)
    return sum(x != y for x, y in zip(signs, signs[1:]))


def sign_at(poly: list[int], a: int, s: int) -> int:
    value, shift = 0, 0
    for v in reversed(poly):
        value = value * a + (v << shift)
        shift += s
    return (value > 0) - (value < 0)


def nth_root(poly: list[int], k: int, bound: int) -> tuple[int, int]:
    """a, s: the k-th largest root lies in ((a - 1) / 2^s, a / 2^s], a of ``ROOT_BITS`` bits; it is positive and at most ``bound``."""
    lo, hi, s = 0, 1 << bound.bit_length(), 0
    above_hi, above_lo = 0, None
    while hi - lo > 1 or hi.bit_length() < ROOT_BITS:
        if hi - lo == 1:
            lo, hi, s = 2 * lo, 2 * hi, s + 1
        mid = (lo + hi) // 2
        if above_lo == k and above_hi == k - 1:  # alone: the sign right of it is that of (-1)^(k - 1)
            side = sign_at(poly, mid, s) * (1 if k % 2 else -1)
            lo, hi = (mid, hi) if side < 0 else (lo, mid)
            continue
        n = roots_above(poly, mid, s)
        if n >= k:
            lo, above_lo = mid, n
        else:
            hi, above_hi = mid, n
    return hi, s


def null_space(m: np.ndarray, a: int, s: int, size: int) -> np.ndarray:
    """``size`` orthonormal vectors (rows, doubles) that ``m - a / 2^s`` takes to about zero."""
    d = len(m)
    u = m * (1 << s)
    u[np.arange(d), np.arange(d)] -= a
    scale = max(abs(v) for v in u.ravel())
    column = np.arange(d)
    for k in range(d - size):
        rest = np.abs(u[k:, k:])
        r, c = np.unravel_index(int(np.argmax(rest)), rest.shape)
        u[[k, k + r]] = u[[k + r, k]]
        u[:, [k, k + c]] = u[:, [k + c, k]]
        column[[k, k + c]] = column[[k + c, k]]
        u[k + 1 :, k:] -= np.outer(u[k + 1 :, k], u[k, k:]) // u[k, k]
    if any(abs(v) << SAME_BITS // 2 > scale for v in u[d - size :, d - size :].ravel()):
        raise ArithmeticError("no null space of that size")
    one = 1 << 256
    found: list[np.ndarray] = []
    for free in range(d - size, d):
        x = np.zeros(d, dtype=object)
        x[free] = one
        for k in range(d - size - 1, -1, -1):
            x[k] = -(u[k, k + 1 :] @ x[k + 1 :]) // u[k, k]
        own = np.zeros(d, dtype=object)
        own[column] = x
        for other in found * 2:
            own = own - other * (own @ other) // (other @ other)
        found.append(own * one // isqrt(int(own @ own)))
    out = np.array([[v / one for v in x] for x in found], dtype=float)
    return out * np.sign(out[np.arange(size), np.argmax(np.abs(out), axis=1)])[:, None]


def components(spark: SparkSession, m: np.ndarray, most: int = COMPONENTS) -> list[tuple[int, int, np.ndarray]]:
    """Up to ``most`` of (a, s, unit vector), by falling root a / 2^s of the positive semidefinite integer matrix ``m``."""
    trace = int(sum(m.diagonal()))
    if not trace:
        return []
    poly = characteristic_polynomial(spark, m)
    zeros = next(k for k, v in enumerate(poly) if v)
    poly = poly[zeros:]

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column("k").to_pylist():
                a, s = nth_root(poly, k, trace)
                step = 1 << max(0, a.bit_length() - SAME_BITS)
                first, last = roots_above(poly, a + step, s) + 1, roots_above(poly, a - step, s)
                yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (k, first, last, str(a), s)], names=["k", "first", "last", "a", "s"])

    ranks = [(k,) for k in range(1, min(most, len(poly) - 1) + 1)]
    found = mapped(_dealt(spark, ranks, "k long"), roots, "k long, first long, last long, a string, s long").collect()
    distinct = [(r.first, r.last, r.a, r.s) for r in found if r.k == r.first]

    def spaces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, a, s in zip(*(batch.column(c).to_pylist() for c in ("first", "last", "a", "s"))):
                vectors = null_space(m, int(a), s, last - first + 1)
                n = len(vectors)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(first, last + 1)), pa.array([a] * n), pa.array([s] * n), pa.array(vectors.tolist())], names=["k", "a", "s", "vector"])

    found = mapped(_dealt(spark, distinct, "first long, last long, a string, s long"), spaces, "k long, a string, s long, vector array<double>").collect()
    return [(int(r.a), r.s, np.array(r.vector)) for r in sorted(found, key=lambda r: r.k) if r.k <= most]


def _project(d: int, n: int, s: np.ndarray, basis: np.ndarray):
    """Per step: rows, deviations (None beyond a long) and whitened values; ``basis`` holds components over their deviation."""
    ends = max(abs(int(v)) for v in s)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list, np.ndarray]]:
        for batch in batches:
            for rows, y in shifted(batch):
                if y.shape[1] != d:
                    continue
                largest = n * int(np.abs(y).max()) + ends
                whole = np.int64 if largest * largest * d < 1 << 62 else object
                off = y.astype(whole) * n - s.astype(whole)
                squares = (off * off).sum(axis=1).tolist()
                yield batch, rows, [v if v < 1 << 63 else None for v in squares], (off / n).astype(float) @ basis.T

    return each


def whitened(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for ``vectors(vec_id, vector)``:
    a row for each row that takes part and each of its list's components up to ``most``."""
    spark = vectors.sparkSession
    vectors = vectors.select("vec_id", "vector")
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    out = None
    for d, (n, s, m) in sorted(scatter_sums(vectors).items()):
        found = components(spark, m, most)
        if not found:
            continue
        trace = int(sum(m.diagonal()))
        explained = [a / (trace << b) for a, b, _ in found]
        basis = np.array([v / sqrt(a / (n * n << b)) for a, b, v in found])
        project = _project(d, n, s, basis)
        own = vectors.where(F.size("vector") == d)

        def moments(batches, project=project, k=len(found)):
            sums, squares = np.zeros(k), np.zeros((k, k))
            for _, _, _, z in project(batches):
                sums += z.sum(axis=0)
                squares += z.T @ z
            yield pa.RecordBatch.from_arrays([pa.array([sums.tolist()]), pa.array([squares.ravel().tolist()])], names=["sums", "squares"])

        # one row per task; z is centred already, so the mean only takes away rounding
        parts = mapped(own, moments, "sums array<double>, squares array<double>")
        added = parts.select(F.posexplode(F.concat("sums", "squares")).alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v"))
        sums = np.array([r.v for r in sorted(added.collect())]) / n
        mean, second = sums[: len(found)], sums[len(found) :].reshape(len(found), -1)
        error = float(np.abs(second - np.outer(mean, mean) - np.eye(len(found))).max())

        def values(batches, project=project):
            for batch, rows, squares, z in project(batches):
                ids = batch.column("vec_id").take(pa.array(rows))
                z = pa.ListArray.from_arrays(pa.array(np.arange(0, z.size + 1, z.shape[1]), pa.int32()), pa.array(z.ravel()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(squares, pa.int64()), z], names=["vec_id", "deviation", "z"])

        rows = mapped(own, values, f"vec_id {id_type}, deviation long, z array<double>").select("vec_id", "deviation", F.posexplode("z").alias("at", "whitened"))
        rows = rows.select(
            "vec_id",
            (F.col("at") + 1).alias("component"),
            F.lit(n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.get(F.lit(explained), F.col("at")).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        return spark.createDataFrame([], f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return out


def op13_exact_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return whitened(embeddings.select("vec_id", F.col("embedding").alias("vector")))
