"""Whitening of embeddings by a bidiagonal qd solver.

Vectors become integers, the distinct ones are the fit list.  Their exact sums
give the mean; every task reduces its centred rows block by block to one
triangular R (QR of the rows below the R so far), and the tasks' R are joined in
the same way in groups of ``FAN``, so neither rows nor a cross product meet
anywhere.  Squaring the data is avoided: the singular values of the last R are
those of all centred rows.  R (dimension x dimension) is made bidiagonal by
Householder reflections, the dqds iteration finds its singular values to high
relative accuracy, and a twisted factorisation of B'B - e gives the vector of
each, which the right reflections carry back.

Defined cases: rows whose vector is null, empty or holds null or non-finite
entries are dropped; so are vectors of another length than the most common one
(the longer at equal counts).  Null, repeated or clashing ids are rows like any
other; equal vectors count once in the fit and get a row each in the result.
Components with no variance (up to rounding) are left out, so equal vectors or an empty
table give an empty result.  Of two opposite directions the one whose largest
entry (the first of equal ones) is positive is taken.  ``deviation`` is null
where it would not fit a long.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from strata.llm.common import DataFrame, SparkSession, cut_lineage, map_arrow, staged, table

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
BLOCK = 4096            # rows of a QR block
FAN = 16                # R of so many tasks are joined in one
EPS = np.finfo(float).eps


# -- singular values: dqds --------------------------------------------------------
def _dqds_step(q: np.ndarray, e: np.ndarray, shift: float):
    """One differential qd step: (q, e, smallest d), or None if the shift is too large."""
    n = len(q)
    q2, e2 = np.empty(n), np.empty(n - 1)
    d = low = q[0] - shift
    for i in range(n - 1):
        if d < 0:
            return None
        q2[i] = d + e[i]
        ratio = q[i + 1] / q2[i] if q2[i] > 0 else 0.0
        e2[i] = e[i] * ratio
        d = d * ratio - shift
        low = min(low, d)
    if d < 0:
        return None
    q2[-1] = d
    return q2, e2, low


def singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Singular values, falling, of the upper bidiagonal matrix (a, b)."""
    out = []
    work = [(np.square(a, dtype=float), np.square(b, dtype=float), 0.0)]
    while work:
        q, e, base = work.pop()
        guess, turns = 0.0, 0
        while len(q):
            n = len(q)
            small = e <= (4 * EPS) ** 2 * np.minimum(q[:-1] + base, q[1:] + base) if n > 1 else e
            if n > 1 and small.any():                   # the matrix falls apart
                k = int(np.flatnonzero(small)[-1])
                work.append((q[:k + 1], e[:k], base))
                q, e, guess = q[k + 1:], e[k + 1:], 0.0
                continue
            if n == 1:
                out.append(base + q[0])
                break
            if turns % 16 == 0 and q[0] * 1.5 < q[-1]:  # small values belong at the end
                q, e = q[::-1].copy(), e[::-1].copy()
            turns += 1
            shift = guess if base + guess > base else 0.0
            got = _dqds_step(q, e, shift)
            while got is None:                          # the shift passed the smallest value
                shift = shift / 4 if shift > EPS * (base + q.max()) else 0.0
                got = _dqds_step(q, e, shift)
            q, e, low = got
            base += shift
            # d bounds the smallest value from above; what couples the last entry lowers it
            last = q[-1] - np.sqrt(max(q[-1] * e[-1], 0.0)) if low >= q[-1] * (1 - 1e-3) else low * 0.5
            guess = max(0.0, last)
    return np.sqrt(np.sort(np.maximum(out, 0.0))[::-1])


# -- singular vectors: twisted factorisations -------------------------------------
def _twisted(a: np.ndarray, b: np.ndarray, value: float):
    """(gamma of each place, upward and downward factors) of B'B - value: the
    stationary transform from the top meets the progressive one from the end."""
    n = len(a)
    q, e, ab = a * a, b * b, a[:-1] * b
    tiny = EPS * EPS * (q.max() + (e.max() if n > 1 else 0.0)) + np.finfo(float).tiny
    s, p = np.empty(n), np.empty(n)
    up, down = np.empty(n - 1), np.empty(n - 1)
    s[0] = -value
    for i in range(n - 1):
        pivot = s[i] + q[i]
        pivot = pivot if abs(pivot) > tiny else tiny
        up[i] = ab[i] / pivot
        s[i + 1] = e[i] / pivot * s[i] - value
    p[-1] = q[-1] - value
    for i in range(n - 2, -1, -1):
        pivot = e[i] + p[i + 1]
        pivot = pivot if abs(pivot) > tiny else tiny
        down[i] = ab[i] / pivot
        p[i] = p[i + 1] * (q[i] / pivot) - value
    return s + p + value, up, down


def singular_vector(a: np.ndarray, b: np.ndarray, value: float, against: list[np.ndarray]) -> np.ndarray:
    """Unit vector of B'B for the eigenvalue ``value``, at right angles to the
    vectors ``against`` of close values.  The twist is put where gamma is
    smallest; if what is left beside ``against`` is little, at the next place."""
    gamma, up, down = _twisted(a, b, value)
    best, most = None, -1.0
    for r in np.argsort(np.abs(gamma), kind="stable"):
        z = np.zeros(len(a))
        z[r] = 1.0
        for i in range(r - 1, -1, -1):
            z[i] = -up[i] * z[i + 1]
        for i in range(r, len(a) - 1):
            z[i + 1] = -down[i] * z[i]
        z /= np.linalg.norm(z)
        for _ in range(2):
            for v in against:
                z -= (v @ z) * v
        left = np.linalg.norm(z)
        if left > most:
            best, most = z / max(left, EPS), left
        if left > 0.5 or not against:
            break
    return best


def bidiagonal(r: np.ndarray):
    """(diagonal, upper diagonal, right reflections) of a square matrix by
    Householder reflections from both sides."""
    m, n = r.astype(float).copy(), len(r)
    right = []
    for k in range(n):
        for x, rows in ((m[k:, k], True), (m[k, k + 1:], False)):
            if len(x) < 1 or (not rows and len(x) < 2):
                continue
            size = np.linalg.norm(x)
            v = x.copy()
            v[0] += np.copysign(size, v[0]) if size else 0.0
            length = np.linalg.norm(v)
            if not length:
                if not rows:
                    right.append((k + 1, None))
                continue
            v /= length
            if rows:
                m[k:, k:] -= 2 * np.outer(v, v @ m[k:, k:])
            else:
                m[k:, k + 1:] -= 2 * np.outer(m[k:, k + 1:] @ v, v)
                right.append((k + 1, v))
    return np.diag(m).copy(), np.diag(m, 1).copy(), right


def principal(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, falling; directions as columns for the first ``most``
    of them that are not zero) of a square matrix."""
    a, b, right = bidiagonal(r)
    cut = np.abs(b) <= EPS * (np.abs(a[:-1]) + np.abs(a[1:])) if len(b) else np.zeros(0, bool)
    edge = [0, *(np.flatnonzero(cut) + 1).tolist(), len(a)]
    found = []                                          # (value, first row, its block's values)
    for x, y in zip(edge, edge[1:]):
        found += [(s, x, y) for s in singular_values(a[x:y], b[x:y - 1])]
    found.sort(key=lambda f: -f[0])
    values = np.array([f[0] for f in found])
    some = [f for f in found[:most] if f[0] > max(len(a), 1) * EPS * values[0]]
    vectors, done = np.zeros((len(a), len(some))), []
    for j, (s, x, y) in enumerate(some):
        near = [v for t, u, v in done if u == x and t - s <= 1e-3 * t]
        z = singular_vector(a[x:y], b[x:y - 1], s * s, near)
        done.append((s, x, z))
        vectors[x:y, j] = z
    for k, v in reversed(right):
        if v is not None:
            vectors[k:] -= 2 * np.outer(v, v @ vectors[k:])
    if vectors.size:
        top = vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])]
        vectors *= np.where(top < 0, -1.0, 1.0)
    return values, vectors


# -- Spark passes -----------------------------------------------------------------
def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def integer_vectors(vectors: DataFrame, of: str = "embedding", to: str = "x") -> DataFrame:
    """``vectors`` with the integers of each whole, finite, non-empty vector; other rows go."""
    c = F.col(of)
    bad = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    some = vectors.filter(c.isNotNull() & (F.size(c) > 0)).filter(~bad)
    x = F.transform(c, lambda v: F.floor(F.lit(float(SCALE)) * v.cast("double")).cast("long") + F.lit(SHIFT))
    return some.withColumn(to, x)


def triangular(fit: DataFrame, mean: np.ndarray) -> np.ndarray:
    """R of the QR factorisation of all centred rows ``x`` of ``fit``."""
    dim = len(mean)

    def square(r: np.ndarray) -> np.ndarray:
        return np.vstack([r, np.zeros((dim - len(r), dim))]) if len(r) < dim else r

    def reduce_rows(batches):
        r, some = np.zeros((dim, dim)), False
        for b in batches:
            x = _matrix(b.column("x"), dim)
            for i in range(0, len(x), BLOCK):
                r, some = square(np.linalg.qr(np.vstack([r, x[i:i + BLOCK] - mean]), mode="r")), True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([r.ravel().tolist()], pa.list_(pa.float64()))], ["x"])

    def join_r(batches):
        r, some = np.zeros((dim, dim)), False
        for b in batches:
            for flat in b.column("x"):
                r, some = square(np.linalg.qr(np.vstack([r, np.array(flat.as_py()).reshape(dim, dim)]), mode="r")), True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([r.ravel().tolist()], pa.list_(pa.float64()))], ["x"])

    rows = cut_lineage(map_arrow(fit.select("x"), reduce_rows, "x array<double>"))
    parts = rows.count()
    while parts > 1:                # one R per task, FAN of them make one
        groups = -(-parts // FAN)
        rows = cut_lineage(map_arrow(rows.repartition(groups), join_r, "x array<double>"))
        parts = rows.count()
    got = rows.toArrow().column("x").to_pylist()
    return np.array(got[0]).reshape(dim, dim) if got else np.zeros((dim, dim))


def fit_whitening(fit: DataFrame, dim: int, components: int = COMPONENTS) -> dict:
    """Mean, directions, eigenvalues and their sum of the rows ``x`` of ``fit``.

    What reaches the driver is bounded by the dimension alone."""
    def sums(batches):
        n, s = 0, np.zeros(dim, np.int64)
        for b in batches:
            x = _matrix(b.column("x"), dim)
            n, s = n + len(x), s + x.sum(0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim)), pa.array(s), pa.array(np.full(dim, n))], ["i", "s", "n"])

    got = (map_arrow(fit.select("x"), sums, "i bigint, s bigint, n bigint").groupBy("i")
           .agg(F.sum("s").alias("s"), F.sum("n").alias("n")).toArrow().sort_by("i"))
    if not got.num_rows:
        return {"n": 0, "values": np.zeros(0)}
    s, n = got.column("s").to_numpy(), int(got.column("n")[0].as_py())
    mean = s / n
    values, vectors = principal(triangular(fit, mean), components)
    e = values ** 2 / n
    k = vectors.shape[1]
    return {"n": n, "sums": s, "mean": mean, "values": e[:k], "trace": float(e.sum()), "vectors": vectors,
            "map": vectors / np.sqrt(e[:k])}


def identity_error(fit: DataFrame, fitted: dict) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the
    identity; its mean, taken in the same pass, is zero up to rounding."""
    dim, k = fitted["vectors"].shape

    def products(batches):
        total = np.zeros((k + 1, k))
        for b in batches:
            x = _matrix(b.column("x"), dim)
            for i in range(0, len(x), BLOCK):
                w = (x[i:i + BLOCK] - fitted["mean"]) @ fitted["map"]
                total[:k] += w.T @ w
                total[k] += w.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["i", "v"])

    got = map_arrow(fit.select("x"), products, "i bigint, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow().sort_by("i")
    total = got.column("v").to_numpy().reshape(k + 1, k) / fitted["n"]
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of the
    rows of ``vectors`` (vec_id, embedding)."""
    row = staged(integer_vectors(vectors.select("vec_id", "embedding")).select("vec_id", "x"), "whitening")
    kind = row.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    length = row.groupBy(F.size("x").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).limit(1).collect()
    if not length:
        return vectors.sparkSession.createDataFrame([], schema)
    dim = length[0]["d"]
    row = row.filter(F.size("x") == dim)
    fit = staged(row.select("x").distinct(), "whitening-fit")
    fitted = fit_whitening(fit, dim, components)
    k = len(fitted["values"])
    if not k:
        return vectors.sparkSession.createDataFrame([], schema)
    error, explained, n = identity_error(fit, fitted), fitted["values"] / fitted["trace"], fitted["n"]

    def project(batches):
        for b in batches:
            for i in range(0, b.num_rows, BLOCK):
                part = b.slice(i, BLOCK)
                x = _matrix(part.column("x"), dim)
                m = len(x)
                w = (x - fitted["mean"]) @ fitted["map"]
                deviation = pa.array(np.repeat(np.array(_deviation(x, n, fitted["sums"]), object), k), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, n)), deviation, pa.array(w.ravel()), pa.array(np.tile(explained, m)),
                     pa.array(np.full(m * k, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return map_arrow(row, project, schema)


def _deviation(x: np.ndarray, n: int, s: np.ndarray) -> list:
    """Sum of (n x - s) ** 2 over the dimensions, exactly; None beyond a long."""
    rough = ((x * float(n) - s) ** 2).sum(1)
    out = np.where(rough < 2.0 ** 61, ((x * n - s) ** 2).sum(1), 0).astype(object)
    for i in np.flatnonzero(rough >= 2.0 ** 61):
        exact = sum((int(v) * n - int(t)) ** 2 for v, t in zip(x[i], s))
        out[i] = exact if exact < 1 << 63 else None
    return out.tolist()


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))
