"""Whitening of embeddings through a bidiagonal qd solver.

Entries become fixed-point numbers x, so sums are exact. Rows are centred and reduced block by block: each task keeps
one triangle R and replaces it by the R of [R; block] (Householder QR); triangles of tasks are stacked and reduced the
same way, FAN_IN at a time. The last R has the covariance's directions: R'R = sum of centred x'x.

On the driver, R (dimensions x dimensions) is made bidiagonal by Householder reflections from both sides. Its
singular values come from the differential qd algorithm with shifts (dqds), which finds small ones to high relative
accuracy. For each wanted value a twisted factorisation of B'B - s^2 I (stationary qd from the top, progressive qd from
the bottom, joined where the pivot is least) gives the direction; directions of values that lie close together are made
orthogonal and refined by inverse iteration with the same factors. The right-hand reflections take them back.

Defined results: rows whose vector is null or empty, or holds null or non-finite entries, take no part; all other
rows do, whatever their vec_id (null and repeated ones too). Vectors of different lengths, and entries beyond the
range in which sums are exact, are an error that says so. A component without variance has whitened NULL and explained
0; fewer dimensions than wanted components give as many components as there are dimensions. An empty table gives an
empty result.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termfold.llm.shared import ship_package, table
from termfold.operators.staging import staged

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Rows that are reduced at a time; triangles that one task stacks.
BLOCK, FAN_IN = 4096, 64
#: Largest x; sums of 8 million rows of such entries still fit a long.
MOST = 1 << 40
EPS = np.finfo(float).eps
#: Singular values closer than this part of each other share a cluster.
CLOSE = 1e-3


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and x (array of long, fixed point) of the rows that take part."""
    v = F.col(column).cast("array<double>")
    fine = (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    near = F.forall(v, lambda c: F.abs(c) < MOST / SCALE)
    x = F.when(near, F.transform(v, lambda c: F.floor(c * SCALE).cast("long") + OFFSET)).otherwise(
        F.raise_error(F.concat(F.lit("an entry is too large for exact sums, vec_id "), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))))
    return vectors.where(F.coalesce(fine, F.lit(False))).select("vec_id", x.alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), d)


def _summed(batches):
    """Rows, and sum of each dimension, of one partition; its lengths."""
    n, total, short, long_ = 0, None, None, None
    for b in batches:
        if not b.num_rows:
            continue
        lengths = b.column(0).value_lengths().to_numpy(zero_copy_only=False)
        short, long_ = min(lengths.min(), short or lengths.min()), max(lengths.max(), long_ or 0)
        n += b.num_rows
        if short == long_:
            s = _matrix(b.column(0), int(short)).sum(axis=0)
            total = s if total is None else total + s
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array([n], pa.int64()), pa.array([int(short)], pa.int64()), pa.array([int(long_)], pa.int64()),
             pa.array([total.tolist() if short == long_ else []], pa.list_(pa.int64()))], names=["n", "short", "long", "total"])


def fitted(rows: DataFrame) -> tuple[int, np.ndarray]:
    """Number of rows and exact sum of each dimension."""
    parts = staged(rows.select("x").mapInArrow(_summed, "n long, short long, long long, total array<long>"))
    n, short, long_ = parts.agg(F.sum("n"), F.min("short"), F.max("long")).first()
    if n is None:
        return 0, np.zeros(0, np.int64)
    if short != long_:
        raise ValueError(f"vectors have from {short} to {long_} entries; they must be of one length")
    sums = parts.select(F.posexplode("total")).groupBy("pos").agg(F.sum("col").alias("s")).collect()
    return n, np.array([r["s"] for r in sorted(sums, key=lambda r: r["pos"])], np.int64)


# --- reduction ---------------------------------------------------------------

def _triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def _reduced(batches, n: int, sums: np.ndarray):
    """The triangle of one partition's centred rows."""
    d, r = len(sums), np.zeros((0, len(sums)))
    for b in batches:
        for i in range(0, b.num_rows, BLOCK):
            x = _matrix(b.column(0).slice(i, BLOCK), d)
            r = _triangle(np.vstack([r, centred(x, n, sums)]))
    if len(r):
        yield _triangles(TaskContext.get().partitionId(), r)


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n, the part of whole numbers exact."""
    whole, rest = np.divmod(sums, n)
    return (x - whole).astype(float) - rest / n


def _triangles(part: int, r: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([np.ascontiguousarray(r).tobytes()], pa.binary())], names=["part", "r"])


def _stacked(batches, d: int):
    r, first = np.zeros((0, d)), None
    for b in batches:
        for part, data in zip(b.column(0).to_pylist(), b.column(1)):
            first = part if first is None else first
            r = _triangle(np.vstack([r, np.frombuffer(data.as_buffer()).reshape(-1, d)]))
    if len(r):
        yield _triangles(first, r)


def reduced(rows: DataFrame, n: int, sums: np.ndarray) -> np.ndarray:
    """R of the centred rows: at most dimensions x dimensions, in a tree of tasks."""
    schema, d = "part long, r binary", len(sums)
    parts = staged(rows.select("x").mapInArrow(partial(_reduced, n=n, sums=sums), schema))
    left = parts.count()
    while left > FAN_IN:
        grouped = parts.repartitionByRange(-(-left // FAN_IN), "part").sortWithinPartitions("part")
        parts = staged(grouped.mapInArrow(partial(_stacked, d=d), schema))
        left = parts.count()
    r = np.zeros((0, d))
    for row in sorted(parts.collect(), key=lambda x: x["part"]):           # FAN_IN triangles at most
        r = _triangle(np.vstack([r, np.frombuffer(bytes(row["r"])).reshape(-1, d)]))
    return np.vstack([r, np.zeros((d - len(r), d))])


# --- bidiagonal solver ---------------------------------------------------------

def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Unit v and value a with (I - 2 v v') x = a e1."""
    norm = np.linalg.norm(x)
    if norm == 0:
        return np.zeros_like(x), 0.0
    v, a = x.astype(float).copy(), -norm if x[0] >= 0 else norm
    v[0] -= a
    return v / np.linalg.norm(v), a


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, upper diagonal, and right-hand reflectors of a square matrix: r = U B V'."""
    a, d = r.astype(float).copy(), len(r)
    right: list[np.ndarray] = []
    for k in range(d):
        v, _ = _reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < d - 2:
            v, _ = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
            right.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def from_right(z: np.ndarray, right: list[np.ndarray]) -> np.ndarray:
    """V z: directions of the bidiagonal matrix as directions of the matrix itself."""
    z = z.copy()
    for k in range(len(right) - 1, -1, -1):
        z[k + 1 :] -= 2 * np.outer(right[k], right[k] @ z[k + 1 :])
    return z


def _dqds(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """One differential qd transform with a shift; None if the shift passes the least value."""
    m, d = len(q), q[0] - shift
    q2, e2 = np.empty(m), np.empty(m - 1)
    for i in range(m - 1):
        if not d >= 0:
            return None
        q2[i] = d + e[i]
        ratio = q[i + 1] / q2[i] if q2[i] > 0 else 1.0
        e2[i] = e[i] * ratio
        d = d * ratio - shift
    q2[-1] = d
    return (q2, e2) if d >= 0 else None


def _below_least(q: np.ndarray, e: np.ndarray) -> float:
    """A number below the least value: that of Newton's step, one by the sum of the reciprocals of all values.

    Without a shift the qd transform's d are the reciprocals of the inverse's diagonal.
    """
    d, total = q[0], 0.0
    for i in range(len(q)):
        if d <= 0:
            return 0.0
        total += 1 / d
        if i < len(e):
            d *= q[i + 1] / (d + e[i])
    return (1 - 8 * len(q) * EPS) / total


def squared_singular_values(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, falling, by dqds."""
    open_: list[tuple[np.ndarray, np.ndarray, float]] = [(diagonal**2, upper**2, 0.0)]
    found: list[float] = []
    while open_:
        q, e, moved = open_.pop()
        if q[0] < q[-1]:                      # reversed, it has the same values; the least is found fastest at the end
            q, e = q[::-1], e[::-1]
        tries = 0
        while len(q) > 1:
            small = np.flatnonzero(e <= EPS * EPS * (moved + np.minimum(q[:-1], q[1:])))
            if len(small):
                cut = int(small[-1]) + 1
                open_.append((q[:cut], e[: cut - 1], moved))
                q, e, tries = q[cut:], e[cut:], 0
                continue
            tries += 1
            shift = _below_least(q, e)
            step = _dqds(q, e, shift)
            if step is None:                  # by rounding only
                shift, step = 0.0, _dqds(q, e, 0.0)
            q, e = step
            moved += shift
            if tries > 100 * len(q) + 1000:
                raise ArithmeticError("singular values did not settle")
        found.append(moved + q[0])
    return np.sort(np.array(found))[::-1]


class _Factors:
    """B'B - value I from the top (stationary qd), from the bottom (progressive qd), and the twists that join them."""

    def __init__(self, diagonal: np.ndarray, upper: np.ndarray, value: float):
        q, e = diagonal**2, upper**2
        m, tiny = len(q), np.finfo(float).tiny + EPS * EPS * (q.max() + (e.max() if len(e) else 0.0))
        self.off = diagonal[:-1] * upper
        self.top, self.bottom = np.empty(m), np.empty(m)
        s, p = np.empty(m), np.empty(m)
        s[0] = -value
        for i in range(m):
            pivot = s[i] + q[i]
            self.top[i] = pivot if abs(pivot) > tiny else -tiny
            if i < m - 1:
                s[i + 1] = e[i] * (s[i] / self.top[i]) - value
        p[-1] = q[-1] - value
        for i in range(m - 1, -1, -1):
            pivot = p[i] + (e[i - 1] if i else 0.0)
            self.bottom[i] = pivot if abs(pivot) > tiny else -tiny
            if i:
                p[i - 1] = q[i - 1] * (p[i] / self.bottom[i]) - value
        self.twists = s + p + value

    def direction(self) -> np.ndarray:
        """Unit solution of the twisted system with the least pivot."""
        k, m = int(np.argmin(np.abs(self.twists))), len(self.top)
        z = np.zeros(m)
        z[k] = 1
        for i in range(k - 1, -1, -1):
            z[i] = -self.off[i] * z[i + 1] / self.top[i]
        for i in range(k, m - 1):
            z[i + 1] = -self.off[i] * z[i] / self.bottom[i + 1]
        return z / np.linalg.norm(z)

    def solve(self, y: np.ndarray) -> np.ndarray:
        """Unit solution of (B'B - value I) x = y, from the top."""
        x = y.astype(float).copy()
        for i in range(len(x) - 1):
            x[i + 1] -= self.off[i] / self.top[i] * x[i]
        x /= self.top
        for i in range(len(x) - 2, -1, -1):
            x[i] -= self.off[i] / self.top[i] * x[i + 1]
        return x / np.linalg.norm(x)


def directions(diagonal: np.ndarray, upper: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Right singular vectors of a bidiagonal matrix, one column for each of its squared singular values ``values``."""
    out: list[np.ndarray] = []
    rng = np.random.default_rng(13)
    cluster = 0
    for i, value in enumerate(values):
        if i and values[i - 1] - value > CLOSE * values[i - 1]:
            cluster = i
        factors = _Factors(diagonal, upper, value)
        z = factors.direction()
        near = np.array(out[cluster:]).reshape(-1, len(z))
        if len(near):
            for start in (z, *rng.standard_normal((8, len(z)))):
                z = start - near.T @ (near @ start)
                if np.linalg.norm(z) < 0.1 * np.linalg.norm(start):
                    continue
                for _ in range(3):
                    z = factors.solve(z / np.linalg.norm(z))
                    z -= near.T @ (near @ z)
                    z -= near.T @ (near @ z)
                if np.linalg.norm(z) > 0.01:
                    break
            z /= np.linalg.norm(z)
        out.append(z)
    return np.array(out).T


def components(r: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues of r'r, falling, and their unit eigenvectors as columns; 0 and no direction without variance."""
    diagonal, upper, right = bidiagonal(r)
    values = squared_singular_values(diagonal, upper)[:wanted]
    values[values <= (len(r) * EPS) ** 2 * values[0]] = 0
    fine = int(np.count_nonzero(values))
    axes = np.zeros((len(r), len(values)))
    if fine:
        axes[:, :fine] = from_right(directions(diagonal, upper, values[:fine]), right)
    return values, axes


# --- whitening ---------------------------------------------------------------

def _whitened(batches, n: int, sums: np.ndarray, model):
    axes = model.value
    for b in batches:
        for i in range(0, max(1, b.num_rows), BLOCK):
            part = b.slice(i, BLOCK)
            x = _matrix(part.column(1), len(sums))
            off = x * n - sums
            if len(off) and (off.astype(float) ** 2).sum(axis=1).max() > 9e18:
                raise ValueError("a deviation exceeds the range of long: too many rows, or entries too far from the mean")
            w = centred(x, n, sums) @ axes
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array((off * off).sum(axis=1)), pa.array(list(w), pa.list_(pa.float64()))], names=["vec_id", "deviation", "w"])


def whitened(vectors: DataFrame, wanted: int = COMPONENTS, column: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of each usable row and component."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = staged(usable(vectors, column))
    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, deviation bigint, w array<double>"
    n, sums = fitted(rows)
    if not n:
        none = spark.createDataFrame([], schema)
        return _listed(none, 0, [], 0, 0.0)
    r = reduced(rows, n, sums)
    values, axes = components(r, min(wanted, len(sums)))
    fine = int(np.count_nonzero(values))
    scaled = np.zeros_like(axes)
    scaled[:, :fine] = axes[:, :fine] / np.sqrt(values[:fine] / n)
    explained = values / max(float((r * r).sum()), np.finfo(float).tiny)
    white = staged(rows.mapInArrow(partial(_whitened, n=n, sums=sums, model=spark.sparkContext.broadcast(scaled)), schema))
    return _listed(white, n, explained.tolist(), fine, identity_error(white, fine))


def identity_error(white: DataFrame, components: int) -> float:
    """Largest difference between the covariance of the whitened values and the identity."""
    if not components:
        return 0.0
    means = white.agg(*[F.avg(F.col("w")[i]) for i in range(components)]).first()
    off = [F.col("w")[i] - F.lit(means[i]) for i in range(components)]
    pairs = [(i, j) for i in range(components) for j in range(i + 1)]
    got = white.agg(*[F.avg(off[i] * off[j]) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for (i, j), v in zip(pairs, got))


def _listed(white: DataFrame, n: int, explained: list[float], fine: int, error: float) -> DataFrame:
    share = F.element_at(F.array(*[F.lit(float(x)) for x in explained or [0.0]]), F.col("component"))
    return white.select("vec_id", "deviation", F.posexplode("w").alias("at", "value")).withColumn("component", (F.col("at") + 1).cast("int")).select(
        "vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", F.when(F.col("component") <= fine, F.col("value")).alias("whitened"),
        share.alias("explained"), F.lit(float(error)).alias("identity_error"))


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))
