"""Whitening of embeddings by singular values of their centred rows.

Entries become whole numbers, x = floor(1024 c) + 100000, so their sums are
exact and a row is centred exactly before anything is multiplied: n x - S has
no rounding.  With rows of dimension d:

1.  Every task folds its centred rows, block by block, into one upper
    triangular factor (QR of the factor so far above the next block).  Factors
    of tasks meet sixteen at a time until one is left; each is d x d, however
    many rows it stands for.  The covariance is never formed.
2.  Householder reflections turn the last factor into an upper bidiagonal
    matrix with the same singular values.
3.  dqds finds their squares from the squared entries, each to a few units in
    its last place whatever its size.
4.  A twisted factorisation of B'B - e I, glued where the stationary and the
    progressive transform leave the smallest pivot, gives each direction.
    Directions of values that lie close together are found by inverse
    iteration with the same factorisation and made orthogonal to each other.

One task does steps 2 to 4 on the last factor.  The driver sees the sums (d
numbers), the directions (at most ``components`` times d) and the sums of
products of the whitened rows (components squared).

Defined results: a vector takes part unless it is null or holds a null or
non-finite entry; if lengths differ, the commonest counts (ties: the longest)
and vectors of another length are left out; components of no spread (singular
value within rounding of zero) are left out, so equal vectors, a single one
and an empty table give no rows; a null id is kept; repeated rows give their
rows each; other columns, whatever their names, are not read.  An entry of
which 1024 times is beyond the range of long is an error.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, small

BLOCK = 2048  # rows folded into a factor at once
FAN_IN = 16  # factors that meet in a task
EPS = float(np.finfo(float).eps)
CLOSE = 1e-3  # relative gap under which values count as a cluster


# ---------------------------------------------------------------- small dense part

def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of U'RV, and V, by Householder reflections."""
    r = np.array(r, float)
    d = r.shape[1]
    v = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.abs(x).max(initial=0.0)
        if len(x) < 2 or not np.abs(x[1:]).max(initial=0.0):
            return None
        w = x / size
        w[0] += math.copysign(float(np.linalg.norm(w)), w[0])
        return w / np.linalg.norm(w)

    for k in range(d):
        w = reflector(r[k:, k])
        if w is not None:
            r[k:, k:] -= 2.0 * np.outer(w, w @ r[k:, k:])
        if k + 1 < d:
            w = reflector(r[k, k + 1:])
            if w is not None:
                r[k:, k + 1:] -= 2.0 * np.outer(r[k:, k + 1:] @ w, w)
                v[:, k + 1:] -= 2.0 * np.outer(v[:, k + 1:] @ w, w)
    return np.diag(r).copy(), np.diag(r, 1).copy(), v


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, largest first,
    by the differential quotient-difference transform with shifts."""
    values: list[float] = []
    q0 = [float(x) ** 2 for x in diagonal]
    e0 = [float(x) ** 2 for x in above]
    scale = max(q0 + e0, default=0.0)
    if scale == 0.0:
        return np.zeros(len(q0))
    waiting = [([x / scale for x in q0], [x / scale for x in e0], 0.0)]
    budget = 200 * len(q0) + 1000
    while waiting:
        q, e, shift = waiting.pop()
        lost = 0.0  # what rounding takes from the sum of the shifts
        least = None
        while q:
            if len(q) == 1:
                values.append(shift + (q[0] + lost))
                break
            if e[-1] <= EPS * EPS * (shift + q[-1]):
                values.append(shift + (q.pop() + lost))
                e.pop()
                least = None
                continue
            gap = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= EPS * EPS * (shift + min(q[k], q[k + 1]))), None)
            if gap is not None:
                waiting.append((q[:gap + 1], e[:gap], shift + lost))
                q, e, least = q[gap + 1:], e[gap + 1:], None
                continue
            if q[-1] > 1.5 * q[0]:
                q.reverse()
                e.reverse()
            # the last two rows bound the least value from above; what the last
            # transform left over bounds it as well
            a, b = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1]
            c2 = q[-2] * e[-1]
            small_root = (a * b - c2) / ((a + b) / 2 + math.sqrt(((a - b) / 2) ** 2 + c2)) if a + b else 0.0
            tau = max(0.0, small_root * (1 - 4 * EPS))
            if least is not None:
                tau = min(tau, least)
            while True:
                budget -= 1
                if budget < 0:
                    raise ArithmeticError("dqds did not converge")
                got = _transform(q, e, tau)
                if got is not None:
                    break
                # zero is safe; a quarter of what failed is mostly safe
                tau = tau / 4 if tau > EPS * EPS * max(q) else 0.0
            q, e, least = got
            lost += tau
            whole = shift + lost
            lost -= whole - shift
            shift = whole
    return np.sort(np.array(values))[::-1] * scale


def _transform(q: list[float], e: list[float], tau: float) -> tuple[list[float], list[float], float] | None:
    """One dqds step; None if the shift was above the least value.  The third
    result bounds the least value left."""
    d = least = q[0] - tau
    if d < 0.0:
        return None
    nq, ne = [], []
    for ek, up in zip(e, q[1:]):
        t = d + ek
        if t == 0.0:  # this row and the next come apart
            nq.append(0.0)
            ne.append(0.0)
            d = up - tau
        else:
            f = up / t
            nq.append(t)
            ne.append(ek * f)
            d = d * f - tau
        if d < 0.0 or d != d:
            return None
        least = min(least, d)
    nq.append(d)
    return nq, ne, least


class Twisted:
    """Twisted factorisation of B'B - value I, B upper bidiagonal."""

    def __init__(self, diagonal: np.ndarray, above: np.ndarray, value: float, least: float = EPS * EPS):
        d = diagonal * diagonal
        n, floor = len(d), least * float(np.max(d, initial=0.0)) or EPS
        low = above / diagonal[:-1]  # L of B'B = L D L'
        self.n = n
        self.down, self.lower = np.zeros(n), np.zeros(max(n - 1, 0))
        s = np.zeros(n)
        s[0] = -value
        for i in range(n - 1):
            p = s[i] + d[i]
            self.down[i] = p = p if abs(p) > floor else floor
            self.lower[i] = low[i] * d[i] / p
            s[i + 1] = self.lower[i] * low[i] * s[i] - value
        self.down[n - 1] = s[n - 1] + d[n - 1]
        self.up, self.upper = np.zeros(n), np.zeros(max(n - 1, 0))
        p = np.zeros(n)
        p[n - 1] = d[n - 1] - value
        for i in range(n - 2, -1, -1):
            t = d[i] * low[i] ** 2 + p[i + 1]
            self.up[i + 1] = t = t if abs(t) > floor else floor
            self.upper[i] = low[i] * d[i] / t
            p[i] = p[i + 1] * d[i] / t - value
        self.up[0] = p[0]
        pivots = s + p + value
        self.at = int(np.argmin(np.abs(pivots)))
        self.pivot = float(pivots[self.at])
        if abs(self.pivot) < floor:
            self.pivot = floor

    def vector(self) -> np.ndarray:
        z = np.zeros(self.n)
        z[self.at] = 1.0
        for i in range(self.at - 1, -1, -1):
            z[i] = -self.lower[i] * z[i + 1]
        for i in range(self.at, self.n - 1):
            z[i + 1] = -self.upper[i] * z[i]
        return z / np.linalg.norm(z)

    def solve(self, b: np.ndarray) -> np.ndarray:
        y, r = np.array(b, float), self.at
        for i in range(1, r):
            y[i] -= self.lower[i - 1] * y[i - 1]
        for i in range(self.n - 2, r, -1):
            y[i] -= self.upper[i] * y[i + 1]
        if r:
            y[r] -= self.lower[r - 1] * y[r - 1]
        if r + 1 < self.n:
            y[r] -= self.upper[r] * y[r + 1]
        x = np.zeros(self.n)
        x[r] = y[r] / self.pivot
        for i in range(r - 1, -1, -1):
            x[i] = y[i] / self.down[i] - self.lower[i] * x[i + 1]
        for i in range(r, self.n - 1):
            x[i + 1] = y[i + 1] / self.up[i + 1] - self.upper[i] * x[i]
        return x / np.linalg.norm(x)


def _gram(diagonal: np.ndarray, above: np.ndarray, z: np.ndarray) -> np.ndarray:
    """B'Bz for upper bidiagonal B."""
    y = diagonal * z
    y[:-1] += above * z[1:]
    out = diagonal * y
    out[1:] += above * y[:-1]
    return out


def right_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit vectors (as rows) of B'B for some of its values, largest first."""
    size = float(np.abs(np.concatenate([diagonal, above])).max(initial=0.0))
    diagonal = np.where(diagonal == 0.0, EPS * size, diagonal)  # within rounding of B
    out: list[np.ndarray] = []
    first = 0  # of the cluster
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLOSE * values[k - 1]:
            first = k
        together = first < k or (k + 1 < len(values) and value - values[k + 1] <= CLOSE * value)
        if not together:
            z = Twisted(diagonal, above, float(value)).vector()
        else:
            # no pivot below rounding, or one copy of a multiple value would drown the others
            twisted = Twisted(diagonal, above, float(value), EPS)
            z = twisted.solve(np.cos(np.arange(1, twisted.n + 1) * (k - first + 1.0)) + 0.5)
            best, error = z, math.inf
            for _ in range(20):
                for other in out[first:] * 2:
                    z = z - (other @ z) * other
                z = z / np.linalg.norm(z)
                off = float(np.linalg.norm(_gram(diagonal, above, z) - value * z))
                if off < error:
                    best, error = z, off
                if error <= 16 * EPS * size * size:
                    break
                z = twisted.solve(z)
            z = best
        out.append(z)
    return np.array(out).reshape(len(values), len(diagonal))


def principal(r: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Squared singular values of a factor, largest first, their unit
    directions as rows, and the sum of all squares.  One value more than asked
    is looked at, so that a cluster at the border is seen."""
    a, b, v = bidiagonalise(r)
    values = dqds(a, b)
    total = float(np.square(r).sum())
    floor = values[0] * (len(values) * EPS) ** 2 if len(values) else 0.0
    real = values[values > floor]
    z = right_vectors(a, b, real[:components + 1])[:components]
    return real[:components], z @ v.T, total


# ---------------------------------------------------------------- rows

def whole_vectors(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """Vectors without null or non-finite entries, as whole numbers."""
    v = F.col(vector).cast("array<double>")
    sound = v.isNotNull() & F.forall(v, lambda c: F.coalesce(F.abs(c) < F.lit(math.inf), F.lit(False)) & ~F.isnan(c))
    return df.filter(sound).select(F.col(id_col).alias("vec_id"), F.transform(
        v, lambda c: F.floor(c * 1024) + F.lit(100_000).cast("long")).alias("x"))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)


def exact_sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors of the commonest length and their sums by dimension."""
    def part(batches):
        sums: dict[int, list] = {}
        for batch in small(batches, 4096):
            x = batch.column("x")
            lengths = x.value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(lengths).tolist():
                rows = x.filter(pa.array(lengths == d))
                if not d:
                    continue
                m = _matrix(rows, d)
                # halves of 31 bits keep the sum of a batch within 64
                high, low = (m >> 31).sum(0).tolist(), (m & 0x7FFFFFFF).sum(0).tolist()
                held = sums.setdefault(d, [0, [0] * d])
                held[0] += len(m)
                held[1] = [s + (h << 31) + w for s, h, w in zip(held[1], high, low)]
        for d, (n, total) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()),
                 pa.array([str(s) for s in total], pa.string())], ["d", "dim", "n", "s"])

    parts = vectors.mapInArrow(part, "d int, dim int, n long, s string")
    sums = cut(parts.groupBy("d", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")),
               "whitening-sums")
    top = sums.filter("dim = 0").orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not top:
        return 0, []
    rows = sums.filter(F.col("d") == top[0]["d"]).orderBy("dim").collect()  # d rows
    return top[0]["n"], [int(r["s"]) for r in rows]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exactly (as Python numbers where 64 bits would not hold it)."""
    bound = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if bound < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def squares(y: np.ndarray) -> list[int]:
    """Sum of squares of every row, exactly."""
    if y.dtype == object or int(np.abs(y).max(initial=0)) ** 2 * max(y.shape[1], 1) >= 1 << 62:
        return [sum(v * v for v in row) for row in y.tolist()]
    return np.square(y).sum(1).tolist()


def fold(r: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    """The factor of rows under an earlier factor."""
    return np.linalg.qr(rows if r is None else np.vstack([r, rows]), mode="r")


FACTOR = "k int, r array<double>"


def _factor_batch(r: np.ndarray | None, d: int):
    if r is not None:
        square = np.zeros((d, d))
        square[:len(r)] = r
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([square.ravel()], pa.list_(pa.float64()))],
                                         ["k", "r"])


def factors(vectors: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """One triangular factor of the centred rows, as a table of one row."""
    d = len(sums)

    def reduce(batches):
        r = None
        for batch in small(batches, BLOCK):
            x = batch.column("x")
            x = x.filter(pa.array(x.value_lengths().to_numpy(zero_copy_only=False) == d))
            if len(x):
                r = fold(r, centred(_matrix(x, d), n, sums).astype(float) / n)
        yield from _factor_batch(r, d)

    def meet(batches):
        r = None
        for batch in batches:
            for one in batch.column("r"):
                r = fold(r, np.array(one.as_py()).reshape(d, d))
        yield from _factor_batch(r, d)

    held = cut(vectors.mapInArrow(reduce, FACTOR), "whitening-factors")
    count = held.count()
    while count > 1:
        count = -(-count // FAN_IN)
        held = held.repartition(count).mapInArrow(meet, FACTOR)
    return held


def directions(factor: DataFrame, d: int, components: int) -> list[tuple[int, float, float, list[float]]]:
    """Component number, squared singular value, sum of all squares and unit
    direction, found by one task from the one factor."""
    def solve(batches):
        for batch in batches:
            for one in batch.column("r"):
                values, rows, total = principal(np.array(one.as_py()).reshape(d, d), components)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(1, len(values) + 1), pa.int32()), pa.array(values, pa.float64()),
                     pa.array([total] * len(values), pa.float64()), pa.array(list(rows), pa.list_(pa.float64()))],
                    ["component", "value", "total", "direction"])

    got = factor.mapInArrow(solve, "component int, value double, total double, direction array<double>").collect()
    return sorted((r.component, r.value, r.total, r.direction) for r in got)  # at most components x d numbers


def whiten(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = 8) -> DataFrame:
    """A row for each vector that takes part and each component: vec_id,
    component, n, deviation, whitened, explained, identity_error."""
    vectors = whole_vectors(df, id_col, vector)
    n, sums = exact_sums(vectors)
    d = len(sums)
    found = directions(factors(vectors, n, sums), d, components) if n else []
    axes = np.array([x[3] for x in found]).reshape(len(found), d)
    spread = [x[1] / n for x in found]
    scaled = axes.T / np.sqrt(np.array(spread)) if found else np.zeros((d, 0))

    def project(batches):
        for batch in small(batches, BLOCK):
            x = batch.column("x")
            mine = pa.array(x.value_lengths().to_numpy(zero_copy_only=False) == d)
            y = centred(_matrix(x.filter(mine), d), n, sums) if d else np.zeros((0, 0))
            white = (y.astype(float) / n) @ scaled
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").filter(mine), pa.array([str(s) for s in squares(y)], pa.string()),
                 pa.array(list(white), pa.list_(pa.float64()))], ["vec_id", "deviation", "white"])

    fields = [vectors.schema["vec_id"], T.StructField("deviation", T.StringType()),
              T.StructField("white", T.ArrayType(T.DoubleType()))]
    rows = cut((vectors if found else vectors.limit(0)).mapInArrow(project, T.StructType(fields)), "whitening-rows")

    explained = F.array(*[F.lit(x[1] / x[2]) for x in found]) if found else F.array().cast("array<double>")
    return (rows.select("vec_id", F.col("deviation").cast("decimal(38,0)").cast("long").alias("deviation"),
                        F.posexplode("white").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"),
                    "deviation", "whitened", F.get(explained, F.col("at")).alias("explained"),
                    F.lit(identity_error(rows, len(found))).cast("double").alias("identity_error")))


def identity_error(rows: DataFrame, k: int) -> float | None:
    """Largest entry, by size, of the whitened rows' covariance less the identity."""
    def part(batches):
        n, s, c = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = batch.column("white").flatten().to_numpy(zero_copy_only=False).reshape(-1, k)
            n, s, c = n + len(w), s + w.sum(0), c + w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range(k * k), pa.int32()), pa.array([n] * (k * k), pa.int64()),
                                          pa.array(np.repeat(s, k)), pa.array(c.ravel())], ["cell", "n", "s", "c"])

    if not k:
        return None
    cells = (rows.select("white").mapInArrow(part, "cell int, n long, s double, c double")
             .groupBy("cell").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("c").alias("c"))
             .orderBy("cell").collect())  # components squared
    n = cells[0]["n"]
    mean = np.array([r["s"] for r in cells]).reshape(k, k)[:, 0] / n
    cov = np.array([r["c"] for r in cells]).reshape(k, k) / n - np.outer(mean, mean)
    return float(np.abs(cov - np.eye(k)).max())


def op13_query(embeddings: DataFrame) -> DataFrame:
    """The first eight whitened components of all embeddings."""
    return whiten(embeddings)
