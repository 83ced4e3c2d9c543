"""Embedding whitening: directions of unit variance without correlation.

Components of a vector become whole numbers, floor(256 * c), so that sums and deviations are exact. The fit list holds each distinct
row of them once. Its rows, centred, are reduced by blockwise QR: a task folds its rows into one triangle, triangles are merged
``FAN`` at a time in shuffles until one is left, and that one, a square of the dimension, goes to the driver. There Householder
reflections make it bidiagonal, dqds finds the squares of its singular values, and twisted factorisations give the leading
directions. No product of the rows with themselves is formed, so small variances keep their digits.

Rows whose vector is null or holds null or non-finite entries give no rows, as do empty vectors. All vectors are taken in one space:
of several lengths the one with the most distinct vectors counts (of equal ones the shorter), others give no rows. Rows without
vec_id are rows like any other. Repeated rows give repeated results and count once in the fit. A direction without variance (equal vectors, fewer
vectors than dimensions, constant components) has whitened NULL, and explained NULL if nothing varies at all. Entries beyond 2**55 in size are
taken as 2**55. Equal variances leave their directions free; any of them is returned, the same for all rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import staged

SCALE = 256
COMPONENTS = 4
BLOCK = 4096  # rows folded into a triangle at a time
FAN = 16      # triangles merged by one task
LARGEST = 2**63 - 1
EPS = np.finfo(np.float64).eps

RESULT = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")


# ---------------------------------------------------------------- the solver, on one d x d triangle

def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, v): r = u b v' with orthogonal u and v, by Householder reflections from both sides."""
    a, d = np.array(r, np.float64), len(r)
    v = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.linalg.norm(x)
        if size == 0 or not np.any(x[1:]):
            return None
        x = x / size
        x[0] += math.copysign(1.0, x[0])
        return x / np.linalg.norm(x)

    for k in range(d):
        h = reflector(a[k:, k].copy())
        if h is not None:
            a[k:, k:] -= 2 * np.outer(h, h @ a[k:, k:])
        if k < d - 2:
            h = reflector(a[k, k + 1:].copy())
            if h is not None:
                a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ h, h)
                v[:, k + 1:] -= 2 * np.outer(v[:, k + 1:] @ h, h)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), v


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """The squared singular values of a bidiagonal, falling: differential quotient-difference sweeps with shifts.

    A sweep with a shift beyond the least value is seen by a negative pivot and done again with a smaller one, at last with none,
    which always converges.
    """
    scale = max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0))
    if scale == 0:
        return np.zeros(len(diagonal))
    found: list[float] = []
    tiny = EPS * EPS
    work = [([float(x) ** 2 for x in diagonal / scale], [float(x) ** 2 for x in above / scale], 0.0)]
    while work:
        q, e, moved = work.pop()
        stale = 0
        while q:
            n = len(q)
            cut = next((i for i in range(n - 2, -1, -1) if e[i] <= tiny * (moved + min(q[i], q[i + 1])) or e[i] < 1e-300), None)
            if n == 1 or cut == n - 2:
                found.append(moved + q.pop())
                e = e[:len(q) - 1] if q else []
                stale = 0
                continue
            if cut is not None:
                work.append((q[:cut + 1], e[:cut], moved))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if n == 2:  # the 2 x 2 matrix itself
                t = q[0] + q[1] + e[0]
                big = (t + math.sqrt(max(0.0, (q[0] - q[1] - e[0]) ** 2 + 4 * q[0] * e[0]))) / 2
                found += [moved + big, moved + q[0] * (q[1] / big)]
                break
            if q[0] * 4 < q[-1] and stale % 8 == 0:
                q, e = q[::-1], e[::-1]
            # the smaller value of the last two rows bounds the least value from above
            t, last = q[-2] + e[-2] + q[-1] + e[-1], q[-1] * (q[-2] + e[-2])
            least = 2 * last / (t + math.sqrt(max(0.0, t * t - 4 * last))) if t else 0.0
            shift = 0.0 if stale > 60 else least * (1 - 1e-3 * min(stale, 100) / 10)
            while True:
                d, nq, ne = q[0] - shift, [], []
                for i in range(n - 1):
                    top = d + e[i]
                    if not (d >= 0 and top > 0):
                        break
                    ratio = q[i + 1] / top
                    nq.append(top)
                    ne.append(e[i] * ratio)
                    d = d * ratio - shift
                if len(nq) == n - 1 and d >= 0:
                    q, e, moved = [*nq, d], ne, moved + shift
                    break
                if shift == 0:  # a pivot of zero: the value is zero up to rounding
                    q = [max(x, 1e-290) for x in q]
                shift = shift / 4 if shift > 1e-30 else 0.0
            stale += 1
            if stale > 20_000:
                raise ArithmeticError("the singular values did not converge")
    return np.sort(np.array(found))[::-1] * scale * scale


def _factors(a: np.ndarray, b: np.ndarray, value: float) -> tuple[np.ndarray, ...]:
    """The stationary and the progressive factorisation of B'B - value, and what a twist at each place leaves."""
    n = len(a)
    q, e, off = a * a, b * b, a[:-1] * b
    small = max(EPS * EPS * value, 1e-150)
    down, up, s, p = np.empty(n), np.empty(n), np.empty(n), np.empty(n)
    lower, upper = np.empty(max(n - 1, 0)), np.empty(max(n - 1, 0))
    fix = lambda x: x if abs(x) > small else -small
    s[0] = -value
    for i in range(n - 1):
        down[i] = fix(s[i] + q[i])
        lower[i] = off[i] / down[i]
        s[i + 1] = e[i] * (s[i] / down[i]) - value
    down[n - 1] = fix(s[n - 1] + q[n - 1])
    p[n - 1] = q[n - 1] - value
    for i in range(n - 2, -1, -1):
        up[i + 1] = fix(e[i] + p[i + 1])
        upper[i] = off[i] / up[i + 1]
        p[i] = p[i + 1] * (q[i] / up[i + 1]) - value
    return down, lower, upper, s + p + value


def twisted(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """The unit vector of a value from the twisted factorisation whose middle pivot is least."""
    _, lower, upper, left = _factors(a, b, value)
    r = int(np.abs(left).argmin())
    z = np.zeros(len(a))
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -lower[i] * z[i + 1]
    for i in range(r, len(a) - 1):
        z[i + 1] = -upper[i] * z[i]
    return z / np.linalg.norm(z)


def _solved(a: np.ndarray, b: np.ndarray, value: float, z: np.ndarray) -> np.ndarray:
    """A step of inverse iteration with the stationary factors."""
    down, lower, _, _ = _factors(a, b, value)
    y = z.copy()
    for i in range(len(a) - 1):
        y[i + 1] -= lower[i] * y[i]
    y = y / down
    for i in range(len(a) - 2, -1, -1):
        y[i] -= lower[i] * y[i + 1]
    return y / np.linalg.norm(y)


def leading(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest ``count`` squared singular values of a square matrix and their right directions, as rows."""
    diagonal, above, v = bidiagonal(r)
    scale = max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0))
    values = dqds(diagonal, above)[:count]
    if scale == 0:
        return values, np.eye(len(diagonal))[:count]
    a, b, near = diagonal / scale, above / scale, values / scale ** 2
    rng, z = np.random.default_rng(7), []
    for k, value in enumerate(near):
        close = [z[j] for j in range(k) if near[j] - value <= 1e-3 * near[0]]
        y = twisted(a, b, value)
        for _ in range(6 if close else 0):  # directions of close values are kept apart
            for x in close:
                y = y - (x @ y) * x
            if np.linalg.norm(y) < 0.1:
                y = rng.normal(size=len(a))
                continue
            y = _solved(a, b, value, y / np.linalg.norm(y))
        for x in [*close, *close]:
            y = y - (x @ y) * x
        z.append(y / np.linalg.norm(y))
    directions = np.array(z) @ v.T
    directions /= np.linalg.norm(directions, axis=1, keepdims=True)
    sign = np.sign(directions[np.arange(len(z)), np.abs(directions).argmax(1)])
    return values, directions * sign[:, None]


# ---------------------------------------------------------------- passes over the rows

def _matrix(column: pa.Array, d: int) -> np.ndarray:
    flat = column.flatten() if not isinstance(column, pa.ChunkedArray) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, d)


def _wide(x: np.ndarray, times: int) -> np.ndarray:
    """The numbers themselves where products with ``times`` stay within 64 bits, else Python's."""
    most = int(np.abs(x).max(initial=0))
    return x if (most + 1) * times < LARGEST // 4 else x.astype(object)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n with one rounding: the numerator n * x - sums is exact."""
    most = max(abs(int(s)) for s in sums)
    wide = _wide(x, n)
    if wide.dtype == object or most > LARGEST // 4:
        return (wide.astype(object) * n - sums.astype(object)).astype(np.float64) / n
    return (wide * n - sums.astype(np.int64)).astype(np.float64) / n


def _sums(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[pa.RecordBatch]:
    total, n = np.zeros(d, object), 0
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch.column("x"), d)
            total, n = total + _wide(x, len(x)).sum(0).astype(object), n + len(x)
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(d), pa.int32()), pa.array([int(t) for t in total], pa.decimal128(38, 0)), pa.array([n] * d, pa.int64())],
            ["i", "s", "n"])


def _folded(r: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows if r is None else np.vstack([r, rows]), mode="r")


def _triangles(batches: Iterator[pa.RecordBatch], d: int, n: int, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
    r = None
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            x = _matrix(batch.slice(at, BLOCK).column("x"), d)
            r = _folded(r, _centred(x, n, sums))
    if r is not None:
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()),
                                          pa.array([r.ravel()], pa.list_(pa.float64()))], ["part", "r"])


def _merged(rows: pd.DataFrame, d: int) -> pd.DataFrame:
    r = None
    for one in rows.sort_values("part")["r"]:
        r = _folded(r, np.asarray(one).reshape(-1, d))
    return pd.DataFrame({"part": [int(rows["part"].min()) // FAN], "r": [r.ravel()]})


def _products(batches: Iterator[pa.RecordBatch], d: int, n: int, sums: np.ndarray, project: np.ndarray) -> Iterator[pa.RecordBatch]:
    k = project.shape[1]
    first, second = np.zeros(k), np.zeros((k, k))
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            w = _centred(_matrix(batch.slice(at, BLOCK).column("x"), d), n, sums) @ project
            first, second = first + w.sum(0), second + w.T @ w
    row = np.concatenate([first, second.ravel()])
    yield pa.RecordBatch.from_arrays([pa.array(range(len(row)), pa.int32()), pa.array(row)], ["i", "s"])


def _rows(batches: Iterator[pa.RecordBatch], d: int, n: int, sums: np.ndarray, project: np.ndarray, explained: list,
          identity_error: float | None) -> Iterator[pa.RecordBatch]:
    k = len(explained)
    known = project.shape[1]
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            some = batch.slice(at, BLOCK)
            x = _matrix(some.column("x"), d)
            white = np.zeros((len(x), k))
            white[:, :known] = _centred(x, n, sums) @ project
            most = max(n * int(np.abs(x).max(initial=0)), *(abs(int(s)) for s in sums)) * 2
            kind = np.int64 if d * most * most < LARGEST else object
            off = x.astype(kind) * n - sums.astype(kind)
            deviation = [int(v) for v in (off * off).sum(1)]
            again = pa.array(np.repeat(np.arange(len(x)), k))
            blank = np.tile(np.arange(k) >= known, len(x))
            yield pa.RecordBatch.from_arrays([
                some.column("vec_id").take(again), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                pa.array(np.full(len(x) * k, n), pa.int64()), pa.array(deviation, pa.decimal128(38, 0)).take(again),
                pa.array(white.ravel(), pa.float64(), mask=blank), pa.array(explained * len(x), pa.float64()),
                pa.array([identity_error] * (len(x) * k), pa.float64())],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of each vector and leading component."""
    spark = vectors.sparkSession
    fine = F.expr("embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))")
    edge = F.lit(float(2**55))
    whole = F.transform("embedding", lambda c: F.floor(F.greatest(-edge, F.least(edge, c.cast("double") * SCALE))).cast("long"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("x"), fine.alias("fine")).where("fine")
    fit = staged(rows.where(F.size("x") > 0).select("x").distinct(), "white-fit")
    found = fit.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if found is None:
        return spark.createDataFrame([], RESULT)
    d, n = found["d"], found["n"]
    fit, rows = (t.where(F.size("x") == d) for t in (fit, rows))
    # one row for each dimension
    sums = np.array([int(r["s"]) for r in fit.mapInArrow(lambda b: _sums(b, d), "i int, s decimal(38,0), n long")
                     .groupBy("i").agg(F.sum("s").alias("s")).orderBy("i").collect()], dtype=object)
    parts = staged(fit.mapInArrow(lambda b: _triangles(b, d, n, sums), "part int, r array<double>"), "white-triangles")
    left = parts.agg(F.max("part")).first()[0] + 1
    while left > 1:
        parts = parts.groupBy(F.floor(F.col("part") / FAN).alias("group")).applyInPandas(
            lambda some: _merged(some, d), "part int, r array<double>")
        left = -(-left // FAN)
    r = np.array(parts.first()["r"]).reshape(-1, d)
    r = np.vstack([r, np.zeros((max(0, d - len(r)), d))])
    r = np.linalg.qr(r, mode="r") if len(r) > d else r
    squares, directions = leading(r, min(components, d))
    total = float((r * r).sum())
    # what is lost in rounding is no variance
    known = [k for k, s in enumerate(squares) if s > (d * EPS) ** 2 * squares[0] * 16 and s > 0]
    project = (directions[known] / np.sqrt(squares[known, None] / n)).T if known else np.zeros((d, 0))
    explained = [float(s) / total if total else None for s in squares]
    error = None
    if known:
        product = np.array([v["s"] for v in fit.mapInArrow(lambda b: _products(b, d, n, sums, project), "i int, s double")
                            .groupBy("i").agg(F.sum("s").alias("s")).orderBy("i").collect()])
        k = len(known)
        mean = product[:k] / n
        error = float(np.abs(product[k:].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max())
    return rows.select("vec_id", "x").mapInArrow(lambda b: _rows(b, d, n, sums, project, explained, error), RESULT)
