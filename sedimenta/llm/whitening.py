"""Whitening of embeddings by singular values of their centred rows.

    entries     x = floor(256 * c) of every vector; rows without a usable vector go
    fit list    each distinct x once; its size n and sums S are exact
    QR          every task reduces its centred rows x - S / n, a block at a time, to one
                triangular factor; factors are stacked and reduced again, a few at a time
    directions  Householder reflections make the last factor bidiagonal, the differential
                qd algorithm with shifts finds its singular values, and twisted factorisations
                their directions

So the covariance is never formed, and small singular values keep their digits. What the driver
sees is one d by d factor, d the number of entries of a vector (at most MAX_DIMENSION).

Defined results: a vector of null, without entries, or with a null or non-finite entry takes no
part, and neither does one of another length than most (of equally frequent lengths the longer
one counts). Entries beyond the range of a long are cut to it. Components without variance
have no direction and are left out, so fewer than asked may come back, and none for an empty
table or a single distinct vector. Repeated rows give repeated results. A deviation
beyond a long is null. Columns that are not named in the result do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import ship_package, stored

MAX_DIMENSION = 1024
#: Rows reduced at a time within a task.
BLOCK_ROWS = 4096
#: Triangular factors stacked at a time.
FAN_IN = 16
EPS = np.finfo(float).eps


# ---- entries ------------------------------------------------------------------


def with_entries(df: DataFrame, vector: str = "embedding", into: str = "x") -> DataFrame:
    """Rows with a usable vector, and its entries as integers."""
    entry = lambda c: c.cast("double")
    bad = lambda c: c.isNull() | F.isnan(entry(c)) | (F.abs(entry(c)) == float("inf"))
    whole = F.size(F.filter(vector, bad)) == 0
    usable = df.where(F.col(vector).isNotNull() & whole & (F.size(vector) > 0))
    return usable.withColumn(
        into, F.transform(vector, lambda c: F.floor(256 * entry(c)).cast("long"))
    )


def of_one_length(df: DataFrame, into: str = "x") -> DataFrame:
    """The rows whose vectors have the most frequent length."""
    lengths = df.groupBy(F.size(into).alias("d")).agg(F.count(F.lit(1)).alias("n_rows"))
    first = lengths.orderBy(F.desc("n_rows"), F.desc("d")).first()
    if first is None:
        return df
    if first["d"] > MAX_DIMENSION:
        raise ValueError(f"vectors of {first['d']} entries, more than {MAX_DIMENSION}")
    return df.where(F.size(into) == first["d"])


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of lists of one length as rows."""
    flat = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


@dataclass(frozen=True)
class Sums:
    """Size and exact sums of the fit list."""

    n: int
    sums: tuple[int, ...]
    largest: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([float(Fraction(s, self.n)) for s in self.sums])


def sums_of(distinct: DataFrame) -> Sums:
    """Summed in halves of 32 bits within a task, as decimals across tasks."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low, largest = 0, 0, 0, 0
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(0))
                n += len(x)
                high, low = high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
                largest = max(largest, abs(int(x.min())), abs(int(x.max())))
        if n:
            d = len(high)
            rows = {"i": np.arange(d), "n": [n] * d, "high": high, "low": low}
            bound = [min(largest, 2**63 - 1)] * d
            yield pa.RecordBatch.from_pydict(
                rows | {"largest": bound},
                pa.schema([(c, pa.int64()) for c in ("i", "n", "high", "low", "largest")]),
            )

    ddl = "i bigint, n bigint, high bigint, low bigint, largest bigint"
    exact = {c: F.sum(F.col(c).cast("decimal(28,0)")).alias(c) for c in ("high", "low")}
    rows = (
        distinct.mapInArrow(partial, ddl)
        .groupBy("i")
        .agg(F.sum("n").alias("n"), *exact.values(), F.max("largest").alias("largest"))
        .orderBy("i")
        .collect()  # one row for each entry of a vector
    )
    sums = tuple((int(r["high"]) << 32) + int(r["low"]) for r in rows)
    return Sums(rows[0]["n"] if rows else 0, sums, max((r["largest"] for r in rows), default=0))


# ---- blockwise QR -------------------------------------------------------------


def _reduced(stack: np.ndarray) -> np.ndarray:
    """The triangular factor of some rows, padded to a square."""
    d = stack.shape[1]
    r = np.linalg.qr(stack, mode="r")
    return r if len(r) == d else np.vstack([r, np.zeros((d - len(r), d))])


def triangular_factor(distinct: DataFrame, sums: Sums) -> np.ndarray:
    """R of the centred rows, with R'R = sum of (x - S/n)(x - S/n)'."""
    mean, d = sums.mean, len(sums.sums)
    ddl = "task int, factor array<double>"

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        factor = np.zeros((0, d))
        for batch in batches:
            x = matrix(batch.column(0)) if batch.num_rows else np.zeros((0, d))
            for start in range(0, len(x), BLOCK_ROWS):
                centred = x[start : start + BLOCK_ROWS].astype(float) - mean
                factor = _reduced(np.vstack([factor, centred]))
        if len(factor):
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_pydict(
                {"task": pa.array([task], pa.int32()), "factor": [factor.ravel()]}
            )

    def reduce_factors(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values("task")
        stack = np.vstack([np.asarray(f, float).reshape(-1, d) for f in ordered["factor"]])
        first = int(ordered["task"].iloc[0]) // FAN_IN
        return pd.DataFrame({"task": [first], "factor": [_reduced(stack).ravel()]})

    factors = stored(distinct.mapInArrow(reduce_rows, ddl), "factors")
    highest = factors.agg(F.max("task")).first()[0]
    if highest is None:
        return np.zeros((d, d))
    while highest > 0:
        # FAN_IN factors at most in a group, however many tasks there were
        shared = F.floor(F.col("task") / FAN_IN)
        factors = stored(factors.groupBy(shared).applyInPandas(reduce_factors, ddl), "factors")
        highest //= FAN_IN
    return np.array(factors.first()["factor"]).reshape(d, d)  # the last one, d by d


# ---- bidiagonal form ----------------------------------------------------------


def _reflector(v: np.ndarray) -> tuple[np.ndarray, float, float]:
    """u, beta, alpha with (I - beta uu')v = alpha e1."""
    u = v.copy()
    scale = np.abs(u).max(initial=0.0)
    if scale == 0 or not np.abs(u[1:]).max(initial=0.0):
        return u, 0.0, v[0]
    u = u / scale
    length = np.linalg.norm(u)
    alpha = -np.copysign(length, u[0])
    u[0] -= alpha
    return u, 2.0 / (u @ u), alpha * scale


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a, superdiagonal b and orthogonal V with R = U B V'."""
    m = r.astype(float).copy()
    d = len(m)
    v = np.eye(d)
    for k in range(d):
        u, beta, alpha = _reflector(m[k:, k])
        if beta:
            m[k:, k:] -= beta * np.outer(u, u @ m[k:, k:])
            m[k, k], m[k + 1 :, k] = alpha, 0.0
        if k < d - 2:
            u, beta, alpha = _reflector(m[k, k + 1 :])
            if beta:
                m[k:, k + 1 :] -= beta * np.outer(m[k:, k + 1 :] @ u, u)
                m[k, k + 1], m[k, k + 2 :] = alpha, 0.0
                v[:, k + 1 :] -= beta * np.outer(v[:, k + 1 :] @ u, u)
    return np.diag(m).copy(), np.diag(m, 1).copy(), v


# ---- singular values: dqds ----------------------------------------------------


def _qd_step(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float]:
    """One differential step: new q and e, whose eigenvalues are less by the shift, and the
    least d on the way. A negative d means that the shift was above the least eigenvalue."""
    q, e = q.tolist(), e.tolist()
    new_q, new_e = [], []
    d = least = q[0] - shift
    for k in range(len(e)):
        if d < 0:
            break
        top = d + e[k]
        ratio = q[k + 1] / top if top > 0 else 0.0
        new_q.append(top)
        new_e.append(e[k] * ratio)
        d = d * ratio - shift if top > 0 else q[k + 1] - shift
        least = min(least, d)
    new_q.append(d)
    return np.array(new_q), np.array(new_e), least


def _shifts(q: np.ndarray, e: np.ndarray, least: float) -> list[float]:
    """Shifts to try, the boldest first: close below the least eigenvalue of the last two
    rows, a part of the least d, and Gerschgorin's bound, which is never too large."""
    t, corner, off = q[-2] + e[-1], q[-1], q[-1] * e[-1]
    middle, half = (t + corner) / 2, (t - corner) / 2
    root = np.hypot(half, np.sqrt(off))
    pair = (t * corner - off) / (middle + root) if middle + root > 0 else 0.0
    across = np.sqrt(q[1:] * e)
    edge = q + np.append(e, 0.0) - np.append(across, 0.0) - np.append(0.0, across)
    return [pair - off / (middle + root) if middle + root > 0 else 0.0, 0.75 * least, edge.min()]


def singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Singular values of the bidiagonal matrix, falling, each to a few units in the last
    place."""
    scale = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if scale == 0:
        return np.zeros(len(a))
    found: list[float] = []
    waiting = [((a / scale) ** 2, (b / scale) ** 2, 0.0)]
    steps = 0
    while waiting:
        q, e, moved = waiting.pop()
        if len(q) == 1:
            found.append(moved + max(q[0], 0.0))
            continue
        small = e <= EPS**2 * (np.minimum(q[:-1], q[1:]) + moved)
        if small.any():  # the matrix falls apart there
            cut = int(np.flatnonzero(small)[-1]) + 1
            waiting += [(q[:cut], e[: cut - 1], moved), (q[cut:], e[cut:], moved)]
            continue
        if 4 * q[0] < q[-1]:  # the same squares; the small end goes last
            q, e = q[::-1], e[::-1]
        q, e, least = _qd_step(q, e, 0.0)
        for shift in _shifts(q, e, least):
            if shift > EPS * moved:
                next_q, next_e, d = _qd_step(q, e, shift)
                if d >= 0:
                    q, e, moved = next_q, next_e, moved + shift
                    break
        waiting.append((q, e, moved))
        steps += 1
        if steps > 100 * len(a) + 1000:
            raise ArithmeticError("the qd steps do not converge")
    return scale * np.sqrt(np.sort(found)[::-1])


# ---- directions: twisted factorisations ---------------------------------------


def twisted_vector(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """A unit vector z with B'Bz = value z nearly, for a bidiagonal block without zeros in b.

    B'B = LDL' with D = a^2 and L = b/a. The stationary transform gives the pivots of
    LDL' - value downwards, the progressive one upwards; they meet at the row whose twisted
    pivot gamma is least, and z follows from there in both directions by products alone.
    """
    n = len(a)
    tiny = EPS * max(np.abs(a).max(), np.abs(b).max(initial=0.0))
    a = np.where(np.abs(a) < tiny, tiny, a)
    square, off = a * a, a[:-1] * b
    lower = b / a[:-1]

    def pivot(x: float) -> float:
        return x if abs(x) > tiny * tiny else tiny * tiny

    down, up = np.empty(n), np.empty(n)
    s, p = np.full(n, -value), np.full(n, square[-1] - value)
    for k in range(n - 1):
        down[k] = pivot(square[k] + s[k])
        s[k + 1] = s[k] * lower[k] * (off[k] / down[k]) - value
    for k in range(n - 2, -1, -1):
        up[k + 1] = pivot(off[k] * lower[k] + p[k + 1])
        p[k] = p[k + 1] * (square[k] / up[k + 1]) - value
    twist = int(np.abs(s + p + value).argmin())
    z = np.zeros(n)
    z[twist] = 1.0
    for k in range(twist - 1, -1, -1):
        z[k] = -(off[k] / down[k]) * z[k + 1]
    for k in range(twist, n - 1):
        z[k + 1] = -(off[k] / up[k + 1]) * z[k]
    return z / np.linalg.norm(z)


def _apart(z: np.ndarray, found: np.ndarray, square: np.ndarray, value: float) -> np.ndarray:
    """z without what it shares with the directions found. Directions of values that agree to
    working precision come out alike; inverse iteration from a start without those then
    gives another one of the same space."""
    rest = z - found @ (found.T @ z)
    if np.linalg.norm(rest) < 0.5:
        shifted = square - value * (1 + 64 * EPS) * np.eye(len(z))
        rest = np.cos(np.arange(len(z)) ** 2)  # any start will do
        for _ in range(3):
            rest -= found @ (found.T @ rest)
            rest = np.linalg.solve(shifted, rest / np.linalg.norm(rest))
            rest -= found @ (found.T @ rest)
    rest = rest / np.linalg.norm(rest)
    rest -= found @ (found.T @ rest)
    return rest / np.linalg.norm(rest)


def directions(r: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest singular values of R above rounding, and their right directions as columns."""
    a, b, v = bidiagonalise(r)
    d, scale = len(a), max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    cuts = (np.flatnonzero(np.abs(b) <= EPS * scale) + 1).tolist()
    blocks = list(zip([0, *cuts], [*cuts, d]))
    values = [
        (s, start, end)
        for start, end in blocks
        for s in singular_values(a[start:end], b[start : end - 1])
    ]
    values.sort(key=lambda found: -found[0])
    values = [found for found in values[:wanted] if found[0] > 16 * d * EPS * scale]
    square = np.diag(a**2 + np.append(0.0, b**2)) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    z = np.zeros((d, 0))
    for s, start, end in values:
        whole = np.zeros(d)
        whole[start:end] = twisted_vector(a[start:end], b[start : end - 1], s * s)
        z = np.column_stack([z, _apart(whole, z, square, s * s)])
    return np.array([s for s, _, _ in values]), v @ z


# ---- whitening ----------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    sums: Sums
    eigenvalues: tuple[float, ...]
    trace: float
    components: np.ndarray  # unit columns
    identity_error: float | None


def fit(rows: DataFrame, wanted: int = 4, into: str = "x") -> Whitening:
    """The whitening of the distinct vectors of rows with entries of one length."""
    distinct = stored(rows.select(into).distinct(), "fit-list")
    ship_package(rows.sparkSession)
    sums = sums_of(distinct)
    if not sums.n:
        return Whitening(sums, (), 0.0, np.zeros((0, 0)), None)
    r = triangular_factor(distinct, sums)
    values, components = directions(r, wanted)
    found = Whitening(
        sums, tuple(values**2 / sums.n), float((r * r).sum() / sums.n), components, None
    )
    return replace(found, identity_error=_identity_error(distinct, found, into))


def _identity_error(distinct: DataFrame, found: Whitening, x: str) -> float | None:
    """The largest entry of the covariance of the whitened fit list, less the identity."""
    k = len(found.eigenvalues)
    if not k:
        return None
    white = distinct.select(whitened(found, x).alias("w"))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = white.agg(
        *[F.covar_pop(F.col("w")[i], F.col("w")[j]).alias(f"c{i}_{j}") for i, j in pairs]
    ).first()
    return max(abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whitened(found: Whitening, x: str = "x") -> Column:
    """(x - S/n) on every component, over the root of its eigenvalue: an array."""
    mean = found.sums.mean
    scaled = found.components / np.sqrt(found.eigenvalues)

    @F.arrow_udf("array<double>")
    def project(column: pa.Array) -> pa.Array:
        if not len(column):
            return pa.array([], pa.list_(pa.float64()))
        out = (matrix(column) - mean) @ scaled
        offsets = np.arange(0, out.size + 1, out.shape[1], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel()))

    return project(F.col(x))


def deviation(found: Whitening, x: str = "x") -> Column:
    """Sum over the entries of (n x - S)^2, exact; in longs where no sum can leave them."""
    n, sums = found.sums.n, found.sums.sums
    reach = n * found.sums.largest + max(map(abs, sums))
    kind = "bigint" if len(sums) * reach**2 < 2**63 else "decimal(38,0)"
    # the literal of a long list is one string
    totals = F.from_json(F.lit(str(list(map(str, sums))).replace("'", '"')), "array<string>")
    totals = F.transform(totals, lambda s: s.cast(kind))
    size = F.lit(n).cast(kind)
    if kind == "bigint":
        square = lambda c, s: (size * c - s) * (size * c - s)
        return F.aggregate(F.zip_with(x, totals, square), F.lit(0).cast(kind), lambda a, b: a + b)
    apart = lambda c, s: F.try_subtract(F.try_multiply(size, c.cast(kind)).cast(kind), s)
    square = lambda v: F.try_multiply(v, v)
    parts = F.transform(
        F.zip_with(x, totals, lambda c, s: apart(c, s).try_cast(kind)),
        lambda v: square(v).try_cast(kind),
    )
    start = F.lit(0).cast(kind)
    whole = F.aggregate(parts, start, lambda a, b: F.try_add(a, b).try_cast(kind))
    return whole.try_cast("bigint")


def whiten(df: DataFrame, vector: str = "embedding", wanted: int = 4) -> DataFrame:
    """The rows with a usable vector, each with its x, deviation and whitened array, and the
    figures of the fit: n, explained (an array) and identity_error."""
    rows = of_one_length(with_entries(df, vector))
    found = fit(rows, wanted)
    explained = [e / found.trace for e in found.eigenvalues]
    if not explained:
        return rows.limit(0).withColumns(
            {
                "n": F.lit(found.sums.n).cast("bigint"),
                "deviation": F.lit(0).cast("bigint"),
                "whitened": F.array().cast("array<double>"),
                "explained": F.array().cast("array<double>"),
                "identity_error": F.lit(0.0),
            }
        )
    return rows.withColumns(
        {
            "n": F.lit(found.sums.n).cast("bigint"),
            "deviation": deviation(found),
            "whitened": whitened(found),
            "explained": F.array(*map(F.lit, explained)),
            "identity_error": F.lit(float(found.identity_error)),
        }
    )
