"""Embedding whitening by a bidiagonal qd solver.

1. Distinct integer vectors are the fit list; their number and per-dimension sums are exact.
2. Blockwise QR: every task reduces its centred rows to one triangular factor, block by block; factors are
   stacked and reduced again in groups of `FAN` until one is left, so no task reads more than `FAN` factors.
3. The driver works on that one factor, as large as one covariance: Householder reflections make it
   bidiagonal, dqds finds its singular values to high relative accuracy, and twisted factorisations of the
   shifted tridiagonal give their directions. Nothing is squared before the singular values are known.
4. One more pass measures the covariance of the whitened fit list, and a map whitens every row.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import checkpointed

FACTOR, COMPONENTS = 256, 4
#: Dimensions up to which the driver's factor and the tasks' blocks stay small (8 * d * d bytes each).
MOST_DIMENSIONS = 4096
BLOCK_VALUES, FAN = 1 << 20, 64
EPS = float(np.finfo(float).eps)
TINY = float(np.finfo(float).tiny)


def scaled(values: list[float | None] | None) -> bytes | None:
    """floor(FACTOR * x) as big-endian longs without trailing zeros; None if the vector takes no part."""
    if values is None or None in values:
        return None
    x = np.asarray(values, np.float64)
    if not np.isfinite(x).all():
        return None
    whole = np.floor(FACTOR * x)
    whole = np.clip(whole, -(2.0**61), 2.0**61)
    used = np.flatnonzero(whole)
    return whole[: used[-1] + 1 if len(used) else 0].astype(">i8").tobytes()


def matrix(packed: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(packed), width), np.int64)
    for i, value in enumerate(packed):
        row = np.frombuffer(value, ">i8")
        out[i, : len(row)] = row
    return out


def numerators(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S: longs where they fit, else Python integers."""
    most = max((abs(int(v)) for v in (x.min(initial=0), x.max(initial=0))), default=0)
    if n * most + max(map(abs, sums), default=0) < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S / n, rounded once: the subtraction is done in whole numbers."""
    return numerators(x, n, sums).astype(np.float64) / n


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Exact sums over dimensions of (n * x - S)^2."""
    d = numerators(x, n, sums)
    most = max((abs(int(v)) for v in d.ravel()[[d.argmin(), d.argmax()]]), default=0) if d.size else 0
    if d.dtype != object and most * most * max(1, d.shape[1]) < 1 << 63:
        return np.einsum("ij,ij->i", d, d).tolist()
    wide = d.astype(object)
    return [int(v) for v in (wide * wide).sum(axis=1)] if d.shape[1] else [0] * len(d)


def stacked(factor: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The triangular factor of a factor and further rows; it has as many rows as columns at most."""
    return np.linalg.qr(np.vstack([factor, rows]), mode="r")


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) of U' R V by Householder reflections; U is not needed."""
    a = np.array(r, np.float64)
    d = a.shape[1]
    if a.shape[0] < d:
        a = np.vstack([a, np.zeros((d - a.shape[0], d))])
    v = np.eye(d)
    for k in range(d):
        w = _reflector(a[k:, k])
        if w is not None:
            a[k:, k:] -= np.outer(2 * w, w @ a[k:, k:])
        if k < d - 2:
            w = _reflector(a[k, k + 1 :])
            if w is not None:
                a[k:, k + 1 :] -= np.outer(a[k:, k + 1 :] @ w, 2 * w)
                v[:, k + 1 :] -= np.outer(v[:, k + 1 :] @ w, 2 * w)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _reflector(x: np.ndarray) -> np.ndarray | None:
    """Unit vector w for which x - 2 w (w'x) has only a first element; None if it has already."""
    scale = np.abs(x).max(initial=0)
    if scale == 0 or not np.abs(x[1:]).max(initial=0):
        return None
    w = x / scale
    w[0] += np.copysign(np.linalg.norm(w), w[0])
    return w / np.linalg.norm(w)


def _sweep(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float]:
    """One dqds transform of (q, e) with a shift: new q and e, and the least pivot (negative: the shift was too large)."""
    n = len(q)
    new_q, new_e = [0.0] * n, [0.0] * (n - 1)
    q, e = q.tolist(), e.tolist()
    d = q[0] - shift
    least = d
    for i in range(n - 1):
        t = d + e[i]
        if t <= 0:
            if t < 0 or shift > 0:
                return np.array(new_q), np.array(new_e), -1.0
            new_q[i], new_e[i], d = 0.0, 0.0, q[i + 1]
        else:
            new_q[i] = t
            ratio = q[i + 1] / t
            new_e[i] = e[i] * ratio
            d = d * ratio - shift
        least = min(least, d)
    new_q[n - 1] = d
    return np.array(new_q), np.array(new_e), least


def dqds(diagonal: np.ndarray, beside: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, falling; differential qd with shifts.

    The last value of a block is found by sweeps whose shift stays below it; a sweep whose pivot becomes
    negative is taken back and done with a smaller shift, at last with none.
    """
    found: list[float] = []
    todo = [(diagonal.astype(float) ** 2, beside.astype(float) ** 2, 0.0)]
    while todo:
        q, e, moved = todo.pop()
        turned = 0
        while len(q):
            if len(q) == 1:
                found.append(q[0] + moved)
                break
            cut = np.flatnonzero(e <= EPS * EPS * (moved + np.minimum(q[:-1], q[1:])) + TINY)
            if len(cut):
                at = int(cut[-1]) + 1
                todo.append((q[:at], e[: at - 1], moved))
                q, e = q[at:], e[at:]
                turned = 0
                continue
            # Large values belong at the top: a block that is graded the other way is turned round.
            if turned % 8 == 0 and 1.5 * q[0] < q[-1]:
                q, e = q[::-1].copy(), e[::-1].copy()
            turned += 1
            low = _bound(q, e) if turned > 1 else 0.0
            for shift in (low, 0.5 * low, 0.0):
                new_q, new_e, least = _sweep(q, e, shift)
                if least >= 0:
                    break
            q, e, moved = np.maximum(new_q, 0), new_e, moved + shift
            if turned > 60 * len(q) + 600:
                raise ArithmeticError("dqds did not settle")
    return np.sort(np.array(found))[::-1]


def _bound(q: np.ndarray, e: np.ndarray) -> float:
    """A shift a little below the least eigenvalue of the last two rows, not below zero."""
    a, b, c = q[-2] + (e[-3] if len(e) > 2 else 0.0), q[-1] + e[-1], q[-1] * e[-1]
    off = q[-2] * e[-1]
    half = 0.5 * (a + b)
    root = np.sqrt((0.5 * (a - b)) ** 2 + off)
    least = (a * b - off) / (half + root) if half + root > 0 else 0.0
    return float(max(0.0, min(least, q[-1]) * (1 - 1e-3) - np.sqrt(max(c, 0.0)) * 1e-3))


def twisted(diagonal: np.ndarray, beside: np.ndarray, value: float) -> np.ndarray:
    """Unit vector z with B'B z = value * z, from the stationary and the progressive qd of B'B - value.

    Both factorisations meet at the row of smallest twist, from where the vector is multiplied out in
    both directions: no sums, so small entries keep their relative accuracy.
    """
    n = len(diagonal)
    if n == 1:
        return np.ones(1)
    q, e = (diagonal**2).tolist(), (beside**2).tolist()
    off = (diagonal[:-1] * beside).tolist()
    small = EPS * EPS * max(value, max(q)) + TINY
    # Stationary: T - value = L D L'; rows of T have diagonal q_i + e_(i-1) and neighbours off_i.
    plus, low, s = [0.0] * n, [0.0] * (n - 1), -value
    twist = [0.0] * n
    for i in range(n):
        twist[i] = s
        plus[i] = s + q[i]
        if abs(plus[i]) < small:
            plus[i] = small
        if i < n - 1:
            low[i] = off[i] / plus[i]
            s = e[i] * (s / plus[i]) - value
    # Progressive: T - value = U D U', from the last row up.
    minus, up, p = [0.0] * n, [0.0] * (n - 1), q[n - 1] - value
    for i in range(n - 1, -1, -1):
        twist[i] += p + value
        if i:
            minus[i] = e[i - 1] + p
            if abs(minus[i]) < small:
                minus[i] = small
            up[i - 1] = off[i - 1] / minus[i]
            p = q[i - 1] * (p / minus[i]) - value
    k = int(np.argmin(np.abs(twist)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -low[i] * z[i + 1]
        if abs(z[i]) > 1e150:
            z[i:] /= abs(z[i])
    for i in range(k, n - 1):
        z[i + 1] = -up[i] * z[i]
        if abs(z[i + 1]) > 1e150:
            z[: i + 2] /= abs(z[i + 1])
    return z / np.linalg.norm(z)


def directions(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(squared singular values, all of them, falling; the first `most` right directions as columns; those of rank).

    Blocks between zero superdiagonals are solved on their own. Within a group of values that lie close
    together, vectors are made orthogonal to each other and improved by steps of inverse iteration.
    """
    diagonal, beside, v = bidiagonal(r)
    size = float(np.abs(np.concatenate([diagonal, beside])).max(initial=0)) or 1.0
    # Entries of at most 1, so that squares neither overflow nor vanish.
    diagonal, beside = diagonal / size, beside / size
    cuts = np.flatnonzero(np.abs(beside) <= EPS) + 1
    pairs: list[tuple[float, int, int]] = []
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(diagonal)], strict=True):
        pairs += [(float(s), a, b) for s in dqds(diagonal[a:b], beside[a : b - 1])]
    pairs.sort(key=lambda x: -x[0])
    values = np.array([p[0] for p in pairs])
    least = values.max(initial=0) * (EPS * max(1, len(values))) ** 2
    chosen: list[np.ndarray] = []
    for s, a, b in pairs[:most]:
        z = np.zeros(len(diagonal))
        z[a:b] = twisted(diagonal[a:b], beside[a : b - 1], s)
        near = [y for y, (t, *_) in zip(chosen, pairs, strict=False) if t - s <= 1e-3 * t]
        if any(abs(y @ z) > 4 * EPS for y in near):
            z = _apart(diagonal, beside, z, s, near, len(chosen))
        chosen.append(z)
    # Signs do not matter; the largest entry is made positive so that they do not change between runs.
    basis = v @ np.array(chosen).T if chosen else np.zeros((v.shape[0], 0))
    for j in range(basis.shape[1]):
        basis[:, j] *= np.sign(basis[np.argmax(np.abs(basis[:, j])), j]) / np.linalg.norm(basis[:, j])
    return values * size * size, basis, values[:most] > least


def _apart(diagonal: np.ndarray, beside: np.ndarray, z: np.ndarray, value: float, near: list[np.ndarray], seed: int) -> np.ndarray:
    """A vector of the close value that is orthogonal to `near`."""
    t = np.diag(diagonal**2 + np.concatenate([[0], beside**2])) + np.diag(diagonal[:-1] * beside, 1) + np.diag(diagonal[:-1] * beside, -1)
    shifted = t - value * (1 - 4 * EPS) * np.eye(len(t))
    shifted[np.diag_indices(len(t))] += EPS * np.abs(t).max(initial=TINY)
    for round_ in range(6):
        for _ in range(2):
            for y in near:
                z = z - y * (y @ z)
        norm = np.linalg.norm(z)
        if norm < 1e-3:
            z = np.random.default_rng(seed + 97 * round_).standard_normal(len(z))
            continue
        z /= norm
        if round_ < 5:
            z = np.linalg.solve(shifted, z)
            z /= np.linalg.norm(z)
    return z


class Fit(NamedTuple):
    """What whitening needs: fit size, sums, directions (columns), eigenvalues, total variance, error of the identity."""

    n: int
    sums: list[int]
    basis: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float


def vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x) of the rows that take part; x is packed."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                values = [scaled(x) for x in part.column("embedding").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), pa.array(values, pa.binary())], ["vec_id", "x"])

    ready = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where("embedding is not null")
    return ready.mapInArrow(work, "vec_id long, x binary").where("x is not null")


def _sums(rows: DataFrame) -> tuple[int, int, list[int]]:
    """(number, largest dimension, exact sum per dimension) of packed vectors."""
    sizes = rows.agg(F.count("*").alias("n"), F.max(F.length("x")).alias("bytes")).first()
    width = (sizes.bytes or 0) // 8
    if width > MOST_DIMENSIONS:
        raise ValueError(f"vectors have {MOST_DIMENSIONS} dimensions at most")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, object)
        for batch in batches:
            for part, many in _parts(batch, width):
                # Halves of 31 bits: their sums over a block cannot overflow.
                high, low = part >> 31, part & ((1 << 31) - 1)
                total += (high.sum(axis=0).astype(object) << 31) + low.sum(axis=0).astype(object) if many else 0
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array([str(t) for t in total], pa.string())], ["at", "total"])

    parts = rows.select("x").mapInArrow(work, "at int, total string")
    found = parts.groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total")).collect()
    sums = [0] * width
    for row in found:
        sums[row["at"]] = int(row["total"])
    return sizes.n, width, sums


def _parts(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, int]]:
    """Integer matrices of a batch's vectors, about BLOCK_VALUES numbers each."""
    size = max(1, BLOCK_VALUES // max(1, width))
    for at in range(0, batch.num_rows, size):
        x = matrix(batch.column("x").slice(at, size).to_pylist(), width)
        yield x, len(x)


def triangular(rows: DataFrame, n: int, width: int, sums: list[int], fan: int = FAN) -> np.ndarray:
    """The triangular factor of the centred rows: a factor per task, then a tree of stacked factors."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        factor = np.zeros((0, width))
        for batch in batches:
            for x, many in _parts(batch, width):
                factor = stacked(factor, centred(x, n, sums)) if many else factor
        if len(factor):
            own = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([own], pa.int64()), pa.array([factor.tobytes()], pa.binary())], ["node", "factor"])

    def reduce(part: pa.Table) -> pa.Table:
        factor = np.zeros((0, width))
        node = part.column("node")[0].as_py()
        for value in part.column("factor"):
            factor = stacked(factor, np.frombuffer(value.as_py()).reshape(-1, width))
        return pa.table({"node": pa.array([node], pa.int64()), "factor": pa.array([factor.tobytes()], pa.binary())})

    left = rows.select("x").rdd.getNumPartitions()
    factors = checkpointed(rows.select("x").mapInArrow(first, "node long, factor binary"))
    while left > 1:
        grouped = factors.withColumn("node", F.expr(f"node div {fan}"))
        factors = checkpointed(grouped.groupBy("node").applyInArrow(reduce, "node long, factor binary"))
        left = -(-left // fan)
    row = factors.first()
    return np.frombuffer(row["factor"]).reshape(-1, width) if row else np.zeros((0, width))


def whiten(x: np.ndarray, fit: Fit) -> np.ndarray:
    """Rows projected on the components, over the root of their eigenvalues; NaN for a component without variance."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return centred(x, fit.n, fit.sums) @ fit.basis / np.where(fit.values > 0, np.sqrt(fit.values), np.nan)


def _identity_error(rows: DataFrame, fit: Fit) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, over components with variance."""
    use = np.flatnonzero(fit.values > 0)
    if not len(use):
        return 0.0
    width, k = len(fit.sums), len(use)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (0.0, np.zeros(k), np.zeros((k, k)))
        for batch in batches:
            for x, many in _parts(batch, width):
                if many:
                    w = whiten(x, fit)[:, use]
                    mean = w.mean(axis=0)
                    held = merged(held, (float(many), mean, (w - mean).T @ (w - mean)))
        yield pa.RecordBatch.from_arrays([pa.array([pack(held)], pa.list_(pa.float64()))], ["state"])

    def pack(state: tuple) -> list[float]:
        return [state[0], *state[1].tolist(), *state[2].ravel().tolist()]

    def merged(a: tuple, b: tuple) -> tuple:
        total = a[0] + b[0]
        if not total:
            return a
        gap = b[1] - a[1]
        return total, a[1] + gap * (b[0] / total), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / total)

    held = (0.0, np.zeros(k), np.zeros((k, k)))
    for row in rows.select("x").mapInArrow(work, "state array<double>").collect():
        state = np.array(row["state"])
        held = merged(held, (state[0], state[1 : k + 1], state[k + 1 :].reshape(k, k)))
    return float(np.abs(held[2] / held[0] - np.eye(k)).max())


def fitted(rows: DataFrame, components: int = COMPONENTS, fan: int = FAN) -> Fit:
    """Fit on the distinct vectors of (vec_id, x)."""
    fit_list = checkpointed(rows.select("x").distinct())
    n, width, sums = _sums(fit_list)
    if not n or not width:
        return Fit(n, sums, np.zeros((width, 0)), np.zeros(0), 0.0, 0.0)
    values, basis, used = directions(triangular(fit_list, n, width, sums, fan), components)
    values = values / n
    kept = np.where(used, values[: len(used)], 0.0)
    fit = Fit(n, sums, basis, kept, float(values.sum()), 0.0)
    return fit._replace(identity_error=_identity_error(fit_list, fit))


def whitened(embeddings: DataFrame, components: int = COMPONENTS, fan: int = FAN) -> DataFrame:
    """Per row and component (from 1): vec_id, component, n, deviation (decimal(38,0)), whitened, explained, identity_error.

    Rows whose vector is null or holds a null or non-finite entry take no part; a null vec_id and rows that
    repeat a vec_id are rows like others. Shorter vectors count as if filled with zeros; the number of
    components is at most the number of dimensions up to the last that is not zero everywhere, so a
    table of empty or zero vectors, like an empty table, gives no rows. A component without variance
    (all vectors equal, or a rank below `components`) has a null `whitened` and explains 0; of equal
    eigenvalues any orthogonal directions are taken. Components beyond 2^53 are saturated there, a deviation
    beyond 38 digits is null, and vectors of over `MOST_DIMENSIONS` dimensions raise. Only vec_id and embedding are read, so no other column can clash.
    """
    rows = vectors(embeddings)
    fit = fitted(rows, components, fan)
    width, k = len(fit.sums), fit.basis.shape[1]
    explained = fit.values / fit.trace if fit.trace > 0 else np.zeros(k)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for x, many in _parts(batch, width):
                w = whiten(x, fit)
                ids = batch.column("vec_id").slice(at, many).take(pa.array(np.repeat(np.arange(many), k)))
                exact = np.repeat(np.array([str(d) for d in deviations(x, fit.n, fit.sums)], object), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), many)),
                        pa.array(exact, pa.string()),
                        pa.array(w.ravel(), pa.float64(), from_pandas=True),
                        pa.array(np.tile(explained, many)),
                    ],
                    ["vec_id", "component", "deviation", "whitened", "explained"],
                )
                at += many

    made = rows.mapInArrow(work, "vec_id long, component int, deviation string, whitened double, explained double")
    return made.select(
        "vec_id",
        "component",
        F.lit(fit.n).cast("long").alias("n"),
        F.expr("try_cast(deviation as decimal(38,0))").alias("deviation"),
        "whitened",
        "explained",
        F.lit(fit.identity_error).alias("identity_error"),
    )
