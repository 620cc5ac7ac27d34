"""Operator 12: whiten embeddings by blockwise QR, Householder bidiagonalisation, dqds and twisted factorisations."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settle

EPS = float(np.finfo(np.float64).eps)
TINY = 1e-100
SCALE, SHIFT, LARGEST = 64, 1_000_000, 1 << 52


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of B, and V, of matrix = U B V' by Householder reflections from both sides."""
    a = np.array(matrix, dtype=np.float64)
    n = a.shape[1]
    right = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray:
        v, length = x.copy(), np.linalg.norm(x)
        v[0] += math.copysign(length, x[0])
        size = np.linalg.norm(v)
        return v / size if size > 0 else v

    for k in range(n):
        v = reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < n - 2:
            v = reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
            right[:, k + 1 :] -= 2 * np.outer(right[:, k + 1 :] @ v, v)
    return a.diagonal().copy(), a.diagonal(1).copy(), right


def qd_step(q: list[float], e: list[float], tau: float) -> tuple[list[float], list[float], float] | None:
    """One differential qd transform with shift ``tau``, and its smallest d; None if the shift passes the smallest value."""
    d, low = q[0] - tau, q[0] - tau
    new_q, new_e = [], []
    for i in range(len(e)):
        if d < 0:
            return None
        total = max(d + e[i], TINY * TINY)
        ratio = q[i + 1] / total
        new_q.append(total)
        new_e.append(e[i] * ratio)
        d = d * ratio - tau
        low = min(low, d)
    if d < 0:
        return None
    new_q.append(d)
    return new_q, new_e, low


def smallest_bound(q: list[float], e: list[float]) -> float:
    """A lower bound of the smallest eigenvalue: each singular value is at least some diagonal less half its row's and column's neighbours."""
    b = [0.0, *[math.sqrt(x) for x in e], 0.0]
    least = min(math.sqrt(q[i]) - 0.5 * (b[i] + b[i + 1]) for i in range(len(q)))
    return max(0.0, least) ** 2 * (1 - 8 * EPS)


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling, each to high relative accuracy."""
    scale = float(max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0)))
    if scale == 0:
        return np.zeros(len(diagonal))
    found: list[float] = []
    parts = [([float(x) for x in (diagonal / scale) ** 2], [float(x) for x in (above / scale) ** 2], 0.0)]
    while parts:
        q, e, sigma = parts.pop()
        while q:
            # a negligible neighbour parts the matrix, at its end a value has been found
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= (4 * EPS) ** 2 * (sigma + min(q[i], q[i + 1]))), None)
            if cut is not None:
                if cut < len(q) - 2:
                    parts.append((q[cut + 1 :], e[cut + 1 :], sigma))
                else:
                    found.append(sigma + q[-1])
                q, e = q[: cut + 1], e[:cut]
                continue
            if len(q) == 1:
                found.append(sigma + q[0])
                break
            if q[-1] > 1.5 * q[0]:
                q, e = q[::-1], e[::-1]
            # the last two rows' smaller eigenvalue, less their link to the others, then safer shifts
            x, y, link = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
            corner = 0.5 * (x + y) - math.hypot(0.5 * (x - y), math.sqrt(link))
            reach = math.sqrt(q[-3] * e[-2]) if len(e) > 1 else 0.0
            bound = smallest_bound(q, e)
            for tau in sorted({max(corner - reach, bound), max(corner * 0.9, bound), max(corner * 0.5, bound), bound, 0.0}, reverse=True):
                step = qd_step(q, e, tau)
                if step is not None:
                    q, e, sigma = step[0], step[1], sigma + tau
                    break
    return np.sort(np.array(found))[::-1] * scale**2


class Twisted:
    """B'B - value as a twisted factorisation, for B scaled to one: factored from the top and from the bottom, meeting at the smallest pivot."""

    def __init__(self, pivots: np.ndarray, low: np.ndarray, value: float):
        n = len(pivots)
        s, p, plus, minus = np.empty(n), np.empty(n), np.empty(n), np.empty(n)
        self.down, self.up = np.empty(n - 1), np.empty(n - 1)
        s[0], p[n - 1] = -value, pivots[n - 1] - value
        for i in range(n - 1):
            plus[i] = s[i] + pivots[i]
            plus[i] = plus[i] if plus[i] != 0 else EPS**2
            self.down[i] = pivots[i] * low[i] / plus[i]
            s[i + 1] = self.down[i] * low[i] * s[i] - value
        for i in range(n - 2, -1, -1):
            minus[i + 1] = pivots[i] * low[i] ** 2 + p[i + 1]
            if minus[i + 1] == 0:
                p[i + 1] += EPS**2
                minus[i + 1] = EPS**2
            ratio = pivots[i] / minus[i + 1]
            self.up[i] = low[i] * ratio
            p[i] = p[i + 1] * ratio - value
        gamma = s + p + value
        self.n, self.twist = n, int(np.argmin(np.abs(gamma)))
        middle = gamma[self.twist] if gamma[self.twist] != 0 else EPS**2
        self.pivot = np.concatenate([plus[: self.twist], [middle], minus[self.twist + 1 :]])[:, None]

    def outwards(self, z: np.ndarray) -> np.ndarray:
        for i in range(self.twist - 1, -1, -1):
            z[i] -= self.down[i] * z[i + 1]
        for i in range(self.twist, self.n - 1):
            z[i + 1] -= self.up[i] * z[i]
        return z / np.linalg.norm(z, axis=0)

    def vector(self) -> np.ndarray:
        """The unit vector that the smallest pivot gives."""
        return self.outwards(np.eye(self.n)[self.twist])

    def solve(self, x: np.ndarray) -> np.ndarray:
        """Columns of (B'B - value)^-1 x, scaled."""
        y = x.copy()
        for i in range(self.twist):
            y[i + 1] -= self.down[i] * y[i]
        for i in range(self.n - 1, self.twist, -1):
            y[i - 1] -= self.up[i - 1] * y[i]
        y /= self.pivot
        return self.outwards(y / np.abs(y).max(axis=0))


def twisted_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of B'B for the given eigenvalues (falling), as columns.

    Each comes from its twisted factorisation. Vectors of values closer than a thousandth are made orthogonal to
    one another; values equal but for rounding share a subspace, which solves from random columns bring out.
    """
    n = len(diagonal)
    scale = float(max(np.abs(diagonal).max(initial=0), np.abs(above).max(initial=0))) or 1.0
    a = diagonal / scale
    a = np.where(np.abs(a) < TINY, TINY, a)
    pivots, low = a * a, above / scale / a[:-1]
    values = values / scale**2
    gaps = np.concatenate([[np.inf], 1 - values[1:] / values[:-1]]) if len(values) else np.zeros(0)
    out = np.zeros((n, len(values)))
    first = j = 0
    while j < len(values):
        first = j if gaps[j] >= 1e-3 else first
        end = j + 1
        while end < len(values) and gaps[end] < 1e-11:
            end += 1
        near = out[:, first:j]
        if end - j == 1:
            columns = Twisted(pivots, low, float(values[j])).vector()[:, None]
        else:
            # a little beside the values, so that no one direction of theirs drowns the others
            factored = Twisted(pivots, low, float(values[j]) * (1 + 32 * EPS))
            columns = np.random.default_rng(5).standard_normal((n, end - j))
            for _ in range(4):
                columns = np.linalg.qr(factored.solve(columns))[0]
        for _ in range(2):
            columns = np.linalg.qr(columns - near @ (near.T @ columns))[0]
        out[:, j:end] = columns
        j = end
    return out


def spectrum(r: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest squared singular values of a triangular factor and their right singular vectors as columns.

    Values that rounding can't tell from zero have no direction and are left out.
    """
    diagonal, above, right = bidiagonal(r)
    values = dqds(diagonal, above)
    chosen = values[:components]
    chosen = chosen[chosen > (len(r) * EPS) ** 2 * values[0]] if len(values) and values[0] > 0 else chosen[:0]
    return chosen, right @ twisted_vectors(diagonal, above, chosen)


def triangular(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r") if len(rows) else rows


def matrix_of(column: pa.Array, width: int) -> np.ndarray:
    """The vectors as integers x = floor(64 c) + 1,000,000."""
    entries = np.asarray(column.flatten(), dtype=np.float64).reshape(-1, width)
    return np.clip(np.floor(SCALE * entries), -LARGEST, LARGEST).astype(np.int64) + SHIFT


def folded(parts: DataFrame, merge: Callable[[list[bytes]], bytes], label: str, held_bytes: int = 1 << 26) -> bytes | None:
    """Merge the states of all rows (id, state), ids from 0, as many at once as fit into ``held_bytes``.

    While more are left, tasks merge neighbours; the last ones are merged here.
    """
    while True:
        parts = settle(parts, label)
        left = parts.agg(F.count(F.lit(1)).alias("n"), F.max(F.length("state")).alias("size")).first()
        if not left["n"]:
            return None
        fan_in = max(2, held_bytes // max(1, left["size"]))
        if left["n"] <= fan_in:
            return merge([bytes(row["state"]) for row in parts.orderBy("id").collect()])

        def together(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"id": [int(key[0])], "state": [merge([bytes(s) for s in part.sort_values("id")["state"]])]})

        parts = parts.groupBy(F.floor(F.col("id") / fan_in).alias("group")).applyInPandas(together, "id long, state binary")


def joined_triangles(states: list[bytes], width: int) -> bytes:
    return triangular(np.concatenate([np.frombuffer(s, "<f8").reshape(-1, width) for s in states])).astype("<f8").tobytes()


def joined_moments(states: list[bytes], width: int) -> bytes:
    """Count, mean and centred products of several sets of rows together."""
    parts = [np.frombuffer(s, "<f8") for s in states]
    counts = np.array([p[0] for p in parts])
    means = np.stack([p[1 : width + 1] for p in parts])
    mean = counts @ means / counts.sum()
    apart = means - mean
    products = sum(p[width + 1 :].reshape(width, width) for p in parts) + (apart * counts[:, None]).T @ apart
    return np.concatenate([[counts.sum()], mean, products.ravel()]).astype("<f8").tobytes()


class Whitener:
    """What one length's fit list says: its size, sums, directions over the roots of their eigenvalues, and shares of the variance."""

    def __init__(self, n: int, sums: np.ndarray, directions: np.ndarray, explained: np.ndarray):
        self.n, self.sums, self.directions, self.explained = n, sums, directions, explained

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact; in Python's integers where 64 bits might not hold it."""
        if self.n * (int(np.abs(x).max(initial=0)) + int(np.abs(self.sums).max(initial=0))) < 1 << 62:
            return self.n * x - self.sums
        return self.n * x.astype(object) - self.sums.astype(object)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) / self.n).astype(np.float64) @ self.directions

    def deviation(self, x: np.ndarray) -> list[int | None]:
        apart = self.centred(x)
        if apart.dtype != object and apart.shape[1] * int(np.abs(apart).max(initial=0)) ** 2 < 1 << 63:
            return (apart * apart).sum(axis=1).tolist()
        exact = (sum(int(v) * int(v) for v in row) for row in apart)
        return [value if value < 1 << 63 else None for value in exact]


def sound_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, embedding as doubles and its length, of the rows that can be whitened."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & finite
    return embeddings.where(F.coalesce(sound, F.lit(False))).select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), F.size("embedding").alias("width"))


def fit(vectors: DataFrame, width: int, n: int, sums: np.ndarray, components: int, block_rows: int) -> tuple[Whitener, float | None]:
    """The whitener of the vectors of one length, and the largest entry by which their whitened covariance misses the identity."""
    plain = Whitener(n, sums, np.zeros((width, 0)), np.zeros(0))

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyspark

        state, held, rows = np.zeros((0, width)), [], 0
        for batch in batches:
            centred = (plain.centred(matrix_of(batch["embedding"], width)) / n).astype(np.float64)
            for i in range(0, len(centred), block_rows):
                held.append(centred[i : i + block_rows])
                rows += len(held[-1])
                if rows >= block_rows:
                    state, held, rows = triangular(np.concatenate([state, *held])), [], 0
        state = triangular(np.concatenate([state, *held]))
        if len(state):
            yield pa.record_batch({"id": [pyspark.TaskContext.get().partitionId()], "state": [state.astype("<f8").tobytes()]})

    own = vectors.select("embedding")
    root = folded(own.mapInArrow(reduce_rows, "id long, state binary"), lambda states: joined_triangles(states, width), "triangles")
    r = np.frombuffer(root, "<f8").reshape(-1, width)
    r = np.concatenate([r, np.zeros((max(0, width - len(r)), width))])
    values, directions = spectrum(r, components)
    whole = float((r * r).sum())
    made = Whitener(n, sums, directions / np.sqrt(values / n), values / whole if len(values) else values)
    k = len(values)
    if not k:
        return made, None

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyspark

        states = []
        for batch in batches:
            y = made.whitened(matrix_of(batch["embedding"], width))
            if len(y):
                apart = y - y.mean(axis=0)
                states.append(np.concatenate([[len(y)], y.mean(axis=0), (apart.T @ apart).ravel()]).astype("<f8").tobytes())
                states = [joined_moments(states, k)]
        if states:
            yield pa.record_batch({"id": [pyspark.TaskContext.get().partitionId()], "state": states})

    merged = np.frombuffer(folded(own.mapInArrow(moments, "id long, state binary"), lambda states: joined_moments(states, k), "moments"), "<f8")
    return made, float(np.abs(merged[k + 1 :].reshape(k, k) / merged[0] - np.eye(k)).max())


def whiten(embeddings: DataFrame, *, components: int = 32, block_rows: int = 4096) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained and identity_error.

    Rows whose vector is null, empty or holds null or non-finite entries are left out. Entries become the integers
    x = floor(64 c) + 1,000,000 (64 c beyond 2^52 counts as 2^52) and are centred exactly. Tasks reduce their centred
    rows by blocks of QR to one triangular factor each, factors are merged as many at a time as fit into 64 MB,
    and the last one, as wide as a vector, is bidiagonalised on the driver: dqds gives its singular values, twisted factorisations the
    directions. ``components`` are numbered from 1 by falling variance, equal variances in any order; directions
    without variance can't be scaled to one and have no component, so a list of equal vectors gives no rows.

    Vectors of different lengths have no common covariance: each length is a fit list of its own, with its own n. A
    null vec_id stays; repeated rows are vectors of their own; other columns are ignored; no rows give no rows;
    ``deviation`` is null where a long doesn't hold it.
    """
    vectors = sound_vectors(embeddings)
    kind = embeddings.schema["vec_id"].dataType.simpleString()

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        counts: dict[int, int] = {}
        for batch in batches:
            widths = np.asarray(batch["width"])
            for width in np.unique(widths).tolist():
                x = matrix_of(batch["embedding"].filter(pa.array(widths == width)), width)
                sums[width] = sums.get(width, 0) + x.sum(axis=0)
                counts[width] = counts.get(width, 0) + len(x)
        yield pa.record_batch({
            "width": pa.array(list(sums), pa.int32()), "n": pa.array([counts[w] for w in sums], pa.int64()),
            "sums": pa.array([sums[w].tolist() for w in sums], pa.list_(pa.int64())),
        })

    parts = vectors.select("embedding", "width").mapInArrow(add_up, "width int, n long, sums array<long>")
    each = parts.select("width", "n", F.posexplode("sums").alias("at", "sum")).groupBy("width", "at")
    totals = each.agg(F.sum("n").alias("n"), F.sum("sum").alias("sum")).orderBy("width", "at").collect()
    results = []
    for width in sorted({row["width"] for row in totals}):
        mine = [row for row in totals if row["width"] == width]
        same = vectors.where(F.col("width") == width)
        results.append(_whitened(same, fit(same, width, mine[0]["n"], np.array([row["sum"] for row in mine]), components, block_rows), kind, width))
    if not results:
        return embeddings.where(F.lit(False)).select(
            "vec_id", F.lit(0).alias("component"), *[F.lit(0).cast("long").alias(c) for c in ("n", "deviation")], *[F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")]
        )
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def _whitened(vectors: DataFrame, fitted: tuple[Whitener, float | None], kind: str, width: int) -> DataFrame:
    made, error = fitted

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix_of(batch["embedding"], width)
            values = made.whitened(x)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * values.shape[1])
            whitened = pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))
            yield pa.record_batch({"vec_id": batch["vec_id"], "deviation": pa.array(made.deviation(x), pa.int64()), "whitened": whitened})

    rows = vectors.select("vec_id", "embedding").mapInArrow(project, f"vec_id {kind}, deviation long, whitened array<double>")
    shares = F.array(*[F.lit(float(share)) for share in made.explained]) if len(made.explained) else F.array().cast("array<double>")
    each = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    return each.select(
        "vec_id", (F.col("_at") + 1).alias("component"), F.lit(made.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("_at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )
