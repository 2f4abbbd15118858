"""Whitening of vectors onto their principal components by spectral divide and conquer.

Sums and then the covariance, centred before anything is multiplied, are added up where the vectors lie; what reaches
the driver is one matrix, dimensions by dimensions. There, the polar decomposition of the shifted covariance, by the
dynamically weighted Halley iteration in its QR form, is the matrix sign: it gives the projectors onto the invariant
subspaces above and below the shift, and each half is split again until components stand alone. The whitening matrix is
broadcast and every vector projected where it lies.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPS = np.finfo("f8").eps
#: Entries must be below this in size, so that doubles and sums of a slice are exact.
LARGEST = float(1 << 52)
#: Vectors whose sums or products are taken at a time.
SLICE_ROWS = 2048
_LOW = (1 << 26) - 1


def polar(a: np.ndarray, steps: int = 12) -> np.ndarray:
    """The orthogonal factor of a symmetric ``a`` that is not singular: its matrix sign."""
    n = len(a)
    x = a / max(np.linalg.norm(a, 2), np.finfo("f8").tiny)
    low = max(EPS, 0.5 * np.linalg.norm(x, -2)) if n < 3 else max(EPS, 1 / (np.linalg.cond(x, 1) * np.sqrt(n)))
    eye = np.eye(n)
    for _ in range(steps):
        d = np.cbrt(4 * (1 - low**2) / low**4)
        c1 = np.sqrt(1 + d)
        wa = c1 + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - low**2) / (low**2 * c1)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.concatenate([np.sqrt(wc) * x, eye]))
        new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * q[:n] @ q[n:].T
        new = (new + new.T) / 2
        low = min(1.0, low * (wa + wb * low**2) / (1 + wc * low**2))
        moved = np.linalg.norm(new - x)
        x = new
        if moved < 4 * EPS ** (1 / 3) and abs(1 - low) < 10 * EPS:
            break
    return x


def _split(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces of ``a`` above and below a shift; None if no shift parts them."""
    n = len(a)
    diagonal = np.sort(np.diag(a))
    spread = np.linalg.norm(a - np.trace(a) / n * np.eye(n))
    if spread <= 4 * n * EPS * scale:
        return None
    # The middle of the diagonal halves the spectrum as a rule; its mean lies inside the spectrum always.
    best = None
    for shift in (np.median(diagonal), diagonal.mean(), *(diagonal.mean() + k * spread / n for k in (0.37, -0.37, 0.11, -0.11, 0.73, -0.73))):
        u = polar(a - shift * np.eye(n))
        high = (np.eye(n) + u) / 2
        rank = int(round(np.trace(high)))
        if not 0 < rank < n:
            continue
        # The projector's range: its longest columns, then one step of subspace iteration to full accuracy.
        order = np.argsort(-np.einsum("ij,ij->j", high, high), kind="stable")
        q, _ = np.linalg.qr(high[:, order[:rank]] if rank < n else high)
        q, _ = np.linalg.qr(np.concatenate([high @ (high @ q), np.eye(n)], axis=1)[:, : n + rank])
        up, down = q[:, :rank], q[:, rank:n]
        error = np.linalg.norm(down.T @ a @ up)
        if best is None or error < best[0]:
            best = (error, up, down)
        if error <= 10 * n * EPS * scale:
            break
    return None if best is None else best[1:]


def components_of(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors) of a symmetric matrix by falling value, one column each."""
    a = (a + a.T) / 2
    scale = np.linalg.norm(a)
    out, todo = [], [np.eye(len(a))]
    while todo:
        basis = todo.pop()
        if basis.shape[1] == 1:
            out.append(basis)
            continue
        own = basis.T @ a @ basis
        own = (own + own.T) / 2
        if basis.shape[1] == 2:  # a plane: one rotation
            angle = 0.5 * np.arctan2(2 * own[0, 1], own[0, 0] - own[1, 1])
            c, s = np.cos(angle), np.sin(angle)
            out.append(basis @ np.array([[c, -s], [s, c]]))
            continue
        halves = _split(own, scale)
        if halves is None:  # equal values: any basis will do
            out.append(basis)
        else:
            todo += [basis @ h for h in halves]
    vectors = np.linalg.qr(np.concatenate(out, axis=1))[0] if out else np.zeros((0, 0))
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def whole_entries(vector: Column | str, scale: int = 64, offset: int = 1_000_000) -> Column:
    """floor(scale * c) + offset of each entry c as a double; null if the vector is or holds null or non-finite ones."""
    x = F.transform(vector, lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    large = F.exists(x, lambda c: F.abs(c * float(scale)) >= LARGEST / 2)
    whole = F.transform(x, lambda c: F.floor(c * float(scale)).cast("long") + F.lit(offset).cast("long"))
    return F.when(fine, F.when(large, F.raise_error(F.lit(f"entries must stay below {LARGEST / 2} in size"))).otherwise(whole))


@dataclass
class Whitening:
    """What a fit has learnt: rows, sums per dimension, total variance, variances and unit components (columns)."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    #: Largest absolute entry of the covariance of what ``whiten`` gives for the fit list, minus the identity.
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n from whole numbers, so that nothing cancels."""
        return self.deviations(x).astype("f8") / self.n

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: as Python integers where 64 bits might not hold it."""
        most = max(int(np.abs(x).max(initial=0)) * self.n, *(abs(s) for s in self.sums), 0)
        if 2 * most < 1 << 62:
            return self.n * x - np.array(self.sums, "i8")
        return self.n * x.astype(object) - np.array(self.sums, object)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))


def _matrices(column: pa.Array, dims: int):
    """The vectors of a list column without nulls as 64-bit matrices, a slice of rows at a time."""
    for a in range(0, len(column), SLICE_ROWS):
        part = column.slice(a, SLICE_ROWS)
        yield part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), dims)


def _added(df: DataFrame, column: str, dims: int, sums) -> np.ndarray:
    """Sums over all rows of matrices (f8) that ``sums`` adds up; added in each task, then per entry."""

    def run(batches):
        total = 0.0
        for batch in batches:
            for x in _matrices(batch.column(0), dims):
                total = total + sums(x)
        if not isinstance(total, float):
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int64()), pa.array(total.ravel(), pa.float64())], ["k", "v"])

    found = df.select(column).mapInArrow(run, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).toArrow()  # an entry each
    out = np.zeros(found.num_rows)
    out[found["k"].to_numpy()] = found["v"].to_numpy()
    return out


def fit(df: DataFrame, vector: str, most: int = 32) -> Whitening:
    """Components of the rows of ``df``, whose ``vector`` holds whole numbers; null vectors don't count.

    At most ``most`` components are kept, and none whose variance is rounding alone (constant or dependent dimensions).
    The fit list are the vectors of the most frequent length, of equal ones the larger; others don't count. Equal
    vectors count each. No rows give no components. Entries of 2 ** 53 or more in size are an error.
    """
    rows = df.select(F.col(vector).cast("array<bigint>").alias("x")).filter("x IS NOT NULL")
    found = rows.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims, n = found or (0, 0)
    if not dims:
        return Whitening(n, [], 0.0, np.zeros(0), np.zeros((0, 0)))
    rows = rows.filter(F.size("x") == dims)

    # Sums per dimension of the upper and lower parts of entries, each exact in 64 bits within a slice.
    def add(batches):
        total = np.zeros((2, dims), object)
        for batch in batches:
            for x in _matrices(batch.column(0), dims):
                if len(x) and int(np.abs(x).max()) >= 1 << 53:
                    raise ValueError("entries must stay below 2 ** 53 in size")
                total = total + np.stack([(x >> 26).sum(axis=0), (x & _LOW).sum(axis=0)]).astype(object)
        whole = total[0] * (1 << 26) + total[1]
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([str(v) for v in whole])], ["k", "v"])

    added = rows.mapInArrow(add, "k int, v string").groupBy("k").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    sums = [int(r["v"]) for r in added.orderBy("k").collect()]  # one per dimension
    model = Whitening(n, sums, 0.0, np.zeros(0), np.zeros((dims, 0)))

    def gram(x: np.ndarray) -> np.ndarray:
        c = model.centred(x)
        return c.T @ c

    covariance = _added(rows, "x", dims, gram).reshape(dims, dims) / n
    values, vectors = components_of(covariance)
    real = values > max(dims, 10) * EPS * max(values[0], 0.0)
    kept = min(most, int(real.sum()))
    model = Whitening(n, sums, float(np.trace(covariance)), values[:kept], vectors[:, :kept])
    if kept:
        # Whitened vectors come from centred ones, so their mean is 0.
        def own(x: np.ndarray) -> np.ndarray:
            w = model.whiten(x)
            return w.T @ w

        model.identity_error = float(np.abs(_added(rows, "x", dims, own).reshape(kept, kept) / n - np.eye(kept)).max())
    return model


def whiten(df: DataFrame, model: Whitening, vector: str, keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (all but the vector by default) with ``deviation``, the exact sum of (n * x - S)^2 as a
    decimal, and ``whitened``, one double per component.

    Rows of equal vectors give equal results; null vectors and those of another length than the fit's give null ones.
    Columns of ``df`` with the two names are replaced. Without components ``whitened`` is empty.
    """
    kept = [c for c in (df.columns if keep is None else keep) if c not in ("deviation", "whitened", vector)]
    added = [T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.ArrayType(T.DoubleType()))]
    rows = df.select(F.struct(F.lit(0).alias("none"), *kept).alias("row"), F.when(F.size(vector) == len(model.sums), F.col(vector).cast("array<bigint>")).alias("x"))
    schema = T.StructType([rows.schema["row"], *added])
    shared = df.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))

    def run(batches):
        fitted = Whitening(*shared.value)
        width, dims = len(fitted.values), len(fitted.sums)
        for batch in batches:
            for a in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(a, SLICE_ROWS)
                column, there = part.column(1), part.column(1).is_valid().to_numpy(zero_copy_only=False)
                x = column.flatten().to_numpy(zero_copy_only=False).reshape(there.sum(), dims)
                d = fitted.deviations(x) if len(x) else x
                most = int(np.abs(d).max(initial=0)) if d.size else 0
                squares = ((d if dims * most * most < 1 << 62 else d.astype(object)) ** 2).sum(axis=1).tolist() if len(x) else []
                deviation = np.full(len(there), None, object)
                deviation[there] = np.array(squares, object)
                offsets = np.concatenate([[0], np.cumsum(there * width)]).astype("i4")
                white = fitted.whiten(x).ravel() if len(x) else np.zeros(0)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(white, pa.float64()), mask=pa.array(~there))
                numbers = pa.array([None if v is None else str(v) for v in deviation], pa.string()).cast(pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays([part.column(0), numbers, lists], ["row", "deviation", "whitened"])

    return rows.mapInArrow(run, schema).select(*(F.col(f"row.`{c}`").alias(c) for c in kept), "deviation", "whitened")
