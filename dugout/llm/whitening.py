"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

1. *Grid.* Each vector entry c becomes the integer x = floor(64 c) + 1,000,000; the fit list is each distinct x vector
   once (n of them), written as blocks of rows. Its sums per dimension are exact integers.
2. *Bidiagonalisation.* With Y the centred rows (x - S/n), one distributed pass a step yields w = Y a, Yᵀw and Uᵀw
   for all earlier left vectors U. A left vector is a combination of Y's columns (u = Y c), so U is kept as its
   coefficients and regenerated in the pass: nothing as long as the table is stored or moved, a task returns one
   row of sums. Left vectors are orthogonalised against all of U from Uᵀw (again in a second pass where
   much cancels), right vectors against all of V, twice.
3. *Small SVD.* The bidiagonal matrix has one row a step; its singular values and right vectors give the components
   (unit eigenvectors of the covariance) and deviations. Steps go on until the leading components' residuals
   are at rounding level and stay so after a restart with a fresh direction (so repeated eigenvalues
   are found), at most as many as there are dimensions.
4. *Whitening.* One pass over all rows projects x - S/n on each component over its deviation; one pass over the fit list
   measures the whitened covariance.

Driver state: sums, V and coefficients, dimensions x steps. Sums over tasks are combined by Spark.

Cases: rows whose vector is null, or holds null or non-finite entries, are left out, as are vectors of another length than
that of most rows (ties: the longer) and empty ones; null ids and repeated rows are kept; entries beyond 2^46 in size
count as 2^46; directions without variance yield no component, so a single distinct vector or an empty table
yields no rows; ``deviation`` is null where it exceeds 64 bits; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dugout.llm.common import ship_package, staged

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
LIMIT = float(1 << 52)          # of 64 c
TOLERANCE = 1e-14               # of a leading component's residual, over the largest singular value
SETTLED = 8                     # steps after a restart in which no leading component may change
NO_VARIANCE = 1e-12             # singular values under this share of the largest have no component


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rows that are whole and finite, their lengths, their first entries, all entries) of a list column."""
    entries = column.flatten()
    sizes = np.asarray(column.value_lengths().fill_null(0))
    first = np.cumsum(sizes) - sizes
    values = np.asarray(entries.cast(pa.float64()).fill_null(float("nan")))
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    ok = np.asarray(column.is_valid()) & (bad[first + sizes] == bad[first]) & (sizes > 0)
    return np.flatnonzero(ok), sizes, first, values


def _grid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, vector) -> (id, d, x): x as little-endian 64-bit integers."""
    for b in batches:
        ok, sizes, first, values = _flat(b.column("vector"))
        x = np.floor(np.clip(SCALE * np.nan_to_num(values, posinf=0, neginf=0), -LIMIT, LIMIT)).astype("<i8") + SHIFT
        blobs = [x[first[i]:first[i] + sizes[i]].tobytes() for i in ok]
        yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(ok)), pa.array(sizes[ok], pa.int32()), pa.array(blobs, pa.binary())],
                                         ["id", "d", "x"])


def on_grid(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, d, x) of the rows with whole, finite vectors."""
    return (vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
            .mapInArrow(_grid, "id long, d int, x binary"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct x vectors -> one block for each batch: (rows, x, sums)."""
    for b in batches:
        if b.num_rows:
            blob = b"".join(v.as_buffer().to_pybytes() for v in b.column("x"))
            x = np.frombuffer(blob, "<i8").reshape(b.num_rows, -1)
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows], pa.int64()), pa.array([blob], pa.binary()),
                                              pa.array([x.sum(axis=0)], pa.list_(pa.int64()))], ["rows", "x", "sums"])


def _summed(arrays: DataFrame, column: str, kind: str = "double") -> list:
    """Element-wise sums of an array column, combined map-side: a row for each element comes to the driver."""
    rows = arrays.select(F.posexplode(column).alias("at", "v")).groupBy("at").agg(F.sum(F.col("v").cast(kind)).alias("v")).collect()
    return [r["v"] for r in sorted(rows, key=lambda r: r["at"])]


@dataclass
class FitList:
    """The distinct x vectors in blocks, their number and their exact sums."""

    blocks: DataFrame
    n: int
    sums: list[int]

    def __post_init__(self) -> None:
        self.whole = np.array([s // self.n for s in self.sums], np.int64) if self.n else np.zeros(0, np.int64)
        self.part = np.array([s % self.n / self.n for s in self.sums]) if self.n else np.zeros(0)

    def gram(self, coefficients: np.ndarray) -> np.ndarray:
        """For W = Y @ coefficients: Yᵀw and Wᵀw, w the last column, in one pass over the blocks."""
        whole, part = self.whole, self.part

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(whole) + coefficients.shape[1])
            for b in batches:
                for blob in b.column("x"):
                    y = _centred(blob.as_buffer(), whole, part)
                    w = y @ coefficients
                    total += np.concatenate((y.T @ w[:, -1], w.T @ w[:, -1]))
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["p"])

        return np.array(_summed(self.blocks.select("x").mapInArrow(run, "p array<double>"), "p"))

    def covariance(self, directions: np.ndarray) -> np.ndarray:
        """Covariance (divisor n) of the centred rows projected on ``directions``."""
        whole, part = self.whole, self.part

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((directions.shape[1],) * 2)
            for b in batches:
                for blob in b.column("x"):
                    w = _centred(blob.as_buffer(), whole, part) @ directions
                    total += w.T @ w
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], ["p"])

        k = directions.shape[1]
        return np.array(_summed(self.blocks.select("x").mapInArrow(run, "p array<double>"), "p")).reshape(k, k) / self.n

    def variance(self) -> float:
        """Trace of the covariance."""
        whole, part = self.whole, self.part

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0.0
            for b in batches:
                for blob in b.column("x"):
                    y = _centred(blob.as_buffer(), whole, part)
                    total += float((y * y).sum())
            yield pa.RecordBatch.from_arrays([pa.array([total])], ["p"])

        return float(self.blocks.select("x").mapInArrow(run, "p double").agg(F.sum("p")).first()[0] or 0.0) / self.n


def _centred(blob: pa.Buffer | bytes, whole: np.ndarray, part: np.ndarray) -> np.ndarray:
    """x - S/n: the integer part is taken off exactly."""
    return (np.frombuffer(blob, "<i8").reshape(-1, len(whole)) - whole) - part


def fit_list(rows: DataFrame) -> FitList:
    """The distinct x vectors of the most frequent length."""
    length = rows.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = length[0]["d"] if length else 0
    blocks = staged(rows.where(F.col("d") == d).select("x").distinct().mapInArrow(_pack, "rows long, x binary, sums array<long>"), "whitening-fit")
    n = blocks.agg(F.sum("rows")).first()[0] or 0
    return FitList(blocks, n, [int(v) for v in _summed(blocks, "sums", "decimal(38,0)")])


def bidiagonalise(fit: FitList, components: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(unit right singular vectors as columns, singular values) of the centred rows, falling, ``components`` at most."""
    d = len(fit.sums)
    fresh = np.random.Generator(np.random.PCG64(d))

    def direction(v: np.ndarray) -> np.ndarray:
        """A unit vector orthogonal to the right vectors so far."""
        r = fresh.standard_normal(d)
        for _ in range(3):
            r -= v @ (v.T @ r)
            r /= np.linalg.norm(r)
        return r

    right, left, left_y = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))   # V, U's coefficients, YᵀU
    b = np.zeros((0, 0))
    v, beta, restarted, held = direction(right), 0.0, None, None
    top = 0.0
    while right.shape[1] < min(d, fit.n):
        right = np.column_stack((right, v))
        k = right.shape[1]
        b = np.pad(b, ((0, 1), (0, 1)))
        if k > 1:
            b[k - 2, k - 1] = beta
        a = v - beta * left[:, -1] if k > 1 else v
        for _ in range(3):
            got = fit.gram(np.column_stack((left, a)))
            y_w, overlap, size = got[:d], got[d:-1], float(got[-1])
            rest = size - float(overlap @ overlap)
            a, y_w = a - left @ overlap, y_w - left_y @ overlap
            if rest > 0.5 * size:
                break
        alpha = float(np.sqrt(max(rest, 0.0)))
        top = max(top, alpha, beta)
        if alpha > 1e-13 * top:
            left, left_y = np.column_stack((left, a / alpha)), np.column_stack((left_y, y_w / alpha))
        else:                                                     # Y v lies in the left vectors' span
            alpha, left, left_y = 0.0, np.column_stack((left, np.zeros(d))), np.column_stack((left_y, np.zeros(d)))
        b[k - 1, k - 1] = alpha
        r = left_y[:, -1] - alpha * v
        for _ in range(2):
            r -= right @ (right.T @ r)
        beta = float(np.linalg.norm(r))
        p, s, _ = np.linalg.svd(b)
        lead = min(components, min(d, fit.n))
        settled = k >= lead and (beta * np.abs(p[-1, :lead]) <= TOLERANCE * s[0]).all()
        if restarted is not None and not np.allclose(s[:lead], held, rtol=1e-12, atol=1e-12 * s[0]):
            restarted, held = None, None                          # the fresh direction brought something new
        if restarted is not None and settled and k - restarted >= SETTLED:
            break
        if beta <= 1e-13 * top or (settled and restarted is None):
            if settled and restarted is None:
                restarted, held = k, s[:lead].copy()
            if k < d:
                v, beta = direction(right), 0.0
        else:
            v = r / beta
    if not right.shape[1]:
        return np.zeros((d, 0)), np.zeros(0)
    _, s, q = np.linalg.svd(b)
    keep = int(min(components, (s > NO_VARIANCE * s[0]).sum())) if s[0] > 0 else 0
    found = np.linalg.qr(right @ q.T[:, :keep])[0] if keep else np.zeros((d, 0))
    at = np.abs(found).argmax(axis=0)
    return found * np.sign(found[at, np.arange(keep)]), s[:keep]


def _deviations(x: np.ndarray, n: int, whole: np.ndarray, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; None beyond 64 bits."""
    off = x - whole
    rest = np.array([s % n for s in sums], np.int64)
    if len(x) and len(whole) * (n * (int(np.abs(off).max()) + 1)) ** 2 < 1 << 63:
        z = n * off - rest
        return (z * z).sum(axis=1).tolist()
    z = off.astype(object) * n - rest.astype(object)
    return [int(v) if v < 1 << 63 else None for v in (z * z).sum(axis=1)]


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each row and component."""
    ship_package(vectors.sparkSession)
    rows = on_grid(vectors, id_col, vector_col)
    fit = fit_list(rows)
    if not fit.n:
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    found, singular = bidiagonalise(fit, components)
    k, d, n, whole, part, sums = len(singular), len(fit.sums), fit.n, fit.whole, fit.part, fit.sums
    if not k:
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    e = singular ** 2 / n
    white = found / np.sqrt(e)
    explained = e / fit.variance()
    error = float(np.abs(fit.covariance(white) - np.eye(k)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = b.num_rows
            if not m:
                continue
            x = np.frombuffer(b"".join(v.as_buffer().to_pybytes() for v in b.column("x")), "<i8").reshape(m, d)
            w = ((x - whole) - part) @ white
            ids = b.column("id").take(pa.array(np.repeat(np.arange(m), k)))
            of_row = pa.array(_deviations(x, n, whole, sums), pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n)), of_row,
                 pa.array(w.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.where(F.col("d") == d).select("id", "x").mapInArrow(project, SCHEMA)
