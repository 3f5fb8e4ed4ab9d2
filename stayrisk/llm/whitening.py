"""Embedding whitening by mixed-precision refinement (op11).

Entries are put on a grid (``floor(256 * c)``), so sums are exact. The model is
fitted on every distinct vector once: counts and sums in one pass, the covariance
(centred before multiplying) in another; only d x d numbers reach the driver.
Eigenvectors are computed in float32 and corrected by Ogita-Aishima iterations,
which are matrix products in float64: from ``X`` with residual ``R = I - X'X`` and
``S = X'VX`` the correction is ``E_ij = (S_ij + l_j R_ij) / (l_j - l_i)``, and
``R_ij / 2`` where the two eigenvalues cannot be told apart at the current
precision. Such clusters are then solved by themselves: the small matrix
``X_c'(V - m I)X_c`` is diagonalised in float64 and turns their vectors, until
they stand apart or coincide to working precision.

Defined results: null vectors, and vectors with null or non-finite entries, are
dropped; so are empty vectors, and vectors whose length is not the commonest
among the rest (ties: the longest). Rows with a null id are kept; repeated rows
give repeated rows. A component whose variance is not above ``d * 1e-15`` of the
trace has no whitened value and gives no rows (one distinct vector, or none: no
rows). A deviation beyond 64 bits is null. Other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrisk.session import ensure_checkpoint_dir, ship_package

GRID = 256
MAX_ITERATIONS = 30
_BLOCK = 4_096


# ------------------------------------------------------------------ eigenvectors
def _corrected(v: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """One iteration: (vectors, eigenvalues, the gap below which two eigenvalues count as one, size of the correction)."""
    r = np.eye(len(v)) - x.T @ x
    s = x.T @ v @ x
    r, s = (r + r.T) / 2.0, (s + s.T) / 2.0  # rounding must not turn two vectors apart by different angles
    lam = np.diag(s) / (1.0 - np.diag(r))
    gap = 2.0 * (np.linalg.norm(s - np.diag(lam)) + np.linalg.norm(v) * np.linalg.norm(r))
    apart = lam[None, :] - lam[:, None]
    near = np.abs(apart) <= gap
    e = np.where(near, r / 2.0, (s + lam[None, :] * r) / np.where(near, 1.0, apart))
    return x + x @ e, lam, gap, float(np.abs(e).max())


def _clusters(lam: np.ndarray, gap: float) -> list[np.ndarray]:
    """Groups of two or more eigenvalues that lie within ``gap`` of the next one."""
    order = np.argsort(lam)
    cut = np.flatnonzero(np.diff(lam[order]) > gap) + 1
    return [c for c in np.split(order, cut) if len(c) > 1]


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix, to double precision."""
    d = len(v)
    scale = float(np.abs(v).max()) if d else 0.0
    if scale == 0.0 or not np.isfinite(scale):
        return np.zeros(d), np.eye(d)
    v = (v + v.T) / (2.0 * scale)
    x = np.linalg.eigh(v.astype(np.float32))[1].astype(np.float64)
    for _ in range(MAX_ITERATIONS):
        x, lam, gap, size = _corrected(v, x)
        for c in _clusters(lam, gap):
            # the vectors of a cluster span the right space; which vectors of it, a solve of its own tells
            q = np.linalg.qr(x[:, c])[0]
            middle = lam[c].mean()
            small = q.T @ (v @ q) - middle * np.eye(len(c))
            x[:, c] = q @ np.linalg.eigh((small + small.T) / 2.0)[1]
        if size <= d * 4 * np.finfo(float).eps:
            break
    x /= np.linalg.norm(x, axis=0)
    lam = np.einsum("ij,ij->j", x, v @ x)
    order = np.argsort(-lam, kind="stable")
    return lam[order] * scale, x[:, order]


# ------------------------------------------------------------------ passes
def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def gridded(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, x): usable rows with entries on the grid, all of one length."""
    values = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    usable = rows.select(F.col(id_col).alias("id"), values.alias("c")).where(
        F.col("c").isNotNull() & (F.size("c") > 0) & F.forall("c", _finite))
    sizes = usable.groupBy(F.size("c").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).first()
    d = sizes["d"] if sizes else 0
    return usable.where(F.size("c") == d).select("id", F.transform("c", lambda c: F.floor(c * GRID)).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _summed(parts: DataFrame) -> dict[int, np.ndarray]:
    """Rows (i, values) added up by i in Spark; as many numbers as the matrix has come back."""
    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")  # sums do not depend on the order of arrival
        total = _matrix(table["values"].combine_chunks()).sum(0)
        return pa.table({"i": table["i"][:1], "values": pa.array([total], pa.list_(pa.float64()))})

    out = parts.withColumn("part", F.spark_partition_id()).groupBy("i").applyInArrow(add, "i int, values array<double>")
    return {r["i"]: np.array(r["values"]) for r in out.collect()}


def _covariance(fit: DataFrame, transform) -> np.ndarray:
    """Sum of outer products of the transformed vectors."""
    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for rb in batches:
            for start in range(0, rb.num_rows, _BLOCK):
                z = transform(_matrix(rb.column(0).slice(start, _BLOCK)))
                total = z.T @ z if total is None else total + z.T @ z
        if total is not None:
            yield pa.RecordBatch.from_pydict({"i": pa.array(range(len(total)), pa.int32()), "values": pa.array(list(total), pa.list_(pa.float64()))})

    rows = _summed(fit.mapInArrow(products, "i int, values array<double>"))
    return np.array([rows[i] for i in range(len(rows))])


@dataclass
class Whitening:
    n: int
    sums: list[int]
    values: np.ndarray  # variances of the kept components, falling
    vectors: np.ndarray  # d x k
    trace: float
    identity_error: float


def fit(x: DataFrame, components: int = 4) -> Whitening | None:
    """Learn from every distinct vector of column ``x`` once; None without a component."""
    once = x.select("x").distinct().checkpoint(eager=True)  # partial aggregation first: copies leave a task once
    n = once.count()
    if n == 0:
        return None
    d = once.select(F.size("x").alias("d")).first()["d"]
    sums = _exact_sums(once, d)
    centre = np.array([s / n for s in sums])

    cov = _covariance(once, lambda v: v.astype(np.float64) - centre) / n
    trace = float(np.trace(cov))
    values, vectors = eigen(cov)
    k = int(min(components, (values > d * 1e-15 * trace).sum())) if trace > 0 else 0
    if k == 0:
        return None
    values, vectors = values[:k], vectors[:, :k]
    # measured: the covariance of the whitened fit list
    white = _covariance(once, lambda v: ((v.astype(np.float64) - centre) @ vectors) / np.sqrt(values)) / n
    return Whitening(n, sums, values, vectors, trace, float(np.abs(white - np.eye(k)).max()))


def _exact_sums(once: DataFrame, d: int) -> list[int]:
    """Sums per dimension as integers, whatever their size."""
    decimal = F.posexplode(F.transform("x", lambda v: v.cast("decimal(38,0)"))).alias("i", "v")
    rows = once.select(decimal).groupBy("i").agg(F.sum("v").alias("s")).collect()
    out = [0] * d
    for r in rows:
        out[r["i"]] = int(r["s"])
    return out


def whiten(rows: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (id, component from 1, n, deviation, whitened, explained, identity_error)."""
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    x = gridded(rows, id_col, vector_col)
    id_type = rows.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit(x, components)
    if model is None:
        return spark.createDataFrame([], schema.replace("id ", f"`{id_col}` ", 1))
    centre, k = np.array([s / model.n for s in model.sums]), len(model.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            for start in range(0, rb.num_rows, _BLOCK):
                part = rb.slice(start, _BLOCK)
                v = _matrix(part.column(1))
                white = ((v.astype(np.float64) - centre) @ model.vectors) / np.sqrt(model.values)
                m = len(v)
                if not m:
                    continue
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, model.n), pa.int64()),
                    pa.array([x for x in _deviations(v, model.n, model.sums) for _ in range(k)], pa.int64()),
                    pa.array(white.ravel()), pa.array(np.tile(model.values / model.trace, m)), pa.array(np.full(m * k, model.identity_error))],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return x.mapInArrow(project, schema).withColumnRenamed("id", id_col)


def _deviations(v: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; null beyond 64 bits."""
    far = n * int(np.abs(v).max()) + max(abs(s) for s in sums)
    if far < 2**62 and far * far * v.shape[1] < 2**62:
        return (((n * v) - np.array(sums, np.int64)) ** 2).sum(1).tolist()
    out = []
    for row in v.tolist():
        total = sum((n * c - s) ** 2 for c, s in zip(row, sums))
        out.append(total if total < 2**63 else None)
    return out
