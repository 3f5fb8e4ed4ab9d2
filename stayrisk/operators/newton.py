"""Logistic regression by Newton steps on one aggregate, many models in shared passes (MOD1, MOD2, ENS5).

A step sums, for every model, ``X'(p - y)`` and ``X'WX`` over the rows (at most
columns^2 numbers a model) in one pass; the driver solves the small systems.
The objective is the reference's: ``0.5 |w|^2 + C * sum(log loss)``, intercept
unpenalised. It is strictly convex, so the coefficients do not depend on the
path; a step that does not lower it is halved. Models of one task read the same
rows and take their own columns of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package
from .boosting import FLAT_PARTITIONS, partitions_for

#: Rows whose products are formed at once, steps at most, and the gradient (largest entry, relative to 1 + |w|) at which a model is done.
BLOCK_ROWS, MAX_STEPS, TOLERANCE = 4_096, 100, 1e-10
#: Bytes of the rows' numbers in a partition before they are compressed, at most about, and how a chunk's numbers are compressed.
PART_BYTES, CODEC = 128 * 2**20, "zstd"


@dataclass(frozen=True)
class LogisticFit:
    name: str
    task: int
    c: float
    columns: tuple[int, ...]  # places in the task's rows


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, list] = {}

    def chunk(task):
        y, x = (np.concatenate(p) for p in zip(*held.pop(task)))
        # column by column: one-hot slots and columns of few values take next to nothing
        cells = pa.compress(np.ascontiguousarray(x.T).tobytes(), codec=CODEC, asbytes=True)
        return pa.RecordBatch.from_pydict({"task": pa.array([task], pa.int32()), "n": pa.array([len(y)], pa.int32()),
                                           "width": pa.array([x.shape[1]], pa.int32()), "y": [y.tobytes()], "x": [cells]})

    for rb in batches:
        tasks, y = rb.column(0).to_numpy(), rb.column(1).to_numpy()
        for task in map(int, np.unique(tasks)):
            at = np.flatnonzero(tasks == task)
            x = rb.column(2).take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), -1)
            held.setdefault(task, []).append((y[at], x))
            if sum(len(v) for v, _ in held[task]) >= BLOCK_ROWS:
                yield chunk(task)
    for task in sorted(held):
        yield chunk(task)


def _moments(asked: dict[int, list[tuple[int, np.ndarray, np.ndarray]]]):
    """Partition function: {model: (log loss, X'(p - y), X'WX)} with the intercept as first column."""
    def run(chunks):
        out = {}
        for task, n, width, y, x in chunks:
            y = np.frombuffer(y)
            cells = pa.decompress(x, decompressed_size=n * width * 8, codec=CODEC, asbytes=True)
            x = np.column_stack([np.ones(n), np.frombuffer(cells).reshape(width, n).T])
            for i, columns, w in asked.get(task, ()):
                own = x[:, columns]
                z = own @ w
                p = 1.0 / (1.0 + np.exp(-z))
                got = (float(np.logaddexp(0, z).sum() - y @ z), own.T @ (p - y), (own * (p * (1 - p))[:, None]).T @ own)
                out[i] = tuple(a + b for a, b in zip(out[i], got)) if i in out else got
        yield out
    return run


def _added(a: dict, b: dict) -> dict:
    return {m: tuple(u + v for u, v in zip(a[m], b[m])) if m in a and m in b else a.get(m, b.get(m)) for m in {*a, *b}}


def solve(rows: DataFrame, fits: list[LogisticFit]) -> dict[tuple[str, int], np.ndarray]:
    """Coefficients (intercept first) of every fit on ``rows`` (task int, key long, y double, x array<double> without nulls)."""
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    rows = rows.select(F.col("task").cast("int"), F.col("y").cast("double"), "x")
    n, width = rows.count(), 1 + max((c for f in fits for c in f.columns), default=-1)  # counted without the vectors
    parts = max(partitions_for(n, spark.sparkContext.defaultParallelism), math.ceil(n * width * 8 / PART_BYTES))
    # rows are packed where they are read: what is sent, and kept once, are compressed chunks
    packed = rows.mapInArrow(_pack, "task int, n int, width int, y binary, x binary").repartition(parts).checkpoint(eager=True)
    chunks = packed.rdd.map(tuple)

    columns = [np.array([0, *(c + 1 for c in f.columns)]) for f in fits]
    w = [np.zeros(len(c)) for c in columns]
    at: list[tuple | None] = [None] * len(fits)  # (objective, weights) of the last accepted point
    step = [np.zeros(len(c)) for c in columns]
    todo = set(range(len(fits)))
    for _ in range(MAX_STEPS):
        if not todo:
            break
        asked: dict[int, list] = {}
        for i in sorted(todo):
            asked.setdefault(fits[i].task, []).append((i, columns[i], w[i]))
        sums = chunks.mapPartitions(_moments(asked))
        if parts > FLAT_PARTITIONS:
            total = sums.treeReduce(_added)
        else:
            total = {}
            for part in sums.collect():
                total = _added(total, part)
        for i in sorted(todo):
            if i not in total:  # a task without rows
                todo.discard(i)
                continue
            loss, g, h = total[i]
            c, penalty = fits[i].c, np.r_[0.0, w[i][1:]]
            value = c * loss + 0.5 * float(penalty @ penalty)
            if at[i] is not None and value > at[i][0] + 1e-12 * abs(at[i][0]):
                step[i] /= 2
                w[i] = at[i][1] + step[i]
                if np.abs(step[i]).max() < 1e-12:
                    todo.discard(i)
                continue
            at[i] = (value, w[i].copy())
            gradient = c * g + penalty
            if np.abs(gradient).max() <= TOLERANCE * (1 + np.abs(w[i]).max()) * max(1.0, c):
                todo.discard(i)
                continue
            ridge = np.diag(np.r_[1e-12, np.ones(len(g) - 1)])
            step[i] = -np.linalg.solve(c * h + ridge, gradient)
            w[i] = w[i] + step[i]
    return {(f.name, f.task): (at[i][1] if at[i] is not None else w[i]) for i, f in enumerate(fits)}
