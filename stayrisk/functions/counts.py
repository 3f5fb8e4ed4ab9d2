"""Distinct values of many numeric columns, counted in one pass over the rows.

A row's numbers come as one array, so no row is exploded into one record a column: a task counts each column's distinct
values in blocks of ``BLOCK_ROWS`` rows, and Spark adds the blocks' counts up by (task, column, value).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

#: Rows whose values are counted at once.
BLOCK_ROWS = 65_536


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[int, list] = {}

    def block(task: int) -> pa.RecordBatch:
        parts = held.pop(task)
        x = np.concatenate([p[0] for p in parts]).T + 0.0  # -0.0 is 0.0
        null = np.concatenate([p[1] for p in parts]).T
        f, v, c, absent = [], [], [], []
        for i, own in enumerate(x):
            gone = int(null[i].sum())
            values, counts = np.unique(own[~null[i]] if gone else own, return_counts=True)
            if gone:
                values, counts = np.append(values, 0.0), np.append(counts, gone)
            f.append(np.full(len(values), i, np.int32)), v.append(values), c.append(counts)
            absent.append(np.arange(len(values)) >= len(values) - bool(gone))
        f, v, c, absent = (np.concatenate(p) if p else np.zeros(0) for p in (f, v, c, absent))
        return pa.RecordBatch.from_pydict({"task": pa.array(np.full(len(f), task, np.int32)), "f": pa.array(f, pa.int32()),
                                           "v": pa.array(v, pa.float64(), mask=absent.astype(bool)), "c": pa.array(c, pa.int64())})

    for rb in batches:
        tasks = rb.column(0).to_numpy()
        for task in map(int, np.unique(tasks)):
            at = np.flatnonzero(tasks == task)
            flat = (rb.column(1) if len(at) == len(tasks) else rb.column(1).take(pa.array(at))).flatten()
            null = flat.is_null().to_numpy(zero_copy_only=False)
            x = flat.to_numpy(zero_copy_only=False).astype(float)
            held.setdefault(task, []).append((x.reshape(len(at), -1), null.reshape(len(at), -1)))
            if sum(len(p) for p, _ in held[task]) >= BLOCK_ROWS:
                yield block(task)
    for task in sorted(held):
        yield block(task)


def value_counts(rows: DataFrame) -> DataFrame:
    """(task, f, v, c) of ``rows`` (task int, x array<double> of one length a task): how many rows hold v at place f.

    Missing values count too, as v NULL; a NaN is a value. ``c`` is a double.
    """
    ship_package(rows.sparkSession)
    parts = rows.select("task", "x").mapInArrow(_counted, "task int, f int, v double, c long")
    return parts.groupBy("task", "f", "v").agg(F.sum("c").cast("double").alias("c"))
