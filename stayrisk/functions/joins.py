"""Join helpers; no broadcast hints, Spark and AQE choose by measured bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_groups(left: DataFrame, right: DataFrame, group_cols, how: str = "inner") -> DataFrame:
    """Equi join on ``group_cols`` with a one-row-per-group table.

    With no group column the right side is a single row: its values are fetched
    (one row, a scalar-sized action) and added as literals, so no cross product
    appears in the plan.
    """
    group_cols = list(group_cols)
    if group_cols:
        return left.join(right, group_cols, how)
    row = right.first()
    if row is None:
        nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
        out = left.select("*", *nulls)
        return out.where(F.lit(False)) if how == "inner" else out
    return left.select("*", *[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in right.schema.fields])
