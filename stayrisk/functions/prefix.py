"""Skew-safe running sums (ordered prefix sums), global or per group.

A plain ``Window.partitionBy(g).orderBy(o)`` sends a whole group to one task,
and a window without ``partitionBy`` sends the whole table to one task. Both
break when one group holds a large share of the rows. Here the rows are range
partitioned on ``(group, order)`` so a hot group spreads over many tasks:

1. ``repartitionByRange`` on ``(group, order)``; the partition number becomes
   a column;
2. a window per (partition number, group) computes the local running sums;
3. the totals per (partition number, group), summed over earlier partitions,
   are the carry. Only the group that continues from an earlier partition has
   one, so there are fewer carries than partitions and they are broadcast.

The ranged rows are checkpointed (reliable, in the shared checkpoint folder):
the range bounds come from a sample, and both consumers, or a recomputation
after a lost executor, must see the same partition numbers. All steps are
DataFrame operations; the columns carried along are not touched.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_PID = "__pid"


def running_sums(
    df: DataFrame,
    order_cols: Sequence[str],
    sum_cols: Sequence[str],
    group_cols: Sequence[str] = (),
    out_cols: Sequence[str] | None = None,
    descending: bool = False,
    num_partitions: int | None = None,
    total_cols: Sequence[str] = (),
) -> DataFrame:
    """Add inclusive running sums of ``sum_cols`` within ``group_cols`` ordered by ``order_cols``.

    ``order_cols`` must make the order total inside a group (add an id as tie-break).
    Output columns are doubles named ``out_cols`` (default ``<col>_cum``); nulls count as 0.
    ``total_cols`` names columns for the group totals of the first ``sum_cols``; they are joined by
    (partition number, group), so a hot group's rows do not meet in one task.
    """
    group_cols, order_cols, sum_cols = list(group_cols), list(order_cols), list(sum_cols)
    out_cols = list(out_cols) if out_cols is not None else [f"{c}_cum" for c in sum_cols]
    order = [(F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first()) for c in order_cols]
    keys = [F.col(c).asc_nulls_first() for c in group_cols] + order
    # Without an explicit count the range shuffle uses spark.sql.shuffle.partitions and AQE may
    # coalesce adjacent (still ordered) partitions from measured sizes.
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    ensure_checkpoint_dir(df.sparkSession)
    ranged = ranged.withColumn(_PID, F.spark_partition_id()).checkpoint(eager=True)

    values = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in sum_cols]
    local = Window.partitionBy(_PID, *group_cols).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = ranged.select("*", *[F.sum(v).over(local).alias(o) for v, o in zip(values, out_cols)])

    # one row per (partition, group); per group at most as many rows as partitions
    earlier = Window.partitionBy(*group_cols).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(_PID, *group_cols).agg(*[F.sum(v).alias(f"__t{i}") for i, v in enumerate(values)])
    carry = totals.select(F.col(_PID).alias("__cpid"), *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group_cols)],
                          *[F.sum(f"__t{i}").over(earlier).alias(f"__c{i}") for i in range(len(values))],
                          *[F.sum(f"__t{i}").over(Window.partitionBy(*group_cols)).alias(t) for i, t in enumerate(total_cols)])
    if not total_cols:
        carry = F.broadcast(carry.where(F.col("__c0").isNotNull()))  # fewer rows than partitions
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(group_cols)],
                  F.col(_PID) == F.col("__cpid"))
    joined = rows.join(carry, same, "left")
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[(F.col(o) + F.coalesce(F.col(f"__c{i}"), F.lit(0.0))).alias(o) for i, o in enumerate(out_cols)],
        *[F.col(t) for t in total_cols])


def row_positions(df: DataFrame, order_cols: Sequence[str], name: str = "pos",
                  group_cols: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """0-based position of each row in ``order_cols`` order (optionally within groups)."""
    with_one = df.withColumn("__one", F.lit(1))
    out = running_sums(with_one, order_cols, ["__one"], group_cols=group_cols, out_cols=["__cnt"],
                       num_partitions=num_partitions)
    return out.withColumn(name, (F.col("__cnt") - 1).cast("long")).drop("__one", "__cnt")


def previous_value(df: DataFrame, order_cols: Sequence[str], value: str, name: str) -> DataFrame:
    """Add ``value`` of the row before in ``order_cols`` order (null for the first row).

    The same scan as the running sums, carrying a row instead of a sum: a lag inside each
    range partition, and for its first row the last value of the nearest earlier partition that has rows.
    """
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(*order).withColumn(_PID, F.spark_partition_id()).checkpoint(eager=True)
    local = Window.partitionBy(_PID).orderBy(*order)
    rows = ranged.select("*", F.row_number().over(local).alias("__rn"), F.lag(value).over(local).alias(name))
    last = ranged.groupBy(_PID).agg(F.max_by(F.struct(value), F.struct(*order_cols)).alias("__last"))
    carry = last.select(F.col(_PID).alias("__cpid"), F.lag(F.col("__last")[value]).over(Window.orderBy(_PID)).alias("__before"))
    joined = rows.join(F.broadcast(carry), F.col(_PID) == F.col("__cpid"), "left")  # a row a partition
    return joined.select(*[F.col(c) for c in df.columns],
                         F.when(F.col("__rn") == 1, F.col("__before")).otherwise(F.col(name)).alias(name))
