"""Exact, linearly interpolated quantiles without a single-task buffer.

``F.median``/``percentile`` are exact but merge one value->count map per group
in one task: fine per hotel, not for a global quantile over the whole table.
Here the distinct values are counted (map-side combine), ranked with the
skew-safe running sum, and only the rows that straddle the wanted positions
survive; the result is the same interpolation as numpy's default ``linear``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.prefix import running_sums


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], group_cols: Sequence[str] = (),
                    prefix: str = "q", mean_at_half: bool = False) -> DataFrame:
    """One row per group with columns ``{prefix}0..`` = interpolated quantiles of ``value`` (nulls skipped)."""
    group_cols = list(group_cols)
    v = df.select(*group_cols, F.col(value).cast("double").alias("__v")).where(F.col("__v").isNotNull())
    counts = v.groupBy(*group_cols, "__v").agg(F.count(F.lit(1)).cast("double").alias("__c"))
    ranked = running_sums(counts, ["__v"], ["__c"], group_cols=group_cols, out_cols=["__cum"], total_cols=["__n"])
    return _interpolated(ranked, probs, group_cols, prefix, mean_at_half)


def counted_quantiles(counts: DataFrame, value: str, count: str, probs: Sequence[float], group_cols: Sequence[str],
                      prefix: str = "q", mean_at_half: bool = False) -> DataFrame:
    """:func:`exact_quantiles` of distinct, non-null values that are counted already, for a bounded number of groups
    (columns, folds): their totals are broadcast, so the counts are sent once."""
    group_cols = list(group_cols)
    c = counts.select(*group_cols, F.col(value).alias("__v"), F.col(count).alias("__c"))
    ranked = running_sums(c, ["__v"], ["__c"], group_cols=group_cols, out_cols=["__cum"])
    totals = c.groupBy(*group_cols).agg(F.sum("__c").alias("__n"))
    return _interpolated(ranked.join(F.broadcast(totals), group_cols), probs, group_cols, prefix, mean_at_half)


def _interpolated(ranked: DataFrame, probs: Sequence[float], group_cols: list[str], prefix: str, mean_at_half: bool) -> DataFrame:
    """Quantiles of ranked distinct values (__v, its count __c, the running count __cum, the group's count __n)."""
    # Position window of each distinct value: [cum - c, cum - 1] (0-based).
    first = F.col("__cum") - F.col("__c")
    last = F.col("__cum") - F.lit(1.0)
    hits = []
    for i, p in enumerate(probs):
        h = (F.col("__n") - F.lit(1.0)) * F.lit(float(p))
        lo = F.floor(h)
        hi = F.least(lo + F.lit(1.0), F.col("__n") - F.lit(1.0))
        frac = h - lo
        for side, pos in (("lo", lo), ("hi", hi)):
            hits.append(F.when((first <= pos) & (pos <= last),
                               F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), frac.alias("frac"))))
    exploded = ranked.select(*group_cols, "__v", F.explode(F.filter(F.array(*hits), lambda x: x.isNotNull())).alias("h"))
    picked = exploded.groupBy(*group_cols, F.col("h.i").alias("i")).agg(
        F.max(F.when(F.col("h.side") == "lo", F.col("__v"))).alias("a"),
        F.max(F.when(F.col("h.side") == "hi", F.col("__v"))).alias("b"),
        F.max("h.frac").alias("t"),
    )
    a, b, t = F.col("a"), F.col("b"), F.col("t")
    # numpy's lerp: a + (b - a) * t, computed from the nearer end for t >= 0.5.
    q = F.when(t >= 0.5, b - (b - a) * (F.lit(1.0) - t)).otherwise(a + (b - a) * t)
    if mean_at_half:  # numpy's median averages the two middle values
        q = F.when(t == 0.5, (a + b) / F.lit(2.0)).otherwise(q)
    wide = picked.groupBy(*group_cols).agg(
        *[F.max(F.when(F.col("i") == i, q)).alias(f"{prefix}{i}") for i in range(len(probs))]
    )
    return wide


def exact_median(df: DataFrame, value: str, group_cols: Sequence[str] = (), name: str = "median") -> DataFrame:
    """Median as the mean of the two middle values (pandas/numpy semantics)."""
    group_cols = list(group_cols)
    qs = exact_quantiles(df, value, [0.5], group_cols, mean_at_half=True)
    return qs.withColumnRenamed("q0", name)
