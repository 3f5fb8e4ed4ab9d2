"""Column-expression helpers shared by the operators (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: str | Column, den: str | Column) -> Column:
    """Division returning NULL on a zero or null divisor (ANSI mode would raise)."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def flag(cond: Column) -> Column:
    """Boolean condition -> 0/1 int, NULL comparisons count as false (pandas semantics)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def np_round(c: str | Column, digits: int) -> Column:
    """numpy-style rounding (round half to even on x * 10**k)."""
    scale = float(10 ** digits)
    return F.rint(col(c) * F.lit(scale)) / F.lit(scale)


def py_round(c: str | Column, digits: int) -> Column:
    """Python's ``round``: the double's exact value decides, half to even only on exact ties.

    ``x * 10**k`` is split into the rounded product and its exact error
    (two-product by splitting x), which breaks apparent ties.
    """
    x, scale = col(c), float(10 ** digits)
    p = x * F.lit(scale)
    t = x * F.lit(134217729.0)
    hi = t - (t - x)
    error = (hi * F.lit(scale) - p) + (x - hi) * F.lit(scale)
    tie = p - F.floor(p) == 0.5
    r = F.when(tie & (error > 0), F.floor(p) + 1).when(tie & (error < 0), F.floor(p)).otherwise(F.rint(p))
    return r / F.lit(scale)


def right_closed_bin(c: str | Column, edges: Sequence[float], labels: Sequence | None = None) -> Column:
    """Index (or label) of the right-closed bin (e[i-1], e[i]] holding c; NULL outside."""
    x = col(c)
    expr = None
    for i in range(1, len(edges)):
        label = F.lit(labels[i - 1] if labels is not None else i - 1)
        cond = (x > F.lit(edges[i - 1])) & (x <= F.lit(edges[i]))
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def interval_label(lo: float, hi: float) -> str:
    """Text label of a right-closed interval as pandas prints it: integer edges stay integers."""
    if isinstance(lo, int) and isinstance(hi, int):
        return f"({lo}, {hi}]"
    return f"({float(lo)}, {float(hi)}]"


def left_closed_bin(c: str | Column, bounds: Sequence[tuple[str, float, float]]) -> Column:
    """Label of the first left-closed bin [lo, hi) holding c; NULL outside."""
    x = col(c)
    expr = None
    for label, lo, hi in bounds:
        cond = (x >= F.lit(lo)) & (x < F.lit(hi))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def map_values(c: str | Column, mapping: dict) -> Column:
    """Literal dictionary lookup; values outside the map give NULL."""
    x = col(c)
    expr = None
    for k, v in mapping.items():
        expr = F.when(x == F.lit(k), F.lit(v)) if expr is None else expr.when(x == F.lit(k), F.lit(v))
    return expr
