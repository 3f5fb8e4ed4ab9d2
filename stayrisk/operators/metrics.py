"""Threshold, ranking and calibration metrics on a scored table (MET1-19).

Input: ``scored`` with a 0/1 label ``y``, a probability ``proba`` and optional
group columns (model, fold, ...). Designs that keep the work distributed:

* threshold sweep in one aggregation: each row gets k = number of grid
  thresholds <= proba (exact ``proba >= t`` semantics, T12); a partial+final
  aggregate by (group, k) leaves <= 182 rows per group, which then expand to
  the 181 thresholds. 181 passes over the data become one.
* ranking metrics (ROC-AUC with ties, average precision, PR curve) aggregate
  by distinct score first, then use the skew-safe running sums (no window
  without partitioning, no group pinned to one task).
* quantile (decile) edges come from the distributed exact-quantile operator.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import interval_label, left_closed_bin, np_round, right_closed_bin
from ..functions.joins import join_groups
from ..functions.prefix import running_sums
from ..sources.schema import CALIBRATION_BINS, COST_FN, COST_FP, RISK_TIERS, THRESHOLD_GRID
from .quantiles import exact_quantiles


# ------------------------------------------------------------------ grid
def threshold_grid(lo: float = THRESHOLD_GRID[0], hi: float = THRESHOLD_GRID[1],
                   num: int = THRESHOLD_GRID[2]) -> list[float]:
    """MET1: evenly spaced thresholds, the same doubles as numpy.linspace."""
    return [float(x) for x in np.linspace(lo, hi, num)]


def _grid_array(grid: Sequence[float]) -> F.Column:
    return F.array(*[F.lit(float(g)) for g in grid])


def grid_bucket(proba: F.Column, grid: Sequence[float]) -> F.Column:
    """k = number of grid values <= proba, so ``proba >= grid[i]`` <=> ``k > i`` (T12).

    Arithmetic estimate on the evenly spaced grid, then a one-step correction
    against the exact grid doubles on each side.
    """
    num = len(grid)
    lo, step = grid[0], (grid[-1] - grid[0]) / (num - 1)
    garr = _grid_array(grid)
    est = F.floor((proba - F.lit(lo)) / F.lit(step)).cast("int") + F.lit(1)
    est = F.least(F.greatest(est, F.lit(0)), F.lit(num))
    up = F.when((est < num) & F.coalesce(F.try_element_at(garr, est + 1) <= proba, F.lit(False)), est + 1).otherwise(est)
    down = F.when((up > 0) & F.coalesce(F.try_element_at(garr, up) > proba, F.lit(False)), up - 1).otherwise(up)
    return down


# ------------------------------------------------------------------ sweep
def sweep(scored: DataFrame, group_cols: Sequence[str] = (), grid: Sequence[float] | None = None,
          y: str = "y", proba: str = "proba") -> DataFrame:
    """Confusion counts and F1 at every grid threshold, per group (MET2, MET3, MET17).

    Output: group cols, i, seuil, vp, fp, fn, vn, precision, rappel, f1, taux_alerte.
    """
    return _sweep(scored, list(group_cols), grid, y, proba).drop("brier")


def _sweep(scored: DataFrame, group_cols: list[str], grid: Sequence[float] | None, y: str, proba: str) -> DataFrame:
    """The sweep and, in the same pass over the scores, the group's Brier score."""
    grid = grid or threshold_grid()
    num = len(grid)
    buckets = scored.groupBy(*group_cols, grid_bucket(F.col(proba), grid).alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("long")).alias("pos"),
        F.sum(F.pow(F.col(proba) - F.col(y), 2)).alias("sq"))
    # each bucket row (<= 182 per group) expands to the thresholds it passes.
    i = F.explode(F.sequence(F.lit(0), F.lit(num - 1))).alias("i")
    expanded = buckets.select(*group_cols, "k", "n", "pos", "sq", i)
    passed = F.col("k") > F.col("i")
    agg = expanded.groupBy(*group_cols, "i").agg(
        F.sum(F.when(passed, F.col("n")).otherwise(0)).alias("pp"),
        F.sum(F.when(passed, F.col("pos")).otherwise(0)).alias("vp"),
        F.sum("n").alias("total"),
        F.sum("pos").alias("p"),
        F.sum("sq").alias("sq"),
    )
    return _from_counts(agg, group_cols, grid)


def _from_counts(agg: DataFrame, group_cols: list[str], grid: Sequence[float]) -> DataFrame:
    vp, pp, p, total = F.col("vp"), F.col("pp"), F.col("p"), F.col("total")
    fp = pp - vp
    fn = p - vp
    vn = total - p - fp
    f1 = F.coalesce(F.try_divide((F.lit(2) * vp).cast("double"), (F.lit(2) * vp + fp + fn).cast("double")), F.lit(0.0))
    return agg.select(
        *group_cols,
        F.col("i"),
        F.element_at(_grid_array(grid), F.col("i") + 1).alias("seuil"),
        vp.cast("long").alias("vp"), fp.cast("long").alias("fp"), fn.cast("long").alias("fn"), vn.cast("long").alias("vn"),
        F.coalesce(F.try_divide(vp.cast("double"), pp.cast("double")), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(vp.cast("double"), p.cast("double")), F.lit(0.0)).alias("rappel"),
        f1.alias("f1"),
        F.try_divide(pp.cast("double"), total.cast("double")).alias("taux_alerte"),
        F.try_divide(F.col("sq"), total.cast("double")).alias("brier"),
    )


def best_threshold(swept: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """MET9/MET10: argmax F1, the lowest threshold on ties. Output: group cols, i, seuil, f1."""
    group_cols = list(group_cols)
    best = _best_row(swept, group_cols, ["seuil"])
    return best.select(*group_cols, "i", "seuil", "f1")


def _best_row(swept: DataFrame, group_cols: list[str], carried: Sequence[str]) -> DataFrame:
    """The sweep row with the highest F1 (lowest threshold on ties) of each group, ``carried`` columns included."""
    row = F.struct(F.col("f1"), (-F.col("i")).alias("ni"), *carried)
    best = swept.groupBy(*group_cols).agg(F.max(row).alias("b"))
    return best.select(*group_cols, (-F.col("b.ni")).alias("i"), F.col("b.f1").alias("f1"), *[F.col(f"b.{c}").alias(c) for c in carried])


def cost_curve(swept: DataFrame, group_cols: Sequence[str] = (), cost_fn: float = COST_FN,
               cost_fp: float = COST_FP) -> DataFrame:
    """MET11: expected business cost by threshold: cost_fp * fp + cost_fn * fn."""
    return swept.select(
        *group_cols, np_round("seuil", 3).alias("seuil"), "fp", "fn",
        (F.lit(cost_fp) * F.col("fp") + F.lit(cost_fn) * F.col("fn")).alias("cout"), "f1")


# ------------------------------------------------------------------ ranking metrics
def _score_counts(scored: DataFrame, group_cols: list[str], y: str, proba: str) -> DataFrame:
    return scored.groupBy(*group_cols, F.col(proba).alias("s")).agg(
        F.sum(F.col(y).cast("double")).alias("pos"),
        F.sum((F.lit(1) - F.col(y)).cast("double")).alias("neg"),
    )


def roc_auc(scored: DataFrame, group_cols: Sequence[str] = (), y: str = "y", proba: str = "proba") -> DataFrame:
    """MET4: ROC-AUC with tied scores counted half (trapezoid). NULL for a one-class group (T17)."""
    return rank_metrics(scored, group_cols, y, proba).select(*group_cols, "roc_auc")


def _desc_cums(scored: DataFrame, group_cols: list[str], y: str, proba: str, total_cols: Sequence[str] = ()) -> DataFrame:
    sc = _score_counts(scored, group_cols, y, proba).withColumn("cnt", F.col("pos") + F.col("neg"))
    return running_sums(sc, ["s"], ["pos", "cnt"], group_cols=group_cols, out_cols=["tp_cum", "pp_cum"],
                        descending=True, total_cols=total_cols)


def average_precision(scored: DataFrame, group_cols: Sequence[str] = (), y: str = "y",
                      proba: str = "proba") -> DataFrame:
    """MET5: step-wise average precision sum((R_k - R_{k-1}) * P_k) over distinct scores (not trapezoid)."""
    return rank_metrics(scored, group_cols, y, proba).select(*group_cols, "pr_auc")


def rank_metrics(scored: DataFrame, group_cols: Sequence[str] = (), y: str = "y", proba: str = "proba") -> DataFrame:
    """MET4 and MET5 from one descending running sum of positives and rows."""
    group_cols = list(group_cols)
    cum = _desc_cums(scored, group_cols, y, proba)
    above = F.col("tp_cum") - F.col("pos")
    agg = cum.groupBy(*group_cols).agg(
        F.sum(F.col("neg") * (above + F.lit(0.5) * F.col("pos"))).alias("roc"),
        F.sum(F.col("pos") * F.col("tp_cum") / F.col("pp_cum")).alias("ap"),
        F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return agg.select(*group_cols, F.try_divide(F.col("roc"), F.col("P") * F.col("N")).alias("roc_auc"),
                      F.try_divide(F.col("ap"), F.col("P")).alias("pr_auc"))


def brier(scored: DataFrame, group_cols: Sequence[str] = (), y: str = "y", proba: str = "proba") -> DataFrame:
    """MET6: mean squared error of the probability."""
    return scored.groupBy(*group_cols).agg(F.avg(F.pow(F.col(proba) - F.col(y), 2)).alias("brier"))


def pr_curve(scored: DataFrame, group_cols: Sequence[str] = (), y: str = "y", proba: str = "proba") -> DataFrame:
    """MET18: precision / recall at each distinct score, plus the final (precision 1, recall 0) point."""
    group_cols = list(group_cols)
    pts = _desc_cums(scored, group_cols, y, proba, total_cols=["P"])
    totals = pts.groupBy(*group_cols).agg(F.sum("pos").alias("P"))
    curve = pts.select(
        *group_cols, F.col("s").alias("seuil"),
        F.coalesce(F.try_divide(F.col("tp_cum"), F.col("pp_cum")), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(F.col("tp_cum"), F.col("P")), F.lit(1.0)).alias("rappel"),
    )
    end = totals.select(*group_cols, F.lit(None).cast("double").alias("seuil"),
                        F.lit(1.0).alias("precision"), F.lit(0.0).alias("rappel"))
    return curve.unionByName(end)


# ------------------------------------------------------------------ metric rows
def metrics_at(scored: DataFrame, thresholds: DataFrame, group_cols: Sequence[str] = (), y: str = "y",
               proba: str = "proba") -> DataFrame:
    """MET8: the 12-column metric row per group at a given threshold (``thresholds``: group cols + seuil)."""
    group_cols = list(group_cols)
    t = thresholds.select(*group_cols, F.col("seuil").alias("__t"))
    joined = join_groups(scored, t, group_cols)  # one row per group
    pred = (F.col(proba) >= F.col("__t")).cast("long")
    yy = F.col(y).cast("long")
    counts = joined.groupBy(*group_cols).agg(
        F.first("__t").alias("seuil"),
        F.sum(pred * yy).alias("vp"), F.sum(pred * (1 - yy)).alias("fp"),
        F.sum((1 - pred) * yy).alias("fn"), F.sum((1 - pred) * (1 - yy)).alias("vn"),
        F.avg(F.pow(F.col(proba) - F.col(y), 2)).alias("brier"),
    )
    vp, fp, fn, vn = (F.col(c) for c in ("vp", "fp", "fn", "vn"))
    base = counts.select(
        *group_cols,
        np_round("seuil", 3).alias("seuil"),
        F.coalesce(F.try_divide((2 * vp).cast("double"), (2 * vp + fp + fn).cast("double")), F.lit(0.0)).alias("f1"),
        F.coalesce(F.try_divide(vp.cast("double"), (vp + fp).cast("double")), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(vp.cast("double"), (vp + fn).cast("double")), F.lit(0.0)).alias("rappel"),
        "brier", "vp", "fp", "fn", "vn",
        ((vp + fp) / (vp + fp + fn + vn)).alias("taux_alerte"),
    )
    out = join_groups(base, rank_metrics(scored, group_cols, y, proba), group_cols, "left")
    return out.select(*group_cols, "seuil", "f1", "precision", "rappel", "roc_auc", "pr_auc", "brier",
                      "vp", "fp", "fn", "vn", "taux_alerte")


def best_metrics(scored: DataFrame, group_cols: Sequence[str] = (), y: str = "y", proba: str = "proba") -> DataFrame:
    """Per group: best-F1 threshold on the grid with its metric row (MET8+MET9).

    Two passes over the scores: the sweep holds the counts and the Brier score,
    one running sum gives both ranking metrics.
    """
    group_cols = list(group_cols)
    carried = ["seuil", "precision", "rappel", "brier", "vp", "fp", "fn", "vn", "taux_alerte"]
    best = _best_row(_sweep(scored, group_cols, None, y, proba), group_cols, carried)
    out = join_groups(best.withColumn("seuil", np_round("seuil", 3)), rank_metrics(scored, group_cols, y, proba), group_cols, "left")
    return out.select(*group_cols, "seuil", "f1", "precision", "rappel", "roc_auc", "pr_auc", "brier",
                      "vp", "fp", "fn", "vn", "taux_alerte")


def summarize_folds(per_fold: DataFrame, model_col: str = "modele",
                    metrics: Sequence[str] = ("f1", "precision", "rappel", "roc_auc", "pr_auc"),
                    first_seen: Sequence[str] = ()) -> DataFrame:
    """MET12: mean and sample std (ddof 1) of each metric by model, rounded to 4.

    ``first_seen`` names the columns that order the rows of ``per_fold``; models then carry ``ordre``, from 1,
    by their first row in that order.
    """
    if first_seen:
        first = per_fold.groupBy(model_col).agg(F.min(F.struct(*first_seen)).alias("__first"))  # a row a model
        order = first.select(F.col(model_col).alias("__model"), F.row_number().over(Window.orderBy("__first")).alias("ordre"))
        summary = summarize_folds(per_fold, model_col, metrics)
        return summary.join(order, F.col(model_col) == F.col("__model")).drop("__model")
    aggs = []
    for m in metrics:
        aggs += [np_round(F.avg(m), 4).alias(f"{m}_mean"), np_round(F.stddev_samp(m), 4).alias(f"{m}_std")]
    return per_fold.groupBy(model_col).agg(*aggs)


def round_report(df: DataFrame, digits: int = 4, keep: Sequence[str] = ()) -> DataFrame:
    """numpy-style rounding of every double column (MET13 report rounding)."""
    out = []
    for f in df.schema.fields:
        if f.dataType.typeName() == "double" and f.name not in keep:
            out.append(np_round(f.name, digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


# ------------------------------------------------------------------ calibration / deciles / tiers
def calibration(scored: DataFrame, group_cols: Sequence[str] = (), edges: Sequence[float] = CALIBRATION_BINS,
                y: str = "y", proba: str = "proba") -> DataFrame:
    """MET14: right-closed probability bins: size, mean probability, observed rate (rounded to 3)."""
    labels = [interval_label(float(edges[i - 1]), float(edges[i])) for i in range(1, len(edges))]
    binned = scored.select(*group_cols, right_closed_bin(proba, edges, labels).alias("tranche"), y, proba)
    return binned.where(F.col("tranche").isNotNull()).groupBy(*group_cols, "tranche").agg(
        F.count(F.lit(1)).alias("n"),
        np_round(F.avg(proba), 3).alias("proba_moyenne"),
        np_round(F.avg(y), 3).alias("taux_reel"),
    )


DECILE_PROBS = [i / 10 for i in range(0, 10)]  # 0 = lowest edge, then the 9 inner edges


def decile_edges(scored: DataFrame, group_cols: Sequence[str] = (), proba: str = "proba") -> DataFrame:
    """Exact interpolated quantile edges at 0, 0.1..0.9 (distributed, no single-task buffer)."""
    return exact_quantiles(scored, proba, DECILE_PROBS, group_cols, prefix="e")


def deciles(scored: DataFrame, group_cols: Sequence[str] = (), y: str = "y", proba: str = "proba",
            duplicates: str = "drop") -> DataFrame:
    """MET15: qcut-style deciles (right-closed, duplicate edges dropped), n, mean proba, rate, lift, share.

    The edge table has one row per group. ``duplicates="raise"`` raises on equal edges instead of dropping them.
    """
    group_cols = list(group_cols)
    edges = decile_edges(scored, group_cols, proba)
    e = [F.col(f"e{j}") for j in range(len(DECILE_PROBS))]
    if duplicates == "raise":
        equal = [e[j] == e[j - 1] for j in range(1, len(e))]
        if not edges.where(F.greatest(*[x.cast("int") for x in equal]) == 1).isEmpty():
            raise ValueError("decile edges are not unique")
    joined = join_groups(scored, edges, group_cols)
    # bin = number of distinct edges strictly below proba (sorted edges: a duplicate
    # equals its predecessor), the lowest value falls in bin 1 (include_lowest).
    below = None
    for j, ej in enumerate(e):
        distinct = F.lit(True) if j == 0 else ej > e[j - 1]
        term = F.when((ej < F.col(proba)) & distinct, 1).otherwise(0)
        below = term if below is None else below + term
    d = joined.select(*group_cols, F.greatest(below, F.lit(1)).alias("decile"), y, proba)
    per = d.groupBy(*group_cols, "decile").agg(
        F.count(F.lit(1)).alias("n"), F.avg(proba).alias("__pm"), F.avg(y).alias("__rate"),
        F.sum(y).alias("__pos"))
    w = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy()
    tot_n, tot_pos = F.sum("n").over(w), F.sum("__pos").over(w)
    overall = tot_pos / tot_n
    return per.select(
        *group_cols, "decile", "n",
        np_round("__pm", 3).alias("proba_moyenne"),
        np_round("__rate", 3).alias("taux_reel"),
        np_round(F.col("__rate") / overall, 2).alias("lift"),
        np_round(F.col("__pos") / tot_pos, 3).alias("part_annulations"),
    )


def risk_tiers(scored: DataFrame, group_cols: Sequence[str] = (), tiers=RISK_TIERS, y: str = "y",
               proba: str = "proba") -> DataFrame:
    """MET16: left-closed tiers [lo, hi): volume share, observed rate, share of cancellations captured."""
    group_cols = list(group_cols)
    tagged = scored.select(*group_cols, left_closed_bin(proba, tiers).alias("niveau"), y)
    per = tagged.groupBy(*group_cols, "niveau").agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("__pos"))
    w = Window.partitionBy(*group_cols) if group_cols else Window.partitionBy()
    per = per.select("*", F.sum("n").over(w).alias("__tn"), F.sum("__pos").over(w).alias("__tp"))
    return per.where(F.col("niveau").isNotNull()).select(
        *group_cols, "niveau", "n",
        np_round(F.col("n") / F.col("__tn"), 6).alias("volume"),
        np_round(F.col("__pos") / F.col("n"), 6).alias("taux_reel"),
        np_round(F.col("__pos") / F.col("__tp"), 6).alias("part_annulations"),
    )


def gain(best: DataFrame, model: str, reference: str, model_col: str = "model") -> DataFrame:
    """MET19: F1 gain of ``model`` over ``reference`` from a per-model best-threshold table (2 rows)."""
    a = best.where(F.col(model_col) == model).select(F.col("f1").alias("f1_modele"))
    b = best.where(F.col(model_col) == reference).select(F.col("f1").alias("f1_reference"))
    return join_groups(a, b, []).select(
        (F.col("f1_modele") - F.col("f1_reference")).alias("gain_f1"), "f1_modele", "f1_reference")
