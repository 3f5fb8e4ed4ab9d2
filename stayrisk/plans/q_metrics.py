"""Registered queries: threshold / ranking / calibration metrics (MET1-19) and the ensemble (ENS1-2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import np_round
from ..operators import ensemble as ens
from ..operators import metrics as M
from ..oracle_sql import r, with_fixture
from ..registry import query
from ..sources import fixture
from ..sources.schema import TARGET

# ------------------------------------------------------------------ inputs
BASELINE_MODEL = "baseline_taux"
ENS_WEIGHTS = {"fixture": 0.50, BASELINE_MODEL: 0.25, "absent": 0.25}


def scored_oof(spark, sf):
    """Validation rows of the 4 temporal folds with the stand-in score: (model, fold, reservation_id, y, proba)."""
    from .inputs import fold_table

    folds = fold_table(spark, sf).where(F.col("role") == "val")
    return folds.select(F.lit("fixture").alias("model"), "fold", "reservation_id", F.col(TARGET).alias("y"), "proba")


def scored_models(spark, sf):
    """Two scorers over every booking: the stand-in score and a rate-by-(deposit, refund) baseline."""
    res = fixture.reservations(spark, sf)
    rates = res.filter(fixture.is_train()).groupBy("type_acompte", "tarif_remboursable").agg(
        F.avg(TARGET).alias("__rate"))
    base = res.join(rates, ["type_acompte", "tarif_remboursable"], "left").select(
        F.lit(BASELINE_MODEL).alias("model"), "reservation_id", F.col(TARGET).alias("y"),
        F.coalesce(F.col("__rate"), F.lit(0.0)).alias("proba"))
    fx = res.select(F.lit("fixture").alias("model"), "reservation_id", F.col(TARGET).alias("y"), "proba")
    return fx.unionByName(base)


ORACLE_INPUTS = """
oof AS (
  SELECT 'fixture' AS model, a.fold, a.reservation_id, a.reservation_annulee AS y, s.proba
  FROM assigned a JOIN res s ON a.reservation_id = s.reservation_id WHERE a.role = 'val'),
rates AS (SELECT type_acompte, tarif_remboursable, avg(reservation_annulee) AS rate FROM train_raw
          GROUP BY type_acompte, tarif_remboursable),
models AS (
  SELECT 'fixture' AS model, reservation_id, reservation_annulee AS y, proba FROM res
  UNION ALL
  SELECT 'baseline_taux', x.reservation_id, x.reservation_annulee, coalesce(rt.rate, 0.0E0)
  FROM res x LEFT JOIN rates rt ON x.type_acompte = rt.type_acompte AND x.tarif_remboursable = rt.tarif_remboursable),
grid AS (SELECT cast(i AS int) AS i, CASE WHEN i = 180 THEN 0.95E0 ELSE i * ((0.95E0 - 0.05E0) / 180) + 0.05E0 END AS seuil
         FROM range(181) r(i))
"""


def _ctes(extra: str = "") -> str:
    from .q_data import FOLD_CTES

    out = FOLD_CTES.strip() + ",\n" + ORACLE_INPUTS.strip()
    return out + (",\n" + extra.strip() if extra.strip() else "")


def _g(groups: list[str], alias: str = "") -> str:
    return "".join(f"{alias}{g}, " for g in groups)


def sweep_sql(src: str, groups: list[str]) -> str:
    gs, gb = _g(groups, "s."), ", ".join([*(f"s.{g}" for g in groups), "g.i", "g.seuil"])
    return f"""
SELECT {_g(groups)} i, seuil, vp, fp, fn, vn,
  coalesce(vp / nullif(vp + fp, 0), 0.0E0) AS precision,
  coalesce(vp / nullif(vp + fn, 0), 0.0E0) AS rappel,
  coalesce(2 * vp / nullif(2 * vp + fp + fn, 0), 0.0E0) AS f1,
  (vp + fp) / nullif(vp + fp + fn + vn, 0) AS taux_alerte
FROM (SELECT {gs} g.i, g.seuil,
        count(CASE WHEN s.proba >= g.seuil AND s.y = 1 THEN 1 END) AS vp,
        count(CASE WHEN s.proba >= g.seuil AND s.y = 0 THEN 1 END) AS fp,
        count(CASE WHEN s.proba < g.seuil AND s.y = 1 THEN 1 END) AS fn,
        count(CASE WHEN s.proba < g.seuil AND s.y = 0 THEN 1 END) AS vn
      FROM {src} s, grid g GROUP BY {gb})"""


def best_sql(sw: str, groups: list[str]) -> str:
    part = f"PARTITION BY {', '.join(groups)}" if groups else ""
    gb = f"GROUP BY {', '.join(groups)}" if groups else ""
    join = " AND ".join([*(f"b.{g} = w.{g}" for g in groups), "b.i = w.i"])
    return f"""
SELECT {_g(groups, 'w.')} w.i, w.seuil, w.f1 FROM {sw} w JOIN (
  SELECT {_g(groups)} min(i) AS i FROM (SELECT *, max(f1) OVER ({part}) AS mf FROM {sw}) WHERE f1 = mf {gb}) b
ON {join}"""


def auc_sql(src: str, groups: list[str]) -> str:
    part = f"PARTITION BY {', '.join(groups)}" if groups else ""
    gb = f"GROUP BY {', '.join(groups)}" if groups else ""
    return f"""
SELECT {_g(groups)} sum(pos * (below + 0.5E0 * neg)) / (sum(pos) * sum(neg)) AS roc_auc FROM (
  SELECT *, coalesce(sum(neg) OVER ({part} ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM (SELECT {_g(groups)} proba AS s, cast(sum(y) AS double) AS pos, cast(sum(1 - y) AS double) AS neg
        FROM {src} GROUP BY {_g(groups)} proba)) {gb}"""


def ap_sql(src: str, groups: list[str]) -> str:
    part = f"PARTITION BY {', '.join(groups)}" if groups else ""
    gb = f"GROUP BY {', '.join(groups)}" if groups else ""
    return f"""
SELECT {_g(groups)} sum(pos * tp / pp) / nullif(sum(pos), 0) AS pr_auc FROM (
  SELECT *, sum(pos) OVER ({part} ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS tp,
            sum(pos + neg) OVER ({part} ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS pp
  FROM (SELECT {_g(groups)} proba AS s, cast(sum(y) AS double) AS pos, cast(sum(1 - y) AS double) AS neg
        FROM {src} GROUP BY {_g(groups)} proba)) {gb}"""


def metrics_sql(src: str, groups: list[str], digits: int = 9) -> str:
    """CTE text (sw_, bt_, mx_) computing the MET8 row at the best-F1 threshold per group."""
    on = " AND ".join([*(f"s.{g} = b.{g}" for g in groups)]) or "true"
    j2 = lambda a: " AND ".join(f"m.{g} = {a}.{g}" for g in groups) or "true"
    return f"""
sw_ AS ({sweep_sql(src, groups)}),
bt_ AS ({best_sql('sw_', groups)}),
cnt_ AS (
  SELECT {_g(groups, 's.')} any_value(b.seuil) AS seuil,
    count(CASE WHEN s.proba >= b.seuil AND s.y = 1 THEN 1 END) AS vp,
    count(CASE WHEN s.proba >= b.seuil AND s.y = 0 THEN 1 END) AS fp,
    count(CASE WHEN s.proba < b.seuil AND s.y = 1 THEN 1 END) AS fn,
    count(CASE WHEN s.proba < b.seuil AND s.y = 0 THEN 1 END) AS vn,
    avg(pow(s.proba - s.y, 2)) AS brier
  FROM {src} s JOIN bt_ b ON {on} {('GROUP BY ' + ', '.join('s.' + g for g in groups)) if groups else ''}),
auc_ AS ({auc_sql(src, groups)}),
ap_ AS ({ap_sql(src, groups)}),
mx_ AS (
  SELECT {_g(groups, 'm.')} {r('m.seuil', 3)} AS seuil,
    coalesce(2 * vp / nullif(2 * vp + fp + fn, 0), 0.0E0) AS f1,
    coalesce(vp / nullif(vp + fp, 0), 0.0E0) AS precision,
    coalesce(vp / nullif(vp + fn, 0), 0.0E0) AS rappel,
    {r('a.roc_auc', digits)} AS roc_auc, {r('p.pr_auc', digits)} AS pr_auc, {r('m.brier', digits)} AS brier,
    vp, fp, fn, vn, (vp + fp) / (vp + fp + fn + vn) AS taux_alerte
  FROM cnt_ m LEFT JOIN auc_ a ON {j2('a')} LEFT JOIN ap_ p ON {j2('p')})"""


def _round_cols(df, cols, digits=9):
    return df.select(*[np_round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


# ------------------------------------------------------------------ queries
@query("met2_3_threshold_sweep", with_fixture(sweep_sql("scored", []), _ctes()))
def met2_3(spark, sf):
    return M.sweep(fixture.scored(spark, sf).drop("model"))


@query("met4_roc_auc_per_fold", with_fixture(
    f"SELECT fold, {r('roc_auc', 9)} AS roc_auc FROM ({auc_sql('oof', ['fold'])})", _ctes()))
def met4(spark, sf):
    return _round_cols(M.roc_auc(scored_oof(spark, sf), ["fold"]), ["roc_auc"])


@query("met5_average_precision_per_fold", with_fixture(
    f"SELECT fold, {r('pr_auc', 9)} AS pr_auc FROM ({ap_sql('oof', ['fold'])})", _ctes()))
def met5(spark, sf):
    return _round_cols(M.average_precision(scored_oof(spark, sf), ["fold"]), ["pr_auc"])


@query("met6_brier_per_fold", with_fixture(
    f"SELECT fold, {r('avg(pow(proba - y, 2))', 9)} AS brier FROM oof GROUP BY fold", _ctes()))
def met6(spark, sf):
    return _round_cols(M.brier(scored_oof(spark, sf), ["fold"]), ["brier"])


@query("met7_alert_rate_accuracy", with_fixture(f"""
SELECT {r('avg(CASE WHEN proba >= b.seuil THEN 1 ELSE 0 END)', 9)} AS taux_alerte,
       {r('avg(CASE WHEN (CASE WHEN proba >= b.seuil THEN 1 ELSE 0 END) = y THEN 1 ELSE 0 END)', 9)} AS accuracy
FROM scored, (SELECT seuil FROM bt_) b""", _ctes(f"sw_ AS ({sweep_sql('scored', [])}), bt_ AS ({best_sql('sw_', [])})")))
def met7(spark, sf):
    s = fixture.scored(spark, sf).drop("model")
    t = M.best_threshold(M.sweep(s)).select("seuil").first()["seuil"]  # one scalar on the driver
    pred = (F.col("proba") >= F.lit(t)).cast("int")
    return s.agg(np_round(F.avg(pred), 9).alias("taux_alerte"),
                 np_round(F.avg((pred == F.col("y")).cast("int")), 9).alias("accuracy"))


@query("met8_metrics_per_fold", with_fixture(
    "SELECT * FROM mx_", _ctes(metrics_sql("oof", ["fold"]))))
def met8(spark, sf):
    out = M.best_metrics(scored_oof(spark, sf), ["fold"])
    return _round_cols(out, ["roc_auc", "pr_auc", "brier"])


@query("met9_best_threshold_per_fold", with_fixture(
    f"SELECT fold, seuil, f1 FROM ({best_sql('sw_', ['fold'])})",
    _ctes(f"sw_ AS ({sweep_sql('oof', ['fold'])})")))
def met9(spark, sf):
    return M.best_threshold(M.sweep(scored_oof(spark, sf), ["fold"]), ["fold"]).select("fold", "seuil", "f1")


@query("met10_pooled_threshold", with_fixture(
    f"SELECT seuil, f1 FROM ({best_sql('sw_', [])})", _ctes(f"sw_ AS ({sweep_sql('oof', [])})")))
def met10(spark, sf):
    return M.best_threshold(M.sweep(scored_oof(spark, sf))).select("seuil", "f1")


@query("met11_cost_curve", with_fixture(
    f"SELECT {r('seuil', 3)} AS seuil, fp, fn, 0.25E0 * fp + 1.0E0 * fn AS cout, f1 FROM sw_",
    _ctes(f"sw_ AS ({sweep_sql('oof', [])})")))
def met11(spark, sf):
    return M.cost_curve(M.sweep(scored_oof(spark, sf)))


_SUMMARY_METRICS = ["f1", "precision", "rappel", "roc_auc", "pr_auc"]


@query("met12_fold_summary", with_fixture(
    "SELECT model AS modele, " + ", ".join(
        f"{r(f'avg({m})', 4)} AS {m}_mean, {r(f'stddev_samp({m})', 4)} AS {m}_std" for m in _SUMMARY_METRICS)
    + " FROM mx_ GROUP BY model", _ctes(metrics_sql("oof", ["model", "fold"]))))
def met12(spark, sf):
    per_fold = M.best_metrics(scored_oof(spark, sf), ["model", "fold"]).withColumnRenamed("model", "modele")
    return M.summarize_folds(per_fold)


@query("met12_fold_summary_in_order", with_fixture(
    "SELECT model AS modele, " + ", ".join(
        f"{r(f'avg({m})', 4)} AS {m}_mean, {r(f'stddev_samp({m})', 4)} AS {m}_std" for m in _SUMMARY_METRICS)
    + ", cast(row_number() OVER (ORDER BY min(fold), min(ligne)) AS int) AS ordre FROM (SELECT *, "
    "CASE model WHEN 'taux' THEN 1 ELSE 2 END AS ligne FROM mx_) GROUP BY model",
    _ctes("duo AS (SELECT 'taux' AS model, fold, y, least(1.0E0, proba * 0.5E0 + 0.25E0) AS proba FROM oof UNION ALL "
          "SELECT model, fold, y, proba FROM oof), " + metrics_sql("duo", ["model", "fold"]))))
def met12_order(spark, sf):
    """Two scorers, the later name first in the report: models keep the order of their first rows."""
    oof = scored_oof(spark, sf)
    squeezed = oof.withColumn("model", F.lit("taux")).withColumn("proba", F.least(F.lit(1.0), F.col("proba") * 0.5 + 0.25))
    per_fold = M.best_metrics(squeezed.unionByName(oof), ["model", "fold"]).withColumnRenamed("model", "modele")
    rows = per_fold.withColumn("ligne", F.when(F.col("modele") == "taux", 1).otherwise(2))
    return M.summarize_folds(rows, first_seen=["fold", "ligne"])


@query("met13_pooled_comparison", with_fixture(
    "SELECT model AS modele, seuil, " + ", ".join(
        f"{r(c, 4)} AS {c}" for c in ["f1", "precision", "rappel", "roc_auc", "pr_auc", "brier"])
    + ", vp, fp, fn, vn, " + r("taux_alerte", 4) + " AS taux_alerte FROM mx_",
    _ctes(metrics_sql("models", ["model"]))))
def met13(spark, sf):
    out = M.best_metrics(scored_models(spark, sf), ["model"]).withColumnRenamed("model", "modele")
    return M.round_report(out, 4, keep=["seuil"])


@query("met14_calibration", with_fixture(f"""
SELECT tranche, count(*) AS n, {r('avg(proba)', 3)} AS proba_moyenne, {r('avg(y)', 3)} AS taux_reel FROM (
  SELECT *, CASE
    WHEN proba > 0 AND proba <= 0.1E0 THEN '(0.0, 0.1]' WHEN proba > 0.1E0 AND proba <= 0.2E0 THEN '(0.1, 0.2]'
    WHEN proba > 0.2E0 AND proba <= 0.3E0 THEN '(0.2, 0.3]' WHEN proba > 0.3E0 AND proba <= 0.4E0 THEN '(0.3, 0.4]'
    WHEN proba > 0.4E0 AND proba <= 0.5E0 THEN '(0.4, 0.5]' WHEN proba > 0.5E0 AND proba <= 0.6E0 THEN '(0.5, 0.6]'
    WHEN proba > 0.6E0 AND proba <= 1.0E0 THEN '(0.6, 1.0]' END AS tranche FROM oof)
WHERE tranche IS NOT NULL GROUP BY tranche""", _ctes()))
def met14(spark, sf):
    return M.calibration(scored_oof(spark, sf))


@query("met15_risk_deciles", with_fixture(f"""
SELECT decile, n, {r('pm', 3)} AS proba_moyenne, {r('rate', 3)} AS taux_reel,
       {r('rate / (sum(pos) OVER () / sum(n) OVER ())', 2)} AS lift,
       {r('pos / sum(pos) OVER ()', 3)} AS part_annulations
FROM (SELECT cast(greatest(len(list_distinct(list_filter(e, lambda x: x < proba))), 1) AS int) AS decile, count(*) AS n,
             avg(proba) AS pm, avg(y) AS rate, sum(y) AS pos
      FROM oof, (SELECT quantile_cont(proba, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM oof)
      GROUP BY 1)""", _ctes()))
def met15(spark, sf):
    return M.deciles(scored_oof(spark, sf))


@query("met16_risk_tiers", with_fixture(f"""
SELECT niveau, n, {r('n / tn', 6)} AS volume, {r('pos / n', 6)} AS taux_reel, {r('pos / tp', 6)} AS part_annulations
FROM (SELECT niveau, count(*) AS n, sum(y) AS pos, sum(count(*)) OVER () AS tn, sum(sum(y)) OVER () AS tp
      FROM (SELECT y, CASE WHEN proba >= 0.0E0 AND proba < 0.2E0 THEN 'vert'
                           WHEN proba >= 0.2E0 AND proba < 0.4E0 THEN 'orange'
                           WHEN proba >= 0.4E0 AND proba < 1.01E0 THEN 'rouge' END AS niveau FROM oof)
      GROUP BY niveau) WHERE niveau IS NOT NULL""", _ctes()))
def met16(spark, sf):
    return M.risk_tiers(scored_oof(spark, sf))


@query("met17_f1_curve", with_fixture("SELECT i, seuil, f1 FROM sw_", _ctes(f"sw_ AS ({sweep_sql('oof', [])})")))
def met17(spark, sf):
    return M.sweep(scored_oof(spark, sf)).select("i", "seuil", "f1")


@query("met18_pr_curve", with_fixture("""
SELECT s AS seuil, coalesce(tp / nullif(pp, 0), 0.0E0) AS precision, coalesce(tp / nullif(p, 0), 1.0E0) AS rappel
FROM (SELECT *, sum(pos) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS tp,
                sum(pos + neg) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS pp, sum(pos) OVER () AS p
      FROM (SELECT proba AS s, cast(sum(y) AS double) AS pos, cast(sum(1 - y) AS double) AS neg FROM oof GROUP BY proba))
UNION ALL SELECT NULL, 1.0E0, 0.0E0""", _ctes()))
def met18(spark, sf):
    return M.pr_curve(scored_oof(spark, sf))


@query("met19_gain_over_baseline", with_fixture("""
SELECT a.f1 - b.f1 AS gain_f1, a.f1 AS f1_modele, b.f1 AS f1_reference
FROM bt_ a JOIN bt_ b ON a.model = 'fixture' AND b.model = 'baseline_taux'""",
    _ctes(f"sw_ AS ({sweep_sql('models', ['model'])}), bt_ AS ({best_sql('sw_', ['model'])})")))
def met19(spark, sf):
    best = M.best_threshold(M.sweep(scored_models(spark, sf), ["model"]), ["model"])
    return M.gain(best, "fixture", BASELINE_MODEL)


# ------------------------------------------------------------------ ensemble
@query("ens1_renormalised_weights", with_fixture("""
SELECT model, w / sum(w) OVER () AS poids FROM (
  SELECT DISTINCT m.model, w.w FROM models m JOIN (VALUES ('fixture', 0.50E0), ('baseline_taux', 0.25E0), ('absent', 0.25E0)) w(model, w)
  ON m.model = w.model)""", _ctes()))
def ens1(spark, sf):
    return ens.ensemble_weights(scored_models(spark, sf).select("model").distinct(), ENS_WEIGHTS)


@query("ens2_weighted_probability", with_fixture(f"""
SELECT reservation_id, {r('sum(m.proba * w.w) / sum(w.w)', 12)} AS proba, any_value(y) AS y
FROM models m JOIN (VALUES ('fixture', 0.50E0), ('baseline_taux', 0.25E0), ('absent', 0.25E0)) w(model, w)
ON m.model = w.model GROUP BY reservation_id""", _ctes()))
def ens2(spark, sf):
    s = scored_models(spark, sf)
    w = ens.ensemble_weights(s.select("model").distinct(), ENS_WEIGHTS)
    out = ens.ensemble_proba(s, w)
    return out.select("reservation_id", np_round("proba", 12).alias("proba"), "y")
