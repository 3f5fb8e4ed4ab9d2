"""Registered queries: preprocessing (PRE1-5), models (MOD1-8), CV / ablation / final fit (ENS3-7, SUB1)."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import np_round
from ..operators import encoding as ENC
from ..operators import metrics as M
from ..operators import models as MOD
from ..operators.reference import apply_reference, fit_reference
from ..oracle_sql import r, with_fixture
from ..registry import query
from ..sources.schema import CATEGORICAL, MODEL_ENSEMBLE, MODEL_LOGREG, MODEL_NUMERIC, RELATIVE_PRICE
from . import inputs, store, validation
from .q_data import REF_CTES

# numeric columns available without a fitted reference (PRE checks run on row features)
ROW_NUMERIC = [c for c in MODEL_NUMERIC if c not in RELATIVE_PRICE]


# ------------------------------------------------------------------ preprocessing (oracle-checked)
@query("pre1_median_imputation", with_fixture(" UNION ALL ".join(
    f"SELECT '{c}' AS colonne, median(cast({c} AS double)) AS mediane FROM train_fe" for c in ROW_NUMERIC)))
def pre1(spark, sf):
    return ENC.column_medians(inputs.engineered(spark, sf)[0], ROW_NUMERIC)


def _pre2_sql() -> str:
    parts = []
    for c in ROW_NUMERIC:
        x = f"coalesce(cast({c} AS double), (SELECT median(cast({c} AS double)) FROM train_fe))"
        parts.append(f"SELECT '{c}' AS colonne, {r(f'avg({x})', 9)} AS moyenne, "
                     f"{r(f'CASE WHEN stddev_pop({x}) = 0 THEN 1.0E0 ELSE stddev_pop({x}) END', 9)} AS echelle FROM train_fe")
    return with_fixture(" UNION ALL ".join(parts))


@query("pre2_standardisation", _pre2_sql())
def pre2(spark, sf):
    return _scales(spark, inputs.engineered(spark, sf)[0], ROW_NUMERIC)


def _scales(spark, tr, columns):
    model = ENC.NumericScaler(columns).fit(tr)
    rows = [(c, model.means[c], model.scales[c]) for c in columns]  # one value pair per column
    schema = T.StructType([T.StructField("colonne", T.StringType()), T.StructField("moyenne", T.DoubleType()),
                           T.StructField("echelle", T.DoubleType())])
    df = spark.createDataFrame(rows, schema)
    return df.select("colonne", np_round("moyenne", 9).alias("moyenne"), np_round("echelle", 9).alias("echelle"))


# the same over every model column: the relative prices need the reference fitted on the training rows
TRAIN_REL = REF_CTES + """,
train_rel AS (
  SELECT t.*,
    t.prix_moyen_nuit_eur / nullif(coalesce(h.prix_ref_hotel, g.prix_ref_global), 0) AS prix_relatif_hotel,
    t.prix_moyen_nuit_eur / nullif(coalesce(s.prix_ref_saison, g.prix_ref_global), 0) AS prix_relatif_saison
  FROM train_fe t
  LEFT JOIN ref_hotel h ON t.hotel_id = h.hotel_id
  LEFT JOIN ref_season s ON t.region_hotel = s.region_hotel AND t.mois_arrivee = s.mois_arrivee
  CROSS JOIN ref_global g
)"""


def _referenced(spark, sf):
    """Engineered train and test with the reference of the training rows applied."""
    tr, te = inputs.engineered(spark, sf)
    ref = fit_reference(tr)
    return apply_reference(tr, ref), apply_reference(te, ref)


@query("pre1_model_median_imputation", with_fixture(" UNION ALL ".join(
    f"SELECT '{c}' AS colonne, median(cast({c} AS double)) AS mediane FROM train_rel" for c in MODEL_NUMERIC), TRAIN_REL))
def pre1_model(spark, sf):
    return ENC.column_medians(_referenced(spark, sf)[0], MODEL_NUMERIC)


def _pre2_model_sql() -> str:
    parts = []
    for c in MODEL_NUMERIC:
        x = f"coalesce(cast({c} AS double), (SELECT median(cast({c} AS double)) FROM train_rel))"
        parts.append(f"SELECT '{c}' AS colonne, {r(f'avg({x})', 9)} AS moyenne, "
                     f"{r(f'CASE WHEN stddev_pop({x}) = 0 THEN 1.0E0 ELSE stddev_pop({x}) END', 9)} AS echelle FROM train_rel")
    return with_fixture(" UNION ALL ".join(parts), TRAIN_REL)


@query("pre2_model_standardisation", _pre2_model_sql())
def pre2_model(spark, sf):
    return _scales(spark, _referenced(spark, sf)[0], MODEL_NUMERIC)


def _layout_sql(drop_first: bool) -> str:
    parts = []
    for c in CATEGORICAL:
        cond = f"WHERE v <> (SELECT min(cast({c} AS varchar)) FROM train_fe)" if drop_first else ""
        parts.append(f"SELECT concat('{c}_', v) AS variable FROM (SELECT DISTINCT cast({c} AS varchar) AS v "
                     f"FROM train_fe WHERE {c} IS NOT NULL) {cond}")
    return with_fixture(" UNION ALL ".join(parts))


def _layout(spark, sf, drop_first: bool):
    tr = inputs.engineered(spark, sf)[0]
    names = ENC.OneHot(CATEGORICAL, drop_first=drop_first).fit(tr).slot_names
    return spark.createDataFrame([(n,) for n in names], "variable string")


@query("pre3_linear_onehot_layout", _layout_sql(True))
def pre3(spark, sf):
    return _layout(spark, sf, True)


@query("pre4_tree_onehot_layout", _layout_sql(False))
def pre4(spark, sf):
    return _layout(spark, sf, False)


@query("pre5_assembled_features")
def pre5(spark, sf):
    tr, te = _referenced(spark, sf)
    model = ENC.linear_preprocessor(MODEL_NUMERIC, CATEGORICAL).fit(tr)
    out = model.transform(te)
    v = vector_to_array("features")
    return out.select("reservation_id", F.size(v).alias("n_variables"),
                      F.size(F.filter(v, lambda x: x != 0)).alias("n_non_nuls"))


def _cells_sql() -> str:
    """Every scaled numeric cell and every one-hot cell that is set, of the test rows."""
    med = ", ".join(f"median(cast({c} AS double)) AS m_{c}" for c in MODEL_NUMERIC)
    x = {c: f"coalesce(cast({c} AS double), m_{c})" for c in MODEL_NUMERIC}
    stats = ", ".join(f"avg({x[c]}) AS a_{c}, CASE WHEN stddev_pop({x[c]}) = 0 THEN 1.0E0 ELSE stddev_pop({x[c]}) END AS s_{c}" for c in MODEL_NUMERIC)
    ctes = REF_CTES + "," + TRAIN_REL[len(REF_CTES) + 1:] + f""",
meds AS (SELECT {med} FROM train_rel),
scales AS (SELECT {stats} FROM train_rel CROSS JOIN meds)"""
    parts = [f"SELECT reservation_id, '{c}' AS variable, {r(f'({x[c]} - a_{c}) / s_{c}', 6)} + 0.0E0 AS valeur "
             "FROM test_ref CROSS JOIN meds CROSS JOIN scales" for c in MODEL_NUMERIC]
    parts += [f"SELECT reservation_id, concat('{c}_', {c}), 1.0E0 FROM test_ref WHERE {c} IN (SELECT cast({c} AS varchar) FROM train_fe) "
              f"AND {c} <> (SELECT min(cast({c} AS varchar)) FROM train_fe)" for c in CATEGORICAL]
    return with_fixture(" UNION ALL ".join(parts), ctes)


@query("pre5_feature_cells", _cells_sql())
def pre5_cells(spark, sf):
    """The assembled vectors themselves, a row per numeric slot and per one-hot slot that is set."""
    tr, te = _referenced(spark, sf)
    model = ENC.linear_preprocessor(MODEL_NUMERIC, CATEGORICAL).fit(tr)
    names = F.array(*[F.lit(n) for n in model.feature_names])
    cells = model.transform(te).select("reservation_id", F.posexplode(vector_to_array("features")).alias("slot", "x"))
    return cells.where((F.col("slot") < len(MODEL_NUMERIC)) | (F.col("x") != 0)).select(
        "reservation_id", F.element_at(names, F.col("slot") + 1).alias("variable"), (np_round("x", 6) + 0.0).alias("valeur"))


# ------------------------------------------------------------------ last-fold fits (rows-only)
def _last_fold(spark, sf):
    from ..operators.cleaning import clean

    a = inputs.fold_table(spark, sf)
    last = a.where(F.col("fold") == 4).drop("proba")
    trn = clean(last.where(F.col("role") == "train").drop("fold", "role"))
    val = clean(last.where(F.col("role") == "val").drop("fold", "role"))
    ref = fit_reference(trn)
    return apply_reference(trn, ref), apply_reference(val, ref)


def _fitted_last(spark, sf, families):
    """Families fitted on the last fold: (fitted models by name, validation rows)."""
    TR, VA = _last_fold(spark, sf)
    TR = TR.persist()
    fitted = MOD.fit_all({4: TR}, ENC.fold_preps({4: TR}, [c for f in families for c in f.numeric], CATEGORICAL), families)
    TR.unpersist()
    return {name: m for (name, _), m in fitted.items()}, VA


@query("mod7_logreg_coefficients")
def mod7(spark, sf):
    return MOD.coefficients(_fitted_last(spark, sf, [MOD.build_logreg()])[0][MODEL_LOGREG], spark)


@query("mod8_top12_coefficients")
def mod8(spark, sf):
    return MOD.top_coefficients(mod7(spark, sf), 12)


def _last_fold_metrics(spark, sf, families):
    """Model families at their reference sizes, fitted on the last fold: metric row at the best threshold."""
    fitted, VA = _fitted_last(spark, sf, families)
    oof = reduce(lambda a, b: a.unionByName(b), [validation._long(m.transform(VA), n, 4) for n, m in fitted.items()])
    return M.best_metrics(oof.checkpoint(eager=True), ["model"]).withColumnRenamed("model", "modele")


@query("mod1_6_last_fold_model_metrics")
def mod1_6(spark, sf):
    """Every model family of the registry."""
    return _last_fold_metrics(spark, sf, list(MOD.build_all().values()))


@query("mod3_random_forest_last_fold")
def mod3(spark, sf):
    return _last_fold_metrics(spark, sf, [MOD.build_random_forest()])


@query("mod4_hgb_last_fold")
def mod4(spark, sf):
    return _last_fold_metrics(spark, sf, [MOD.build_hgb()])


@query("mod5_lgbm_last_fold")
def mod5(spark, sf):
    return _last_fold_metrics(spark, sf, [MOD.build_lgbm()])


@query("ens3_ensemble_scoring")
def ens3(spark, sf):
    from ..operators.ensemble import EnsembleEstimator

    TR, VA = _last_fold(spark, sf)
    model = EnsembleEstimator(validation.ensemble_members(), threshold=0.5).fit(TR.persist())
    return model.transform(VA).select("reservation_id", "proba", "prediction")


# ------------------------------------------------------------------ cross-validation (written once)
def oof_scores(spark, sf, names=None):
    """ENS4: out-of-fold scores at the reference sizes, one stored table a family, and the ensemble's rows.

    ``names`` are the families that are read (default: the ensemble's members); only those that no table holds
    yet are fitted, together. A run that was cut short goes on with the families that it had not stored.
    """
    every = MOD.build_all()
    names = list(names or validation.ENSEMBLE_MEMBERS)
    paths = {n: store.path_for(spark, "oof", f"oof-v4:{n}", sf) for n in names}
    missing = {n: every[n] for n in names if not store.exists(spark, paths[n])}
    if missing:
        validation.cross_validate(inputs.cleaned(spark, sf)[0], missing, with_ensemble=False,
                                  keep=lambda n, scores: store.stored(spark, paths[n], lambda: scores))
    oof = reduce(lambda a, b: a.unionByName(b), [spark.read.parquet(paths[n]) for n in names])
    return oof.unionByName(validation.ensemble_rows(oof))


def ensemble_oof(spark, sf):
    """The ensemble's out-of-fold rows: its three members are read, nothing else is fitted."""
    return oof_scores(spark, sf).where(F.col("model") == MODEL_ENSEMBLE)


@query("ens4_cv_fold_results")
def ens4_folds(spark, sf):
    return validation.fold_report(oof_scores(spark, sf, MOD.build_all()))


@query("ens4_cv_summary")
def ens4_summary(spark, sf):
    return M.summarize_folds(validation.fold_report(oof_scores(spark, sf, MOD.build_all())))


@query("ens4_cv_pooled_comparison")
def ens4_pooled(spark, sf):
    return validation.pooled_report(oof_scores(spark, sf, MOD.build_all()))


@query("ens4_cv_cost_curve")
def ens4_cost(spark, sf):
    oof = ensemble_oof(spark, sf)
    return M.cost_curve(M.sweep(oof))


@query("ens4_cv_calibration_deciles")
def ens4_deciles(spark, sf):
    oof = ensemble_oof(spark, sf)
    return M.deciles(oof)


@query("ens4_cv_calibration")
def ens4_calibration(spark, sf):
    return M.calibration(ensemble_oof(spark, sf))


@query("ens5_6_ablation")
def ens5(spark, sf):
    def build():
        return validation.ablation(inputs.cleaned(spark, sf)[0])
    return store.written(spark, "ablation", "ablation-v3", build, sf)


def _final(spark, sf):
    """SUB1: the final ensemble with its frozen threshold, fitted and saved once, then loaded."""
    from ..operators.ensemble import EnsembleModel
    from ..operators.reference import ReferenceStats

    path = store.path_for(spark, "final-model", "final-v1", sf)
    if not store.exists(spark, f"{path}/model"):
        t = M.best_threshold(M.sweep(ensemble_oof(spark, sf))).first()["seuil"]  # frozen pooled threshold (scalar)
        ref, model = validation.final_model(inputs.cleaned(spark, sf)[0], t)
        ref.save(f"{path}/reference")
        model.write().overwrite().save(f"{path}/model")  # last: its _SUCCESS file marks the whole
    return ReferenceStats.load(spark, f"{path}/reference"), EnsembleModel.load(f"{path}/model")


@query("sub1_final_submission")
def sub1(spark, sf):
    from ..operators.submission import submission

    ref, model = _final(spark, sf)
    return submission(validation.score(inputs.cleaned(spark, sf)[1], ref, model), model.threshold)


@query("fld3_random_cv_f1")
def fld3_random(spark, sf):
    def build():
        return validation.random_cv_f1(inputs.cleaned(spark, sf)[0])
    return store.written(spark, "random-cv", "random-cv-v4", build, sf)


@query("met19_temporal_minus_random_f1")
def met19_random(spark, sf):
    """MET19: pooled out-of-fold F1 of the ensemble (temporal folds) vs the random stratified 5-fold check."""
    from ..functions.joins import join_groups

    temporal = M.best_threshold(M.sweep(ensemble_oof(spark, sf))).select(
        F.col("f1").alias("f1_temporel"))
    rnd = fld3_random(spark, sf).select(F.col("f1").alias("f1_aleatoire"))
    return join_groups(temporal, rnd, []).select(
        "f1_temporel", "f1_aleatoire", (F.col("f1_aleatoire") - F.col("f1_temporel")).alias("ecart"))


@query("ens3_stream_scoring")
def ens3_stream(spark, sf):
    """The final ensemble scoring the test bookings as a stream (availableNow), read back from the sink."""
    from ..streaming.scoring import run_scoring

    ref, model = _final(spark, sf)
    raw_test = inputs.raw(spark, sf)[1]
    run = uuid.uuid4().hex  # a stream's own source, sink and checkpoint: nothing of an earlier run is taken over
    src = store.path_for(spark, "stream-src", run)
    raw_test.write.parquet(src)
    base = store.path_for(spark, "stream-out", run)
    run_scoring(spark, src, base + "/data", base + "/_checkpoint", ref, model)
    return spark.read.parquet(base + "/data")


@query("snk1_report_tables")
def snk1_reports(spark, sf):
    """Every report table of a run written as CSV (SNK1) plus the ordered submission (SNK2), read back."""
    from ..sources.schema import SUBMISSION_SCHEMA
    from . import reports

    tr, te = inputs.cleaned(spark, sf)
    out_dir = store.path_for(spark, "reports", uuid.uuid4().hex)
    tables, sub = reports.build_reports(tr, te, oof_scores(spark, sf, MOD.build_all()), ens5(spark, sf), _final(spark, sf))
    reports.write_reports(tables, sub, out_dir)
    names = reports.REPORTS + ["submission"]
    counts = []
    for n in names:
        reader = spark.read.option("header", True)
        df = reader.schema(SUBMISSION_SCHEMA).csv(f"{out_dir}/{n}") if n == "submission" else reader.csv(f"{out_dir}/{n}")
        counts.append(df.agg(F.count(F.lit(1)).alias("lignes")).select(F.lit(n).alias("rapport"), "lignes"))
    return reduce(lambda a, b: a.unionByName(b), counts)
