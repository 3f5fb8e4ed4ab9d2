"""Sizes of the registered models, and the whole model half end to end with few trees."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayrisk.operators import models as MOD
from stayrisk.plans import inputs, q_models, store, validation
from stayrisk.registry import QUERIES
from stayrisk.sources.schema import CATEGORICAL, MODEL_BASELINE, MODEL_ENSEMBLE, MODEL_HGB, MODEL_LGBM, MODEL_LOGREG, MODEL_NUMERIC, MODEL_RF

SF = "/root/testdata/sf0.001"


def _sizes(models):
    return models[MODEL_RF].forest.trees, models[MODEL_HGB].boost.rounds, models[MODEL_LGBM].boost.rounds


def test_families_have_the_reference_sizes():
    every = MOD.build_all()
    assert list(every) == [MODEL_BASELINE, MODEL_LOGREG, MODEL_RF, MODEL_HGB, MODEL_LGBM] and _sizes(every) == (500, 300, 400)
    h, g, r = every[MODEL_HGB].boost, every[MODEL_LGBM].boost, every[MODEL_RF].forest
    assert (h.learning_rate, h.max_leaves, h.min_leaf, h.l2, h.row_share, h.column_share) == (0.04, 8, 60, 5.0, 1.0, 1.0)
    assert (g.learning_rate, g.max_leaves, g.min_leaf, g.l2, g.row_share, g.column_share) == (0.03, 7, 80, 10.0, 0.8, 0.6)
    assert (r.min_leaf, r.column_share) == (30, 0.3)


@pytest.fixture
def few(monkeypatch):
    """Registered queries with few trees; the fits are counted."""
    real, fit = MOD.build_all, MOD.fit_all
    fitted = []

    def small(*a, **k):
        return real(trees=8, hgb_rounds=5, lgbm_rounds=6)

    def counted(tables, preps, families):
        fitted.append((len(tables), [f.name for f in families]))
        return fit(tables, preps, families)

    monkeypatch.setattr(MOD, "build_all", small)
    monkeypatch.setattr(validation, "build_all", small)
    for module in (MOD, validation):
        monkeypatch.setattr(module, "fit_all", counted)
    import stayrisk.operators.ensemble as ens

    monkeypatch.setattr(ens, "fit_all", counted)
    monkeypatch.setattr(store, "path_for", lambda spark, kind, key, inputs=None, p=store.path_for: p(spark, kind, f"few:{key}", inputs))
    return fitted


def test_queries_share_stored_scores_and_the_saved_model(spark, few):
    members = list(validation.ENSEMBLE_MEMBERS)
    cost = QUERIES["ens4_cv_cost_curve"](spark, SF)
    assert few == [(4, members)] and cost.count() == 181  # the ensemble's readers fit its members only
    assert QUERIES["ens4_cv_calibration"](spark, SF).count() > 0 and len(few) == 1
    assert QUERIES["ens4_cv_fold_results"](spark, SF).count() == 6 * 4
    assert few[1:] == [(4, [MODEL_BASELINE, MODEL_RF])]
    sub = QUERIES["sub1_final_submission"](spark, SF).toPandas()
    assert few[2:] == [(1, members)]
    stream = QUERIES["ens3_stream_scoring"](spark, SF).toPandas()
    assert len(few) == 3  # loaded, not fitted again
    both = sub.merge(stream, on="reservation_id")
    assert len(both) == len(sub) == len(stream) and np.allclose(both["probabilite_annulation"], both["proba"], atol=5.1e-7)
    assert (both["reservation_annulee"] == both["prediction"]).all()
    one = QUERIES["fld3_random_cv_f1"](spark, SF).first()
    assert few[3:] == [(5, members)] and 0 < one["f1"] <= 1
    gap = QUERIES["met19_temporal_minus_random_f1"](spark, SF).first()
    assert abs(gap["f1_aleatoire"] - one["f1"]) < 1e-12
    reports = {r["rapport"]: r["lignes"] for r in QUERIES["snk1_report_tables"](spark, SF).collect()}
    assert len(reports) == 18 and reports["submission"] == len(sub) and reports["courbe_cout"] == 181


def test_every_family_is_saved_and_loaded(spark, few, tmp_path):
    train = q_models._last_fold(spark, SF)[0].persist()
    families = list(MOD.build_all().values())
    from stayrisk.operators.encoding import fold_preps

    preps = fold_preps({0: train}, [c for f in families for c in f.numeric], CATEGORICAL)
    for (name, _), model in MOD.fit_all({0: train}, preps, families).items():
        path = str(tmp_path / str(abs(hash(name))))
        model.write().save(path)
        with pytest.raises(Exception):
            model.write().save(path)  # only overwrite() replaces a saved model
        again = type(model).load(path)
        assert again.name == name and again.feature_names == model.feature_names
        pair = again.transform(model.transform(train.limit(200)).withColumnRenamed("proba", "first")).select("first", "proba").toPandas()
        assert np.array_equal(pair["first"], pair["proba"]) and pair["proba"].between(0, 1).all()


def test_folds_fitted_together_equal_folds_fitted_alone(spark):
    """Shared jobs give every fold the statistics and models of its own rows only."""
    train = inputs.cleaned(spark, SF)[0]
    families = [MOD.build_logreg(), MOD.build_hgb(rounds=4)]
    oof = validation.cross_validate(train, {f.name: f for f in families}, with_ensemble=False).toPandas()
    from stayrisk.operators.folds import temporal_folds
    from stayrisk.operators.reference import apply_reference, fit_reference

    a = temporal_folds(train)
    tr, va = (a.where((F.col("fold") == 3) & (F.col("role") == r)).drop("fold", "role") for r in ("train", "val"))
    ref = fit_reference(tr)
    for f in families:
        alone = f.fit(apply_reference(tr, ref)).transform(apply_reference(va, ref)).select("reservation_id", F.col("proba").alias("alone")).toPandas()
        both = oof[(oof["model"] == f.name) & (oof["fold"] == 3)].merge(alone, on="reservation_id")
        assert len(both) == len(alone) > 0 and np.allclose(both["proba"], both["alone"], atol=1e-9)


def test_unseen_level_and_missing_values_are_scored(spark):
    train = q_models._last_fold(spark, SF)[0]
    for f in (MOD.build_logreg(), MOD.build_hgb(rounds=3), MOD.build_random_forest(trees=4)):
        model = f.fit(train)
        odd = train.limit(5).withColumn(CATEGORICAL[0], F.lit("never seen"))
        for c in MODEL_NUMERIC:
            odd = odd.withColumn(c, F.lit(None).cast("double"))
        rows = model.transform(odd).toPandas()
        assert len(rows) == 5 and rows["proba"].between(0, 1).all()


def test_ensemble_rows_are_the_weighted_mean(spark):
    rows = [(m, k, i, 1, p) for i, k in ((1, 1), (1, 2), (2, 1)) for m, p in ((MODEL_LOGREG, 0.2), (MODEL_HGB, 0.4), (MODEL_LGBM, 0.8 + k / 100), ("other", 0.0))]
    oof = spark.createDataFrame([(m, k, f"R{i}", y, p) for m, k, i, y, p in rows], "model string, fold int, reservation_id string, y int, proba double")
    got = {(r["reservation_id"], r["fold"]): r["proba"] for r in validation.ensemble_rows(oof).collect()}
    assert set(got) == {("R1", 1), ("R1", 2), ("R2", 1)}
    assert all(abs(v - (0.1 + 0.1 + 0.25 * (0.8 + k / 100))) < 1e-12 for (_, k), v in got.items())
    assert {r["model"] for r in validation.ensemble_rows(oof).collect()} == {MODEL_ENSEMBLE}
