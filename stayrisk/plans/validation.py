"""Validation jobs: expanding-window CV (ENS4), ablation (ENS5-7), final refit (SUB1), random CV (FLD3).

All folds of a run are fitted together: references, preprocessing statistics and
bins of every fold come from shared jobs, and every family trains its folds in
shared passes (:func:`..operators.models.fit_all`). Scores are long tables
``(model, fold, reservation_id, y, proba)``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import ensemble as ens
from ..operators import metrics as M
from ..operators.encoding import FoldPrep, fold_preps
from ..operators.folds import fold_members, stratified_folds
from ..operators.models import Family, build_all, build_logreg, fit_all, run_parallel
from ..operators.reference import apply_reference, fit_reference, fit_references
from ..sources.schema import (ABLATION_CONFIGS, CATEGORICAL, ENSEMBLE_RAW_WEIGHTS, ID_COL, MODEL_ENSEMBLE,
                              MODEL_HGB, MODEL_LGBM, MODEL_LOGREG, RAW_NUMERIC, TARGET)

ENSEMBLE_MEMBERS = (MODEL_LOGREG, MODEL_HGB, MODEL_LGBM)


def _long(scored: DataFrame, model: str, fold: int) -> DataFrame:
    return scored.select(F.lit(model).alias("model"), F.lit(fold).cast("int").alias("fold"), ID_COL,
                         F.col(TARGET).cast("int").alias("y"), "proba")


class FoldTables:
    """Training and validation rows of every fold with the fold's own reference, and their shared statistics."""

    def __init__(self, parts: dict[int, tuple[DataFrame, DataFrame]], numeric: Sequence[str], categorical: Sequence[str] = CATEGORICAL):
        refs = fit_references({k: tr for k, (tr, _) in parts.items()}, categorical)
        self.train = {k: apply_reference(tr, refs[k]).persist(StorageLevel.MEMORY_AND_DISK) for k, (tr, _) in parts.items()}
        self.val = {k: apply_reference(va, refs[k]) for k, (_, va) in parts.items()}
        self.preps: dict[int, FoldPrep] = fold_preps(self.train, numeric, categorical)

    def fit(self, families: Sequence[Family]) -> dict:
        return fit_all(self.train, self.preps, families)

    def scores(self, models: dict[int, object], name: str) -> DataFrame:
        """Validation rows of every fold scored by the fold's model."""
        return reduce(DataFrame.unionByName, [_long(m.transform(self.val[k]), name, k) for k, m in models.items()])

    def scores_of_all(self, fitted: dict, names: Sequence[str]) -> DataFrame:
        """Validation rows of every fold scored by all its models: the reference is applied once a fold, not once a model."""
        parts = []
        for k, d in self.val.items():
            for i, n in enumerate(names):
                fitted[n, k].out = f"__p{i}"
                d = fitted[n, k].transform(d)
            one = F.explode(F.array(*[F.struct(F.lit(n).alias("model"), F.col(f"__p{i}").alias("proba")) for i, n in enumerate(names)])).alias("s")
            parts.append(d.select(F.lit(k).cast("int").alias("fold"), ID_COL, F.col(TARGET).cast("int").alias("y"), one).select(
                "s.model", "fold", ID_COL, "y", "s.proba"))
        return reduce(DataFrame.unionByName, parts)

    def release(self) -> None:
        for t in self.train.values():
            t.unpersist()


def _temporal(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> FoldTables:
    """The temporal folds that have rows; membership is a condition on the rows, so their copies (about three a row) are not stored."""
    members = fold_members(train)
    some = train.agg(*[F.max((c["train"] | c["val"]).cast("int")).alias(f"f{k}") for k, c in members.items()]).first()
    return FoldTables({k: (train.where(c["train"]), train.where(c["val"])) for k, c in members.items() if some[f"f{k}"]}, numeric, categorical)


def ensemble_rows(oof: DataFrame) -> DataFrame:
    """The ensemble's rows from its members' out-of-fold rows."""
    members = oof.where(F.col("model").isin(list(ENSEMBLE_MEMBERS)))
    w = ens.ensemble_weights(members.select("model").distinct(), ENSEMBLE_RAW_WEIGHTS)
    e = ens.ensemble_proba(members.withColumn("__key", F.struct("fold", ID_COL)), w, id_col="__key", keep=("y",))
    return e.select(F.lit(MODEL_ENSEMBLE).alias("model"), F.col("__key.fold").alias("fold"), F.col(f"__key.{ID_COL}").alias(ID_COL), "y", "proba")


def cross_validate(train: DataFrame, models: dict | None = None, with_ensemble: bool = True,
                   keep: Callable[[str, DataFrame], DataFrame] | None = None) -> DataFrame:
    """ENS4: out-of-fold scores of every model (and the ensemble) on the 4 temporal folds.

    ``train`` is the cleaned training table. Every family's scores are checkpointed (lineage cut in the shared
    folder), so reports never refit anything; ``keep(model, scores)`` may store them instead.
    """
    keep = keep or (lambda name, scores: scores.checkpoint(eager=True))
    models = models if models is not None else build_all()
    families = list(models.values())
    tables = _temporal(train, [c for e in families for c in e.numeric], families[0].categorical)
    fitted = tables.fit(families)
    parts = run_parallel([lambda n=e.name: keep(n, tables.scores({k: m for (name, k), m in fitted.items() if name == n}, n)) for e in families])
    tables.release()
    out = reduce(DataFrame.unionByName, parts)
    if with_ensemble and any(n in ENSEMBLE_MEMBERS for n in models):
        out = out.unionByName(ensemble_rows(out).checkpoint(eager=True))
    return out


def fold_report(oof: DataFrame) -> DataFrame:
    """Per (model, fold): best-F1 threshold and the metric row (reference 'results by fold')."""
    return M.best_metrics(oof, ["model", "fold"]).withColumnRenamed("model", "modele")


def pooled_report(oof: DataFrame) -> DataFrame:
    """MET13 on out-of-fold rows: per model best pooled threshold + metrics, rounded to 4."""
    out = M.best_metrics(oof, ["model"]).withColumnRenamed("model", "modele")
    return M.round_report(out, 4, keep=["seuil"])


def ablation(train: DataFrame, configs: Sequence[tuple[str, list[str]]] = ABLATION_CONFIGS,
             categorical: Sequence[str] = CATEGORICAL) -> DataFrame:
    """ENS5-7: logistic model on cumulative feature sets, pooled threshold metrics, gains.

    All configurations and folds are fitted in the same passes.
    """
    families = [build_logreg(list(numeric), list(categorical), name) for name, numeric in configs]
    tables = _temporal(train, [c for f in families for c in f.numeric], categorical)
    fitted = tables.fit(families)
    oof = tables.scores_of_all(fitted, [f.name for f in families]).checkpoint(eager=True)
    tables.release()
    order = F.create_map(*[x for i, (name, numeric) in enumerate(configs) for x in (F.lit(name), F.struct(F.lit(i).alias("ordre"), F.lit(len(numeric)).alias("n")))])
    return ablation_table(M.best_metrics(oof, ["model"]).withColumn("__c", order[F.col("model")]).withColumn(
        "ordre", F.col("__c.ordre")).withColumn("n_variables", F.col("__c.n")).drop("__c"))


def ablation_table(metrics_by_config: DataFrame) -> DataFrame:
    """ENS6/ENS7: gains vs the first configuration (before rounding) and marginal gains (of rounded F1).

    Windows run over one row per configuration (8 rows).
    """
    from pyspark.sql import Window

    from ..functions.columns import np_round

    w = Window.orderBy("ordre")
    base = F.first("f1").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    f1r = np_round("f1", 4)
    return metrics_by_config.select(
        "ordre", F.col("model").alias("configuration"), "n_variables",
        f1r.alias("f1"),
        np_round(F.col("f1") - base, 4).alias("gain_vs_baseline"),
        np_round("precision", 4).alias("precision"), np_round("rappel", 4).alias("rappel"),
        np_round("roc_auc", 4).alias("roc_auc"), "seuil",
        np_round(f1r - F.lag(f1r).over(w), 4).alias("gain_marginal"),
        np_round(f1r - F.first(f1r).over(w.rowsBetween(Window.unboundedPreceding, 0)), 4).alias("gain_cumule"),
    )


def ensemble_members(models: dict | None = None) -> dict:
    """The ensemble's members out of a model registry (reference sizes by default)."""
    return {n: e for n, e in (models if models is not None else build_all()).items() if n in ENSEMBLE_MEMBERS}


def final_model(train: DataFrame, threshold: float, models: dict | None = None):
    """SUB1: reference + ensemble refit on the whole training table, frozen out-of-fold threshold."""
    ref = fit_reference(train)
    TR = apply_reference(train, ref).persist(StorageLevel.MEMORY_AND_DISK)
    model = ens.EnsembleEstimator(ensemble_members(models), ENSEMBLE_RAW_WEIGHTS, threshold).fit(TR)
    TR.unpersist()
    return ref, model


def score(test: DataFrame, ref, model) -> DataFrame:
    """Row-wise scoring job (batch or stream): reference lookups, then the ensemble."""
    return model.transform(apply_reference(test, ref))


def random_cv_f1(train: DataFrame, k: int = 5, models: dict | None = None) -> DataFrame:
    """FLD3 counter-check: ensemble on a stratified random k-fold; pooled best F1 (one row)."""
    folded = stratified_folds(train, k=k).persist(StorageLevel.MEMORY_AND_DISK)
    members = list(ensemble_members(models).values())
    tables = FoldTables({f: (folded.where(F.col("fold") != f).drop("fold"), folded.where(F.col("fold") == f).drop("fold"))
                         for f in range(1, k + 1)}, [c for e in members for c in e.numeric], members[0].categorical)
    oof = tables.scores(ens.ensembles(tables.fit(members)), MODEL_ENSEMBLE).checkpoint(eager=True)
    tables.release()
    folded.unpersist()
    return M.best_threshold(M.sweep(oof)).select("seuil", "f1")


__all__ = ["cross_validate", "fold_report", "pooled_report", "ablation", "ablation_table", "final_model", "score",
           "random_cv_f1", "RAW_NUMERIC"]
