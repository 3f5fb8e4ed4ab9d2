"""Weighted-probability ensemble (ENS1-2) on a long scored table.

Scores are kept in long format ``(model, row id, proba)``: members join a
weights table (one row per model, broadcast-sized) and the ensemble is a
``groupBy(row id)`` weighted mean, so adding a member adds rows, not columns.
Weights are renormalised over the members actually present.
"""

from __future__ import annotations

from pyspark.ml import Estimator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.joins import join_groups
from ..sources.schema import ENSEMBLE_RAW_WEIGHTS, ID_COL
from .encoding import fold_preps
from .models import _Kept, fit_all


def weights_table(spark: SparkSession, raw: dict[str, float] = ENSEMBLE_RAW_WEIGHTS) -> DataFrame:
    schema = T.StructType([T.StructField("model", T.StringType()), T.StructField("w", T.DoubleType())])
    return spark.createDataFrame([(k, float(v)) for k, v in raw.items()], schema)


def ensemble_weights(available: DataFrame, raw: dict[str, float] = ENSEMBLE_RAW_WEIGHTS,
                     model_col: str = "model") -> DataFrame:
    """ENS1: (model, poids) for the available members with a raw weight, renormalised to sum 1."""
    w = weights_table(available.sparkSession, raw)
    members = available.select(F.col(model_col).alias("model")).distinct().join(w, "model")
    total = members.agg(F.sum("w").alias("__tw"))
    return join_groups(members, total, []).select("model", (F.col("w") / F.col("__tw")).alias("poids"))


def ensemble_proba(scored: DataFrame, weights: DataFrame, id_col: str = ID_COL, model_col: str = "model",
                   keep: tuple[str, ...] = ("y",)) -> DataFrame:
    """ENS2: per row, sum(poids * proba) / sum(poids) over the members that scored it.

    The weights (a row a model) are broadcast: a shuffle on the model would make one task a model. A row has a few scores
    in all, so summing ahead of the shuffle would hold every id of a split and merge hardly any: rows go to their id's partition first.
    """
    w = weights.select(F.col("model").alias(model_col), "poids")
    j = scored.join(F.broadcast(w), model_col)
    kept = [c for c in keep if c in scored.columns]
    return j.select(id_col, "poids", "proba", *kept).repartition(id_col).groupBy(id_col).agg(
        (F.sum(F.col("poids") * F.col("proba")) / F.sum("poids")).alias("proba"), *[F.first(c).alias(c) for c in kept])


class EnsembleModel(_Kept):
    """ENS3 fitted: member models + normalised weights + decision threshold; row-wise scoring.

    ``transform`` works on batch and streaming DataFrames alike: every member adds
    its probability column, the ensemble is their weighted mean, ``prediction``
    is ``proba >= threshold``.
    """

    def __init__(self, members: dict | None = None, weights: dict | None = None, threshold: float = 0.5):
        super().__init__()
        self.members = members or {}
        self.weights = weights or {}
        self.threshold = threshold

    def to_dict(self) -> dict:
        return {"kind": "ensemble", "name": "ensemble", "members": [m.to_dict() for m in self.members.values()],
                "weights": self.weights, "threshold": self.threshold}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols = dataset.columns
        d = dataset
        member_cols = {}
        for i, (name, model) in enumerate(self.members.items()):
            model.out = f"__m{i}"
            d = model.transform(d)
            member_cols[name] = f"__m{i}"
        total = sum(self.weights[n] for n in member_cols)
        proba = None
        for n, c in member_cols.items():
            term = F.col(c) * F.lit(self.weights[n] / total)
            proba = term if proba is None else proba + term
        return d.select(*cols, proba.alias("proba"),
                        (proba >= F.lit(float(self.threshold))).cast("int").alias("prediction"))


class EnsembleEstimator(Estimator):
    """ENS3: fit the weighted members on one training table; missing members renormalise the weights."""

    def __init__(self, members: dict | None = None, raw_weights: dict[str, float] = ENSEMBLE_RAW_WEIGHTS,
                 threshold: float = 0.5):
        super().__init__()
        self.members = members or {}
        self.raw_weights = raw_weights
        self.threshold = threshold

    def _fit(self, dataset: DataFrame) -> EnsembleModel:
        members = [m for n, m in self.members.items() if n in self.raw_weights]
        prep = fold_preps({0: dataset}, [c for m in members for c in m.numeric], members[0].categorical)
        return ensembles(fit_all({0: dataset}, prep, members), self.raw_weights, self.threshold)[0]


def ensembles(fitted: dict, raw_weights: dict[str, float] = ENSEMBLE_RAW_WEIGHTS, threshold: float = 0.5) -> dict[int, EnsembleModel]:
    """One ensemble per training table out of the fitted members (name, table) that have a weight."""
    by_table: dict[int, dict] = {}
    for (name, k), model in fitted.items():
        if name in raw_weights:
            by_table.setdefault(k, {})[name] = model
    out = {}
    for k, members in by_table.items():
        members = {n: members[n] for n in raw_weights if n in members}
        total = sum(raw_weights[n] for n in members)
        out[k] = EnsembleModel(members, {n: raw_weights[n] / total for n in members}, threshold)
    return out
