"""Model families (MOD1-8): fitted models add a ``proba`` column to any batch or streaming DataFrame.

* Logistic families (MOD1-2): Newton steps on one aggregate (:mod:`.newton`), scored as one JVM expression.
* Boosted families (MOD4-5): second-order histogram boosting with best-first trees (:mod:`.boosting`); missing
  values stay missing; scored by an Arrow function over the feature vector.
* Random forest (MOD3): all trees grown level by level together (:mod:`.forest`), scored like the boosted families.

``fit_all`` trains every family on every training table (fold) of a run: the logistic fits in shared passes, the
boosters in shared passes, the forests level by level.
"""

from __future__ import annotations

import copy
import json
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.util import MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package
from ..sources.schema import (CATEGORICAL, ID_COL, MODEL_BASELINE, MODEL_HGB, MODEL_LGBM, MODEL_LOGREG, MODEL_NUMERIC,
                              MODEL_RF, RAW_NUMERIC, SEED, TARGET)
from . import boosting, forest, newton
from .boosting import BoostedTrees, BoostParams
from .encoding import FeatureLayout, FoldPrep, fold_preps
from .forest import ForestParams, ForestTrees

# --------------------------------------------------------------------------
# Hyperparameters of the original model families
# --------------------------------------------------------------------------
LOGREG_C = 0.05
BASELINE_C = 1.0
RF_PARAMS = dict(n_estimators=500, min_samples_leaf=30, max_features=0.3)
HGB_PARAMS = dict(max_iter=300, learning_rate=0.04, max_leaf_nodes=8, min_samples_leaf=60, l2_regularization=5.0)
LGBM_PARAMS = dict(n_estimators=400, learning_rate=0.03, num_leaves=7, min_child_samples=80,
                   colsample_bytree=0.6, subsample=0.8, reg_lambda=10.0)


BOOST_BINS = 255


def row_key(df: DataFrame) -> F.Column:
    """A 64-bit key of the row: of its id, or of all columns where there is none."""
    return F.xxhash64(ID_COL) if ID_COL in df.columns else F.xxhash64(*df.columns)


# ------------------------------------------------------------------ fitted models
class _Kept(Model, MLWritable, MLReadable):
    """Models that are plain data: saved as one row of JSON, ``load`` gives equal scores in any session."""

    def write(self) -> "JsonWriter":
        return JsonWriter(self)

    @classmethod
    def read(cls) -> "JsonReader":
        return JsonReader()


class JsonWriter(MLWriter):
    def __init__(self, instance: Model):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        spark = SparkSession.active()
        mode = "overwrite" if self.shouldOverwrite else "error"
        spark.createDataFrame([(json.dumps(self.instance.to_dict()),)], "model string").write.mode(mode).parquet(path)

    def save(self, path: str) -> None:
        self.saveImpl(path)


class JsonReader(MLReader):
    def load(self, path: str) -> Model:
        return model_from_dict(json.loads(SparkSession.active().read.parquet(path).first()["model"]))


class LinearModel(_Kept):
    """Fitted logistic family: ``proba`` is one projection."""

    def __init__(self, layout: FeatureLayout | None = None, weights=(), name: str = "", out: str = "proba"):
        super().__init__()
        self.layout, self.weights, self.name, self.out = layout, [float(w) for w in weights], name, out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        z = F.lit(self.weights[0])
        for w, x in zip(self.weights[1:], self.layout.columns()):
            z = z + F.lit(w) * x
        return dataset.select("*", (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).alias(self.out))

    @property
    def feature_names(self) -> list[str]:
        return self.layout.names

    def to_dict(self) -> dict:
        return {"kind": "linear", "name": self.name, "layout": self.layout.to_dict(), "weights": self.weights}


class BoostedModel(_Kept):
    """Fitted trees: they walk Arrow batches of the feature vector."""

    def __init__(self, layout: FeatureLayout | None = None, trees: BoostedTrees | ForestTrees | None = None, name: str = "", out: str = "proba"):
        super().__init__()
        self.layout, self.trees, self.name, self.out = layout, trees, name, out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship_package(dataset.sparkSession)
        trees, width = self.trees, len(self.layout.names)

        @F.pandas_udf("double")
        def walk(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype="float64")
            return pd.Series(trees.probability(np.concatenate(x.to_numpy()).astype(float).reshape(len(x), width)))

        return dataset.select("*", walk(self.layout.vector()).alias(self.out))

    @property
    def feature_names(self) -> list[str]:
        return self.layout.names

    def to_dict(self) -> dict:
        return {"kind": "boosted", "name": self.name, "layout": self.layout.to_dict(), "trees": self.trees.to_dict()}


class ForestModel(BoostedModel):
    """Fitted forest: the mean over trees of the leaf's share of cancellations."""

    def to_dict(self) -> dict:
        return super().to_dict() | {"kind": "forest"}


def model_from_dict(d: dict) -> Model:
    if d["kind"] == "ensemble":
        from .ensemble import EnsembleModel

        return EnsembleModel({m["name"]: model_from_dict(m) for m in d["members"]}, d["weights"], d["threshold"])
    layout = FeatureLayout.from_dict(d["layout"])
    if d["kind"] == "linear":
        return LinearModel(layout, d["weights"], d["name"])
    if d["kind"] == "forest":
        return ForestModel(layout, ForestTrees.from_dict(d["trees"]), d["name"])
    return BoostedModel(layout, BoostedTrees.from_dict(d["trees"]), d["name"])


# ------------------------------------------------------------------ estimators
class Family(Estimator):
    """A model family: columns and sizes; ``fit`` trains it on one table."""

    linear = False
    prepared: FoldPrep | None = None  # statistics of the training table, where several families share them

    def __init__(self, name: str, numeric: Sequence[str], categorical: Sequence[str], label: str = TARGET):
        super().__init__()
        self.name, self.numeric, self.categorical, self.label = name, list(numeric), list(categorical), label

    def with_prep(self, prepared: FoldPrep) -> "Family":
        other = copy.copy(self)
        other.prepared = prepared
        return other

    def _fit(self, dataset: DataFrame) -> Model:
        prep = self.prepared or fold_preps({0: dataset}, self.numeric, self.categorical)[0]
        return fit_all({0: dataset}, {0: prep}, [self])[self.name, 0]


class LogisticFamily(Family):
    linear = True

    def __init__(self, name: str, numeric: Sequence[str], categorical: Sequence[str], c: float, label: str = TARGET):
        super().__init__(name, numeric, categorical, label)
        self.c = c


class BoostedFamily(Family):
    def __init__(self, name: str, numeric: Sequence[str], categorical: Sequence[str], params: BoostParams, label: str = TARGET):
        super().__init__(name, numeric, categorical, label)
        self.boost = params


class ForestFamily(Family):
    def __init__(self, name: str, numeric: Sequence[str], categorical: Sequence[str], params: ForestParams, label: str = TARGET):
        super().__init__(name, numeric, categorical, label)
        self.forest = params


def _stacked(tables: dict[int, DataFrame], layouts: dict[int, FeatureLayout], label: str) -> DataFrame:
    """The training rows of all tasks: (task, key, y, x)."""
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(t).cast("int").alias("task"), row_key(df).alias("key"), F.col(label).cast("double").alias("y"),
                  layouts[t].vector().alias("x")) for t, df in tables.items()])


def _fit_logistic(tables, preps, families: list[LogisticFamily]) -> dict:
    """All fits read the union of their numeric columns, each takes its own."""
    numeric = list(dict.fromkeys(c for f in families for c in f.numeric))
    union = {t: preps[t].layout(numeric, families[0].categorical, linear=True) for t in tables}
    fits = []
    for t in tables:
        levels = range(len(numeric), len(union[t].names))
        fits += [newton.LogisticFit(f.name, t, f.c, (*(numeric.index(c) for c in f.numeric), *levels)) for f in families]
    weights = newton.solve(_stacked(tables, union, families[0].label), fits)
    return {(f.name, t): LinearModel(preps[t].layout(f.numeric, f.categorical, linear=True), weights[f.name, t], f.name)
            for f in families for t in tables}


def _fit_boosted(tables, preps, families: list[BoostedFamily]) -> dict:
    layouts = {t: preps[t].layout(families[0].numeric, families[0].categorical, linear=False) for t in tables}
    trees = boosting.train(_stacked(tables, layouts, families[0].label), {f.name: f.boost for f in families})
    return {k: BoostedModel(layouts[k[1]], t, k[0]) for k, t in trees.items()}


def _fit_forest(tables, preps, families: list[ForestFamily]) -> dict:
    out = {}
    for f in families:
        layouts = {t: preps[t].layout(f.numeric, f.categorical, linear=False) for t in tables}
        out |= {(f.name, t): ForestModel(layouts[t], trees, f.name) for t, trees in forest.train(_stacked(tables, layouts, f.label), f.forest).items()}
    return out


def run_parallel(tasks: Sequence[Callable], threads: int = 4) -> list:
    """Run independent jobs concurrently (Spark schedules them; order kept)."""
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        return list(pool.map(lambda f: f(), tasks))


def fit_all(tables: dict[int, DataFrame], preps: dict[int, FoldPrep], families: Sequence[Family]) -> dict[tuple[str, int], Model]:
    """Every family on every training table (persisted by the caller): (family name, table) -> fitted model."""
    groups: dict[tuple, list[Family]] = {}
    for f in families:
        # boosters share passes over one feature vector, logistic fits over the union of theirs
        key = (type(f), tuple(f.categorical), f.label, tuple(f.numeric) if isinstance(f, BoostedFamily) else ())
        groups.setdefault(key, []).append(f)
    fits = {LogisticFamily: _fit_logistic, BoostedFamily: _fit_boosted, ForestFamily: _fit_forest}
    jobs = [lambda fit=fits[kind], members=members: fit(tables, preps, members) for (kind, *_), members in groups.items()]
    return {k: m for part in run_parallel(jobs, 4) for k, m in part.items()}


def build_baseline(numeric=None, categorical=None) -> LogisticFamily:
    """MOD1: logistic regression, C = 1, raw numerics + categoricals."""
    return LogisticFamily(MODEL_BASELINE, numeric or RAW_NUMERIC, categorical or CATEGORICAL, BASELINE_C)


def build_logreg(numeric=None, categorical=None, name: str = MODEL_LOGREG) -> LogisticFamily:
    """MOD2: logistic regression, C = 0.05, enriched numerics."""
    return LogisticFamily(name, numeric or MODEL_NUMERIC, categorical or CATEGORICAL, LOGREG_C)


def build_random_forest(numeric=None, categorical=None, trees: int = RF_PARAMS["n_estimators"], bins: int = BOOST_BINS) -> ForestFamily:
    """MOD3: random forest, min leaf 30, 30 % of the features per split."""
    p = ForestParams(trees, RF_PARAMS["min_samples_leaf"], RF_PARAMS["max_features"], bins=bins, seed=SEED)
    return ForestFamily(MODEL_RF, numeric or MODEL_NUMERIC, categorical or CATEGORICAL, p)


def build_hgb(numeric=None, categorical=None, rounds: int = HGB_PARAMS["max_iter"], bins: int = BOOST_BINS) -> BoostedFamily:
    """MOD4: histogram boosting, best-first trees of 8 leaves, learning rate .04, min leaf 60, L2 5."""
    p = BoostParams(rounds, HGB_PARAMS["learning_rate"], HGB_PARAMS["max_leaf_nodes"], HGB_PARAMS["min_samples_leaf"],
                    HGB_PARAMS["l2_regularization"], bins=bins, seed=SEED)
    return BoostedFamily(MODEL_HGB, numeric or MODEL_NUMERIC, categorical or CATEGORICAL, p)


def build_lgbm(numeric=None, categorical=None, rounds: int = LGBM_PARAMS["n_estimators"], bins: int = BOOST_BINS) -> BoostedFamily:
    """MOD5: leaf-wise boosting, 7 leaves, rows (0.8) and columns (0.6) drawn per tree, learning rate .03, min child 80, L2 10."""
    p = BoostParams(rounds, LGBM_PARAMS["learning_rate"], LGBM_PARAMS["num_leaves"], LGBM_PARAMS["min_child_samples"],
                    LGBM_PARAMS["reg_lambda"], LGBM_PARAMS["subsample"], LGBM_PARAMS["colsample_bytree"], bins=bins, seed=SEED)
    return BoostedFamily(MODEL_LGBM, numeric or MODEL_NUMERIC, categorical or CATEGORICAL, p)


def build_all(trees: int = RF_PARAMS["n_estimators"], hgb_rounds: int = HGB_PARAMS["max_iter"],
              lgbm_rounds: int = LGBM_PARAMS["n_estimators"]) -> dict[str, Family]:
    """MOD6: ordered registry of the compared models."""
    every = (build_baseline(), build_logreg(), build_random_forest(trees=trees), build_hgb(rounds=hgb_rounds), build_lgbm(rounds=lgbm_rounds))
    return {est.name: est for est in every}


def coefficients(model: ScoringModel, spark) -> DataFrame:
    """MOD7: (variable, coefficient, odds_ratio) sorted by |coefficient| desc (name as tie-break)."""
    names = model.feature_names
    coefs = model.weights[1:]  # one value per feature column
    schema = T.StructType([T.StructField("variable", T.StringType()), T.StructField("coefficient", T.DoubleType())])
    df = spark.createDataFrame(list(zip(names, coefs)), schema)
    return df.select("variable", "coefficient", F.exp("coefficient").alias("odds_ratio")).orderBy(
        F.abs("coefficient").desc(), "variable")


def top_coefficients(coefs: DataFrame, k: int = 12) -> DataFrame:
    """MOD8: the k most influential coefficients."""
    return coefs.orderBy(F.abs("coefficient").desc(), "variable").limit(k)
