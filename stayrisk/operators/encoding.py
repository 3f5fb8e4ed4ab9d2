"""Model input preparation (PRE1-5) as Spark ML Estimators / Models.

* PRE1 exact median imputation: the medians of all numeric columns come from
  one distributed exact-quantile job over the stacked (column, value) pairs;
  ``pyspark.ml.feature.Imputer`` would be approximate (relativeError).
* PRE2 standardisation with the population std on the imputed values, zero
  variance scale = 1 (``StandardScaler`` uses the sample std).
* PRE3 linear one-hot: drop the alphabetically first level, unknown -> zeros:
  string indexes (alphabetically descending, keep) + OneHotEncoder(dropLast) + VectorSlicer.
* PRE4 tree one-hot: every known level kept, unknown -> zeros:
  string indexes (ascending, keep) + OneHotEncoder(dropLast).
* PRE5 routing: numeric block + categorical blocks -> one ``features`` vector.

Fitted statistics are per column (bounded by the column count) and applied as
literal expressions: scoring is a narrow projection, batch or streaming.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler, VectorSlicer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.counts import value_counts
from .quantiles import counted_quantiles, exact_quantiles


def stacked(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(colonne, valeur) long format of numeric columns (nulls kept out)."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("colonne"), F.col(c).cast("double").alias("valeur")) for c in columns])).alias("p")
    return df.select(pairs).select("p.colonne", "p.valeur").where(F.col("valeur").isNotNull())


def column_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """PRE1 statistics: exact median per column, all columns in one job; all-null column -> NULL."""
    long = stacked(df, columns)
    return exact_quantiles(long, "valeur", [0.5], ["colonne"], mean_at_half=True).withColumnRenamed("q0", "mediane")


def column_moments(df: DataFrame, columns: Sequence[str], medians: dict[str, float]) -> DataFrame:
    """PRE2 statistics on imputed values: mean and population std per column (one pass)."""
    imputed = [F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c))).alias(c) for c in columns]
    base = df.select(*imputed)
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"m__{c}"), F.stddev_pop(c).alias(f"s__{c}")]
    row = base.agg(*aggs)
    return row


class NumericScalerModel(Model):
    """Applies median fill then (x - mean) / scale as one projection."""

    def __init__(self, columns=(), medians=None, means=None, scales=None, standardize=True, output_prefix="n__"):
        super().__init__()
        self.columns = list(columns)
        self.medians = medians or {}
        self.means = means or {}
        self.scales = scales or {}
        self.standardize = standardize
        self.output_prefix = output_prefix

    def output_cols(self) -> list[str]:
        return [self.output_prefix + c for c in self.columns]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = []
        for c in self.columns:
            x = F.coalesce(F.col(c).cast("double"), F.lit(self.medians.get(c)).cast("double"))
            if self.standardize:
                x = (x - F.lit(self.means.get(c) or 0.0)) / F.lit(self.scales.get(c) or 1.0)
            # a column with no value at all imputes to 0 (its statistics are undefined)
            out.append(F.coalesce(x, F.lit(0.0)).alias(self.output_prefix + c))
        return dataset.select("*", *out)


class NumericScaler(Estimator):
    """PRE1 + PRE2 estimator (``standardize=False`` gives the tree branch: median fill only)."""

    def __init__(self, columns=(), standardize=True, output_prefix="n__"):
        super().__init__()
        self.columns = list(columns)
        self.standardize = standardize
        self.output_prefix = output_prefix

    def _fit(self, dataset: DataFrame) -> NumericScalerModel:
        meds = {r["colonne"]: r["mediane"] for r in column_medians(dataset, self.columns).collect()}
        means, scales = {}, {}
        if self.standardize:
            row = column_moments(dataset, self.columns, meds).first()
            for c in self.columns:
                means[c] = row[f"m__{c}"]
                s = row[f"s__{c}"]
                scales[c] = 1.0 if (s is None or s == 0.0) else s
        return NumericScalerModel(self.columns, meds, means, scales, self.standardize, self.output_prefix)


class OneHotModel(Model):
    def __init__(self, pipeline: PipelineModel | None = None, output_cols=(), slot_names=(), levels=None):
        super().__init__()
        self.pipeline = pipeline
        self.levels = levels or {}  # kept levels per column, in slot order
        self.output_cols = list(output_cols)
        self.slot_names = list(slot_names)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.pipeline.transform(dataset)


class OneHot(Estimator):
    """PRE3 (``drop_first=True``) / PRE4 (``drop_first=False``) one-hot, unknown levels -> zero vector."""

    def __init__(self, columns=(), drop_first=True, prefix="c__"):
        super().__init__()
        self.columns = list(columns)
        self.drop_first = drop_first
        self.prefix = prefix

    def _fit(self, dataset: DataFrame) -> OneHotModel:
        levels = column_levels({0: dataset}, self.columns)[0]
        return one_hot_model(levels, self.drop_first, self.prefix, dataset.sparkSession)


def column_levels(tables: dict[int, DataFrame], columns: Sequence[str]) -> dict[int, dict[str, list[str]]]:
    """Non-null levels of every column per table, alphabetically; one job. Levels are what the one-hot slots are made of."""
    if not columns:
        return {k: {} for k in tables}
    sets = reduce(DataFrame.unionByName, [
        df.select(F.lit(k).alias("task"), *[F.col(c).cast("string").alias(f"__l{i}") for i, c in enumerate(columns)])
        for k, df in tables.items()]).groupBy("task").agg(*[F.collect_set(f"__l{i}").alias(f"__l{i}") for i in range(len(columns))])
    out: dict[int, dict[str, list[str]]] = {k: {c: [] for c in columns} for k in tables}
    for r in sets.collect():
        out[r["task"]] = {c: r[f"__l{i}"] for i, c in enumerate(columns)}
    return {k: {c: sorted(v) for c, v in own.items()} for k, own in out.items()}


def one_hot_model(levels: dict[str, list[str]], drop_first: bool, prefix: str = "c__", spark=None) -> OneHotModel:
    """PRE3 / PRE4 from known levels; no job."""
    columns = [c for c in levels if levels[c]]
    order = {c: levels[c][::-1] if drop_first else levels[c] for c in columns}
    idx, hot = [f"{prefix}i_{c}" for c in columns], [f"{prefix}o_{c}" for c in columns]
    stages, outputs, names, kept = [], [], [], {}
    if columns:
        indexer = PipelineModel([StringIndexerModel.from_labels(order[c], inputCol=c, outputCol=i, handleInvalid="keep") for c, i in zip(columns, idx)])
        spark = spark or SparkSession.active()
        one = spark.createDataFrame([tuple(order[c][0] for c in columns)], ", ".join(f"`{c}` string" for c in columns))
        # dropLast removes the unknown slot (index = number of labels)
        stages = [indexer, OneHotEncoder(inputCols=idx, outputCols=hot, dropLast=True, handleInvalid="keep").fit(indexer.transform(one))]
    for c, oh in zip(columns, hot):
        labels = order[c]
        if drop_first:
            # desc order: the alphabetically first level sits in the last slot; slice it away
            if len(labels) < 2:
                continue
            stages.append(VectorSlicer(inputCol=oh, outputCol=f"{prefix}{c}", indices=list(range(len(labels) - 1))))
            outputs.append(f"{prefix}{c}")
            kept[c] = labels[:-1]
        else:
            outputs.append(oh)
            kept[c] = labels
        names += [f"{c}_{lv}" for lv in kept[c]]
    return OneHotModel(PipelineModel([_CastStrings(list(levels)), PipelineModel(stages)]), outputs, names, kept)


class _CastStrings(Model):
    def __init__(self, columns=()):
        super().__init__()
        self.columns = list(columns)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.select(*[F.col(c).cast("string").alias(c) if c in self.columns else F.col(c)
                                for c in dataset.columns])


class FeatureAssemblerModel(Model):
    def __init__(self, numeric: NumericScalerModel | None = None, onehot: OneHotModel | None = None,
                 output_col: str = "features"):
        super().__init__()
        self.numeric = numeric
        self.onehot = onehot
        self.output_col = output_col

    @property
    def feature_names(self) -> list[str]:
        return list(self.numeric.columns) + list(self.onehot.slot_names)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        d = self.onehot.transform(self.numeric.transform(dataset))
        inputs = self.numeric.output_cols() + self.onehot.output_cols
        assembled = VectorAssembler(inputCols=inputs, outputCol=self.output_col).transform(d)
        helper = [c for c in assembled.columns if c.startswith(("n__", "c__"))]
        return assembled.drop(*helper)


class FeatureAssembler(Estimator):
    """PRE5: numeric block (imputed, optionally standardised) + one-hot blocks -> ``features``."""

    def __init__(self, numeric=(), categorical=(), linear=True, output_col="features"):
        super().__init__()
        self.numeric = list(numeric)
        self.categorical = list(categorical)
        self.linear = linear
        self.output_col = output_col

    def _fit(self, dataset: DataFrame) -> FeatureAssemblerModel:
        num = NumericScaler(self.numeric, standardize=self.linear).fit(dataset)
        oh = OneHot(self.categorical, drop_first=self.linear).fit(dataset)
        return FeatureAssemblerModel(num, oh, self.output_col)


def linear_preprocessor(numeric, categorical) -> FeatureAssembler:
    return FeatureAssembler(numeric, categorical, linear=True)


__all__ = ["FeatureAssembler", "FeatureAssemblerModel", "NumericScaler", "OneHot", "Pipeline",
           "column_medians", "column_moments", "linear_preprocessor"]


class FoldPrep:
    """Statistics of one training table shared by every model fitted on it.

    Medians, means, scales and category levels are per column, so one fit on the
    union of numeric columns serves every subset (baseline, enriched, ablation
    configurations, linear or tree branch). ``fold_preps`` fits all folds of a
    run in the same jobs.
    """

    def __init__(self, numeric: Sequence[str], categorical: Sequence[str], scaler: NumericScalerModel, levels: dict[str, list[str]]):
        self.numeric, self.categorical, self.scaler = list(numeric), list(categorical), scaler
        self.levels = levels  # per column, alphabetically

    def model(self, numeric: Sequence[str], categorical: Sequence[str], linear: bool,
              output_col: str = "features") -> FeatureAssemblerModel:
        if list(categorical) != self.categorical or not set(numeric) <= set(self.numeric):
            raise ValueError("columns outside the prepared fold statistics")
        s = self.scaler
        num = NumericScalerModel(list(numeric), s.medians, s.means, s.scales, standardize=linear)
        return FeatureAssemblerModel(num, one_hot_model(self.levels, drop_first=linear), output_col)

    def layout(self, numeric: Sequence[str], categorical: Sequence[str], linear: bool) -> "FeatureLayout":
        """The same statistics as plain data; tree families take missing values as they are."""
        if list(categorical) != self.categorical or not set(numeric) <= set(self.numeric):
            raise ValueError("columns outside the prepared fold statistics")
        s = self.scaler
        levels = {c: v[:0:-1] if linear else v for c, v in self.levels.items()}  # linear: as the one-hot slots, first level dropped
        if not linear:
            return FeatureLayout(list(numeric), levels)
        return FeatureLayout(list(numeric), levels, {c: s.medians.get(c) for c in numeric}, {c: s.means[c] for c in numeric},
                             {c: s.scales[c] for c in numeric})


def fold_preps(tables: dict[int, DataFrame], numeric: Sequence[str], categorical: Sequence[str]) -> dict[int, FoldPrep]:
    """Shared statistics of several training tables: the distinct values of all columns are counted in one pass; medians and
    moments come from the counts. The levels are one job more."""
    numeric = list(dict.fromkeys(numeric))
    counts = value_counts(reduce(DataFrame.unionByName, [
        df.select(F.lit(k).cast("int").alias("task"), F.array(*[F.col(c).cast("double") for c in numeric]).alias("x"))
        for k, df in tables.items()])).checkpoint(eager=True)
    # a missing value takes the median, so it adds to neither sum of distances from the median
    found = counted_quantiles(counts.where(F.col("v").isNotNull()), "v", "c", [0.5], ["task", "f"], prefix="mediane", mean_at_half=True)
    away = F.col("v") - F.col("mediane0")
    sums = counts.join(F.broadcast(found), ["task", "f"], "left").groupBy("task", "f").agg(
        F.first("mediane0").alias("mediane"), F.sum("c").alias("n"), F.sum(F.col("c") * away).alias("s1"), F.sum(F.col("c") * away * away).alias("s2"))
    medians: dict[int, dict[str, float]] = {k: {} for k in tables}
    means: dict[int, dict[str, float | None]] = {k: dict.fromkeys(numeric) for k in tables}
    scales: dict[int, dict[str, float]] = {k: dict.fromkeys(numeric, 1.0) for k in tables}
    for r in sums.collect():
        if r["mediane"] is not None:
            k, c, off = r["task"], numeric[r["f"]], r["s1"] / r["n"]
            medians[k][c], means[k][c] = r["mediane"], r["mediane"] + off
            scales[k][c] = math.sqrt(max(r["s2"] / r["n"] - off * off, 0.0)) or 1.0
    levels = column_levels(tables, categorical)
    out = {}
    for k in tables:
        out[k] = FoldPrep(numeric, categorical, NumericScalerModel(numeric, medians[k], means[k], scales[k]), levels[k])
    return out


@dataclass
class FeatureLayout:
    """PRE1-5 of one fitted model as plain data: numeric columns, then one slot a kept category level.

    With ``medians`` the numerics are filled, centred and scaled (PRE1-2, a column without any value is 0);
    without, they stay as they are and a missing value is NULL.
    """

    numeric: list[str]
    levels: dict[str, list[str]] = field(default_factory=dict)
    medians: dict[str, float | None] | None = None
    means: dict[str, float | None] = field(default_factory=dict)
    scales: dict[str, float] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return self.numeric + [f"{c}_{v}" for c, vs in self.levels.items() for v in vs]

    def columns(self) -> list[F.Column]:
        out = []
        for c in self.numeric:
            x = F.col(c).cast("double")
            if self.medians is not None:
                x = (F.coalesce(x, F.lit(self.medians.get(c)).cast("double")) - F.lit(self.means.get(c) or 0.0)) / F.lit(
                    self.scales.get(c) or 1.0)
                x = F.coalesce(x, F.lit(0.0))
            out.append(x)
        for c, vs in self.levels.items():
            out += [F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("double"), F.lit(0.0)) for v in vs]
        return out

    def vector(self) -> F.Column:
        return F.array(*self.columns())

    def to_dict(self) -> dict:
        return asdict(self)

    @staticmethod
    def from_dict(d: dict) -> "FeatureLayout":
        return FeatureLayout(**d)
