"""Standard inputs of the registered queries, all derived by Spark from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.cleaning import clean
from ..operators.features import engineer
from ..sources import fixture


def raw(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return fixture.train_test(spark, sf_dir)


def cleaned(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    tr, te = raw(spark, sf_dir)
    return clean(tr), clean(te)


def engineered(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    tr, te = cleaned(spark, sf_dir)
    return engineer(tr), engineer(te)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.scored(spark, sf_dir)


def fold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training bookings (with the stand-in score) + fold and role.

    Membership is a comparison with a few keys in the scan, so the copies of a row (about three) are not stored.
    """
    from ..operators.folds import temporal_folds

    return temporal_folds(fixture.reservations(spark, sf_dir).filter(fixture.is_train()))
