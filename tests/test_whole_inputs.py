import pytest
from oracle_harness import compare, duck
from pyspark.sql import functions as F

from stayrisk.plans import q_models
from stayrisk.registry import ORACLE, QUERIES
from stayrisk.sources.schema import MODEL_NUMERIC

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["pre1_model_median_imputation", "pre2_model_standardisation", "src2_load_both_sets"])
def test_whole_inputs_match_sql(spark, name):
    got = compare(spark, duck(SF), name, QUERIES[name], ORACLE[name], SF)
    assert got["status"] == "OK" and (name.startswith("src2") or got["spark_rows"] == len(MODEL_NUMERIC)), got


def test_both_sets_are_loaded(spark):
    assert {r.jeu for r in QUERIES["src2_load_both_sets"](spark, SF).select("jeu").distinct().collect()} == {"train", "test"}


def test_features_hold_every_model_column(spark):
    sizes = [r.n_variables for r in QUERIES["pre5_assembled_features"](spark, SF).select("n_variables").distinct().collect()]
    assert sizes == [len(MODEL_NUMERIC) + QUERIES["pre3_linear_onehot_layout"](spark, SF).count()]


def test_calibration_of_the_out_of_fold_scores(spark, monkeypatch):
    oof = spark.range(1000).select(F.lit(q_models.MODEL_ENSEMBLE).alias("model"), (F.col("id") % 2).cast("int").alias("y"), ((F.col("id") + 1) / 1000).alias("proba"))
    monkeypatch.setattr(q_models, "oof_scores", lambda spark, sf: oof.unionByName(oof.withColumn("model", F.lit("other"))))
    got = QUERIES["ens4_cv_calibration"](spark, SF)
    assert got.agg(F.sum("n")).first()[0] == 1000 and got.columns == ["tranche", "n", "proba_moyenne", "taux_reel"]
