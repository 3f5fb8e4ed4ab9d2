import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayrisk.functions.columns import py_round
from stayrisk.functions.prefix import running_sums
from stayrisk.operators import metrics as M
from stayrisk.sources.readers import read_csv

SCHEMA = T.StructType([T.StructField("reservation_id", T.StringType()), T.StructField("nuits", T.IntegerType()), T.StructField("adultes", T.IntegerType())])


def test_csv_columns_are_bound_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("adultes,extra,reservation_id,nuits\n2,x,R1,9\nNA,y,R2,\n")
    rows = sorted(tuple(r) for r in read_csv(spark, str(tmp_path / "a.csv"), SCHEMA).collect())
    assert rows == [("R1", 9, 2), ("R2", None, None)]
    (tmp_path / "b.csv").write_text("reservation_id,adultes\nR1,2\n")
    with pytest.raises(ValueError, match="nuits"):
        read_csv(spark, str(tmp_path / "b.csv"), SCHEMA)


def test_running_sums_leave_carried_columns_alone(spark):
    big = [9007199254740993, 9007199254740995, None]
    rows = [(i % 2, i, big[i % 3], float("nan") if i % 5 == 0 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "g int, o int, b bigint, x double").withColumn("one", F.lit(1))
    out = running_sums(df, ["o"], ["one"], ["g"], ["c"], num_partitions=7, total_cols=["n"]).collect()
    assert len(out) == 40
    for r in out:
        want = rows[r.o]
        assert r.b == want[2] and ((r.x is None) == (want[3] is None)) and (r.x is None or math.isnan(r.x))
        assert r.c == r.o // 2 + 1 and r.n == 20
    plan = running_sums(df, ["o"], ["one"], ["g"], ["c"])._jdf.queryExecution().executedPlan().toString()
    assert "Pandas" not in plan and "Python" not in plan


def test_rounding_is_pythons(spark):
    rows = [(c / n, k) for n in range(1, 501) for c in range(n + 1) for k in (3,)] + [(x, 3) for x in (0.0125, 2.0005, 1.0005, 0.5, 1e-9, 123.4565)]
    df = spark.createDataFrame(rows, "x double, k int").select("x", py_round("x", 3).alias("r"))
    assert all(r.r == round(r.x, 3) for r in df.collect())


def test_best_metrics_match_metrics_at(spark):
    rows = [(i % 3, (i * 7919) % 2, ((i * 104729) % 1000) / 1000) for i in range(900)]
    df = spark.createDataFrame(rows, "g int, y int, proba double")
    a = {r.g: r for r in M.best_metrics(df, ["g"]).collect()}
    best = M.best_threshold(M.sweep(df, ["g"]), ["g"])
    for r in M.metrics_at(df, best, ["g"]).collect():
        for c in r.asDict():
            assert abs(r[c] - a[r.g][c]) < 1e-9, c


def test_equal_decile_edges_raise_on_request(spark):
    df = spark.createDataFrame([(i % 2, 0.5 if i < 60 else i / 100) for i in range(100)], "y int, proba double")
    assert M.deciles(df).count() < 10
    with pytest.raises(ValueError, match="unique"):
        M.deciles(df, duplicates="raise")
