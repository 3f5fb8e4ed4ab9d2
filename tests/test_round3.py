"""Findings of round 3: files that are written, sums ahead of a shuffle, passes over wide rows."""

import re

import pytest
from pyspark.sql import functions as F

from stayrisk.operators import ensemble, newton
from stayrisk.plans import q_data, validation

SF = "/root/testdata/sf0.001"


def test_only_the_named_csv_copies_are_written(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(q_data, "_io_path", lambda spark, sf, name: str(tmp_path / name))
    assert list(q_data.csv_copies(spark, SF, ["template_csv"])) == ["template_csv"]
    assert [p.name for p in tmp_path.iterdir()] == ["template_csv"]
    assert sorted(q_data.csv_copies(spark, SF)) == ["template_csv", "test_csv", "train_csv"]


def test_ensemble_does_not_sum_ids_ahead_of_the_shuffle(spark):
    scored = spark.range(2000).select(F.explode(F.array(F.lit("a"), F.lit("b"))).alias("model"), F.col("id").alias("reservation_id"),
                                      (F.col("id") % 2).cast("int").alias("y"), (F.col("id") / 2000).alias("proba"))
    weights = spark.createDataFrame([("a", 0.75), ("b", 0.25)], "model string, poids double")
    out = ensemble.ensemble_proba(scored, weights)
    plan = out._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("Initial Plan") if "Initial Plan" in plan else 0:]
    shuffle = re.search(r"Exchange hashpartitioning\(reservation_id", plan).start()
    assert "hashpartitioning(model" not in plan
    assert "HashAggregate" in plan[:shuffle] and "HashAggregate" not in plan[shuffle:]
    rows = out.orderBy("reservation_id").collect()
    assert len(rows) == 2000 and all(r["proba"] == pytest.approx(r["reservation_id"] / 2000) and r["y"] == r["reservation_id"] % 2 for r in rows)


def test_logistic_rows_are_dealt_to_bounded_partitions(spark, monkeypatch):
    rows = spark.range(3000).select(F.lit(0).alias("task"), F.col("id").alias("key"), (F.rand(3) < 0.3).cast("double").alias("y"),
                                    F.array(F.rand(1), F.rand(2)).alias("x"))
    whole = newton.solve(rows, [newton.LogisticFit("m", 0, 1.0, (0, 1))])
    seen = []
    monkeypatch.setattr(newton, "PART_BYTES", 3000 * 16 // 40)
    monkeypatch.setattr(newton, "FLAT_PARTITIONS", 1)
    from pyspark import RDD

    tree = RDD.treeReduce
    monkeypatch.setattr(RDD, "treeReduce", lambda self, f, depth=2: seen.append(self.getNumPartitions()) or tree(self, f, depth))
    cut = newton.solve(rows, [newton.LogisticFit("m", 0, 1.0, (0, 1))])
    assert seen and min(seen) >= 40
    assert cut["m", 0] == pytest.approx(whole["m", 0], abs=1e-9)


def test_all_models_of_a_fold_are_scored_in_one_branch(spark):
    class Share:
        out = "proba"

        def __init__(self, w):
            self.w = w

        def transform(self, d):
            return d.select("*", (F.col("v") * self.w).alias(self.out))

    val = {k: spark.range(5).select(F.concat(F.lit(f"R{k}"), F.col("id").cast("string")).alias("reservation_id"),
                                    (F.col("id") % 2).cast("int").alias("reservation_annulee"), (F.col("id") / 10).alias("v")) for k in (1, 2)}
    tables = object.__new__(validation.FoldTables)
    tables.val = val
    fitted = {(n, k): Share(w) for n, w in (("a", 1.0), ("b", 0.5)) for k in val}
    got = tables.scores_of_all(fitted, ["a", "b"])
    for f in fitted.values():
        f.out = "proba"
    want = [tables.scores({k: fitted[n, k] for k in val}, n) for n in ("a", "b")]
    want = want[0].unionByName(want[1])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got._jdf.queryExecution().analyzed().toString().count("Range (") == 2
