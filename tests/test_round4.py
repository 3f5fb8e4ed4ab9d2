"""Findings of round 3, third pass: how often rows are sent and written."""

import pytest
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayrisk.operators import newton
from stayrisk.plans import inputs, store
from stayrisk.sources import fixture
from stayrisk.sources.readers import read_csv
from stayrisk.sources.schema import SUBMISSION_SCHEMA

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bookings_are_sent_by_customer_without_a_checkpoint(spark, monkeypatch):
    monkeypatch.setattr(DataFrame, "checkpoint", lambda *a, **k: pytest.fail("rows are checkpointed"))
    plan = _plan(fixture.derive_reservations(spark, SF))
    assert "rangepartitioning" not in plan and plan.count("Window [") == 1


@pytest.mark.parametrize("hot", [3, 10**9])
def test_history_of_hot_customers_is_that_of_one_window(spark, monkeypatch, hot):
    monkeypatch.setattr(fixture, "HOT_ORDERS", hot)
    # ties of (date, key) are rows that are equal; customer 1 has a null date and repeated days
    rows = spark.createDataFrame(
        [(1, k, None if k < 3 else f"2000-01-{1 + k // 3:02d}", k % 2) for k in range(40)] + [(2, 100, "2000-01-01", 1), (3, 101, None, 0), (3, 102, "1960-05-05", 1)],
        "o_custkey long, o_orderkey long, d string, reservation_annulee int").withColumn("date_reservation", F.col("d").cast("date"))
    whole = Window.partitionBy("o_custkey").orderBy("date_reservation", "o_orderkey").rowsBetween(Window.unboundedPreceding, 0)
    want = rows.select("*", F.sum(F.lit(1)).over(whole).alias("__rn"), F.sum("reservation_annulee").over(whole).alias("__cum_target"))
    got = fixture._customer_history(rows, [1, 3] if hot == 3 else [])
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_hot_customers_are_found_in_the_orders(spark, monkeypatch):
    n = {r["o_custkey"]: r["count"] for r in fixture.table(spark, SF, "orders").groupBy("o_custkey").count().collect()}
    monkeypatch.setattr(fixture, "HOT_ORDERS", 12)
    assert set(fixture._hot_customers(spark, SF)) == {k for k, c in n.items() if c > 12 and k is not None}
    few = fixture.derive_reservations(spark, SF)
    monkeypatch.setattr(fixture, "HOT_ORDERS", 10**9)
    assert fixture._hot_customers(spark, SF) == []
    assert sorted(map(str, few.collect())) == sorted(map(str, fixture.derive_reservations(spark, SF).collect()))


def test_fold_copies_are_not_stored(spark, monkeypatch):
    monkeypatch.setattr(store, "written", lambda *a, **k: pytest.fail("copies of rows are written"))
    folds = inputs.fold_table(spark, SF)
    assert {(r["fold"], r["role"]) for r in folds.select("fold", "role").distinct().collect()} == {(k, r) for k in range(1, 5) for r in ("train", "val")}


def test_numbered_csv_rows_are_neither_checkpointed_nor_shuffled(spark, tmp_path):
    want = [(f"R{i}", None if i % 7 == 0 else i / 100, i % 2) for i in range(500)]
    for part in range(3):
        lines = ["reservation_id,probabilite_annulation,reservation_annulee"]
        lines += [f"{a},{'' if b is None else b},{c}" for a, b, c in want[part * 200:part * 200 + 200]]
        (tmp_path / f"part-{part}.csv").write_text("\n".join(lines) + "\n")
    got = read_csv(spark, str(tmp_path), SUBMISSION_SCHEMA, position="pos")
    plan = _plan(got)
    assert "hashpartitioning(__path" not in plan and "Scan ExistingRDD[reservation_id" not in plan
    assert [tuple(r)[:3] for r in sorted(got.collect(), key=lambda r: r["pos"])] == want
    assert sorted(r["pos"] for r in got.collect()) == list(range(500))


def test_logistic_rows_are_counted_without_their_vectors(spark, monkeypatch):
    rows = spark.range(400).select(F.lit(0).alias("task"), F.col("id").alias("key"), (F.col("id") % 2).cast("double").alias("y"),
                                   F.array(F.col("id") / 400).alias("x"))
    monkeypatch.setattr(newton.F, "size", lambda c: pytest.fail("every vector is built to be counted"))
    assert len(newton.solve(rows, [newton.LogisticFit("m", 0, 1.0, (0,))])["m", 0]) == 2
