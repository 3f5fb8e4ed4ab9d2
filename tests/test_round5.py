"""Round 3, fourth pass: values counted in one pass, price lookups broadcast, forest levels in groups of nodes."""

import datetime as dt

import numpy as np
import pytest

from stayrisk.functions.counts import value_counts
from stayrisk.operators import boosting, forest
from stayrisk.operators.encoding import fold_preps
from stayrisk.operators.reference import fit_reference, relative_prices


def test_value_counts_tell_null_from_nan(spark):
    rows = [(1, [1.0, None]), (1, [-0.0, float("nan")]), (1, [0.0, 2.0]), (2, [3.0]), (2, [3.0])]
    got = {(r["task"], r["f"], str(r["v"])): r["c"] for r in value_counts(spark.createDataFrame(rows, "task int, x array<double>")).collect()}
    assert got == {(1, 0, "1.0"): 1.0, (1, 0, "0.0"): 2.0, (1, 1, "None"): 1.0, (1, 1, "nan"): 1.0, (1, 1, "2.0"): 1.0, (2, 0, "3.0"): 2.0}


def test_fold_statistics_come_from_counts(spark, monkeypatch):
    """No row is exploded into a record a column; medians, means and scales are numpy's on imputed values."""
    monkeypatch.setattr("stayrisk.operators.encoding.stacked", lambda *a: pytest.fail("rows were exploded"))
    rng = np.random.default_rng(3)
    tables, plain = {}, {}
    for k, n in ((1, 200), (4, 333)):
        rows = [(float(v) if v > -1 else None, 0.1, None, i % 7, None if i % 5 == 0 else f"c{i % 3}") for i, v in enumerate(rng.normal(size=n))]
        plain[k] = rows
        tables[k] = spark.createDataFrame(rows, "a double, b double, c double, d int, k string").repartition(3)
    preps = fold_preps(tables, ["a", "b", "c", "d"], ["k"])
    for k, rows in plain.items():
        s = preps[k].scaler
        a = np.array([np.nan if r[0] is None else r[0] for r in rows])
        filled = np.where(np.isnan(a), np.nanmedian(a), a)
        d = np.array([r[3] for r in rows], float)
        assert s.medians["a"] == np.nanmedian(a) and s.medians["d"] == np.median(d) and "c" not in s.medians
        assert s.means["a"] == pytest.approx(filled.mean(), rel=1e-12) and s.scales["a"] == pytest.approx(filled.std(), rel=1e-12)
        assert s.means["d"] == pytest.approx(d.mean(), rel=1e-12) and s.scales["d"] == pytest.approx(d.std(), rel=1e-12)
        assert (s.means["b"], s.scales["b"]) == (0.1, 1.0) and (s.means["c"], s.scales["c"]) == (None, 1.0)
        assert preps[k].levels == {"k": ["c0", "c1", "c2"]}


def test_table_facts_and_cuts_of_one_count(spark):
    rows = [(0, i, float(i % 4 == 0), [float(i), None if i == 3 else 1.0]) for i in range(40)] + [(7, i, 1.0, [2.0]) for i in range(5)]
    facts, counted = boosting.table_facts(spark.createDataFrame(rows, "task int, key long, y double, x array<double>"))
    assert {t: (r["n"], r["rate"], r["width"], r["missing"]) for t, r in facts.items()} == {0: (40, 0.25, 2, True), 7: (5, 1.0, 1, False)}
    cuts = boosting.counted_cut_points(counted, {0: 2, 7: 1}, 255)
    assert cuts[0][0].tolist() == [i + 0.5 for i in range(39)] and not len(cuts[0][1]) and not len(cuts[7][0])


def test_small_price_lookups_do_not_send_the_bookings(spark):
    day = dt.date(1999, 1, 1)
    rows = [(f"R{i}", day, f"H{i % 3}" if i % 9 else None, "r1", 1 + i % 12, 50.0 + i, "x") for i in range(60)]
    df = spark.createDataFrame(rows, "reservation_id string, date_reservation date, hotel_id string, region_hotel string, mois_arrivee int, "
                                     "prix_moyen_nuit_eur double, canal_reservation string").repartition(2)
    ref = fit_reference(df, ["canal_reservation"])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = relative_prices(df, ref)
        assert "SortMergeJoin" not in out._jdf.queryExecution().toString()
        got = {r["reservation_id"]: r["prix_relatif_hotel"] for r in out.collect()}
        ref.lookup_rows = None  # as loaded: the planner chooses
        again = relative_prices(df, ref)
        assert "SortMergeJoin" in again._jdf.queryExecution().toString()
        assert got == {r["reservation_id"]: r["prix_relatif_hotel"] for r in again.collect()} and len(got) == 60
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_tree_does_not_depend_on_the_groups_of_nodes(monkeypatch):
    """A level's nodes are summed a few at a time, and numbered in one call a side."""
    rng = np.random.default_rng(5)
    bins = np.stack([rng.integers(0, 200, 6000), rng.integers(0, 5, 6000), rng.integers(0, 2, 6000)], 1).astype(np.uint8)
    y = (rng.random(6000) < 0.2 + 0.001 * bins[:, 0] + 0.2 * bins[:, 2]).astype(np.int64)
    key, sizes, p = rng.integers(-2**62, 2**62, 6000), np.array([201, 6, 3]), forest.ForestParams(1, 5, 0.7)
    calls, largest = [], []
    child, best = forest.child, forest.best_splits
    monkeypatch.setattr(forest, "child", lambda path, side: calls.append(len(path)) or child(path, side))
    monkeypatch.setattr(forest, "best_splits", lambda sums, wide, least: largest.append(len(sums)) or best(sums, wide, least))

    def grown(cells):
        monkeypatch.setattr(forest, "GROUP_CELLS", cells)
        calls.clear(), largest.clear()
        t = forest._grown(bins, y, key, 0, p, sizes)
        return t.feature, t.cut, t.left, t.right, [c.tolist() for c in t.counts]

    whole = grown(10**9)
    assert len(whole[0]) > 100 and len(calls) < 2 * 64 and sum(calls) == len(whole[0]) - 1
    assert grown(500) == whole and max(largest) <= 500 + 207
