import numpy as np
import pandas as pd
import pytest

from stayrisk.operators import errors as E
from stayrisk.operators import metrics as M


def _scores(n=3000, seed=5):
    rng = np.random.default_rng(seed)
    grid = M.threshold_grid()
    p = np.round(rng.random(n), 3)
    p[:200] = rng.choice(grid, 200)  # scores exactly on grid points (T12)
    y = (rng.random(n) < p * 0.8).astype(int)
    return pd.DataFrame({"g": rng.integers(0, 2, n), "y": y, "proba": p})


def _f1(y, pred):
    tp = int(((y == 1) & (pred == 1)).sum()); fp = int(((y == 0) & (pred == 1)).sum())
    fn = int(((y == 1) & (pred == 0)).sum())
    return 0.0 if 2 * tp + fp + fn == 0 else 2 * tp / (2 * tp + fp + fn)


def _auc(y, p):
    ranks = pd.Series(p).rank(method="average").to_numpy()
    npos, nneg = y.sum(), len(y) - y.sum()
    return (ranks[y == 1].sum() - npos * (npos + 1) / 2) / (npos * nneg)


def _ap(y, p):
    order = np.argsort(-p, kind="mergesort")
    ys, ps = y[order], p[order]
    distinct = np.r_[np.flatnonzero(np.diff(ps)), len(ps) - 1]
    tps = np.cumsum(ys)[distinct]; pps = distinct + 1
    rec = tps / ys.sum(); prec = tps / pps
    return float(np.sum(np.diff(np.r_[0, rec]) * prec))


def test_sweep_equals_brute_force(spark):
    pdf = _scores()
    out = M.sweep(spark.createDataFrame(pdf), ["g"]).toPandas()
    grid = M.threshold_grid()
    for g, part in pdf.groupby("g"):
        y, p = part["y"].to_numpy(), part["proba"].to_numpy()
        got = out[out.g == g].sort_values("i")
        for i, t in enumerate(grid):
            pred = (p >= t).astype(int)
            row = got.iloc[i]
            assert row["seuil"] == t
            assert row["vp"] == int(((y == 1) & (pred == 1)).sum()) and row["fp"] == int(((y == 0) & (pred == 1)).sum())
            assert np.isclose(row["f1"], _f1(y, pred))
        best = M.best_threshold(M.sweep(spark.createDataFrame(part))).first()
        f1s = [_f1(y, (p >= t).astype(int)) for t in grid]
        assert best["seuil"] == grid[int(np.argmax(f1s))]


def test_ranking_metrics_match_brute_force(spark):
    pdf = _scores(seed=9)
    df = spark.createDataFrame(pdf)
    auc = M.roc_auc(df, ["g"]).toPandas().set_index("g")["roc_auc"]
    ap = M.average_precision(df, ["g"]).toPandas().set_index("g")["pr_auc"]
    for g, part in pdf.groupby("g"):
        y, p = part["y"].to_numpy(), part["proba"].to_numpy()
        assert np.isclose(auc[g], _auc(y, p))
        assert np.isclose(ap[g], _ap(y, p))
    one_class = spark.createDataFrame(pd.DataFrame({"y": [0, 0, 0], "proba": [0.1, 0.2, 0.3]}))
    assert M.roc_auc(one_class).first()["roc_auc"] is None


def test_deciles_calibration_tiers(spark):
    pdf = _scores(seed=11)
    df = spark.createDataFrame(pdf)
    d = M.deciles(df).toPandas().sort_values("decile")
    labels = pd.qcut(pdf["proba"], 10, labels=False, duplicates="drop") + 1
    exp = pdf.assign(decile=labels).groupby("decile").size()
    assert d["n"].tolist() == exp.tolist()
    assert np.isclose(d["part_annulations"].sum(), 1.0, atol=0.01)
    cal = M.calibration(df).toPandas()
    cut = pd.cut(pdf["proba"], [0, .1, .2, .3, .4, .5, .6, 1.0])
    assert cal["n"].sum() == cut.notna().sum()
    tiers = M.risk_tiers(df).toPandas().set_index("niveau")
    assert tiers.loc["vert", "n"] == int((pdf["proba"] < 0.2).sum())


def test_group_performance_min_size_and_empty(spark):
    rows = [("a", 1, 1)] * 30 + [("a", 0, 1)] * 29 + [("b", 1, 0)] * 60
    df = spark.createDataFrame(rows, "k string, y_reel int, y_predit int")
    out = E.group_performance(df, "k", 60).toPandas()
    assert out["k"].tolist() == ["b"]
    empty = E.group_performance(df, "k", 1000)
    assert empty.count() == 0 and "f1" in empty.columns


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"y_reel": rng.integers(0, 2, 500), "proba": rng.random(500)})
    out = E.class_histogram(spark.createDataFrame(pdf)).toPandas()
    for c, part in pdf.groupby("y_reel"):
        counts, edges = np.histogram(part["proba"], bins=30)
        got = out[out.classe == c].sort_values("bin")
        assert got["n"].tolist() == counts.tolist()
        assert np.allclose(got["borne_basse"], edges[:-1])


def test_quarterly_spine_keeps_empty_quarters(spark):
    import datetime as dt

    from stayrisk.operators.eda import quarterly_rate

    rows = [(dt.date(2023, 1, 5), 1), (dt.date(2023, 2, 1), 0), (dt.date(2023, 10, 3), 1)]
    df = spark.createDataFrame(rows, "date_reservation date, reservation_annulee int")
    out = {r["trimestre"]: (r["effectif"], r["taux_annulation"]) for r in quarterly_rate(df).collect()}
    assert out == {dt.date(2023, 3, 31): (2, 0.5), dt.date(2023, 6, 30): (0, None),
                   dt.date(2023, 9, 30): (0, None), dt.date(2023, 12, 31): (1, 1.0)}


def test_median_lead_reindexed_with_missing_type(spark):
    rows = [("vrai positif", 10), ("vrai positif", 20), ("faux négatif", 7)]
    df = spark.createDataFrame(rows, "type_erreur string, delai_reservation_jours int")
    out = {r["type_erreur"]: r["delai_median"] for r in E.median_lead_by_error(df).collect()}
    assert out == {"vrai positif": 15.0, "faux positif": None, "faux négatif": 7.0, "vrai négatif": None}
