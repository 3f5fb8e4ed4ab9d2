"""Histogram boosting against a plain booster, both ways of growing, drawing and missing values."""

import numpy as np
import pandas as pd
import pytest

from stayrisk.operators import boosting
from stayrisk.operators.boosting import BoostedTrees, BoostParams

SMALL = BoostParams(rounds=6, learning_rate=0.1, max_leaves=8, min_leaf=20, l2=5.0)


def _rows(spark, x, y, task=None):
    n = len(y)
    pdf = pd.DataFrame({"task": np.zeros(n, int) if task is None else task, "key": np.arange(n) * 7919 + 13, "y": y.astype(float), "x": [list(map(float, v)) for v in x]})
    return spark.createDataFrame(pdf)


def _plain(x, y, p, columns=None, bag=None):
    """Exact best-first booster: every threshold between distinct values, missing values to either side."""
    raw = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    levels = [np.unique(v[~np.isnan(v)]) for v in x.T]
    middles = [(v[:-1] + v[1:]) / 2 for v in levels]
    trees = []
    for turn in range(p.rounds):
        q = 1 / (1 + np.exp(-raw))
        g, h = q - y, q * (1 - q)
        use = np.arange(x.shape[1]) if columns is None else columns(turn)
        inside = np.ones(len(y), bool) if bag is None else bag(turn)

        def best(rows):
            rows = rows[inside[rows]]
            G, H = g[rows].sum(), h[rows].sum()
            top = (0, None)
            for f in use:
                v = x[rows, f]
                gap = np.isnan(v)
                for left in sorted({False, bool(gap.any())}):
                    for cut in [*middles[f], *([np.inf] if gap.any() else [])]:
                        go = (v <= cut) | (gap & left)
                        if min(go.sum(), (~go).sum()) < p.min_leaf:
                            continue
                        a, b = g[rows][go].sum(), h[rows][go].sum()
                        gain = a * a / (b + p.l2) + (G - a) ** 2 / (H - b + p.l2) - G * G / (H + p.l2)
                        if gain > top[0] + 1e-9:
                            top = (gain, (f, cut, left))
            return top

        leaves = [(np.arange(len(y)), *best(np.arange(len(y))))]
        splits = []
        while len(leaves) < p.max_leaves and max(v[1] for v in leaves) > 0:
            i = max(range(len(leaves)), key=lambda k: leaves[k][1])
            rows, gain, (f, cut, left) = leaves.pop(i)
            go = (x[rows, f] <= cut) | (np.isnan(x[rows, f]) & left)
            splits.append((int(f), round(float(cut), 9)))
            leaves += [(part, *best(part)) for part in (rows[go], rows[~go])]
        for rows, _, _ in leaves:
            own = rows[inside[rows]]
            raw[rows] += -p.learning_rate * g[own].sum() / (h[own].sum() + p.l2)
        trees.append(splits)
    return raw, trees


def _data(n=2000, missing=False, seed=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 60, n), rng.integers(0, 2, n), rng.normal(size=n).round(1), rng.integers(0, 9, n)]).astype(float)
    z = 0.05 * x[:, 0] - x[:, 1] * x[:, 2] - 1 + 0.3 * (x[:, 3] > 5)
    y = (rng.random(n) < 1 / (1 + np.exp(-z))).astype(float)
    if missing:
        x[rng.random(n) < 0.15 + 0.1 * y, 2] = np.nan
    return x, y


@pytest.mark.parametrize("alone_rows", [10**6, 0])
@pytest.mark.parametrize("missing", [False, True])
def test_equals_a_plain_booster(spark, alone_rows, missing):
    x, y = _data(missing=missing)
    raw, splits = _plain(x, y, SMALL)
    model = boosting.train(_rows(spark, x, y), {"m": SMALL}, alone_rows=alone_rows)["m", 0]
    assert [[(f, round(c, 9)) for f, c in zip(t.feature, t.cut)] for t in model.trees] == splits
    assert np.allclose(model.log_odds(x), raw, atol=1e-9)


def test_drawn_rows_and_columns(spark):
    x, y = _data()
    p = BoostParams(4, 0.1, 7, 30, 10.0, row_share=0.8, column_share=0.6)
    key = np.arange(len(y)) * 7919 + 13
    raw, splits = _plain(x, y, p, columns=lambda t: np.sort(np.random.default_rng([42, t]).choice(4, 2, replace=False)),
                         bag=lambda t: boosting._drawn(key, 42, t, 0.8))
    share = boosting._drawn(key, 42, 0, 0.8).mean()
    assert 0.76 < share < 0.84
    for alone in (10**6, 0):
        model = boosting.train(_rows(spark, x, y), {"m": p}, alone_rows=alone)["m", 0]
        assert [[(f, round(c, 9)) for f, c in zip(t.feature, t.cut)] for t in model.trees] == splits
        assert np.allclose(model.log_odds(x), raw, atol=1e-9)


def test_passes_refresh_scores_and_serve_many_models(spark, monkeypatch):
    monkeypatch.setattr(boosting, "REFRESH", 2)
    x, y = _data()
    task = (np.arange(len(y)) % 3 > 0).astype(int)
    families = {"a": SMALL, "b": BoostParams(5, 0.2, 5, 30, 1.0)}
    wide = boosting.train(_rows(spark, x, y, task), families, alone_rows=0)
    alone = boosting.train(_rows(spark, x, y, task), families)
    for name, p in families.items():
        for t in (0, 1):
            raw, _ = _plain(x[task == t], y[task == t], p)
            assert np.allclose(wide[name, t].log_odds(x[task == t]), raw, atol=1e-9)
            assert np.allclose(alone[name, t].log_odds(x[task == t]), raw, atol=1e-9)
    again = BoostedTrees.from_dict(wide["a", 0].to_dict())
    assert np.array_equal(again.log_odds(x), wide["a", 0].log_odds(x))


def test_odd_tables(spark):
    empty = _rows(spark, np.zeros((1, 2)), np.zeros(1)).where("key < 0")
    assert boosting.train(empty, {"m": SMALL}) == {}
    one = boosting.train(_rows(spark, np.ones((50, 2)), np.ones(50)), {"m": SMALL})["m", 0]
    assert (one.probability(np.ones((3, 2))) > 0.999).all()
    gaps = boosting.train(_rows(spark, np.full((90, 2), np.nan), np.arange(90) % 2), {"m": SMALL})["m", 0]
    assert np.allclose(gaps.probability(np.full((2, 2), np.nan)), 0.5)


def test_many_values_share_bins(spark):
    rng = np.random.default_rng(0)
    v = rng.normal(size=5000)
    cuts = boosting.cut_points(_rows(spark, v[:, None], v > 0), {0: 1}, 255)[0][0]
    assert len(cuts) == 254 and (np.diff(cuts) > 0).all()
    share = np.diff(np.searchsorted(np.sort(v), cuts, side="right"), prepend=0)
    assert share.min() >= 19 and share.max() <= 20


@pytest.mark.parametrize("bag", [False, True])
def test_joint_sums_equal_one_sum_a_column(bag):
    """Columns that share a byte give every column's own sums, and one pass over the rows serves a whole group."""
    rng = np.random.default_rng(1)
    sizes = [2] * 40 + [255, 3, 17, 90, 256]
    drawn = np.stack([rng.integers(0, s, 700) for s in sizes]).astype(np.uint8)
    widths = np.array(sizes) + 1
    begin = np.concatenate([[0], np.cumsum(widths)[:-1]])
    g, h = rng.normal(size=700), rng.random(700)
    rows = np.flatnonzero(rng.random(700) < 0.7) if bag else None
    slot = None if rows is None else rng.integers(0, 3, len(rows))
    nodes = 1 if slot is None else 3
    got, want = np.zeros((nodes, 3, widths.sum())), np.zeros((nodes, 3, widths.sum()))
    boosting._add_sums(got, drawn, begin, rows, slot, g, h)
    for i, r in enumerate(range(700) if rows is None else rows):
        for c in range(len(sizes)):
            want[0 if slot is None else slot[i], :, begin[c] + drawn[c, r]] += (g[r], h[r], 1)
    assert np.allclose(got, want, atol=1e-11)
    groups = boosting._joint(drawn.max(axis=1))
    assert sorted(c for v in groups for c in v) == list(range(len(sizes))) and len(groups) <= 10


def test_equal_columns_split_at_the_first(spark):
    x, y = _data()
    twin = np.column_stack([x[:, 0], x[:, 3], x[:, 0], 1 - x[:, 1], x[:, 1]])
    for alone in (10**6, 0):
        trees = boosting.train(_rows(spark, twin, y), {"m": SMALL}, alone_rows=alone)["m", 0].trees
        assert not {2, 4} & {f for t in trees for f in t.feature}


def test_table_held_whole_is_summed_in_few_groups_and_computed_once_a_tree(monkeypatch):
    """A tree grown alone: gradients and joint bins are made once, wide and narrow columns share sums, the trees are those of the passes."""
    rng = np.random.default_rng(3)
    n, tops = boosting.CHUNK_ROWS + 9, [255, 200, 90] + [2] * 12
    bins = np.stack([rng.integers(0, t, n) for t in tops]).astype(np.uint8)
    y = (rng.random(n) < 0.2 + 0.3 * (bins[0] > 99) + 0.2 * bins[4]).astype(np.uint8)
    key, n_cuts, p = rng.integers(-2**62, 2**62, n), [t - 1 for t in tops], BoostParams(3, 0.1, 6, 30, 5.0, row_share=0.8, column_share=0.8)
    made = []
    real = boosting._codes
    monkeypatch.setattr(boosting, "_codes", lambda drawn: made.append(real(drawn)) or made[-1])
    start = float(np.log(y.mean() / (1 - y.mean())))
    alone, passes = (boosting._Growth(0, 0, p, n_cuts, False, start, ahead=ahead) for ahead in (False, True))
    chunk = (0, n, bins.tobytes(), y.tobytes(), key.tobytes(), np.full(n, start).tobytes())
    ((_, trees),) = boosting._alone({0: alone})([(0, chunk)])
    assert len(made) == p.rounds and all(len(groups) <= 4 for groups in made)
    while not passes.done:
        (got,) = boosting._sums({0: [(0, passes.request())]}, {0: n_cuts})([chunk])
        passes.receive(got[0])
    for a, b in zip(trees, passes.trees):
        assert [sorted(zip(t.feature, t.cut)) for t in (a,)] == [sorted(zip(t.feature, t.cut)) for t in (b,)]
        assert np.allclose(sorted(a.value.values()), sorted(b.value.values()), atol=1e-12)
