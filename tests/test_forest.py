"""The forest's trees against plain recursive ones, both ways of growing."""

import numpy as np
import pandas as pd

from stayrisk.operators import forest
from stayrisk.operators.forest import ForestParams, ForestTrees

P = ForestParams(trees=6, min_leaf=15, column_share=0.5)


def _rows(spark, x, y, key, task=None):
    pdf = pd.DataFrame({"task": 0 if task is None else task, "key": key, "y": y.astype(float), "x": [list(map(float, v)) for v in x]})
    return spark.createDataFrame(pdf)


def _data(n=900, seed=5):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 30, n), rng.integers(0, 2, n), rng.normal(size=n).round(1), rng.integers(0, 5, n)]).astype(float)
    y = (rng.random(n) < 1 / (1 + np.exp(-(0.1 * x[:, 0] - 2 * x[:, 1] * x[:, 2] - 1)))).astype(int)
    return x, y, np.arange(n) * 104_729 + 7


def _plain(x, y, key, p):
    """Mean probability of trees grown one node at a time over every threshold."""
    out = np.zeros(len(y))
    middles = [(v[:-1] + v[1:]) / 2 for v in (np.unique(c) for c in x.T)]
    for tree in range(p.trees):
        w = forest.weights(key, p.seed, tree).astype(float)

        def grow(rows, path):
            own = w[rows]
            n, pos = own.sum(), (own * y[rows]).sum()
            columns = forest.drawn_columns(p.seed, tree, np.array([path]), x.shape[1], int(x.shape[1] * p.column_share))[0]
            top, best = 1e-9 * n, None
            for f in columns if 0 < pos < n else ():
                for cut in middles[f]:
                    go = x[rows, f] <= cut
                    nl, pl = own[go].sum(), (own[go] * y[rows][go]).sum()
                    nr, pr = n - nl, pos - pl
                    if min(nl, nr) < p.min_leaf:
                        continue
                    gain = (pl**2 + (nl - pl) ** 2) / nl + (pr**2 + (nr - pr) ** 2) / nr - (pos**2 + (n - pos) ** 2) / n
                    if gain > top + 1e-12:
                        top, best = gain, (f, cut)
            if best is None:
                out[rows] += pos / n if n else 0.0
                return
            go = x[rows, best[0]] <= best[1]
            for side, part in enumerate((rows[go], rows[~go])):
                grow(part, forest.child(np.array([path]), side)[0])

        grow(np.arange(len(y)), np.uint64(1))
    return out / p.trees


def test_equals_plain_trees_both_ways(spark, monkeypatch):
    monkeypatch.setattr(forest, "TREES_A_TASK", 4)
    x, y, key = _data()
    want = _plain(x, y, key, P)
    for alone in (10**6, 0):
        got = forest.train(_rows(spark, x, y, key), P, alone_rows=alone)[0]
        assert np.allclose(got.probability(x), want, atol=1e-12)
        again = ForestTrees.from_dict(got.to_dict())
        assert np.array_equal(again.probability(x), got.probability(x))


def test_levels_in_several_jobs(spark, monkeypatch):
    x, y, key = _data(400)
    monkeypatch.setattr(forest, "NODE_BYTES", 60_000)
    task = (np.arange(400) % 3 > 0).astype(int)
    got = forest.train(_rows(spark, x, y, key, task), P, alone_rows=0)
    for t in (0, 1):
        assert np.allclose(got[t].probability(x[task == t]), _plain(x[task == t], y[task == t], key[task == t], P), atol=1e-12)


def test_bootstrap_weights_are_poisson():
    w = np.concatenate([forest.weights(np.arange(20_000), 42, t) for t in range(5)])
    share = np.bincount(w, minlength=5)[:5] / len(w)
    assert np.abs(share - [0.3679, 0.3679, 0.1839, 0.0613, 0.0153]).max() < 0.006
    c = forest.drawn_columns(42, 0, np.arange(4000, dtype=np.uint64), 10, 3)
    assert (np.diff(c, axis=1) > 0).all() and np.abs(np.bincount(c.ravel(), minlength=10) / 1200 - 1).max() < 0.15


def test_odd_tables(spark):
    x, y, key = _data(50)
    assert forest.train(_rows(spark, x, y, key).where("key < 0"), P) == {}
    one = forest.train(_rows(spark, x, np.ones(50), key), P)[0]
    assert np.allclose(one.probability(x), 1.0)
    for alone in (10**6, 0):
        gap = x.copy()
        gap[y == 1, 2] = np.nan
        got = forest.train(_rows(spark, gap, y, key), ForestParams(20, 5, 1.0), alone_rows=alone)[0]
        assert (got.probability(gap)[y == 1] > 0.7).all() and (got.probability(gap)[y == 0] < 0.3).all()


def test_sums_of_a_level_in_blocks(monkeypatch):
    rng = np.random.default_rng(2)
    bins = rng.integers(0, 7, (500, 6)).astype(np.uint8)
    y, w, at = rng.integers(0, 2, 500), rng.integers(0, 3, 500).astype(np.uint8), rng.integers(-1, 4, 500)
    columns, sizes = np.sort(np.argsort(rng.random((4, 6)), axis=1)[:, :3], axis=1), np.full(6, 7)
    want = np.zeros((4, 3, 7, 2))
    for r in np.flatnonzero(at >= 0):
        for j, c in enumerate(columns[at[r]]):
            want[at[r], j, bins[r, c], y[r]] += w[r]
    for block in (30, 4096):
        monkeypatch.setattr(forest, "BLOCK_ROWS", block)
        assert np.array_equal(forest._node_sums(bins, y, w, at, columns, sizes), want.reshape(-1, 2))


def test_tables_of_a_usual_partition_are_grown_by_tasks():
    from stayrisk.operators.boosting import ALONE_BYTES, fits_alone

    assert fits_alone(600_000, 90, None) and not fits_alone(ALONE_BYTES, 2, None)
    assert fits_alone(10, 90, 10) and not fits_alone(11, 90, 10) and not fits_alone(1, 1, 0)
