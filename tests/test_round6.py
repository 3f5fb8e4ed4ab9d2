"""Round 4: joint bins of the boosting passes, forests in few bytes, rows of the Newton passes compressed, folds not stored."""

import datetime as dt

import numpy as np
import pyarrow as pa
import pytest

from stayrisk.operators import boosting, forest, newton
from stayrisk.operators.folds import temporal_folds
from stayrisk.plans import validation


def _chunk(rng, sizes, n, start=-1.1):
    bins = np.stack([rng.integers(0, s, n) for s in sizes]).astype(np.uint8)
    y = (rng.random(n) < 0.2 + 0.4 * (bins[0] > 90) * (bins[-1] > 0)).astype(np.uint8)
    key = rng.integers(-2**62, 2**62, n)
    return (0, n, bins.tobytes(), y.tobytes(), key.tobytes(), np.full((1, n), start).tobytes()), bins, y, key


def test_chunks_of_the_passes_hold_joint_bins():
    """A row has fewer bytes than columns, every column comes back out of its joint bin, and rows find the same nodes."""
    sizes = [255, 254, 256, 163, 13, 3] + [2] * 40
    n_cuts = [s - 2 for s in sizes]  # the highest bin is the missing values'
    chunk, bins, _, _ = _chunk(np.random.default_rng(1), sizes, 5000)
    own = boosting._Shared(n_cuts)
    codes = own.codes(own.coded(chunk))
    assert 2 * len(codes) < len(sizes) / 2
    assert all(np.array_equal(own.column(codes, c), bins[c]) for c in range(len(sizes)))
    splits = [(0, 0, 90, False, 1, 2), (1, 45, 0, False, 3, 4), (2, 3, 40, True, 5, 6)]
    assert np.array_equal(own.node_of(codes, splits), boosting._node_of(dict(enumerate(bins)), splits, n_cuts, 5000))


def test_trees_of_the_passes_do_not_depend_on_when_scores_are_refreshed():
    """Coded and plain chunks, scores refreshed after every round or never: the same trees as those grown by one task."""
    sizes = [255, 200, 90] + [2] * 12
    n_cuts = [s - 1 for s in sizes]
    chunk, bins, y, key = _chunk(np.random.default_rng(3), sizes, 9000)
    p = boosting.BoostParams(4, 0.1, 6, 30, 5.0, row_share=0.8, column_share=0.8)
    ((_, want),) = boosting._alone({0: boosting._Growth(0, 0, p, n_cuts, False, -1.1, ahead=False)})([(0, chunk)])
    shared = {0: boosting._Shared(n_cuts, False)}
    for coded, refresh in ((True, True), (True, False), (False, False)):
        chunks = [shared[0].coded(chunk) if coded else chunk]
        m = boosting._Growth(0, 0, p, n_cuts, False, -1.1)
        while not m.done:
            (got,) = boosting._sums({0: [(0, m.request())]}, {0: n_cuts}, shared if coded else None)(chunks)
            m.receive(got[0])
            if refresh and m.since:
                chunks = list(boosting._refreshed({0: [m.since]}, shared)(chunks))
                m.since = []
        for a, b in zip(want, m.trees):
            assert sorted(zip(a.feature, a.cut)) == sorted(zip(b.feature, b.cut))
            assert np.allclose(sorted(a.value.values()), sorted(b.value.values()), atol=1e-12)


def test_forests_take_few_bytes_a_node(monkeypatch):
    """A task sends 15 bytes a node, the driver keeps 14; no Python number is made of a node."""
    rng = np.random.default_rng(5)
    bins = np.stack([rng.integers(0, 200, 6000), rng.integers(0, 5, 6000), rng.integers(0, 2, 6000)], 1).astype(np.uint8)
    y = (rng.random(6000) < 0.2 + 0.001 * bins[:, 0] + 0.2 * bins[:, 2]).astype(np.uint8)
    chunk = (0, 6000, bins.T.tobytes(), y.tobytes(), rng.integers(-2**62, 2**62, 6000).tobytes(), b"")
    sizes, p = {0: np.array([201, 6, 3])}, forest.ForestParams(2, 5, 0.7)
    sent = {index: tree for _, index, tree in forest._alone(sizes, p)([((0, 0), chunk)])}
    nodes = [len(t[1]) for t in sent.values()]
    assert min(nodes) > 100 and all(isinstance(v, bytes) for t in sent.values() for v in t)
    assert [sum(map(len, t)) for t in sent.values()] == [15 * n for n in nodes]
    cuts = [np.arange(199) + 0.5, np.arange(4) + 0.5, np.array([0.5])]
    trees = forest._flat([sent[0], sent[1]], cuts)
    assert trees.feature.nbytes + trees.left.nbytes + trees.value.nbytes == 14 * (sum(nodes) + 1)
    # joint bins give the same trees as a sum a column
    monkeypatch.setattr(forest, "JOINT_ROWS", 10**9)
    assert {index: tree for _, index, tree in forest._alone(sizes, p)([((0, 0), chunk)])} == sent
    share = trees.probability(bins.astype(float))
    assert abs(share.mean() - y.mean()) < 0.02 and share[y == 1].mean() > share[y == 0].mean() + 0.1


def test_rows_of_the_newton_passes_are_compressed_where_they_are_read():
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.integers(0, 9, 5000) / 7, rng.normal(size=5000), *(rng.integers(0, 2, (30, 5000)) * 1.0)])
    y = (rng.random(5000) < 0.3) * 1.0
    rows = pa.RecordBatch.from_pydict({"task": pa.array(np.zeros(5000, np.int32)), "y": y, "x": pa.array(list(x))})
    chunks = [tuple(c.column(i)[0].as_py() for i in range(5)) for c in newton._pack(iter([rows]))]
    assert sum(c[1] for c in chunks) == 5000 and sum(len(c[4]) for c in chunks) < x.nbytes / 5
    w = rng.normal(size=33) / 9
    (got,) = newton._moments({0: [(0, np.arange(33), w)]})(chunks)
    one = np.column_stack([np.ones(5000), x])
    q = 1 / (1 + np.exp(-one @ w))
    assert np.allclose(got[0][1], one.T @ (q - y)) and np.allclose(got[0][2], (one.T * (q * (1 - q))) @ one)


@pytest.mark.parametrize("n", [200, 3])
def test_temporal_folds_are_conditions_and_not_stored(spark, monkeypatch, n):
    """The rows of every fold are those of temporal_folds; folds without rows are left out; nothing is cached for them."""
    df = spark.createDataFrame([(f"R{i}", dt.date(1999, 1, 1) + dt.timedelta(days=i // 3), i) for i in range(n)], "reservation_id string, date_reservation date, v int")
    kept = []
    monkeypatch.setattr(validation, "FoldTables", lambda parts, *a: parts)
    monkeypatch.setattr(type(df), "persist", lambda self, *a: kept.append(self) or self)
    parts = validation._temporal(df, [], [])
    want = {}
    for r in temporal_folds(df).collect():
        want.setdefault((r["fold"], r["role"]), set()).add(r["v"])
    got = {(k, role): {r["v"] for r in t.collect()} for k, both in parts.items() for role, t in zip(("train", "val"), both)}
    assert not kept and {k: v for k, v in got.items() if v} == want and set(parts) == {k for k, _ in want}
