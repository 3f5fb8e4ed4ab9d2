"""Neighbours against brute force: exactness in one part, recall over many, odd rows."""

import numpy as np
from pyspark.sql import functions as F

from stayrisk.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>, rank int, score double"


def _frame(spark, vectors, ids=None):
    ids = ids or range(len(vectors))
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 1, 0.5) for i, v in zip(ids, vectors)], SCHEMA).repartition(3)


def brute(ids, vectors, asked, k=5):
    x = np.array(vectors, np.float32).astype(float)
    out = {}
    for i in asked:
        at = ids.index(i)
        s = ann.cosine(x[at], x)
        order = sorted((-s[j], ids[j]) for j in range(len(ids)) if j != at)
        out[i] = [(e, -v) for v, e in order[:k]]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def _mixed(n, d=16, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    tight = centres[rng.integers(0, 12, n // 2)] + 0.03 * rng.normal(size=(n // 2, d))
    return np.concatenate([tight, rng.normal(size=(n - n // 2, d))]).astype(np.float32)


def test_exact_with_one_part(spark):
    x = _mixed(600).tolist()
    x[100] = x[50]  # copies of a query
    x[101] = x[50]
    ids = list(range(600))
    got = answers(ann.neighbours(_frame(spark, x), F.col("id") % 50 == 0))
    assert got == brute(ids, x, [i for i in ids if i % 50 == 0])


def test_recall_over_many_parts(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART_ROWS", 128)
    monkeypatch.setattr(ann, "TILE_ROWS", 100)
    monkeypatch.setattr(ann, "QUERY_ROWS", 8)
    x = _mixed(2500)
    df = _frame(spark, x.tolist())
    router = ann.fit(ann.usable(df, "vec_id", "embedding"), 2500, 5)
    assert router.parts == 2500 // 128 and router.probes < router.parts
    got = answers(ann.neighbours(df, F.col("id") % 50 == 0))
    want = brute(list(range(2500)), x.tolist(), range(0, 2500, 50))
    hit = np.mean([len({e for e, _ in got[q]} & {e for e, _ in want[q]}) / 5 for q in want])
    assert hit >= 0.9
    scores = {(q, e): s for q, v in want.items() for e, s in v}
    assert all(abs(scores[q, e] - s) < 1e-14 for q, v in got.items() for e, s in v if (q, e) in scores)


def test_parts_are_balanced():
    x = ann._unit(_mixed(1000).astype(float))
    graph = ann.neighbour_graph(x, 10)
    label = ann.balanced_parts(x, graph, 7)
    sizes = np.bincount(label, minlength=7)
    assert sizes.min() >= 1000 // 7 - 4 and sizes.max() <= 1000 // 7 + 4
    kept = (label[graph] == label[:, None]).mean()
    rng = np.random.default_rng(0)
    assert kept > 2 * (rng.permutation(label)[graph] == label[:, None]).mean()


def test_one_hot_vector(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART_ROWS", 64)
    x = _mixed(600).tolist()
    x[:300] = [x[0]] * 300
    got = answers(ann.neighbours(_frame(spark, x), F.col("id") % 50 == 0))
    assert [e for e, _ in got[0]] == [1, 2, 3, 4, 5] and [e for e, _ in got[250]] == [0, 1, 2, 3, 4]


def test_odd_rows(spark):
    near = F.col("id") % 50 == 0
    assert ann.neighbours(_frame(spark, []), near).collect() == []
    assert ann.neighbours(_frame(spark, [None, [], [0.0, 0.0], [float("nan"), 1.0], [None, 1.0], [float("inf"), 1.0]]), near).collect() == []
    assert ann.neighbours(_frame(spark, [[1.0, 2.0]]), near).collect() == []  # no candidate but the query's own row
    ids = [0, 0, 0, None, 7, 8, 9]
    x = [[1.0, 0.0], [1.0, 0.0], [0.0, 2.0], [2.0, 0.0], [2.0, 0.0], [0.0, -1.0], [1.0, 2.0, 3.0]]
    got = sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in ann.neighbours(_frame(spark, x, ids), near).collect() if r["vec_id"] is not None)
    # the repeated row is one; id 0 has two vectors, each barred from itself only; the other length takes no part
    assert got == sorted([(0, 1, 7, 1.0), (0, 3, 0, 0.0), (0, 4, 8, 0.0), (0, 1, 0, 0.0), (0, 2, 7, 0.0), (0, 4, 8, -1.0)])


def test_extreme_sizes(spark):
    x = [[1e-30, 0.0], [1e30, 1e30], [1e-30, 1e-30], [-1e30, 0.0]]
    got = answers(ann.neighbours(_frame(spark, x), F.col("id") == 0))[0]
    assert [e for e, _ in got] == [1, 2, 3] and np.allclose([s for _, s in got], [2**-0.5, 2**-0.5, -1.0])
