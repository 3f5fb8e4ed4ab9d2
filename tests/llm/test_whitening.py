"""Whitening against numpy in double precision and exact integers."""

from fractions import Fraction

import numpy as np
import pytest

from stayrisk.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, component int, x int"


def _frame(spark, vectors, ids=None):
    rows = [(None if ids and ids[i] is None else i, None if v is None else [None if c is None else float(c) for c in v], 7, 7) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def brute(vectors):
    usable = {i: tuple(int(np.floor(256 * float(np.float32(c)))) + 0 for c in v) for i, v in enumerate(vectors)
              if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)}
    sizes = [len(v) for v in usable.values()]
    usable = {i: v for i, v in usable.items() if len(v) == max(sizes, key=lambda s: (sizes.count(s), s))}
    once = np.array(sorted(set(usable.values())), dtype=np.int64)
    n, sums = len(once), once.sum(0)
    z = once - sums / n
    cov = z.T @ z / n
    lam, vec = np.linalg.eigh(cov)
    return usable, n, sums, lam[::-1], vec[:, ::-1], cov


def check(spark, vectors):
    usable, n, sums, lam, vec, cov = brute(vectors)
    got = whitening.whiten(_frame(spark, vectors)).collect()
    k = min(4, int((lam > len(lam) * 1e-15 * lam.sum()).sum()))
    assert len(got) == len(usable) * k
    sign = {}
    for r in got:
        x, j = np.array(usable[r["vec_id"]]), r["component"] - 1
        assert r["n"] == n and r["deviation"] == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums))
        assert abs(r["explained"] / (lam[j] / lam.sum()) - 1) < 1e-9 and r["identity_error"] < 1e-8
        want = float((x - sums / n) @ vec[:, j] / np.sqrt(lam[j]))
        if abs(want) > 1e-6:
            sign.setdefault(j, np.sign(want * r["whitened"]))
        assert abs(r["whitened"] - sign.get(j, 1) * want) < 1e-6
    return got


def test_equals_numpy(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(300, 12)) * np.linspace(0.2, 2, 12)
    vectors = [*base.tolist(), *base[:80].tolist(), *([base[3].tolist()] * 100)]
    vectors += [None, [float("nan")] * 12, [None] + [0.0] * 11, [float("inf")] * 12, [], [1.0, 2.0]]
    check(spark, vectors)


def test_refinement_reaches_double_precision():
    rng = np.random.default_rng(1)
    for d in (1, 2, 9, 64):
        a = rng.normal(size=(d, d))
        v = a @ a.T
        lam, x = whitening.eigen(v)
        assert np.abs(x.T @ x - np.eye(d)).max() < 1e-13
        assert np.abs(v @ x - x * lam).max() < 1e-12 * np.abs(v).max() * d and (np.diff(lam) <= 0).all()
        rough = np.linalg.eigh(v.astype(np.float32))[1]
        if d > 2:  # float32 alone does not get there
            assert np.abs(rough.T @ v @ rough - np.diag(np.diag(rough.T @ v @ rough))).max() > 1e-9


@pytest.mark.parametrize("gap", [0.0, 1e-13, 1e-9, 1e-7, 1e-4])
def test_clustered_eigenvalues(gap):
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.normal(size=(20, 20)))[0]
    lam = np.array([5.0, 5.0 - gap, 5.0 - 2 * gap, 3.0, 3.0, *np.linspace(1, 2, 13), 0.5, 0.5 + gap])
    v = (q * lam) @ q.T
    got, x = whitening.eigen(v)
    assert np.abs(got - np.sort(lam)[::-1]).max() < 1e-12
    assert np.abs(x.T @ x - np.eye(20)).max() < 1e-13 and np.abs(v @ x - x * got).max() < 1e-12


def test_odd_tables(spark):
    assert whitening.whiten(_frame(spark, [])).collect() == []
    assert whitening.whiten(_frame(spark, [None, []])).collect() == []
    assert whitening.whiten(_frame(spark, [[1.0, 2.0]] * 5)).collect() == []  # one distinct vector: no variance
    two = whitening.whiten(_frame(spark, [[1.0, 2.0], [3.0, 2.0], [3.0, 2.0]])).collect()
    assert {(r["component"], round(abs(r["whitened"]), 9)) for r in two} == {(1, 1.0)} and len(two) == 3
    kept = whitening.whiten(_frame(spark, [[-0.0, 1.0], [0.001, -0.001]], ids=[None, 1])).collect()
    assert sorted(map(str, {r["vec_id"] for r in kept})) == ["1", "None"]


def test_deviations_beyond_64_bits():
    v = np.array([[10**9, -(10**9)]])
    assert whitening._deviations(v, 10, [0, 0]) == [None]
    assert whitening._deviations(np.array([[3, 4]]), 2, [1, 1]) == [int(Fraction(5) ** 2 + 7**2)]


def test_registered_query_equals_numpy(spark):
    from stayrisk.llm import queries

    sf = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").toPandas().sort_values("vec_id", ignore_index=True)
    assert list(source["vec_id"]) == list(range(len(source)))
    usable, n, sums, lam, vec, _ = brute(source["embedding"].tolist())
    got = queries.QUERIES["op11_whitening"](spark, sf).toPandas()
    assert len(got) == 4 * len(usable) and (got["n"] == n).all() and got["identity_error"].nunique() == 1
    x = np.array([usable[i] for i in got["vec_id"]])
    assert (got["deviation"].to_numpy() == ((n * x - sums) ** 2).sum(1)).all()
    want = ((x - sums / n) @ vec[:, :4] / np.sqrt(lam[:4]))[np.arange(len(got)), got["component"] - 1]
    assert np.allclose(np.abs(want), np.abs(got["whitened"]), atol=1e-8)
    for c in range(1, 5):
        pick = (got["component"] == c).to_numpy()
        assert abs(np.corrcoef(want[pick], got["whitened"][pick])[0, 1]) > 1 - 1e-12
