import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stayrisk.operators.encoding import FeatureAssembler, OneHot
from stayrisk.operators.models import LogisticFamily


def test_onehot_drop_first_and_unknown(spark):
    tr = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "k string")
    m = OneHot(["k"], drop_first=True).fit(tr)
    assert m.slot_names == ["k_c", "k_b"]  # alphabetically first level 'a' dropped
    te = spark.createDataFrame([("a",), ("b",), ("z",)], "k string")
    vec = [list(r[0]) for r in m.transform(te).select(vector_to_array(m.output_cols[0])).collect()]
    assert vec == [[0.0, 0.0], [0.0, 1.0], [0.0, 0.0]]  # reference level and unknown level are all zeros
    trees = OneHot(["k"], drop_first=False).fit(tr)
    assert trees.slot_names == ["k_a", "k_b", "k_c"]


def _newton(X, y, C, iters=50):
    Xb = np.c_[np.ones(len(X)), X]
    w = np.zeros(Xb.shape[1])
    reg = np.r_[0.0, np.ones(X.shape[1])]
    for _ in range(iters):
        p = 1 / (1 + np.exp(-Xb @ w))
        g = C * Xb.T @ (p - y) + reg * w
        H = C * (Xb.T * (p * (1 - p))) @ Xb + np.diag(reg)
        w -= np.linalg.solve(H, g)
    return w


def test_logistic_matches_independent_newton_solve(spark):
    rng = np.random.default_rng(0)
    n = 400
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(0.8 * x1 - 0.5 * x2)))).astype(int)
    pdf = pd.DataFrame({"x1": x1, "x2": x2, "reservation_annulee": y, "k": rng.choice(["u", "v"], n)})
    df = spark.createDataFrame(pdf)
    est = LogisticFamily("lr", ["x1", "x2"], [], 0.05)
    model = est.fit(df)
    Xs = np.c_[(x1 - x1.mean()) / x1.std(), (x2 - x2.mean()) / x2.std()]
    w = _newton(Xs, y, 0.05)
    assert np.allclose(model.weights, w, atol=1e-10)


def test_stream_scoring_equals_batch(spark, tmp_path):
    from stayrisk.operators.ensemble import EnsembleEstimator
    from stayrisk.operators.reference import fit_reference
    from stayrisk.plans import inputs
    from stayrisk.sources.schema import MODEL_LOGREG
    from stayrisk.streaming.scoring import run_scoring, score_stream
    from stayrisk.operators.models import build_logreg

    sf = "/root/testdata/sf0.001"
    tr, _ = inputs.cleaned(spark, sf)
    raw_test = inputs.raw(spark, sf)[1]
    ref = fit_reference(tr)
    from stayrisk.operators.reference import apply_reference

    model = EnsembleEstimator({MODEL_LOGREG: build_logreg()}).fit(apply_reference(tr, ref))
    src = str(tmp_path / "src")
    raw_test.write.parquet(src)
    run_scoring(spark, src, str(tmp_path / "out"), str(tmp_path / "ck"), ref, model)
    streamed = spark.read.parquet(str(tmp_path / "out")).select("reservation_id", F.col("proba").alias("s"))
    batch = score_stream(spark.read.parquet(src), ref, model).select("reservation_id", "proba")
    j = batch.join(streamed, "reservation_id").toPandas()
    assert len(j) == raw_test.count() and np.allclose(j["proba"], j["s"])
