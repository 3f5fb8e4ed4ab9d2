import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stayrisk.llm import langid, quality, sample, toxicity
from stayrisk.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def truth():
    docs, labels = (pq.read_table(f"{SF}/{t}.parquet").to_pandas() for t in ("documents", "labels"))
    return docs.merge(labels, on="doc_id", how="left").set_index("doc_id")


def auc(y, s):
    rank = pd.Series(s).rank()
    n1 = (y == 1).sum()
    return (rank[(y == 1).to_numpy()].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


def held(sp, name, truth):
    got = QUERIES[name](sp, SF).toPandas()
    assert len(got) == len(truth) and got.score.between(0, 1).all()
    return got.join(truth, on="doc_id")[lambda d: d.held_out]


def test_quality_held_out(sp, truth):
    h = held(sp, "op10_quality_classifier", truth).dropna(subset=["quality"])
    assert auc(h.quality, h.score.to_numpy()) > 0.95 and (h.predicted == h.quality).mean() > 0.9


def test_toxicity_held_out(sp, truth):
    h = held(sp, "op2_toxicity", truth).dropna(subset=["toxic"])
    assert auc(h.toxic, h.score.to_numpy()) > 0.8 and h[h.toxic == 0].predicted.mean() < 0.05


def test_language_held_out(sp, truth):
    h = held(sp, "op3_language_id", truth)
    assert (h.lang_pred == h.lang).mean() > 0.97


ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "12 -- 34"), (None, "the cat and the dog"), (5, "x" * 300_000), (5, "x" * 300_000), (6, "\x00 😀".encode("utf-16", "surrogatepass").decode("utf-16"))]


def few(n=60):
    good = [("the cat and the dog went over there and sat", 1, 0, "en")] * n
    bad = [("BUY NOW!!! CLICK | HERE | !!!", 0, 0, "de")] * n
    toxic = [("a calm start. you are an idiot. the end", 1, 1, "en")] * (n // 4)
    return pd.DataFrame(good + bad + toxic, columns=["text", "quality", "toxic", "lang"])


def test_odd_rows(documents):
    docs, train = documents(ODD, extra=True), few()
    q = quality.fit(train.rename(columns={"quality": "label"}), epochs=6)
    t = toxicity.fit(train.rename(columns={"toxic": "label"}))
    g = langid.fit(train.rename(columns={"lang": "label"}))
    for got in (quality.score(docs, q).collect(), toxicity.score(docs, t).collect(), langid.predict(docs, g).collect()):
        assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    lang = {r.doc_id: r for r in langid.predict(docs, g).collect()}
    assert [lang[k].lang_pred for k in (1, 2, 3, 4)] == ["und"] * 4 and lang[1].score == 0 and lang[None].lang_pred == "en"
    same = [r.score for r in quality.score(docs, q).collect() if r.doc_id in (1, 2)]
    assert same[0] == same[1]
    kept = quality.keep(docs, q)
    assert kept.columns == docs.columns and kept.count() <= len(ODD)
    empty = documents([])
    assert quality.score(empty, q).count() == toxicity.score(empty, t).count() == langid.predict(empty, g).count() == quality.keep(empty, q).count() == 0


def test_offending_sentences_are_located(documents):
    t = toxicity.fit(few().rename(columns={"toxic": "label"}))
    text = "Ünfine day! YOU are, an IDIOT? the cat sat."
    (r,) = toxicity.score(documents([(1, text)]), t).collect()
    assert r.n_sentences == 3 and r.score > 0.5 and [s.sentence for s in r.offending] == [" YOU are, an IDIOT"]
    s = r.offending[0]
    assert text.encode()[s.start : s.end].decode() == s.sentence


def test_without_labels(documents):
    none = pd.DataFrame({"text": pd.Series([], dtype=str), "label": []})
    docs = documents(ODD)
    assert {r.score for r in quality.score(docs, quality.fit(none)).collect()} == {0.0}
    assert {r.score for r in toxicity.score(docs, toxicity.fit(none)).collect()} == {0.0}
    assert {r.lang_pred for r in langid.predict(docs, langid.fit(none)).collect()} == {"und"}
    one = pd.DataFrame({"text": ["a", "b"], "label": [1, 1]})
    assert {r.score for r in quality.score(docs, quality.fit(one)).collect()} == {1.0}


def test_sample_is_bounded_and_stable(sp, documents):
    rows = [(i, f"text {i}") for i in range(100)] + [(3, "again"), (None, "no id"), (101, None), (102, "y" * 50)]
    labels = sp.createDataFrame([(i, i % 2) for i in range(103)] + [(5, None), (None, 1)], "doc_id long, quality int")
    docs = documents(rows)
    a = sample.labelled(docs, labels, "quality", F.col("doc_id") % 3 != 0, 20, 40)
    b = sample.labelled(docs.repartition(7), labels.repartition(5), "quality", F.col("doc_id") % 3 != 0, 20, 40)
    assert a.equals(b) and 15 < len(a) <= 21 and not a.text.str.startswith("y").any()
    assert all(int(t.split()[1]) % 3 and int(t.split()[1]) % 2 == y for t, y in zip(a.text, a.label))


def test_repeated_ids_do_not_fill_the_sample(sp, documents):
    rows = [(i, f"text {i}") for i in range(30)] + [(i, f"zz copy {k}") for i in range(0, 30, 3) for k in range(40)]
    docs = documents(rows)
    labels = sp.createDataFrame([(i, i % 2) for i in range(30)] * 3, "doc_id long, quality int")
    got = sample.labelled(docs, labels, "quality", F.lit(True), 20, 40)
    assert len(got) == 20 and got.text.nunique() == 20 and got.text.str.startswith("text").all()
    own = sample.labelled(docs, None, "lang", F.lit(True), 20, 40)
    assert len(own) == 20 and sorted(own.text) == sorted(got.text)


def test_filters_meet_every_byte_position():
    model = quality.ByteCNN()
    x, _ = quality.chunks(["aXbYc " * 60, "odd"])
    tables = model.tables()
    at = [sum(tables[w][x[:, s + w]] for w in range(quality.WIDTH)) for s in range(quality.CHUNK - quality.WIDTH + 1)]
    assert np.allclose(model.pooled(x, tables)[0], np.max(at, axis=0), atol=1e-5)


def test_pipeline_keeps_documents_without_labels(sp, documents, tmp_path):
    from corpus_pipeline import quality_filter

    docs = documents([(1, "one"), (2, None), (None, "three")])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    sp.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert quality_filter(sp, docs, str(tmp_path)).count() == 3


def test_gradients_match_differences():
    r = np.random.default_rng(0)
    model = quality.ByteCNN()
    model.p["b"] += 0.1  # away from the kink of empty chunks
    x, of = quality.chunks(["abc def " * 100, "XYZ!! " * 30, "", "q"])
    y = np.array([1.0, 0.0, 1.0, 0.0])

    def loss():
        _, f = model.features(model.pooled(x, model.tables())[0], of, 4)
        z = f @ model.p["v"] + model.p["c"]
        return float(np.mean(np.logaddexp(0, z) - y * z) + 0.5e-4 * (model.p["v"] ** 2).sum())

    g = model.gradients(x, of, y)
    for k in ("W", "v", "b", "c"):
        for _ in range(4):
            i = tuple(r.integers(0, s) for s in model.p[k].shape)
            model.p[k][i] += 1e-3
            up = loss()
            model.p[k][i] -= 2e-3
            down = loss()
            model.p[k][i] += 1e-3
            assert abs((up - down) / 2e-3 - g[k][i]) < 2e-3


def test_a_text_goes_with_the_label_of_its_row(sp):
    rows = [(1, "hello there my friend", "en"), (1, "bonjour mon ami", "fr"), (2, "aaa without a language", None), (2, "guten tag", "de"), (3, "x" * 60, "en"), (4, "yes", "en")]
    docs = sp.createDataFrame(rows, "doc_id long, text string, lang string")
    got = sample.labelled(docs, None, "lang", F.lit(True), 20, 40)
    assert sorted(zip(got["text"], got["label"])) == [("bonjour mon ami", "fr"), ("guten tag", "de"), ("yes", "en")]
    few = sample.labelled(docs, None, "lang", F.lit(True), 20, 40, max_total=20)
    assert 0 < few["text"].str.len().sum() <= 20


def test_buckets_of_many_words_are_those_of_each():
    ws = [b"a", b"ab", b"abc", b"abcd", "été".encode(), b"x" * 40, b"\xff", b"a"]
    for some in (ws, ws[:1], ws[1:2]):
        flat, n = langid.subwords_of(some)
        own = [langid.subwords(w) for w in some]
        assert flat.tolist() == [i for x in own for i in x] and n.tolist() == [len(x) for x in own]
