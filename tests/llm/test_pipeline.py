import corpus_pipeline as P
import pyarrow.parquet as pq

from stayrisk.llm import decontam
from tests.llm.test_simhash import brute as fingerprint
from tests.llm.test_simhash import classes
from tests.llm.test_substring_lm import cut

SF = "/root/testdata/sf0.001"
BASE = "the quick brown fox jumps over the lazy dog and runs far away from here to there"


def test_stage_names():
    assert [n for n, _ in P.STAGES] == ["quality", "near_dedup", "substrings", "decontaminate", "mix"] and P.ORACLE_SQL is None


def test_stages_against_brute_force(sp):
    docs = sp.read.parquet(f"{SF}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        rows = docs.collect()
        out = stage(sp, docs, SF)
        assert out.columns == docs.columns
        got = out.collect()
        if name == "quality":
            labels = {r.doc_id: r.quality for r in sp.read.parquet(f"{SF}/labels.parquet").collect()}
            kept = {r.doc_id for r in got}
            right = [(d in kept) == (q == 1) for d, q in labels.items()]
            assert sum(right) / len(right) > 0.9
        elif name == "near_dedup":
            nodes = {}
            for r in rows:
                f = fingerprint(r.text)
                nodes[f] = min(nodes.get(f, r.doc_id), r.doc_id)
            label = classes(list(nodes.items()))
            assert sorted(r.doc_id for r in got) == sorted({label[n] for n in nodes.values()})
        elif name == "substrings":
            want = {i: n for i, _, n, _ in cut([(r.doc_id, r.text) for r in rows], 13)}
            before = {r.doc_id: r for r in rows}
            for r in got:
                assert (r.text == before[r.doc_id].text) == (want[r.doc_id] == 0) and r.lang == before[r.doc_id].lang
                assert len(before[r.doc_id].text.encode().split()) - len(r.text.encode().split()) == want[r.doc_id]
        else:
            grams = set()
            for t in pq.read_table(f"{SF}/benchmark.parquet").column("text").to_pylist():
                w = decontam.tokens(t).tolist()
                grams |= {tuple(w[k : k + 8]) for k in range(len(w) - 7)}

            def leaks(t, grams=grams):
                w = decontam.tokens(t).tolist()
                return any(tuple(w[k : k + 8]) in grams for k in range(len(w) - 7))

            assert {r.doc_id for r in got} == {r.doc_id for r in rows if not leaks(r.text)}
        docs = out.checkpoint()
    rates = P.STAGES[-1][1](sp, docs, SF).collect()
    assert sorted(r.doc_id for r in rates) == sorted(r.doc_id for r in docs.collect()) and all(r.rate >= 0 for r in rates)


def test_odd_rows(sp, documents):
    rows = [(1, BASE), (1, BASE), (1, None), (2, BASE.upper()), (3, None), (4, ""), (None, BASE), (None, None), (5, BASE + " and something more " * 3)]
    docs = documents(rows, extra=True)
    for name, stage in P.STAGES[:-1]:
        out = stage(sp, docs, SF)
        assert out.columns == docs.columns, name
        got = sorted(out.select("doc_id", "text").collect(), key=str)
        if name == "near_dedup":
            ids = [r.doc_id for r in got]
            assert ids.count(None) == 2 and ids.count(1) == 2 and not {2, 3, 4} & {*ids}  # document 1 has two different texts
        if name == "substrings":
            assert len(got) == len(rows)
        assert stage(sp, docs.limit(0), SF).count() == 0
    assert P.mix(sp, docs, SF).count() == len({(i, t) for i, t in rows}) and P.mix(sp, docs.limit(0), SF).count() == 0


def test_near_dedup_keeps_every_text(sp, documents):
    a, b = BASE, "something else entirely different from all of that and more"
    got = P.near_dedup(sp, documents([(5, a), (5, b), (3, b), (9, a)]), SF).collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted([(5, a), (3, b)])


def test_run(sp):
    out = P.run(sp, SF)
    assert out.columns == ["doc_id", "copies", "n_tokens", "domain", "rate"] and out.count() > 50
