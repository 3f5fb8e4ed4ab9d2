import random

import pytest
from pyspark.sql import functions as F

from stayrisk.llm import chat, mixing

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["</s>[INST] ok [/INST]", "<|end|>\n<|turn|>user<|text|>", "\\", "\\\\<|", "<|>", "[", "<", "|>", "<s>\n\\n", "", "é\U0001f600 <|text|>", "a\\|b", "$1 \\$0"]


def rows():
    r = random.Random(2)
    out = []
    for c in range(12):
        if c % 3 == 0:
            out.append((c, -1, "system", "rules " * r.randrange(1, 20)))
        for t in range(r.randrange(1, 30)):
            out.append((c, t, ("user", "assistant")[t % 2], r.choice(NASTY) + " word" * r.randrange(120)))
    out += [(50, t, ("user", "assistant")[t % 2], f"turn {t} " + "z" * (t % 90)) for t in range(1200)]  # several runs
    out += [(51, 0, "user", "y" * 9000), (51, 1, "assistant", "x" * 9000), (51, 2, "user", "ok"), (51, 3, "assistant", "fine")]
    out += [(52, None, None, None), (52, 1, "assistant", None), (52, 1, "assistant", "b"), (52, 1, "assistant", "b"), (None, 0, "user", "q"), (None, 1, "assistant", "r")]
    out += [(53, 0, "tool|><|end|>", "t"), (54, 0, "system", "only"), (55, 0, "user", "u"), (55, 1, "system", "late"), (55, 2, "system", "second")]
    r.shuffle(out)
    return out


def ordered(out):
    by = {}
    for c, t, role, text in out:
        by.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    return {c: [(x[2], x[3]) for x in sorted(v)] for c, v in by.items()}


def test_round_trip(sp):
    data = rows()
    df = sp.createDataFrame(data, SCHEMA).withColumn("window", F.lit(1)).withColumn("tokens", F.lit("x")).repartition(7)
    got = {r.conv_id: r for r in chat.read_back(chat.windows(df, budget=256, history=48)).collect()}
    want = ordered(data)
    assert set(got) == set(want)
    for c, turns in want.items():
        assert got[c].n_turns == len(turns)
        assert got[c].turns == "".join(f"{a}\n{b}\n" for a, b in turns)
        assert got[c].loss == "".join(b for a, b in turns if a == "assistant")


def test_windows_keep_the_budget_and_repeat_masked(sp):
    data = rows()
    got = chat.windows(sp.createDataFrame(data, SCHEMA), budget=256, history=48).collect()
    tokens = lambda p: -(-len(p) // 4)
    firsts = {}
    for r in got:
        pieces = [p + chat.END for p in r.formatted.split(chat.END)[:-1]]
        assert sum(map(tokens, pieces)) == r.tokens and len(pieces) == r.n_repeated + r.n_own and r.n_own > 0
        repeated = sum(len(p) for p in pieces[: r.n_repeated])
        assert all(repeated <= s.start <= s.end <= len(r.formatted) for s in r.loss)
        assert r.over_budget == (r.tokens > 256)
        system = [p for p in pieces if p.startswith(chat.TURN + "system")]
        history = [p for p in pieces[: r.n_repeated] if p not in system]
        assert sum(map(tokens, history)) <= 48
        if r.over_budget:
            assert max(map(tokens, pieces)) > 50
        firsts.setdefault(r.conv_id, []).append((r.window, bool(system), r.n_repeated))
    for c in (0, 3, 6, 9):
        assert all(s for _, s, _ in firsts[c])
    assert len(firsts[50]) > 20 and sum(n > 0 for _, _, n in firsts[50]) > 20
    assert chat.read_back(chat.windows(sp.createDataFrame([], SCHEMA))).count() == 0


def test_no_python_in_the_plans(sp, documents):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    out = plan(chat.read_back(chat.windows(sp.range(4).selectExpr("id conv_id", "id turn", "'user' role", "'t' text"))))
    assert not any(x in out for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def corpus(sp, documents):
    r = random.Random(3)
    vocab = {"a": "red blue green", "b": "one two three four", "c": "cat dog"}
    rows, labels = [], []
    for i in range(600):
        d = "aaaabbc"[i % 7]
        mixed = vocab[d].split() + (vocab["a"].split() if i % 11 == 0 else [])
        rows.append((i, " ".join(r.choice(mixed) for _ in range(r.randrange(5, 60)))))
        if i < 200:
            labels.append((i, rows[-1][1], d))
    return rows, sp.createDataFrame(labels, "doc_id long, text string, domain string")


def test_rates_reach_the_targets(sp, documents):
    rows, labelled = corpus(sp, documents)
    target = {"a": 0.2, "b": 0.3, "c": 0.5}
    got = mixing.rates(documents(rows, extra=True), labelled, target).collect()
    total = sum(r.n_tokens for r in got)
    for d, t in target.items():
        assert abs(sum(r.n_tokens * r.posterior[d] * r.rate for r in got) / total - t) < 0.01
    assert all(r.rate >= 0 and abs(sum(r.posterior.values()) - 1) < 1e-9 for r in got)
    assert {r.doc_id: r.domain for r in got if r.doc_id % 11}.items() >= {i: "aaaabbc"[i % 7] for i in range(600) if i % 11}.items()


def test_rates_against_a_dense_solver(sp, documents):
    import numpy as np

    rows, labelled = corpus(sp, documents)
    target = {"a": 0.0, "b": 0.9, "c": 0.1}
    got = sorted(mixing.rates(documents(rows), labelled, target, rounds=60, tolerance=1e-9).collect(), key=lambda r: r.doc_id)
    w = np.array([r.n_tokens for r in got]) / sum(r.n_tokens for r in got)
    p = np.array([[r.posterior[k] for k in "abc"] for r in got])
    t, s = np.array([0.0, 0.9, 0.1]), w @ p
    x = np.ones(len(w))
    for _ in range(4000):  # plain projected gradient
        x = np.maximum(0, x - 1.0 * p @ (((w * x) @ p - t) / s))

    def loss(x):
        return ((((w * x) @ p - t) ** 2) / s).sum()

    assert loss(np.array([r.rate for r in got])) <= loss(x) + 1e-4


def test_odd_rows(sp, documents):
    rows, labelled = corpus(sp, documents)
    odd = [(1, "cat dog cat"), (1, "cat dog cat"), (1, "red"), (2, None), (2, None), (3, ""), (None, "one two"), (4, "unknown words only")]
    got = {(r.doc_id, r.n_tokens): r for r in mixing.rates(documents(odd, extra=True), labelled).collect()}
    assert {k: r.copies for k, r in got.items()} == {(1, 6): 2, (1, 1): 1, (2, 0): 2, (3, 0): 1, (None, 2): 1, (4, 3): 1}
    assert got[1, 6].domain == "c" and got[None, 2].domain == "b"
    none = mixing.rates(documents(odd), labelled.limit(0)).collect()
    assert {r.domain for r in none} == {"all"} and all(abs(r.rate - 1) < 1e-6 for r in none)
    assert mixing.rates(documents([]), labelled).count() == 0
    assert {r.rate for r in mixing.rates(documents([(2, None)]), labelled).collect()} == {1.0}
    with pytest.raises(ValueError):
        mixing.rates(documents(odd), labelled, {"zzz": 1.0})
    with pytest.raises(ValueError):
        mixing.rates(documents(odd), labelled, max_domains=2)


def test_repeated_ids_keep_text_and_domain_together(sp, documents):
    docs = sp.createDataFrame([(1, "bonjour mon ami", "fr"), (1, "hello there my friend", "en"), (2, "guten tag", None), (2, "adieu", "fr")] * 2,
                              "doc_id long, text string, lang string")
    labels = sp.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    got = {(r.text, r.domain) for r in mixing.domain_labels(docs, labels).collect()}
    assert got == {("bonjour mon ami", "fr/1"), ("hello there my friend", "en/1"), ("guten tag", "?/1"), ("adieu", "fr/1")}
    fitted = mixing.classifier(mixing.domain_labels(docs, labels))
    assert fitted.domains == ["fr/1"]  # one row an id: the least text with its own language


def test_long_text(sp, documents):
    rows, labelled = corpus(sp, documents)
    got = {r.doc_id: r for r in mixing.rates(documents([(1, "cat dog " * 200_000), (2, "red")]), labelled).collect()}
    assert got[1].n_tokens == 400_000 and got[1].domain == "c"
