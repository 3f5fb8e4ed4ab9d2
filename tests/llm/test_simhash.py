import random

import numpy as np
import xxhash

from stayrisk.llm import simhash


def brute(text, k=3):
    w = [x.decode() for x in (text or "").encode().lower().split()]
    if not w:
        return 0
    sh = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(nodes, bits=3):
    """Smallest node reachable, by comparing all pairs."""
    label = {n: n for _, n in nodes}
    while True:
        old = dict(label)
        for f, n in nodes:
            for g, m in nodes:
                if (f ^ g).bit_count() <= bits:
                    label[n] = label[m] = min(label[n], label[m])
        if old == label:
            return label


def test_fingerprint():
    for t in (None, "", "  \n", "One", "one TWO", "a b c", "É ä\xa0b C d e f " * 9, "x " * 70_000 + "y"):
        assert simhash.fingerprint(t) == brute(t)


def test_nearest_anchor_is_shared_within_three_bits():
    r = random.Random(3)
    base = [r.getrandbits(64) for _ in range(500)] + [0, 2**64 - 1]
    near = []
    for x in base:
        for i in r.sample(range(64), r.randrange(4)):
            x ^= 1 << i
        near.append(x)

    def of(values):
        row, anchor, home = simhash.anchors(np.array(values, np.uint64))
        every, own = {}, {}
        for i, a, h in zip(row.tolist(), anchor.tolist(), home.tolist()):
            every.setdefault(i, set()).add(a)
            if h:
                own.setdefault(i, set()).add(a)
        return every, own

    _, own = of(base)
    every, _ = of(near)
    assert all(own[i] & every[i] for i in range(len(base))) and all(len(x) <= 32 for x in every.values())


def chains(seed):
    """Chains and clouds of fingerprints around a few centres."""
    r = random.Random(seed)
    out = set()
    for _ in range(6):
        x = r.getrandbits(64)
        for _ in range(30):
            out.add(x)
            for i in r.sample(range(64), r.randrange(1, 6)):
                x ^= 1 << i
    return [(f, 1000 - 7 * k) for k, f in enumerate(sorted(out, key=lambda _: r.random()))]


def test_components_against_all_pairs(sp, monkeypatch):
    for tile in (2048, 4):  # 4: anchors split into tiles
        monkeypatch.setattr(simhash, "TILE", tile)
        nodes = chains(tile)
        df = sp.createDataFrame([(f - (1 << 64) if f >> 63 else f, n) for f, n in nodes], "fp long, node long")
        got = {r.node: r.label for r in simhash.components(simhash.links(df)).collect()}
        assert {n: got.get(n, n) for _, n in nodes} == classes(nodes)


def test_documents(documents):
    base = "the quick brown fox jumps over the lazy dog and runs far away from here"
    rows = [(9, base), (4, base.upper()), (7, "something else entirely different from all that"), (3, None), (8, ""), (5, " \n "), (None, base),
            (None, "alone"), (7, "something else entirely different from all that")]
    got = simhash.near_dedup(documents(rows, extra=True)).collect()
    assert len(got) == len(rows)
    assert sorted((r.doc_id, r.component_id) for r in got if r.doc_id) == [(3, 3), (4, 4), (5, 3), (7, 7), (7, 7), (8, 3), (9, 4)]
    assert sorted((r.component_id for r in got if r.doc_id is None), key=str) == [4, None]
    assert all(r.fingerprint == format(brute(dict(rows).get(r.doc_id)), "016x") for r in got if r.doc_id)
    assert simhash.near_dedup(documents([])).count() == 0


A, B = "the quick brown fox jumps over the lazy dog and runs far away", "something else entirely different from all of that and more"


def test_repeated_ids_link_their_fingerprints(documents):
    got = simhash.near_dedup(documents([(5, A), (5, B), (3, B), (9, A), (7, "quite another thing")], extra=True)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(3, 3), (5, 3), (5, 3), (7, 7), (9, 3)]


def test_components_with_repeated_ids_against_all_pairs(sp, documents):
    r = random.Random(11)
    texts = [" ".join(r.choice("alpha beta gamma delta eps zeta eta theta".split()) for _ in range(14)) for _ in range(25)]
    rows = [(r.randrange(30), r.choice(texts)) for _ in range(60)]
    near = {i: {i} for i, _ in rows}
    for i, t in rows:
        for j, u in rows:
            if (brute(t) ^ brute(u)).bit_count() <= 3:
                near[i].add(j)
    label = dict.fromkeys(near)
    for i in sorted(near):
        todo = [i]
        while todo:
            if label[k := todo.pop()] is None:
                label[k] = i
                todo += near[k]
    got = simhash.near_dedup(documents(rows)).collect()
    assert len(got) == len(rows) and all(x.component_id == label[x.doc_id] for x in got)


def test_keep_one_loses_no_text(documents):
    rows = [(5, A), (5, B), (3, B), (9, A), (None, A), (None, A), (5, A), (8, None), (6, "")]
    got = sorted(((r.doc_id, r.text) for r in simhash.keep_one(documents(rows, extra=True)).collect()), key=str)
    assert got == sorted([(5, A), (3, B), (None, A), (None, A), (6, "")], key=str)
    out = simhash.keep_one(documents([], extra=True))
    assert out.count() == 0 and out.columns == documents([], extra=True).columns
