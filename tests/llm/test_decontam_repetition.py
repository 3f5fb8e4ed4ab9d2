import itertools
import random
from collections import Counter

import numpy as np

from stayrisk.llm import decontam, repetition


def sentence(r, n):
    return " ".join("".join(r.choice("abcdefghij") for _ in range(4)) for _ in range(n))


def test_leaks(sp, documents):
    r = random.Random(1)
    items = [sentence(r, n) for n in (40, 25, 15, 9, 5)]
    bench = sp.createDataFrame([*enumerate(items), (50, items[1].upper() + "!"), (60, None), (70, "")], "item_id long, text string")
    swapped = items[0].split()
    for i in (3, 9, 15, 21, 27, 33):
        swapped[i] = "zzzz"
    far = items[0].split()
    for i in range(0, 40, 3):
        far[i] = "yyyy"
    rows = [(1, sentence(r, 50) + " " + items[0] + " " + sentence(r, 9)), (2, " ".join(swapped)), (3, sentence(r, 300)),
            (4, "-- " + items[1].upper().replace(" ", ", ")), (5, items[2] + "\n" + items[2] + " " + items[0]), (6, items[3]), (7, items[4]),
            (8, None), (9, ""), (None, items[2]), (10, " ".join(far)), (1, "clean row with a repeated id"), (11, " ".join(items[0].split()[5:25]))]
    docs = documents(rows, extra=True)
    got = {(x.doc_id, x.item_id): (x.start, x.end, x.matched, x.substituted) for x in decontam.leaks(docs, bench).collect()}
    assert set(got) == {(1, 0), (2, 0), (4, 1), (5, 2), (5, 0), (6, 3), (None, 2), (11, 0)}
    assert got[1, 0] == (50, 90, 40, 0) and got[2, 0] == (0, 40, 34, 6) and got[5, 2] == (0, 15, 15, 0) and got[11, 0] == (0, 20, 20, 0)
    kept = decontam.clean(docs, bench)
    assert kept.columns == docs.columns
    assert {x.text for x in kept.collect()} == {rows[k][1] for k in (2, 6, 7, 8, 10, 11)}
    assert sorted(x.doc_id for x in kept.collect()) == [1, 3, 7, 8, 9, 10]
    small = decontam.leaks(docs, bench, bits=64).count()  # a full bitmap lets everything pass, the join decides
    assert small == len(got)
    assert decontam.leaks(documents([]), bench).count() == 0 and decontam.leaks(docs, bench.limit(0)).count() == 0
    assert decontam.clean(docs, bench.limit(0)).count() == len(rows)


def segments(same, max_subst=0.25, min_words=8):
    """By trying all: (length, -start, matched) of the longest segment that meets the rule."""
    every = [(e - s, -s, sum(same[s:e])) for s in range(len(same)) for e in range(s + 1, len(same) + 1)
             if same[s] and same[e - 1] and sum(same[s:e]) >= min_words and e - s - sum(same[s:e]) <= max_subst * (e - s) + 1e-9]
    return max(every, default=None)


def test_overlap_is_the_longest_within_the_rule():
    r = random.Random(2)
    for k in range(600):
        n, share = r.randrange(8, 61), r.choice([0.25, 0.2, 0.3, 0.0])
        item = np.arange(1, n + 1, dtype=np.uint64)
        copy = item.copy()
        copy[r.sample(range(n), r.randrange(n // 4 + 1 + k % 3))] = 0
        before, after = np.zeros(r.randrange(5), np.uint64), np.zeros(r.randrange(5), np.uint64)
        got = decontam.overlap(item, np.concatenate([before, copy, after]), len(before), share, 8)
        want = segments([bool(x) for x in copy], share)
        assert got == (want and (len(before) - want[1], len(before) - want[1] + want[0], want[2]))


def test_every_short_overlap_within_the_rule_is_hit():
    """All placings of the most substitutions the rule allows between two matching ends, 0.25 of the words."""
    def hit(same):
        return any(all(same[q + j] for j, c in enumerate(m) if c == "1") for m in decontam.MASKS for q in range(len(same) - len(m) + 1))

    for n in range(8, 14):
        k = min(n // 4, n - 8)
        for at in itertools.combinations(range(1, n - 1), k):
            assert hit([i not in at for i in range(n)]), (n, at)
    r = random.Random(8)
    for n in (14, 15, 16, 20, 25, 30, 40, 60):
        for _ in range(400):
            at = set(r.sample(range(1, n - 1), n // 4))
            assert hit([i not in at for i in range(n)]), (n, sorted(at))


def test_leaks_with_spread_substitutions(sp, documents):
    """Every copy whose overlap meets the rule is reported, and no other."""
    r = random.Random(5)
    items = {i: sentence(r, r.choice([8, 10, 11, 12, 13, 15, 20, 30, 40, 60])).split() for i in range(120)}
    copies = {i: list(w) for i, w in items.items()}
    for w in copies.values():
        for at in r.sample(range(len(w)), r.randrange(len(w) // 4 + 1)):
            w[at] = f"new{at}"
    items[200], items[201], items[202] = sentence(r, 15).split(), sentence(r, 40).split(), sentence(r, 12).split()
    copies[200] = [f"new{k}" if k in (2, 8, 11) else w for k, w in enumerate(items[200])]  # 12 matched, 20 % substituted
    copies[201] = [f"new{k}" if k % 4 == 3 else w for k, w in enumerate(items[201])]  # 25 %
    copies[202] = [f"new{k}" if k == 6 else w for k, w in enumerate(items[202])]
    want = {}
    for i, w in items.items():
        if best := segments([a == b for a, b in zip(w, copies[i])]):
            want[i] = (-best[1], best[0] - best[1], best[2])
    assert {200, 201, 202} <= set(want) and len(want) > 80
    bench = sp.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    docs = documents([(i, " ".join(w)) for i, w in copies.items()])
    got = decontam.leaks(docs, bench).collect()
    assert {x.doc_id: (x.start, x.end, x.matched) for x in got} == want and all(x.doc_id == x.item_id for x in got)


def test_shuffled_join_many_items_and_long_texts(sp, documents, monkeypatch):
    """The same leaks when the test hashes are joined by shuffle and a row's items come in many groups; a text of 300,000 characters or more."""
    r = random.Random(9)
    items = {i: sentence(r, 12) for i in range(150)}
    bench = sp.createDataFrame([*items.items(), (3, items[3] + " " + sentence(r, 5))], "item_id long, text string")
    long = " ".join(f"{sentence(r, 400)} {items[i]}" for i in items)
    assert len(long) >= 300_000
    docs = documents([(1, long), (2, sentence(r, 3000)), (3, items[7]), (3, items[8]), (4, " ".join(items.values()))])

    def found():
        rows = [tuple(x) for x in decontam.leaks(docs, bench).select("doc_id", "item_id", "start", "end", "matched", "substituted").collect()]
        assert len(rows) == len(set(rows))
        return set(rows)

    whole = found()
    assert {(d, i) for d, i, *_ in whole} == {(d, i) for d in (1, 4) for i in items} | {(3, 7), (3, 8)}
    assert all(e - s >= 12 and m >= 12 for _, _, s, e, m, _ in whole)
    monkeypatch.setattr(decontam, "BROADCAST_KEYS", 0)
    monkeypatch.setattr(decontam, "GROUP", 10)
    assert found() == whole


def brute(text, at_least=5):
    w = (text or "").encode().split()
    n = len(w)
    best = [0] * n
    for a in range(n):
        for b in range(a + 1, n):
            k = 0
            while b + k < n and w[a + k] == w[b + k]:
                k += 1
            best[a], best[b] = max(best[a], k), max(best[b], k)

    def cover(k):
        c = [False] * n
        for a in range(n):
            if best[a] >= k:
                c[a : a + (3 if k == 3 else best[a])] = [True] * (3 if k == 3 else best[a])
        return sum(c)

    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\r\x0b\x0c")]
    return (n, sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text or ""), sum(v - 1 for v in Counter(lines).values()),
            cover(3), cover(at_least), max(best, default=0))


def test_rules_against_brute_force(documents):
    r = random.Random(4)
    texts = [None, "", "\n\n", "one", "a b a b a b a b", "é ü\xa0x # | é ü\xa0x\n\tä\n\tä\n ä", "x " * 200, "p q r s t u v w " * 20]
    texts += [" ".join(r.choice("abc") for _ in range(r.randrange(80))) for _ in range(30)]
    texts += ["\n".join(r.choice(["a b", "c", "", " ", "a b "]) for _ in range(20)) for _ in range(10)]
    texts += [" ".join(f"w{r.randrange(400)}" for _ in range(150)) for _ in range(5)]
    rows = list(enumerate(texts)) + [(3, texts[6]), (None, texts[7])]
    got = repetition.rules(documents(rows, extra=True)).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), *brute(t)) for i, t in rows)
    assert sorted((str(x.doc_id), x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.n_covered, x.longest_repeat) for x in got) == want
    for x in got:
        assert x.base_failed == (x.n_words < 50 or 100 * x.n_repeat_words > 50 * x.n_words)
        assert x.kept == (not x.base_failed and x.covered_fraction <= 0.4 and x.longest_repeat <= 0.25 * x.n_words)
    assert repetition.rules(documents([])).count() == 0
