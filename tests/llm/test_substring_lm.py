import hashlib
import math
import random
from collections import Counter

from stayrisk.llm import blocks, lm, substring


def corpus(seed, n=60, vocab=6, most=60):
    r = random.Random(seed)
    rows = [(i * 3, " ".join(r.choice("abcdefgh"[:vocab]) for _ in range(r.randrange(most)))) for i in range(n)]
    long = " ".join(f"w{r.randrange(50)}" for _ in range(3000))
    rows += [(1000, long), (1001, long), (999, "x " + long + " y"), (2, ""), (4, None), (None, long), (None, None), (0, rows[0][1])]
    r.shuffle(rows)
    return rows


def cut(rows, window):
    seen = {}
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in docs:
        for k in range(len(w) - window + 1) if i is not None else ():
            g = tuple(w[k : k + window])
            seen[g] = min(seen.get(g, i), i)
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1) if i is not None else ():
            if seen[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        out.append((i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()))
    return out


def hot(seed):
    """One id on a third of the rows, with texts of its own and repeated ones; a null id with one text as well."""
    r = random.Random(seed)
    text = lambda: " ".join(r.choice("abcdef") for _ in range(30))
    same = text()
    rows = [(i + 10, text()) for i in range(150)] + [(7, text()) for _ in range(50)] + [(7, same)] * 100 + [(None, same)] * 60
    r.shuffle(rows)
    return rows


def key(rows):
    return sorted(rows, key=repr)


def test_levels():
    assert substring.levels(13) == [7, 13] and substring.levels(50) == [7, 13, 25, 50] and substring.levels(5) == [5]


def test_pack_round_trip():
    import numpy as np

    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64) * np.uint64(2))
    assert (blocks.unpack(blocks.pack(keys)) == keys).all() and len(blocks.unpack(blocks.pack(keys[:0]))) == 0
    e = blocks.edges(keys, 7)
    assert e[0] == 0 and e[-1] == len(keys) and (e[1:] >= e[:-1]).all()


def test_against_brute_force(documents):
    for seed, window in ((1, 13), (2, 5), (3, 20)):
        rows = corpus(seed)
        got = substring.dedup(documents(rows, extra=True), window=window, keep=["block", "rest", "part"]).collect()
        assert key((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == key(cut(rows, window))
        for r in got:
            assert r.rest.block == "block" and sum(s.end - s.start for s in r.spans) == r.n_removed
            assert hashlib.sha256(" ".join((r.text or "").split()).encode()).hexdigest() == r.kept_sha256


def test_hot_ids_and_repeated_rows(documents):
    rows = hot(3)
    got = substring.dedup(documents(rows), window=5).collect()
    assert key((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == key(cut(rows, 5))
    got = lm.score(documents(rows)).collect()
    assert key((r.doc_id, r.n_words, round(r.log_score, 6) + 0.0, tuple(r.n_by_order)) for r in got) == key(backoff(rows, 3, 0.4, 1))


def test_no_block_holds_a_hot_id(documents):
    rows = [(7, "one text")] * 2000 + [(None, "one text")] * 2000 + [(i, f"text {i}") for i in range(2000)]
    sizes = [r["count"] for r in blocks.blocked(documents(rows), 16, "doc_id", "text").groupBy("block").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * len(rows) / 16


def test_rows_exchanged_shrink_with_larger_ranges(documents, monkeypatch):
    docs = documents([(1, "a")])
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(blocks, "BLOCK_CHARS", 10)
    monkeypatch.setattr(blocks, "RANGE_CHARS", 40)
    assert blocks.plan(docs, 10_000) == (1000, 250) and blocks.plan(docs, 1) == (least, least)


def test_untouched_text_is_kept_as_it_is(documents):
    rows = [(1, "  one\n two\tthree "), (2, "é\xa0x  y"), (3, None)]
    assert {r.doc_id: r.text for r in substring.dedup(documents(rows)).collect()} == dict(rows)


def test_empty_tables(documents):
    assert substring.dedup(documents([])).count() == 0 and lm.score(documents([])).count() == 0
    assert substring.dedup(documents([(1, None), (2, "")])).count() == 2


def backoff(rows, order, alpha, min_count):
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    c = [Counter() for _ in range(order + 1)]
    for _, w in docs:
        for n in range(1, order + 1):
            c[n].update(tuple(w[k : k + n]) for k in range(len(w) - n + 1))
    total = sum(c[1].values())
    out = []
    for i, w in docs:
        log, by = 0.0, [0] * order
        for k in range(len(w)):
            top = min(order, k + 1)
            for n in range(top, 0, -1):
                g = tuple(w[k - n + 1 : k + 1])
                if n == 1 or c[n][g] >= min_count:
                    log += math.log(c[n][g] / (c[n - 1][g[:-1]] if n > 1 else total)) + (top - n) * math.log(alpha)
                    by[n - 1] += 1
                    break
        out.append((i, len(w), round(log, 6), tuple(by)))
    return out


def test_lm_against_brute_force(documents):
    rows = corpus(5)
    for order, min_count in ((1, 2), (2, 2), (3, 2), (4, 3), (2, 1), (4, 1), (5, 1)):
        got = lm.score(documents(rows, extra=True), order=order, min_count=min_count).collect()
        assert key((r.doc_id, r.n_words, round(r.log_score, 6) + 0.0, tuple(r.n_by_order)) for r in got) == key(backoff(rows, order, 0.4, min_count))
        assert all((r.mean_log is None) == (r.n_words == 0) for r in got)


def test_lm_scores_with_every_ngram_of_the_corpus(documents):
    rows = corpus(6) + [(2000 + i, f"rare{i} words{i} that{i} occur{i} once{i}") for i in range(20)]
    got = lm.score(documents(rows)).collect()
    assert key((r.doc_id, r.n_words, round(r.log_score, 6) + 0.0, tuple(r.n_by_order)) for r in got) == key(backoff(rows, 3, 0.4, 1))
    assert all(tuple(r.n_by_order) == (1, 1, 3) for r in got if (r.doc_id or 0) >= 2000)
