"""The manifest against a tree built in plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from stayrisk.llm import merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, digest string, grp string, pos int"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row):
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def _tree(nodes):
    """(root, proofs): a proof lists (own side, sibling or None) level by level."""
    proofs, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        upper, held = [], []
        for i in range(0, len(nodes), 2):
            run = nodes[i:i + 2]
            for j in range(len(run)):
                for leaf in owners[i + j]:
                    proofs[leaf].append((j, run[1 - j] if len(run) == 2 else None))
            upper.append(_h(*run))
            held.append(sum(owners[i:i + 2], []))
        nodes, owners = upper, held
    return nodes[0], proofs


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0], _leaf(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    found = {}
    for g in names:
        groups[g].sort(key=lambda e: (e[0], e[1] or 0, e[2]))
        found[g] = _tree([e[2] for e in groups[g]])
    root, upper = _tree([found[g][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for (_, _, leaf, r), proof in zip(groups[g], found[g][1]):
            steps = proof + upper[k]
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            back = _leaf((r[0], r[1], r[2], r[3] + 1 if hit and r[3] is not None else r[3], r[4]))
            for side, other in steps:
                back = _h(back) if other is None else _h(*((other, back) if side else (back, other)))
            out.append((r[0], leaf, found[g][0], root, _h(*(s for _, s in steps if s)), back, back == root))
    return out


def _manifest(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    out = merkle.manifest(df, "doc_id", "lang", FIELDS, tampered={"n_chars": F.col("n_chars") + 1}, where=hit)
    return [tuple(r)[:7] for r in out.collect()]


def _key(row):
    return tuple((v is not None, str(v)) for v in row)


def _rows(n):
    langs = ["en", "en", "en", "é", "zz", None]
    return [(i * 3 % (n + 7), f"s{i % 3}", langs[i % 6], i if i % 11 else None, f"text {i} é" if i % 5 else "", "x", None, 1) for i in range(n)]


@pytest.mark.parametrize("bits", [1, 2, 3, 12])
@pytest.mark.parametrize("n", [1, 2, 7, 65])
def test_equals_a_plain_tree(spark, monkeypatch, bits, n):
    monkeypatch.setattr(merkle, "BLOCK_BITS", bits)
    monkeypatch.setattr(merkle, "BLOCK", 1 << bits)
    rows = _rows(n)
    got = _manifest(spark, rows) if bits == 12 else _local(rows)
    assert sorted(got, key=_key) == sorted(brute(rows), key=_key)


def _local(rows):
    """The tiers with small blocks, their functions called as Spark calls them."""
    def climb(digests):
        tiers = [digests]
        while len(tiers[-1]) > 1:
            low = tiers[-1]
            tiers.append([merkle.upwards(low[i:i + merkle.BLOCK], merkle.levels_of(len(low)))[-1][0] for i in range(0, len(low), merkle.BLOCK)])
        return tiers

    def descend(tiers, above):
        chains = [above]
        for low in reversed(tiers[:-1]):
            nxt = []
            for b, i in enumerate(range(0, len(low), merkle.BLOCK)):
                text = merkle._pack(list(merkle.steps_of(chains[b])))
                nodes = merkle.upwards(low[i:i + merkle.BLOCK], merkle.levels_of(len(low)))
                nxt += merkle.downwards(nodes, merkle._unpacked(text))
            chains = nxt
        return chains

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, _leaf(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda e: e[:3])
    tiers = {g: climb([e[2] for e in groups[g]]) for g in names}
    upper = climb([tiers[g][-1][0] for g in names])
    out = []
    for g, head in zip(names, descend(upper, None)):
        for (_, _, leaf, r), chain in zip(groups[g], descend(tiers[g], head)):
            steps = list(merkle.steps_of(chain))
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            now = _leaf((r[0], r[1], r[2], r[3] + 1 if hit and r[3] is not None else r[3], r[4]))
            back = merkle.folded(now, steps)
            out.append((r[0], leaf, tiers[g][-1][0], upper[-1][0], merkle.digest([d for _, d in steps]), back, back == upper[-1][0]))
    return out


def test_more_than_one_block(spark):
    n = 2 * merkle.BLOCK + 5
    rows = [(i, "s", "en" if i % 40 else "fr", 1, f"t{i}", "", "", 0) for i in range(n)]
    assert sorted(_manifest(spark, rows), key=_key) == sorted(brute(rows), key=_key)


def test_many_groups(spark):
    rows = [(i, "s", f"l{i}", 1, "t", "", "", 0) for i in range(merkle.BLOCK + 3)]
    assert sorted(_manifest(spark, rows), key=_key) == sorted(brute(rows), key=_key)


def test_odd_rows(spark):
    assert _manifest(spark, []) == []
    rows = [(None, None, None, None, None, None, None, None), (5, "s", "en", 3, "a" * 400_000, "", "", 1), (5, "s", "en", 3, "b", "", "", 1),
            (5, "s", "en", 3, "b", "", "", 1), (None, "s", "en", 0, "", "", "", 1), (9, "s", "en", None, None, "", "", 1)]
    got = _manifest(spark, rows)
    assert len(got) == len(rows) and sorted(got, key=_key) == sorted(brute(rows), key=_key)
