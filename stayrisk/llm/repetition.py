"""Quality rules by suffix-array repetition.

Every document's words form a suffix array (prefix doubling on ranks, many
documents in one pass, ties only). The longest common prefix of neighbours
bounds the LCP intervals, whose values are the lengths of the maximal repeated
substrings; the union of the spans of all with at least ``min_repeat`` words
gives the covered fraction. A document is kept if it passes the base rules, at
most ``max_covered`` of its words lie in such repeats and its longest repeat is
at most ``max_longest`` of its words.

Defined results: null and empty texts have no words: all counts 0, base failed.
Every input row gives one row; ids may be null or repeat; other columns are
ignored. Memory follows the longest single document. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import slices, words

MIN_WORDS = 50
MIN_REPEAT = 5
MAX_COVERED = 0.4
MAX_LONGEST = 0.25
SPACES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"


def _order(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorting order and, in that order, the start of each run of equal keys."""
    order = np.argsort(keys)
    s = keys[order]
    head = np.concatenate([[True], s[1:] != s[:-1]])
    return order, np.maximum.accumulate(np.where(head, np.arange(len(s)), 0))


def suffix_array(symbols: np.ndarray, doc: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, LCP with the suffix before) of many documents at once.

    ``symbols``: word ids; ``doc`` and ``end``: document number and end position
    of each word. Suffixes of different documents share no prefix.
    """
    n = len(symbols)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order, run = _order(doc.astype(np.int64) << np.int64(32) | symbols)
    rank = np.empty(n, np.int64)
    rank[order] = run
    ranks = [rank.astype(np.int32) if n < 1 << 31 else rank]
    size = np.bincount(rank, minlength=n)
    tie, k = np.flatnonzero(size[rank] > 1), 1
    while len(tie):
        after = tie + k
        inside = after < end[tie]
        follow = np.zeros(len(tie), np.int64)
        follow[inside] = rank[after[inside]] + 1
        order, run = _order(rank[tie] * np.int64(n + 1) + follow)
        base = rank[tie][order]
        head = np.maximum.accumulate(np.where(np.concatenate([[True], base[1:] != base[:-1]]), np.arange(len(base)), 0))
        rank = rank.copy()
        rank[tie[order]] = base + run - head
        ranks.append(rank.astype(ranks[0].dtype))
        size = np.bincount(rank[tie], minlength=n)
        tie = tie[size[rank[tie]] > 1]
        k *= 2
    sa = np.empty(n, np.int64)
    sa[rank] = np.arange(n)
    lcp = np.zeros(n, np.int64)
    at = np.flatnonzero(ranks[0][sa[1:]] == ranks[0][sa[:-1]]) + 1
    a, b, got = sa[at - 1], sa[at], np.zeros(len(at), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        x, y = a + got, b + got
        inside = (x < end[a]) & (y < end[b])
        same = np.zeros(len(at), bool)
        same[inside] = ranks[level][x[inside]] == ranks[level][y[inside]]
        got[same] += 1 << level
    lcp[at] = got
    return sa, lcp


def longest_repeat(sa: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """By word: length of the longest substring that starts here and occurs elsewhere in the document.

    It is the value of the innermost LCP interval around the suffix: the larger
    of its two neighbours' LCPs.
    """
    out = np.zeros(len(sa), np.int64)
    if len(sa):
        out[sa] = np.maximum(lcp, np.append(lcp[1:], 0))
    return out


def covered(length: np.ndarray, at_least: int) -> np.ndarray:
    """By word: does it lie in a span ``[i, i + length[i])`` with ``length[i] >= at_least``?"""
    at = np.flatnonzero(length >= at_least)
    mark = np.bincount(at, minlength=len(length) + 1) - np.bincount(at + length[at], minlength=len(length) + 1)
    return np.cumsum(mark)[:-1] > 0


def duplicate_lines(text: str | None) -> int:
    if not text or "\n" not in text:
        return 0
    lines = [x for x in text.split("\n") if x.strip(SPACES.decode())]
    return len(lines) - len(set(lines))


def _measure(texts: list[str | None], min_repeat: int) -> dict[str, list | np.ndarray]:
    ids: defaultdict[bytes, int] = defaultdict(count().__next__)
    per = []
    chars, symbols, lines = [], [], []
    for t in texts:
        ws = words(t)
        per.append(np.fromiter(map(ids.__getitem__, ws), np.int64, len(ws)))
        raw = t.encode("utf-8", "surrogatepass") if t else b""
        chars.append((len(t) if t else 0) - len(raw) + len(raw.translate(None, SPACES)))
        symbols.append(len(raw) - len(raw.translate(None, SYMBOLS)))
        lines.append(duplicate_lines(t))
    n = np.array([len(x) for x in per], np.int64)
    end = np.cumsum(n)
    flat = np.concatenate(per) if per else np.empty(0, np.int64)
    sa, lcp = suffix_array(flat, np.repeat(np.arange(len(n)), n), np.repeat(end, n))
    longest = longest_repeat(sa, lcp)

    def total(mask: np.ndarray) -> np.ndarray:
        run = np.concatenate([[0], np.cumsum(mask)])
        return run[end] - run[end - n]

    most = np.zeros(len(n), np.int64)
    some = n > 0
    if some.any():
        most[some] = np.maximum.reduceat(longest, (end - n)[some])
    return {"n_words": n, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": lines,
            "n_repeat_words": total(covered(np.minimum(longest, 3), 3)),
            "n_covered": total(covered(longest, min_repeat)), "longest_repeat": most}


def rules(docs: DataFrame, min_words: int = MIN_WORDS, min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED,
          max_longest: float = MAX_LONGEST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, counts, ``covered_fraction``, ``longest_repeat``, ``base_failed``, ``kept``."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            for s, e in slices(texts):
                got = _measure(texts[s:e], min_repeat)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(s, e - s), *(pa.array(got[x], pa.int64()) for x in names)], names=["doc_id", *names])

    out = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, "doc_id long, " + ", ".join(f"{x} long" for x in names))
    n = F.greatest(F.col("n_words"), F.lit(1))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = out.withColumn("covered_fraction", F.col("n_covered") / n).withColumn("base_failed", failed)
    return out.withColumn("kept", ~failed & (F.col("covered_fraction") <= max_covered) & (F.col("longest_repeat") <= max_longest * n))
