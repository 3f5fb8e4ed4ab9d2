"""Benchmark decontamination by spaced-seed hashing.

Fixed masks select some of the words of a window and ignore the others, so that
a window still hashes alike when ignored words were substituted. Windows of the
test items and of the documents meet in an equi-join on the hash; around each
hit the two word sequences are compared along the hit's diagonal, and the
longest substitution-tolerant overlap on it decides.

Words are lower-cased (A-Z) with ASCII punctuation as white space. Items with
the same words are one item (the smallest id); items with fewer than
``min_words`` words are not searched. An overlap counts if it matches at least
``min_words`` words and at most ``max_subst`` of its words are substituted.

The twelve masks select 6 of up to 10 words each and were chosen together, so
that the shortest overlaps within the rule are hit as well: every placing of 0,
1, 1 or 2, 2, 3, 3 substitutions in 8, 9, 10, 11, 12, 13 words and every one
tried in longer overlaps with a quarter substituted.

Documents send only hashes that a bitmap of the test hashes lets pass. The
bitmap has a fixed size (``BITS``), whatever the tables' sizes; where it fills
up it lets more through and the join still decides. Up to ``BROADCAST_KEYS``
test hashes (counted first) are handed to every task, so that hits of one
diagonal are made one before they are shuffled; more are joined by shuffle. A
row's hits meet its text in groups of about ``GROUP`` items, however many items
it holds.

Defined results: null and empty texts and items have no words and no leaks; a
row with a null id is reported with a null id; rows that repeat an id are
judged each by its own text; of several overlaps with one item the one with the
most matched words is reported, then the first; other columns are ignored.
Empty tables give an empty result.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import MULT, hashes, mix, slices

#: Which words of a window count.
MASKS = ("1111011", "110010111", "1101000111", "11011101", "11101011", "1100110011",
         "1010010111", "1110001011", "1101101001", "101010111", "111111", "11111001")
MIN_WORDS = 8
MAX_SUBST = 0.25
BITS = 1 << 25
#: 16 bytes and a row's overhead each: some 20 MB at most in a task.
BROADCAST_KEYS = 400_000
GROUP = 1_000
_CLEAN = bytes.maketrans(string.ascii_uppercase.encode() + string.punctuation.encode(),
                         string.ascii_lowercase.encode() + b" " * len(string.punctuation))


def tokens(text: str | None) -> np.ndarray:
    return hashes(text.encode("utf-8", "surrogatepass").translate(_CLEAN).split()) if text else np.empty(0, np.uint64)


def seeds(h: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the mask's selected words at each position."""
    m = len(h) - len(mask) + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = np.full(m, int(mask, 2), np.uint64)
    for j, c in enumerate(mask):
        if c == "1":
            out *= MULT
            out += h[j : j + m]
    return mix(out)


def overlap(item: np.ndarray, doc: np.ndarray, diagonal: int, max_subst: float, min_words: int) -> tuple[int, int, int] | None:
    """Longest overlap on one diagonal: (start, end) in the document and matched words, or none.

    From every matching word the farthest matching word at which the share of
    substitutions is still at most ``max_subst``; of those with ``min_words``
    matches the longest, then the first. No segment that meets both bounds is
    missed: its substituted ends can be cut off, and from its first word the
    farthest end has the most matches.
    """
    lo, hi = max(0, diagonal), min(len(doc), diagonal + len(item))
    if hi - lo < min_words:
        return None
    same = item[lo - diagonal : hi - diagonal] == doc[lo:hi]
    matched = np.concatenate([[0], np.cumsum(same)])
    n = np.arange(len(matched))
    spare = max_subst * n - (n - matched)  # a segment is within the share if this does not fall from its start to its end
    highest = np.maximum.accumulate(spare[::-1])  # from the end back to each place
    start = np.flatnonzero(same)
    far = len(same) - np.searchsorted(highest, spare[start] - 1e-9)
    last = np.concatenate([[0], np.maximum.accumulate(np.where(same, n[1:], 0))])  # end of the last match up to each place
    end = last[far]
    length = np.where(matched[end] - matched[start] >= min_words, end - start, 0)
    if not length.any():
        return None
    k = int(np.argmax(length))
    return (lo + int(start[k]), lo + int(end[k]), int(matched[end[k]] - matched[start[k]]))


def _items(benchmark: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """``item, item_id, words`` (packed hashes), one row per distinct word sequence of enough words; ``item`` is its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([tokens(t.as_py()).tobytes() for t in b.column(1)], pa.binary())], names=["item_id", "words"])

    rows = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("t"))
    packed = rows.mapInArrow(run, "item_id long, words binary").filter(F.length("words") >= 8 * min_words)
    return packed.groupBy("words").agg(F.min("item_id").alias("item_id")).select(F.xxhash64("words").alias("item"), "item_id", "words")


def _test_hashes(items: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    """``key, item, q``: every masked window of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, w in zip(b.column(0), b.column(1)):
                h = np.frombuffer(w.as_py(), np.uint64)
                keys = [seeds(h, m) for m in masks]
                key, q = np.concatenate(keys).view(np.int64), np.concatenate([np.arange(len(k)) for k in keys]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.full(len(key), i.as_py(), np.int64)), pa.array(q)], names=["key", "item", "q"])

    return items.select("item", "words").mapInArrow(run, "key long, item long, q int")


def _bitmap(test: DataFrame, bits: int) -> np.ndarray:
    """Which low bits of a hash occur in the test set; ``bits / 8`` bytes at most, whatever the test set's size."""
    word = test.selectExpr(f"shiftright(key & {bits - 1}L, 6) AS w", "shiftleft(1L, CAST(key & 63 AS INT)) AS b")
    rows = word.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(bits >> 6, np.uint64)
    out[rows.column("w").to_numpy()] = rows.column("b").to_numpy().view(np.uint64)
    return out


def leaks(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, min_words: int = MIN_WORDS,
          max_subst: float = MAX_SUBST, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", bits: int = BITS) -> DataFrame:
    """One row per document and leaked item: ``doc_id, item_id, start, end`` (words), ``matched, substituted``."""
    return _leaks(docs, benchmark, masks, min_words, max_subst, id_col, text_col, item_col, item_text_col, bits).drop("row")


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` without a leak, with all their columns."""
    found = leaked_rows(docs, benchmark, id_col=id_col, text_col=text_col, **how).toDF("leak_id", "leak_row").checkpoint()
    own_id, own_text = docs[id_col].cast("long"), docs[text_col].cast("string")
    same = (F.xxhash64(own_id, own_text) == found["leak_row"]) & own_id.eqNullSafe(found["leak_id"])
    return docs.join(found, same, "left_anti")


def leaked_rows(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, min_words: int = MIN_WORDS,
                max_subst: float = MAX_SUBST, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                item_text_col: str = "text", bits: int = BITS) -> DataFrame:
    """``doc_id, row`` of the rows with a leak; ``row`` is a hash of id and text."""
    return _leaks(docs, benchmark, masks, min_words, max_subst, id_col, text_col, item_col, item_text_col, bits).select("doc_id", "row").distinct()


def _row(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"))


def _leaks(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...], min_words: int, max_subst: float, id_col: str, text_col: str,
           item_col: str, item_text_col: str, bits: int) -> DataFrame:
    if min(map(len, masks)) > min_words:
        raise ValueError("a mask must fit into min_words words")
    spark = docs.sparkSession
    items = _items(benchmark, item_col, item_text_col, min_words).checkpoint()
    test = _test_hashes(items, masks).checkpoint()
    bitmap = spark.sparkContext.broadcast(_bitmap(test, bits))
    groups = -(-items.count() // GROUP) or 1

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = bitmap.value
        for b in batches:
            ids, texts = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_pylist()
            for s, e in slices(texts):
                per = [tokens(t) for t in texts[s:e]]
                n = np.array([len(x) for x in per], np.int64)
                h = np.concatenate(per) if per else np.empty(0, np.uint64)
                ends = np.cumsum(n)
                of, end_of = np.repeat(np.arange(len(per)), n), np.repeat(ends, n)
                out = []
                for m in masks:
                    keys = seeds(h, m)
                    low = keys & np.uint64(bits - 1)
                    at = np.flatnonzero(filled[low >> np.uint64(6)] >> (low & np.uint64(63)) & np.uint64(1))
                    at = at[at + len(m) <= end_of[at]]
                    out.append((ids[s:e][of[at]], keys[at].view(np.int64), at - (ends - n)[of[at]]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["row", "key", "p"])

    rows = docs.select(_row(id_col, text_col).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = rows.select("row", "text").mapInArrow(candidates, "row long, key long, p long")
    hits = found.join(F.broadcast(test) if test.count() <= BROADCAST_KEYS else test, "key")
    pairs = hits.groupBy("row", "item").agg(F.collect_set(F.col("p") - F.col("q")).alias("diagonals")).join(items, "item")
    by_row = pairs.groupBy("row", F.pmod(F.xxhash64("item_id"), F.lit(groups)).alias("part")).agg(
        F.collect_list(F.struct("item_id", "words", "diagonals")).alias("hits"))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc_id, row, text, hits in zip(pdf["doc_id"], pdf["row"], pdf["text"], pdf["hits"]):
                doc, best = tokens(text), {}
                for hit in hits:
                    item = np.frombuffer(hit["words"], np.uint64)
                    for diagonal in hit["diagonals"]:
                        if got := overlap(item, doc, int(diagonal), max_subst, min_words):
                            rank = (got[2], -got[0])
                            if hit["item_id"] not in best or rank > best[hit["item_id"]][0]:
                                best[hit["item_id"]] = (rank, got)
                out += [(doc_id, row, i, s, e, m, e - s - m) for i, (_, (s, e, m)) in sorted(best.items())]
            yield pd.DataFrame(out, columns=["doc_id", "row", "item_id", "start", "end", "matched", "substituted"]).astype({"doc_id": "Int64"})

    return rows.join(by_row, "row").select("doc_id", "row", "text", "hits").mapInPandas(
        verify, "doc_id long, row long, item_id long, start long, end long, matched long, substituted long")
