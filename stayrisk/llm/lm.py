"""Language-model scoring by stupid backoff over n-gram counts of the whole corpus.

The score of a word is ``c(n-gram) / c(context)`` for the longest n-gram ending
at it that the corpus holds, times ``alpha`` for each order given up; the
shortest is ``c(word) / N``. n-grams above one word that occur fewer than
``min_count`` times count as unseen; with 1, the default, every n-gram counts.

The counts are tables partitioned by n-gram hash. Each block of documents sends
its distinct n-grams with their local counts to the hash ranges; the ranges add
them up and answer each block, where the counts meet the exploded n-grams and
the logs are summed per document (``blocks.py``). One- and two-word n-grams go
in the first exchange, then one order per exchange. A longer n-gram is sent only
if its count is still open: where one of the two n-grams one word shorter occurs
once, it occurs once as well, and where one of them occurs fewer than
``min_count`` times, so does it. Neither changes a score.

Defined results: null or empty texts have no words, score 0.0 and a null mean;
rows with a null id are scored but not told apart by id; repeated rows count
as often as they stand in the table; other columns are ignored. An empty table
gives an empty result.

n-grams are identified by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks
from .text import mix, window_hashes

TOTAL = np.uint64(0)  # the key under which blocks send their number of words


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, how often each occurs, and each key's place among them."""
    if not len(keys):
        return keys, np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(keys)
    s = keys[order]
    head = np.concatenate([[True], s[1:] != s[:-1]])
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(head) - 1
    starts = np.flatnonzero(head)
    return s[starts], np.diff(np.append(starts, len(s))), place


def _add_up(keys: list[np.ndarray], extra: list[bytes]) -> list[bytes]:
    """Reducer: the corpus count of every key."""
    every, n = np.concatenate(keys), np.concatenate([blocks.unplanes(x) for x in extra])
    order = np.argsort(every)
    s = every[order]
    starts = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    total = np.add.reduceat(n[order], starts)
    uniq = s[starts]
    return [blocks.planes(total[np.searchsorted(uniq, k)]) for k in keys]


class _Model:
    def __init__(self, order: int, alpha: float, min_count: int, n_parts: int):
        self.order, self.alpha, self.min_count, self.n_parts = order, alpha, min_count, n_parts

    def keys(self, b: blocks.Tokens, n: int) -> np.ndarray:
        """Hashes of the n-grams; never TOTAL."""
        return np.maximum(mix(window_hashes(b.h, n) + np.uint64(n)), np.uint64(1))

    def counts(self, b: blocks.Tokens, replies: list[list[bytes]]) -> tuple[int, list[np.ndarray]]:
        """N, and by order the corpus count of the n-gram that starts at each word (0: none, or fewer than ``min_count``)."""
        if not replies:
            return 0, []
        got = [np.concatenate([blocks.unplanes(x) for x in r]) if r else np.empty(0, np.int64) for r in replies]
        uniq, _, place, first, second = self.start(b)
        total, c = int(got[0][0]) if len(got[0]) else 0, np.zeros((2, len(b.h)), np.int64)
        c[0, first] = got[0][place[: len(first)]]
        c[1, second] = got[0][place[len(first) : -1]]
        out = list(c[: self.order])
        for n in range(3, len(replies) + 2):
            at = self.candidates(b, out, n)
            _, _, place = _ranked(self.keys(b, n)[at])
            own = np.zeros(len(b.h), np.int64)
            if self.min_count <= 1:
                own[b.fits(n)] = 1  # what was not sent holds a shorter n-gram that occurs once
            own[at] = got[n - 2][place]
            out.append(own)
        return total, out

    def start(self, b: blocks.Tokens):
        """The first exchange's keys: one- and two-word n-grams and the total."""
        first, second = b.fits(1), b.fits(2) if self.order > 1 else np.empty(0, np.int64)
        keys = np.concatenate([self.keys(b, 1)[first], self.keys(b, 2)[second], [TOTAL]])
        uniq, n, place = _ranked(keys)
        return uniq, n, place, first, second

    def candidates(self, b: blocks.Tokens, counts: list[np.ndarray], n: int) -> np.ndarray:
        """Starts of n-grams whose two shorter n-grams both occur ``min_count`` times, and twice at least."""
        at, least = b.fits(n), max(self.min_count, 2)
        c = counts[n - 2]
        return at[(c[at] >= least) & (c[at + 1] >= least)]

    def send(self, block: int, b: blocks.Tokens, replies: list[list[bytes]]) -> pa.Table:
        if not replies:
            uniq, n, *_ = self.start(b)
            n = np.where(uniq == TOTAL, len(b.h), n)
        else:
            _, counts = self.counts(b, replies)
            order = len(replies) + 2
            uniq, n, _ = _ranked(self.keys(b, order)[self.candidates(b, counts, order)])
        return blocks.blob_table(block, uniq, self.n_parts, lambda x, y: blocks.planes(n[x:y]))

    def score(self, b: blocks.Tokens, replies: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """By word: natural log of its score, and the order used."""
        total, counts = self.counts(b, replies)
        w = len(b.h)
        pos = np.arange(w)
        start = np.repeat(b.starts, b.ends - b.starts)
        log = np.log(np.maximum(counts[0], 1) / max(total, 1)) if w else np.empty(0)
        used = np.ones(w, np.int64)
        for n in range(2, self.order + 1):
            at = pos[pos - start >= n - 1]  # words with n - 1 words before them
            c = counts[n - 1][at - n + 1]
            log[at] += np.log(self.alpha)
            hit = c >= self.min_count
            at, c = at[hit], c[hit]
            log[at] = np.log(c / counts[n - 2][at - n + 1])
            used[at] = n
        return log, used


def score(docs: DataFrame, order: int = 3, alpha: float = 0.4, min_count: int = 1, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_words, log_score, mean_log, n_by_order`` (words scored at each order)."""
    if order < 1:
        raise ValueError("order must be at least 1")
    chars = blocks.characters(docs, text_col)
    n_blocks, n_parts = blocks.plan(docs, chars)
    by_block = blocks.blocked(docs, n_blocks, id_col, text_col)
    model = _Model(order, alpha, min_count, n_parts)

    def first(table: pa.Table) -> pa.Table:
        return model.send(blocks.block_id(table), blocks.Tokens(table, every=True), [])

    def later(k: int):
        def send(left: pa.Table, right: pa.Table) -> pa.Table:
            return model.send(blocks.block_id(left), blocks.Tokens(left, every=True), blocks.by_level(right, k))

        return send

    exchanges = max(1, order - 1)
    replies = None
    for k in range(exchanges):
        if replies is None:
            sent = by_block.groupBy("block").applyInArrow(first, blocks.BLOB_SCHEMA)
        else:
            sent = by_block.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(later(k), blocks.BLOB_SCHEMA)
        got = blocks.answer(sent, _add_up, k)
        replies = got if replies is None else replies.unionByName(got)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        b = blocks.Tokens(left, every=True)
        log, used = model.score(b, blocks.by_level(right, exchanges))
        n = b.ends - b.starts
        per = [np.concatenate([[0], np.cumsum(used == k)]) for k in range(1, order + 1)]
        by_order = np.stack([p[b.ends] - p[b.starts] for p in per], 1) if len(n) else np.empty((0, order), np.int64)
        total = np.array([log[x:y].sum() for x, y in zip(b.starts, b.ends)], np.float64)
        ids = left.column("doc_id").take(pa.array(b.order, pa.int64()))
        return pa.table({
            "doc_id": ids.cast(pa.int64()), "n_words": pa.array(n, pa.int64()), "log_score": pa.array(total, pa.float64()),
            "mean_log": pa.array(total / np.maximum(n, 1), pa.float64(), mask=n == 0),
            "n_by_order": pa.array(by_order.tolist(), pa.list_(pa.int64())),
        })

    return by_block.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        finish, "doc_id long, n_words long, log_score double, mean_log double, n_by_order array<long>")
