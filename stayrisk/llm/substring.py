"""Substring dedup: windows of words that already occur in an earlier document are cut out.

Method: level-wise doubling. Window lengths grow by doubling up to ``window``
(7 then 13 by default); only windows repeated at one length alone are extended
to the next: a window of 13 words can only be repeated if the 7 words at its
start and the 7 words at its end are. Each level is one key exchange between
blocks (``blocks.py``), so the first, unselective level ships packed distinct
keys and the later levels ship survivors only. The doubling ends at ``window``;
how far a repeat reaches beyond it is not found out.

Defined results: null or empty text has no words and stays as it is; a row
with a null id neither removes nor loses words; rows that repeat one id are one
document to each other (neither is smaller); ties of equal windows inside one
document remove nothing; windows never span two documents. Other columns pass
through untouched whatever their names. An empty table gives an empty result.

Windows are compared by 64-bit hashes at each level. A false removal needs a
colliding pair among windows that passed the level before.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import blocks
from .text import window_hashes, words

WINDOW = 13
OUT = "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, text string, kept_sha256 string"


def levels(window: int, base: int = 7) -> list[int]:
    """Window lengths: ``window`` halved (rounding up) until at most ``base``, ascending."""
    out = [window]
    while out[-1] > base:
        out.append((out[-1] + 1) // 2)
    return out[::-1]


class _Block(blocks.Tokens):
    def extend(self, at: np.ndarray, alive: np.ndarray, shorter: int, longer: int) -> np.ndarray:
        """Positions of longer windows whose first and last ``shorter`` words are both repeated."""
        live = np.zeros(len(self.h), bool)
        live[at[alive]] = True
        at = self.fits(longer)
        return at[live[at] & live[at + (longer - shorter)]]

    def keys(self, at: np.ndarray, length: int) -> np.ndarray:
        return window_hashes(self.h, length)[at]


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and whether each occurs more than once."""
    s = np.sort(keys)
    first = np.concatenate([[True], s[1:] != s[:-1]]) if len(s) else np.empty(0, bool)
    starts = np.flatnonzero(first)
    return s[starts], np.diff(np.append(starts, len(s))) > 1


def _member(keys: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(keys), bool)
    return sorted_set[np.minimum(np.searchsorted(sorted_set, keys), len(sorted_set) - 1)] == keys


def _bits(replies: list[bytes], sizes: np.ndarray) -> np.ndarray:
    own = sizes[sizes > 0]
    if not len(own):
        return np.empty(0, bool)
    return np.concatenate([np.unpackbits(np.frombuffer(r, np.uint8), count=n) for r, n in zip(replies, own, strict=True)]).astype(bool)


def _repeated(keys: list[np.ndarray], extra: list[bytes]) -> list[bytes]:
    """Reducer of the inner levels: is the key held by two blocks, or twice by one?"""
    multi = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(k)).astype(bool) for k, x in zip(keys, extra)]
    rep = np.sort(np.concatenate(keys))
    rep = rep[1:][rep[1:] == rep[:-1]]
    return [np.packbits(_member(k, rep) | m).tobytes() for k, m in zip(keys, multi)]


def _earlier(keys: list[np.ndarray], extra: list[bytes]) -> list[bytes]:
    """Reducer of the last level: does another block hold the key in a smaller document?"""
    docs = [np.frombuffer(x, np.int64) for x in extra]
    every, doc = np.concatenate(keys), np.concatenate(docs)
    order = np.lexsort((doc, every))
    s = every[order]
    head = np.concatenate([[True], s[1:] != s[:-1]])
    uniq, least = s[head], doc[order][head]
    return [np.packbits(least[np.searchsorted(uniq, k)] < d).tobytes() for k, d in zip(keys, docs)]


class _Passes:
    """What a block does before level k, after the replies to the levels below it."""

    def __init__(self, lens: list[int], n_parts: int):
        self.lens, self.n_parts = lens, n_parts

    def positions(self, b: _Block, replies: list[list[bytes]]) -> np.ndarray:
        """Candidate positions of level ``len(replies)``."""
        at = b.fits(self.lens[0])
        for k, reply in enumerate(replies):
            keys = b.keys(at, self.lens[k])
            uniq, _ = _distinct(keys)
            rep = uniq[_bits(reply, np.diff(blocks.edges(uniq, self.n_parts)))]
            at = b.extend(at, _member(keys, rep), self.lens[k], self.lens[k + 1])
        return at

    def blobs(self, block: int, b: _Block, replies: list[list[bytes]]) -> pa.Table:
        k = len(replies)
        at = self.positions(b, replies)
        keys = b.keys(at, self.lens[k])
        if k < len(self.lens) - 1:
            uniq, multi = _distinct(keys)
            return blocks.blob_table(block, uniq, self.n_parts, lambda x, y: np.packbits(multi[x:y]).tobytes())
        uniq, first = np.unique(keys, return_index=True)
        docs = b.doc_of[at[first]]
        return blocks.blob_table(block, uniq, self.n_parts, lambda x, y: docs[x:y].tobytes())

    def removed(self, b: _Block, replies: list[list[bytes]]) -> np.ndarray:
        """By word: is it covered by a window that an earlier document holds?"""
        at = self.positions(b, replies[:-1])
        keys = b.keys(at, self.lens[-1])
        uniq, first = np.unique(keys, return_index=True)
        earlier = _bits(replies[-1], np.diff(blocks.edges(uniq, self.n_parts)))
        where = np.searchsorted(uniq, keys)
        hit = at[earlier[where] | (b.doc_of[at] > b.doc_of[at[first]][where])] if len(at) else at
        mark = np.zeros(len(b.h) + 1, np.int32)
        np.add.at(mark, hit, 1)
        np.add.at(mark, hit + self.lens[-1], -1)
        return np.cumsum(mark)[:-1] > 0


def _later(passes: _Passes, k: int):
    """What a block sends at level ``k``, given the documents and the replies of the levels below."""

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        return passes.blobs(blocks.block_id(left), _Block(left), blocks.by_level(right, k))

    return send


def dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
          keep: list[str] = (), base: int = 7) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, spans, text, kept_sha256[, rest]``.

    ``text`` is the input text if nothing was removed, else the kept words joined
    by one space; ``spans`` the removed word ranges ``[start, end)``;
    ``kept_sha256`` the digest of the kept words joined by one space.
    """
    n_blocks, n_parts = blocks.plan(docs, blocks.characters(docs, text_col))
    by_block = blocks.blocked(docs, n_blocks, id_col, text_col, keep)
    passes = _Passes(levels(window, base), n_parts)

    def first(table: pa.Table) -> pa.Table:
        return passes.blobs(blocks.block_id(table), _Block(table), [])

    replies = None
    for k in range(len(passes.lens)):
        if replies is None:
            sent = by_block.groupBy("block").applyInArrow(first, blocks.BLOB_SCHEMA)
        else:
            sent = by_block.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
                _later(passes, k), blocks.BLOB_SCHEMA)
        got = blocks.answer(sent, _repeated if k < len(passes.lens) - 1 else _earlier, k)
        replies = got if replies is None else replies.unionByName(got)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        n = left.num_rows
        b = _Block(left)
        gone = passes.removed(b, blocks.by_level(right, len(passes.lens))) if n else np.empty(0, bool)
        place = {i: j for j, i in enumerate(b.order)}
        texts = left.column("text").to_pylist()
        out = {"n_words": [], "n_removed": [], "spans": [], "text": [], "kept_sha256": []}
        for i, t in enumerate(texts):
            w, j = words(t), place.get(i)
            g = gone[b.starts[j] : b.ends[j]] if j is not None else np.zeros(len(w), bool)
            kept = b" ".join([x for x, y in zip(w, g.tolist()) if not y] if g.any() else w)
            turn = np.flatnonzero(np.diff(np.concatenate([[0], g.astype(np.int8), [0]]))).reshape(-1, 2)
            out["n_words"].append(len(w))
            out["n_removed"].append(int(g.sum()))
            out["spans"].append([{"start": int(x), "end": int(y)} for x, y in turn])
            out["text"].append(kept.decode("utf-8", "surrogatepass") if len(turn) else t)
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
        kinds = {"n_words": pa.int64(), "n_removed": pa.int64(), "text": pa.string(), "kept_sha256": pa.string(),
                 "spans": pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))}
        cols = {"doc_id": left.column("doc_id"), **{c: pa.array(out[c], kinds[c]) for c in out}}
        if keep:
            cols["rest"] = left.column("rest")
        return pa.table(cols)

    out = T.StructType.fromDDL(OUT)
    if keep:
        out.add(by_block.schema["rest"])
    return by_block.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(cut, out)
