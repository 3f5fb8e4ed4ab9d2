"""Language identification by averaged hashed subword embeddings.

A word (lower-cased) is the set of its byte n-grams of ``SIZES`` bytes with word
marks; each n-gram hashes to an embedding. A document is the average embedding
of all its words' n-grams, a linear softmax gives the languages. Embeddings and
softmax are trained together by stochastic gradient descent on a bounded
labelled sample (``max_docs`` documents of at most ``max_chars`` characters).
Part of the sample is set aside to calibrate: a temperature makes the scores
probabilities, and a threshold rejects documents (column ``rejected``) so that
at most ``max_error`` of the accepted ones are expected to be wrong.

Defined results: a null text or one without any letter is ``und`` with score
0.0; every input row gives one row, ids may be null or repeat; other columns
are ignored; equal scores go to the alphabetically first language. Without any
labelled document everything is ``und``. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sample import labelled
from .text import letters, slices

BUCKETS, DIM, SIZES = 1 << 13, 16, (2, 3, 4)
UNKNOWN = "und"
MAX_KNOWN = 100_000


def words(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").split() if text else []


def subwords(w: bytes) -> list[int]:
    """Buckets of the word's byte n-grams."""
    w = b"<" + w + b">"
    return [crc32(w[i : i + k]) % BUCKETS for k in SIZES for i in range(max(1, len(w) - k + 1))]


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


_CRC = _crc_table()


def subwords_of(ws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of every word's n-grams, one word after the other as :func:`subwords` has them, and their number in each word."""
    text = np.frombuffer(b"".join(b"<" + w + b">" for w in ws), np.uint8)
    size = np.fromiter(map(len, ws), np.int64, len(ws)) + 2
    per = [np.maximum(1, size - k + 1) for k in SIZES]
    n = sum(per)
    first, at = np.cumsum(size) - size, np.cumsum(n) - n
    flat = np.empty(int(n.sum()), np.int64)
    crc = np.full(len(text), 0xFFFFFFFF, np.uint32)  # of the bytes from each position on; the last one ends early
    for k in range(1, max(SIZES) + 1):
        m = len(text) - k + 1
        if m > 0:
            crc[:m] = _CRC[(crc[:m] ^ text[k - 1:]) & np.uint32(0xFF)] ^ (crc[:m] >> np.uint32(8))
        if k == 1:
            short = np.where(size == 1, crc[first], 0)
        else:
            short = np.where(size == k, crc[first], short)  # a word shorter than the next n-grams is one of them whole
        if k in SIZES:
            own = per[SIZES.index(k)]
            place = np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)  # in the word
            got = crc[np.repeat(first, own) + place]
            got[np.cumsum(own) - own] = np.where(size < k, short, got[np.cumsum(own) - own])
            flat[np.repeat(at, own) + place] = (got ^ np.uint32(0xFFFFFFFF)) % np.uint32(BUCKETS)
            at = at + own
    return flat, n


class Model:
    def __init__(self, languages: list[str]):
        self.languages = languages
        self.E = np.zeros((BUCKETS, DIM), np.float32)
        self.U = np.zeros((DIM, len(languages)), np.float32)
        self.c = np.zeros(len(languages), np.float32)
        self.temperature, self.threshold = 1.0, 0.0

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = (x @ self.U + self.c) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


class Vectors:
    """Sum of a word's embeddings and their number, remembered for the words seen last."""

    def __init__(self, model: Model):
        self.model, self.place, self.sums = model, {}, np.empty((0, DIM + 1))

    def mean(self, texts: list[str | None]) -> np.ndarray:
        """Average embedding of each text."""
        per = [words(t) for t in texts]
        if len(self.place) > MAX_KNOWN:
            self.place, self.sums = {}, self.sums[:0]
        new = list({w for ws in per for w in ws}.difference(self.place))
        if new:
            flat, n = subwords_of(new)
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            sums = np.add.reduceat(self.model.E[flat], np.cumsum(n) - n)
            self.sums = np.concatenate([self.sums, np.column_stack([sums, n]).astype(np.float32)])  # added in double precision
        out = np.zeros((len(texts), DIM), np.float32)
        for i, ws in enumerate(per):
            if ws:
                got = self.sums[np.fromiter(map(self.place.__getitem__, ws), np.int64, len(ws))].sum(axis=0)
                out[i] = got[:DIM] / got[DIM]
        return out


def fit(sample: pd.DataFrame, epochs: int = 15, batch: int = 32, rate: float = 20.0, max_error: float = 0.01, seed: int = 7) -> Model:
    """SGD on four fifths of the sample; temperature and threshold on the rest."""
    sample = sample[[letters(t) for t in sample["text"]]] if len(sample) else sample
    model = Model(sorted(map(str, sample["label"].unique())) if len(sample) else [])
    if not model.languages:
        return model
    y = np.array([model.languages.index(str(v)) for v in sample["label"]])
    x = np.zeros((len(y), BUCKETS), np.float32)
    for i, t in enumerate(sample["text"]):
        flat = [b for w in words(t) for b in subwords(w)]
        x[i] = np.bincount(flat, minlength=BUCKETS) / len(flat)
    r = np.random.default_rng(seed)
    model.E[:] = r.normal(0, 0.3, model.E.shape)
    model.U[:] = r.normal(0, 0.3, model.U.shape)
    held = np.arange(len(y)) % 5 == 4
    learn = np.flatnonzero(~held) if held.any() else np.arange(len(y))
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for s in range(0, len(learn), batch):
            rows = r.choice(learn, min(batch, len(learn)), replace=False)
            h = x[rows] @ model.E
            d = model.probabilities(h)
            d[np.arange(len(rows)), y[rows]] -= 1
            d /= len(rows)
            back = d @ model.U.T
            model.U -= 0.05 * step * (h.T @ d)
            model.c -= 0.05 * step * d.sum(0)
            model.E -= step * (x[rows].T @ back)
    if held.any():
        h, yh = x[held] @ model.E, y[held]

        def loss(t: float) -> float:
            model.temperature = t
            return -np.log(model.probabilities(h)[np.arange(len(yh)), yh] + 1e-12).mean()

        model.temperature = float(min(np.geomspace(0.1, 10, 41), key=loss))
        p = model.probabilities(h)
        top, right = p.max(1), p.argmax(1) == yh
        order = np.argsort(-top)
        error = np.cumsum(~right[order]) / np.arange(1, len(order) + 1)
        fine = np.flatnonzero(error <= max_error)
        model.threshold = float(top[order][fine[-1]]) if len(fine) and fine[-1] + 1 < len(order) else 0.0 if len(fine) else 1.0
    return model


def train(docs: DataFrame, learn: Column, lang_col: str = "lang", max_docs: int = 2500, max_chars: int = 50_000,
          id_col: str = "doc_id", text_col: str = "text", **how) -> Model:
    """Fit on at most ``max_docs`` of the documents that have a language and that ``learn`` (a condition on their id) allows."""
    return fit(labelled(docs, None, lang_col, learn, max_docs, max_chars, id_col, text_col), **how)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vectors(model)
        for b in batches:
            texts = b.column(1).to_pylist()
            for s, e in slices(texts):
                part = texts[s:e]
                lang, score = [UNKNOWN] * len(part), np.zeros(len(part))
                if model.languages:
                    p = model.probabilities(known.mean(part))
                    some = np.array([letters(t) for t in part])
                    score = np.where(some, p.max(1), 0.0)
                    lang = [model.languages[k] if z else UNKNOWN for k, z in zip(p.argmax(1), some)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(s, e - s), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                     pa.array((score < model.threshold) | np.array([x == UNKNOWN for x in lang], bool))],
                    names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, "doc_id long, lang_pred string, score double, rejected boolean")
