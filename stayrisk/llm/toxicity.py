"""Toxicity by multiple-instance learning.

A document is a bag of sentences and only the document is labelled. Each
sentence gets a probability from the hashed words it holds; noisy-or combines
them: a document is toxic unless every one of its sentences is clean. The word
weights are trained through the noisy-or on document labels, and the sentence
probabilities then locate the offending sentences.

Sentences end at ``.``, ``!``, ``?`` or a line feed. Words are lower-cased
(A-Z), other ASCII punctuation is white space; a word counts once a sentence.
The model is fitted on a bounded labelled sample (``max_docs`` documents of at
most ``max_chars`` characters); words that do not stand out in its toxic
documents carry no weight. Every document is scored by all its sentences.

Defined results: null and empty texts are one sentence without words; every
input row gives one row, ids may be null or repeat; other columns are ignored.
Without any labelled document the score is 0.0; with one class only it is that
class. An empty table gives an empty result.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sample import labelled
from .text import slices

BUCKETS = 1 << 18
_ENDS = ".!?\n"
_OTHER = "".join(c for c in string.punctuation if c not in _ENDS)
_CLEAN = bytes.maketrans((string.ascii_uppercase + _OTHER + _ENDS).encode(),
                         (string.ascii_lowercase + " " * len(_OTHER) + "\n" * len(_ENDS)).encode())


class Words(dict):
    """Bucket of a word; forgets when it has seen many."""

    def __missing__(self, w: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        self[w] = v = xxhash.xxh32_intdigest(w) % BUCKETS
        return v


def bags(texts: list[str | None], known: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[tuple[int, int]]]]:
    """(bucket of each word, its sentence, document of each sentence, byte spans of each document's sentences)."""
    word, size, doc, spans = [], [], [], []
    get = known.__getitem__
    for i, t in enumerate(texts):
        raw = (t or "").encode("utf-8", "surrogatepass").translate(_CLEAN)
        own, at = [], 0
        for s in raw.split(b"\n"):
            if ws := s.split():
                ids = [*map(get, ws)]
                word += ids
                size.append(len(ids))
                doc.append(i)
                own.append((at, at + len(s)))
            at += len(s) + 1
        if not own:
            size.append(0)
            doc.append(i)
            own.append((0, 0))
        spans.append(own)
    return np.array(word, np.int64), np.repeat(np.arange(len(size)), size), np.array(doc, np.int64), spans


def _once(word: np.ndarray, sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each word once a sentence."""
    key = np.unique(sentence * BUCKETS + word)
    return key % BUCKETS, key // BUCKETS


class NoisyOr:
    def __init__(self):
        self.w = np.zeros(BUCKETS)
        self.b = -6.0
        self.constant: float | None = None

    def sentences(self, word: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
        """Logit of each sentence. Only words with a weight are made distinct."""
        live = self.w[word] != 0
        word, sentence = _once(word[live], sentence[live])
        return self.b + np.bincount(sentence, self.w[word], minlength=n)

    @staticmethod
    def documents(logit: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        """Noisy-or: 1 minus the product of the sentences' clean probabilities."""
        return -np.expm1(-np.bincount(doc, np.logaddexp(0, logit), minlength=n))


def fit(sample: pd.DataFrame, epochs: int = 1000, rate: float = 0.5, l1: float = 1e-5, min_docs: int = 4, screen: float = 6.0) -> NoisyOr:
    """Proximal AdaGrad on the log loss of the noisy-or.

    Only words in ``min_docs`` documents that stand in toxic documents at least
    ``screen`` standard deviations more often than by chance get a weight, so a
    large sample stays cheap: sentences without such words share one logit.
    """
    model = NoisyOr()
    y = sample["label"].to_numpy(np.float64)
    if not len(y) or y.min() == y.max():
        model.constant = float(y[0]) if len(y) else 0.0
        return model
    n, word, sentence, doc = len(y), [], [], []
    m = 0
    known = Words()
    for s, e in slices(sample["text"].tolist()):
        w, at, d, _ = bags(sample["text"].tolist()[s:e], known)
        w, at = _once(w, at)
        word.append(w)
        sentence.append(at + m)
        doc.append(d + s)
        m += len(d)
    word, sentence, doc = map(np.concatenate, (word, sentence, doc))
    pair = np.unique(doc[sentence] * BUCKETS + word)
    in_docs = np.bincount(pair % BUCKETS, minlength=BUCKETS)
    in_toxic = np.bincount(pair % BUCKETS, y[pair // BUCKETS], minlength=BUCKETS)
    q = y.mean()
    excess = (in_toxic - q * in_docs) / np.sqrt(np.maximum(in_docs * q * (1 - q), 1e-9))
    own = ((in_docs >= min_docs) & (excess >= screen))[word]
    word, sentence = word[own], sentence[own]
    used, col = np.unique(word, return_inverse=True)
    told, row = np.unique(sentence, return_inverse=True)  # sentences with such words
    told_doc = doc[told]
    plain = np.bincount(doc, minlength=n) - np.bincount(told_doc, minlength=n)
    w, b, sw, sb = np.zeros(len(used)), model.b, np.full(len(used), 1e-8), 1e-8
    for _ in range(epochs):
        logit = b + np.bincount(row, w[col], minlength=len(told))
        p = np.clip(-np.expm1(-np.bincount(told_doc, np.logaddexp(0, logit), minlength=n) - plain * np.logaddexp(0, b)), 1e-9, 1)
        pull = np.where(y == 1, -(1 - p) / p, 1.0) / n
        g = pull[told_doc] / (1 + np.exp(-logit))
        gw, gb = np.bincount(col, g[row], minlength=len(used)), g.sum() + (pull * plain).sum() / (1 + np.exp(-b))
        sw, sb = sw + gw * gw, sb + gb * gb
        step = rate / np.sqrt(sw)
        w = w - step * gw
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
        b -= rate * gb / np.sqrt(sb)
    model.w[used], model.b = w, b
    return model


def train(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "toxic", max_docs: int = 12_000,
          max_chars: int = 50_000, id_col: str = "doc_id", text_col: str = "text", **how) -> NoisyOr:
    """Fit on at most ``max_docs`` of the labelled documents that ``learn`` (a condition on their id) allows."""
    return fit(labelled(docs, labels, label, learn, max_docs, max_chars, id_col, text_col), **how)


def score(docs: DataFrame, model: NoisyOr, at_least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, n_sentences, offending``: the sentences with a probability of ``at_least``, as text and byte span."""
    sentence_type = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64()), ("sentence", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for b in batches:
            texts = b.column(1).to_pylist()
            for s, e in slices(texts):
                part = texts[s:e]
                word, sentence, doc, spans = bags(part, known)
                logit = model.sentences(word, sentence, len(doc))
                got = model.documents(logit, doc, len(part)) if model.constant is None else np.full(len(part), model.constant)
                p = 1 / (1 + np.exp(-logit))
                first = np.searchsorted(doc, np.arange(len(part)))
                found: list[list[dict]] = [[] for _ in part]
                for k in np.flatnonzero(p >= at_least):
                    x, y = spans[doc[k]][k - first[doc[k]]]
                    raw = (part[doc[k]] or "").encode("utf-8", "surrogatepass")[x:y]
                    found[doc[k]].append({"start": x, "end": y, "probability": float(p[k]), "sentence": raw.decode("utf-8", "replace")})
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(s, e - s), pa.array(got, pa.float64()), pa.array([len(x) for x in spans], pa.int64()),
                     pa.array(found, pa.list_(sentence_type))], names=["doc_id", "score", "n_sentences", "offending"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        run, "doc_id long, score double, n_sentences long, offending array<struct<start:long,end:long,probability:double,sentence:string>>")
