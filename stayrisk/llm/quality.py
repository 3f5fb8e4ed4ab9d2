"""Quality classifier: a byte-level convolutional network in numpy.

The bytes of a whole document are cut into overlapping chunks. Learned filters
slide over each chunk byte by byte; every filter's largest response in the chunk is kept
(max-pooling), chunks are combined by the maximum and the mean of what their
filters kept, and a logistic layer gives one probability. Embeddings, filters
and the output layer are trained together by Adam on a bounded labelled sample
(``max_docs`` documents of at most ``max_chars`` characters); every document is
scored by all of its bytes.

Defined results: null and empty texts are one chunk of padding and get its
score; every input row gives one row, ids may be null or repeat; other columns
are ignored. Without any labelled document the score is 0.0 and ``keep`` keeps
every row; with one class only the score is that class. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sample import labelled
from .text import slices

CHUNK, OVERLAP, WIDTH = 512, 64, 8
FILTERS, DIM, PAD = 16, 8, 256
POSITIONS = CHUNK - WIDTH + 1


def chunks(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(chunks x CHUNK byte values, document of each chunk); padding is PAD."""
    out, of = [], []
    hop = CHUNK - OVERLAP
    for i, t in enumerate(texts):
        raw = np.frombuffer((t or "").encode("utf-8", "surrogatepass"), np.uint8)
        n = max(1, -(-(len(raw) - OVERLAP) // hop))
        full = np.full((n - 1) * hop + CHUNK, PAD, np.int16)
        full[: len(raw)] = raw
        out.append(np.lib.stride_tricks.sliding_window_view(full, CHUNK)[::hop])
        of.append(np.full(n, i))
    return np.concatenate(out), np.concatenate(of)


class ByteCNN:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = {
            "E": r.normal(0, 0.5, (PAD + 1, DIM)), "W": r.normal(0, 1 / np.sqrt(WIDTH * DIM), (WIDTH, DIM, FILTERS)),
            "b": np.zeros(FILTERS), "v": r.normal(0, 0.1, 2 * FILTERS), "c": np.zeros(1),
        }
        self.p["E"][PAD] = 0
        self.constant: float | None = None
        self.learned = True

    def tables(self) -> np.ndarray:
        """Response of each filter to each byte value at each offset."""
        return np.einsum("bd,wdf->wbf", self.p["E"], self.p["W"]).astype(np.float32)

    def pooled(self, x: np.ndarray, tables: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Largest response of each filter in each chunk and, if asked, its position."""
        best, at = np.empty((len(x), FILTERS), np.float32), np.empty((len(x), FILTERS), np.int64) if where else None
        for s in range(0, len(x), 64):
            part = x[s : s + 64]
            got = np.take(tables[0], part[:, :POSITIONS], axis=0)
            for w in range(1, WIDTH):
                got += np.take(tables[w], part[:, w : w + POSITIONS], axis=0)
            best[s : s + 64] = got.max(axis=1)
            if where:
                at[s : s + 64] = got.argmax(axis=1)
        return best, at

    def features(self, best: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        act = np.maximum(best + self.p["b"], 0)
        starts = np.searchsorted(of, np.arange(n))
        return act, np.concatenate([np.maximum.reduceat(act, starts), np.add.reduceat(act, starts) / np.bincount(of, minlength=n)[:, None]], axis=1)

    def predict(self, texts: list[str | None], tables: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        x, of = chunks(texts)
        _, f = self.features(self.pooled(x, tables)[0], of, len(texts))
        return 1 / (1 + np.exp(-np.clip(f @ self.p["v"] + self.p["c"], -30, 30)))

    def gradients(self, x: np.ndarray, of: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        n = len(y)
        best, at = self.pooled(x, self.tables(), where=True)
        act, f = self.features(best, of, n)
        d = (1 / (1 + np.exp(-np.clip(f @ self.p["v"] + self.p["c"], -30, 30))) - y) / n
        top, mean = f[:, :FILTERS], f[:, FILTERS:]
        share = np.bincount(of, minlength=n)[of][:, None]
        first = act == top[of]  # equal chunks share the gradient of the maximum
        first = first / np.add.reduceat(first.astype(np.int64), np.searchsorted(of, np.arange(n)))[of]
        g = first * (d[of, None] * self.p["v"][:FILTERS]) + d[of, None] * self.p["v"][FILTERS:] / share
        g *= act > 0
        gt = np.zeros((WIDTH, PAD + 1, FILTERS))
        rows, filters = np.arange(len(x))[:, None], np.arange(FILTERS)
        for w in range(WIDTH):
            np.add.at(gt[w], (x[rows, at + w], filters), g)
        out = {"E": np.einsum("wbf,wdf->bd", gt, self.p["W"]), "W": np.einsum("wbf,bd->wdf", gt, self.p["E"]), "b": g.sum(0),
               "v": f.T @ d + 1e-4 * self.p["v"], "c": d.sum(keepdims=True)}
        out["E"][PAD] = 0
        return out


def fit(sample: pd.DataFrame, epochs: int = 8, batch: int = 32, rate: float = 0.01, seed: int = 7, least_steps: int = 300) -> ByteCNN:
    """Adam on the logistic loss; a small sample is gone through more often, for ``least_steps`` steps."""
    model = ByteCNN(seed)
    y = sample["label"].to_numpy(np.float64)
    if not len(y) or y.min() == y.max():
        model.constant, model.learned = float(y[0]) if len(y) else 0.0, len(y) > 0
        return model
    r = np.random.default_rng(seed)
    x, of = chunks(sample["text"].tolist())
    starts, ends = np.searchsorted(of, np.arange(len(y))), np.searchsorted(of, np.arange(len(y)), "right")
    m = {k: np.zeros_like(a) for k, a in model.p.items()}
    v = {k: np.zeros_like(a) for k, a in model.p.items()}
    model.p["c"][:] = np.log(y.mean() / (1 - y.mean()))
    t = 0
    for _ in range(max(epochs, -(-least_steps * batch // len(y)))):
        turn = r.permutation(len(y))
        for s in range(0, len(y), batch):
            docs = turn[s : s + batch]
            rows = np.concatenate([np.arange(starts[d], ends[d]) for d in docs])
            of_batch = np.repeat(np.arange(len(docs)), (ends - starts)[docs])
            t += 1
            for k, g in model.gradients(x[rows], of_batch, y[docs]).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                model.p[k] -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return model


def train(docs: DataFrame, labels: DataFrame, learn: Column, label: str = "quality", max_docs: int = 2500,
          max_chars: int = 50_000, id_col: str = "doc_id", text_col: str = "text", **how) -> ByteCNN:
    """Fit on at most ``max_docs`` of the labelled documents that ``learn`` (a condition on their id) allows."""
    return fit(labelled(docs, labels, label, learn, max_docs, max_chars, id_col, text_col), **how)


def score(docs: DataFrame, model: ByteCNN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` for every row."""
    tables = model.tables()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            for s, e in slices(texts, 2_000_000):
                got = model.predict(texts[s:e], tables)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(s, e - s), pa.array(got, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, "doc_id long, score double")


def keep(docs: DataFrame, model: ByteCNN, at_least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows whose text scores ``at_least``, with all their columns; all rows if there was nothing to learn from."""
    if not model.learned:
        return docs
    tables = model.tables()
    types = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.schema.get_field_index(text_col)).to_pylist()
            for s, e in slices(texts, 2_000_000):
                yield b.slice(s, e - s).filter(pa.array(model.predict(texts[s:e], tables) >= at_least))

    return docs.mapInArrow(run, types)
