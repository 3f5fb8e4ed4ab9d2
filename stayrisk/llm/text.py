"""Words and hashes shared by the operators of this subpackage.

A word is a maximal run of bytes other than space and ``\\x09-\\x0D``, i.e.
``[^\\x20\\x09-\\x0D]+``: exactly what ``bytes.split()`` cuts (``str.split``
would also cut at other Unicode spaces). A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

MULT = np.uint64(0x9E3779B97F4A7C15)
_H = xxhash.xxh64_intdigest


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def hashes(ws: list[bytes]) -> np.ndarray:
    """64-bit hash of each word."""
    return np.fromiter(map(_H, ws), np.uint64, len(ws))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread entropy over all bits, so that the top bits can deal keys to partitions."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n items starting at each position; ``len(h) - n + 1`` values."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = h[:m].copy()
    for j in range(1, n):
        out *= MULT
        out += h[j : j + m]
    return mix(out)


def slices(texts: list[str | None], max_chars: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges of about ``max_chars`` characters: the working set of one numpy pass.

    A single longer text forms a range of its own; no text is cut.
    """
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and size + n > max_chars:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def fold(id_col: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod`` (null id: -1)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % mod, F.lit(-1))


def letters(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def with_columns(batch: pa.RecordBatch, new: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with columns appended."""
    return pa.RecordBatch.from_arrays(
        [*batch.columns, *new.values()], names=[*batch.schema.names, *new.keys()]
    )
