"""Key exchange between blocks of documents: "which of my keys do other blocks hold too?"

Window and n-gram operators need facts about every key of the corpus (how many
occurrences, is it repeated, which is its smallest document) at every place
where the key occurs. One shuffled row per occurrence would be several times
the input, and a key that a third of all documents hold would land in one task.
Instead documents are dealt to blocks of a bounded size, row by row, so that an
id or a text on a third of all rows spreads over all blocks, and

1. each block sends its *distinct* keys, sorted and packed, one row per
   (block, key range): a hot key costs one entry per block;
2. each key range merges its rows and answers every row it got with an array
   aligned to that row's keys;
3. the answers go back to the blocks by block id.

All three steps are ordinary grouped operations (``groupBy(...).applyInArrow``
and ``cogroup``), so Spark places, spills and recomputes them; the exchange of
the documents by block is planned once and reused by every pass of a query.

Rows are dealt by a hash of id, text and the row's number in its input
partition. A task that is run again reads the same file split in the same order
and deals it alike; documents that no table or checkpoint holds, and whose order
may change from one run of a task to the next, must be checkpointed before.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import hashes, words

#: Characters of a block, and characters whose keys a range merges.
BLOCK_CHARS, RANGE_CHARS = 8_000_000, 16_000_000
BLOB_SCHEMA = "part int, block int, keys binary, extra binary"
REPLY_SCHEMA = "block int, part int, reply binary, level int"
_REPLY = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("reply", pa.binary()), ("level", pa.int32())])
_BLOB = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("extra", pa.binary())])


def characters(docs: DataFrame, text: str = "text") -> int:
    return docs.select(F.sum(F.length(text))).first()[0] or 0


def plan(docs: DataFrame, chars: int) -> tuple[int, int]:
    """(blocks, key ranges) for documents of so many characters.

    At least one of each per shuffle partition, so small inputs use all cores too.
    """
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(least, math.ceil(chars / BLOCK_CHARS)), max(least, math.ceil(chars / RANGE_CHARS))


def blocked(docs: DataFrame, n_blocks: int, id_col: str, text_col: str, keep: list[str] = ()) -> DataFrame:
    """``block, doc_id, text[, rest struct]``; rows that repeat an id or a text get blocks of their own."""
    key = F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"), F.monotonically_increasing_id())
    cols = [F.pmod(key, F.lit(n_blocks)).cast("int").alias("block"), F.col(id_col).cast("long").alias("doc_id"),
            F.col(text_col).cast("string").alias("text")]
    if keep:
        cols.append(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("rest"))
    return docs.select(*cols)


def pack(keys: np.ndarray) -> bytes:
    """Sorted distinct uint64 keys as byte planes of their differences (the high planes are zeros and compress)."""
    d = np.diff(keys, prepend=np.uint64(0))
    return np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def planes(x: np.ndarray) -> bytes:
    """int64 values as byte planes."""
    return np.ascontiguousarray(x.astype(np.int64).view(np.uint8).reshape(-1, 8).T).tobytes()


def unplanes(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, -1).T).view(np.int64).ravel()


def edges(keys: np.ndarray, n_parts: int) -> np.ndarray:
    """Bounds of the key ranges inside sorted keys; ``n_parts + 1`` positions."""
    cuts = (np.arange(1, n_parts, dtype=object) * (1 << 64) // n_parts).astype(np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, cuts), [len(keys)]])


def blob_table(block: int, keys: np.ndarray, n_parts: int, extra: Callable[[int, int], bytes | None]) -> pa.Table:
    """Rows of BLOB_SCHEMA for one block's sorted distinct keys; ``extra(a, b)`` packs what goes with ``keys[a:b]``."""
    e = edges(keys, n_parts)
    own = [p for p in range(n_parts) if e[p + 1] > e[p]]
    return pa.table({
        "part": pa.array(own, pa.int32()), "block": pa.array([block] * len(own), pa.int32()),
        "keys": pa.array([pack(keys[e[p] : e[p + 1]]) for p in own], pa.binary()),
        "extra": pa.array([extra(e[p], e[p + 1]) for p in own], pa.binary()),
    }, schema=_BLOB)


def answer(blobs: DataFrame, reduce: Callable[[list[np.ndarray], list[bytes]], list[bytes]], level: int) -> DataFrame:
    """Step 2: ``reduce(keys of each row, extra of each row)`` gives one reply per row.

    ``block, part, reply, level``, dealt by block into a set number of partitions:
    the later passes read this one exchange, alone or in a union with other levels.
    """
    n = int(blobs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))

    def merge(table: pa.Table) -> pa.Table:
        keys = [unpack(k) for k in table.column("keys").to_pylist()]
        replies = reduce(keys, table.column("extra").to_pylist())
        return pa.table({"block": table.column("block").cast(pa.int32()), "part": table.column("part").cast(pa.int32()),
                         "reply": pa.array(replies, pa.binary()), "level": pa.array([level] * len(replies), pa.int32())}, schema=_REPLY)

    return blobs.groupBy("part").applyInArrow(merge, REPLY_SCHEMA).repartition(n, "block")


def union_reply(table: pa.Table) -> list[bytes]:
    """The replies to a block in key order."""
    order = np.argsort(table.column("part").to_numpy())
    replies = table.column("reply").to_pylist()
    return [replies[i] for i in order]


def by_level(table: pa.Table, n: int) -> list[list[bytes]]:
    """The replies to a block, for each of the levels 0 to ``n - 1``, in key order."""
    return [union_reply(table.filter(pc.equal(table.column("level"), k))) for k in range(n)]


def block_id(table: pa.Table) -> int:
    return table.column("block")[0].as_py()


class Tokens:
    """The words of one block's documents in id order, as one array of hashes.

    Rows with a null id are left out, or come last if ``every``.
    """

    def __init__(self, table: pa.Table, every: bool = False):
        ids = table.column("doc_id").to_pylist()
        texts = table.column("text")
        self.order = sorted((i for i, d in enumerate(ids) if d is not None), key=lambda i: ids[i])
        if every:
            self.order += [i for i, d in enumerate(ids) if d is None]
        self.ids = np.array([-1 if ids[i] is None else ids[i] for i in self.order], np.int64)
        per = [hashes(words(texts[i].as_py())) for i in self.order]
        n = np.array([len(x) for x in per], np.int64)
        self.h = np.concatenate(per) if per else np.empty(0, np.uint64)
        self.ends = np.cumsum(n)
        self.starts = self.ends - n
        self.end_of = np.repeat(self.ends, n)  # by word
        self.doc_of = np.repeat(self.ids, n)

    def fits(self, length: int) -> np.ndarray:
        """Positions at which a window of ``length`` words ends inside the document."""
        return np.flatnonzero(np.arange(len(self.h)) + length <= self.end_of)
