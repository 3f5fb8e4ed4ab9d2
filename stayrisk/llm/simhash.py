"""SimHash near-dedup: documents whose 64-bit fingerprints differ in few bits form one group.

Fingerprint: ASCII letters are lower-cased, words joined by one space into
shingles of ``shingle`` words (all shingles count, repeats included; fewer
words: the whole sequence; none: fingerprint zero). A bit is 1 if it is set in
over half of the shingles' XXH64 (seed 42).

Links: anchor-point covering. Both 32-bit halves of a fingerprint get anchors
of their own: the codewords of the Hamming [31, 26] code on the half's low 31
bits, which cover every point within radius 1. Fingerprints at most 3 bits
apart are at most 1 bit apart in one half, so the nearest codeword of one lies
within radius 1 + 1 of the other. Every distinct fingerprint is replicated to
the codewords within radius 2 (16 of them, or 1 if it is a codeword itself)
and, per anchor, compared on all 64 bits with the fingerprints at home there.
Copies share a fingerprint and are compared once. An anchor with more than
``TILE`` fingerprints is cut into tiles of home x replica chunks that go to
different tasks, and a tile returns a spanning forest of its links, never all
pairs. Components come from min-label propagation with pointer jumping, each
round checkpointed in the shared folder.

Defined results: null and empty texts have fingerprint zero and are linked
like any other; rows that repeat an id are one document, so all their
fingerprints are linked; a row with a null id makes no links and takes the
component of its fingerprint (null if no row with an id has it). Other columns
are ignored. An empty table gives an empty result. ``keep_one`` judges rows by
their own text instead: one row of every group of near texts stays, so no text is
lost unless a kept row holds it or a near copy; rows with a null id all stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import words

BITS = 3
TILE = 2048
_HALF = np.uint64(0x7FFFFFFF)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    ws = words(text)
    if not ws:
        return 0
    joined = b" ".join(ws).lower()  # bytes.lower touches A-Z only
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
    k = min(shingle, len(ws))
    starts = np.concatenate([[0], ends[: len(ws) - k] + 1])
    h = xxhash.xxh64_intdigest
    n = len(starts)
    count = np.zeros(64, np.int64)
    for a in range(0, n, 50_000):  # uint16 sums below
        part = [h(joined[i:j], 42) for i, j in zip(starts[a : a + 50_000].tolist(), ends[k - 1 + a : k - 1 + a + 50_000].tolist())]
        bits = np.unpackbits(np.array(part, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += np.add.reduce(bits, axis=0, dtype=np.uint16)
    return int(np.packbits(2 * count > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """``doc_id, fp`` (the fingerprint as a signed long) and, if ``row_col`` names a long column, that as ``row``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), *b.columns[2:]], names=["doc_id", "fp", "row"][: b.num_columns])

    more = [F.col(row_col).cast("long")] if row_col else []
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"), *more).mapInArrow(
        run, "doc_id long, fp long" + (", row long" if row_col else ""))


def _syndromes() -> tuple[np.ndarray, np.ndarray]:
    """Syndrome of the low and of the high 16 bits of a half; bit i has the column i + 1."""
    low = np.zeros(1 << 16, np.uint8)
    high = np.zeros(1 << 16, np.uint8)
    v = np.arange(1 << 16)
    for i in range(16):
        low ^= np.where(v >> i & 1, i + 1, 0).astype(np.uint8)
        if i < 15:
            high ^= np.where(v >> i & 1, i + 17, 0).astype(np.uint8)
    return low, high


def _flips() -> np.ndarray:
    """By syndrome: what to flip to reach the nearest codeword (first) and those at distance 2."""
    def bit(i: int) -> int:
        return 1 << (i - 1)

    out = np.zeros((32, 16), np.uint64)
    for s in range(1, 32):
        out[s, 0] = bit(s)
        out[s, 1:] = [bit(i) | bit(i ^ s) for i in range(1, 32) if i < i ^ s and i != s and i ^ s]
    return out


def anchors(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, home) for every anchor of every fingerprint (uint64)."""
    low, high = _syndromes()
    flips = _flips()
    rows, out, home = [], [], []
    for half in (0, 1):
        v = (fp >> np.uint64(32 * half)) & _HALF
        s = low[v & np.uint64(0xFFFF)] ^ high[v >> np.uint64(16)]
        at = v[:, None] ^ flips[s]
        own = np.ones(at.shape, bool)
        own[s == 0, 1:] = False
        r, c = np.nonzero(own)
        rows.append(r)
        out.append(at[own].astype(np.int64) | (half << 31))
        home.append(c == 0)
    return np.concatenate(rows), np.concatenate(out), np.concatenate(home)


def _replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        fp, node = b.column(0), b.column(1)
        r, a, h = anchors(fp.to_numpy().view(np.uint64))
        r = pa.array(r)
        yield pa.RecordBatch.from_arrays([pa.array(a), fp.take(r), node.take(r), pa.array(h)], names=["anchor", "fp", "node", "home"])


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index connected with each of n indices by the links (a, b)."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _tile(fp: np.ndarray, node: np.ndarray, role: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, smallest node it reaches) inside one tile; role: 1 home, 2 replica, 3 both."""
    fp, first, place = np.unique(fp, return_index=True, return_inverse=True)
    order = np.argsort(node[first], kind="stable")  # the smallest index is the smallest node
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    fp, node, place = fp[order], node[first][order], rank[place]
    home = np.unique(place[role & 1 > 0])
    other = np.unique(place[role & 2 > 0])
    a, b = [], []
    for s in range(0, len(home), TILE):
        x, y = np.nonzero(np.bitwise_count(fp[home[s : s + TILE], None] ^ fp[None, other]) <= bits)
        a.append(home[s : s + TILE][x])
        b.append(other[y])
    if not a:
        return node[:0], node[:0]
    label = forest(len(node), np.concatenate(a), np.concatenate(b))
    moved = np.flatnonzero(node[label] != node)
    return node[moved], node[label[moved]]


def _compare(bits: int):
    """Stream over rows sorted by tile; one tile is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None
        for b in batches:
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
            if rest is not None:
                cols = [np.concatenate(x) for x in zip(rest, cols)]
            n = len(cols[0])
            if not n:
                continue
            new = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1])) + 1
            last = int(new[-1]) if len(new) else 0
            yield from _tiles([c[:last] for c in cols], new[:-1] if len(new) else new, bits)
            rest = [c[last:] for c in cols]
        if rest is not None and len(rest[0]):
            yield from _tiles(rest, np.empty(0, np.int64), bits)

    return run


def _tiles(cols: list[np.ndarray], cuts: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    if not len(cols[0]):
        return
    a, b = [], []
    for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(cols[0])]):
        if e - s > 1:
            x, y = _tile(cols[3][s:e].view(np.uint64), cols[4][s:e], cols[5][s:e], bits)
            a.append(x)
            b.append(y)
    if a:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])


def links(nodes: DataFrame, bits: int = BITS) -> DataFrame:
    """Spanning links ``a, b`` (b < a) between nodes whose fingerprints differ in at most ``bits`` bits.

    ``nodes``: ``fp long, node long``, each fingerprint once.
    """
    if not 0 <= bits <= 3:
        raise ValueError("the code covers distances up to 3")
    near = nodes.select("fp", "node").mapInArrow(_replicate, "anchor long, fp long, node long, home boolean")
    sizes = near.groupBy("anchor").agg(F.count("*").alias("n"), F.max("home").alias("any_home"))
    sizes = sizes.filter("any_home and n > 1").select("anchor", F.ceil(F.col("n") / TILE).cast("int").alias("m"))
    chunk = F.pmod(F.xxhash64("fp"), F.col("m")).cast("int")
    k = F.sequence(F.lit(0), F.col("m") - 1)
    as_home = F.transform(k, lambda j: F.struct(F.col("c").alias("i"), j.alias("j"), F.lit(1).alias("role")))
    as_other = F.transform(k, lambda i: F.struct(i.alias("i"), F.col("c").alias("j"), F.lit(2).alias("role")))
    both = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.when(F.col("home"), 3).otherwise(2).alias("role")))
    tiles = F.when(F.col("m") == 1, both).when(F.col("home"), F.concat(as_home, as_other)).otherwise(as_other)
    rows = near.join(sizes, "anchor").withColumn("c", chunk).select("anchor", "fp", "node", F.explode(tiles).alias("t"))
    rows = rows.select("anchor", "t.i", "t.j", "fp", "node", "t.role").repartition("anchor", "i", "j")
    return rows.sortWithinPartitions("anchor", "i", "j").mapInArrow(_compare(bits), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: the smallest node that each linked node reaches, by min-label propagation.

    Each round takes the smallest label among the neighbours, then the label of
    that label; it ends when no label changes.
    """
    edges = edges.checkpoint()
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).checkpoint()
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("label")).checkpoint()
    while True:
        seen = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("l"))
        near = labels.join(seen, "node").select("node", F.col("label").alias("old"), F.least("label", "l").alias("label"))
        step = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = near.join(step, "label", "left").select("node", "old", F.least("label", "next").alias("label")).checkpoint()
        labels = new.select("node", "label")
        if new.filter("old != label").isEmpty():
            return labels


def _same_document(fps: DataFrame, nodes: DataFrame) -> DataFrame | None:
    """Links ``a, b`` between the nodes of ids that have several fingerprints; None if no id has."""
    told = fps.filter("doc_id is not null")
    several = told.groupBy("doc_id").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).filter("lo != hi").select("doc_id").checkpoint()
    if several.isEmpty():
        return None
    of = told.join(several, "doc_id").select("doc_id", "fp").distinct().join(nodes, "fp").select("doc_id", "node").distinct().checkpoint()
    least = of.groupBy("doc_id").agg(F.min("node").alias("b"))
    return of.join(least, "doc_id").filter("node != b").select(F.col("node").alias("a"), "b").distinct()


def near_dedup(docs: DataFrame, shingle: int = 3, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, fp, fingerprint`` (16 hex digits) and ``component_id`` (smallest doc_id reachable)."""
    fps = fingerprints(docs, shingle, id_col, text_col).checkpoint()
    nodes = fps.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")).checkpoint()
    edges = links(nodes, bits)
    if (own := _same_document(fps, nodes)) is not None:
        edges = edges.unionByName(own)
    labels = components(edges)
    of = nodes.join(labels, "node", "left").select("fp", F.coalesce("label", "node").alias("component_id")).checkpoint()
    return fps.join(of, "fp", "left").select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each group of near texts the row with the smallest id.

    Of rows with that id and several near texts the one with the least hash stays, of repeated rows the least by
    their other columns.
    """
    def key(df: DataFrame) -> F.Column:
        return F.xxhash64(df[id_col].cast("long"), df[text_col].cast("string"))

    rows = docs.select(F.col(id_col), F.col(text_col), key(docs).alias("row"))
    fps = fingerprints(rows, shingle, id_col, text_col, row_col="row").checkpoint()
    told = fps.filter("doc_id is not null")
    nodes = told.groupBy("fp").agg(F.min(F.struct("doc_id", "row")).alias("best")).withColumn("node", F.xxhash64("fp")).checkpoint()
    labels = components(links(nodes, bits))
    of = nodes.join(labels, "node", "left").select("fp", "best", F.coalesce("label", "node").alias("label")).checkpoint()
    least = of.groupBy("label").agg(F.min("best").alias("kept"))
    of = of.join(least, "label").select("fp", "kept").checkpoint()
    gone = told.join(of, "fp").filter((F.col("kept.doc_id") != F.col("doc_id")) | (F.col("kept.row") != F.col("row")))
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("row").alias("gone_row")).distinct()
    kept = docs.join(gone, (key(docs) == gone["gone_row"]) & (docs[id_col].cast("long") == gone["gone_id"]), "left_anti")
    # repeated rows: only ids and texts that occur again are grouped
    again = told.groupBy(F.col("doc_id").alias("again_id"), F.col("row").alias("again_row")).count().filter("count > 1").drop("count").checkpoint()
    if again.isEmpty():
        return kept
    same = (key(kept) == again["again_row"]) & (kept[id_col].cast("long") == again["again_id"])
    # packed before the join: the columns of ``docs`` may have any names
    packed = kept.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), key(kept).alias("row"), kept[id_col].cast("long").alias("id"))
    one = packed.join(again, (packed["row"] == again["again_row"]) & (packed["id"] == again["again_id"]))
    one = one.groupBy("again_id", "again_row").agg(F.min("whole").alias("whole"))
    return kept.join(again, same, "left_anti").unionByName(one.select("whole.*"))
