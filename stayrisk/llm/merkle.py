"""Merkle manifest of a table by time-forward processing (op13).

A tree's nodes are labelled (level, index). Going up, a priority queue ordered
by label hands every digest to its parent, which hashes once its children are
there; going down in reversed order, it hands each node the proof of its parent,
to which the node adds its sibling. The queue is external: Spark's shuffle sorts
the nodes into blocks of ``BLOCK`` consecutive ones, whose labels a task works
off with a heap; the blocks' digests are the nodes of the next tier. A tree of
10^10 leaves takes three tiers, and no task holds more than a block.

Two trees are stacked: rows of one group (ascending by id) give a subroot, the
subroots (by group, null first, bytewise) give the root. A node alone in its run
is hashed alone; a lone leaf is its group's subroot, a lone subroot the root.

Defined results: a null field counts as ``-``; rows with a null id come first in
their group; rows that repeat an id are ordered by their leaf, repeated rows are
leaves of their own; an empty text has length 0; a null group is a group; an
empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrisk.functions.prefix import running_sums
from stayrisk.session import ensure_checkpoint_dir, ship_package

BLOCK_BITS = 12
BLOCK = 1 << BLOCK_BITS


def leaf_digest(columns: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of the fields, each ``-`` or its UTF-8 length, a colon and the value."""
    fields = []
    for c in columns:
        text = c.cast("string")
        fields.append(F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*fields).cast("binary"), 256)


def digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# ------------------------------------------------------------------ one block
def levels_of(n: int) -> int:
    """Levels that a block adds in a tree (or tier) of ``n`` nodes."""
    return BLOCK_BITS if n > BLOCK else (n - 1).bit_length()


def upwards(digests: Sequence[str], levels: int) -> list[list[str]]:
    """Digests of every level of a block; the queue delivers them to the parents in order of their labels."""
    sizes = [-(-len(digests) // (1 << k)) for k in range(levels + 1)]
    nodes: list[list[str]] = [[] for _ in sizes]
    arrived: list[str] = []
    queue = [(0, i, d) for i, d in enumerate(digests)]  # sorted, so a heap
    while queue:
        level, i, d = heapq.heappop(queue)
        nodes[level].append(d)
        if level == levels:
            continue
        arrived.append(d)
        if i % 2 or i == sizes[level] - 1:
            heapq.heappush(queue, (level + 1, i // 2, digest(arrived)))
            arrived = []
    return nodes


def downwards(nodes: list[list[str]], above) -> list:
    """Proof of every lowest node: chain (side, sibling, rest), the rest of the top node being ``above``."""
    top = len(nodes) - 1
    proofs: list = [None] * len(nodes[0])
    queue = [(-top, 0, 0, above)]
    turn = 0  # keeps the queue from comparing chains
    while queue:
        level, i, _, rest = heapq.heappop(queue)
        level, i = -level, -i
        if level == 0:
            proofs[i] = rest
            continue
        below = nodes[level - 1]
        for child in (2 * i + 1, 2 * i):
            if child < len(below):
                other = child ^ 1
                step = ("s", "", rest) if other >= len(below) else ("l" if other < child else "r", below[other], rest)
                turn += 1
                heapq.heappush(queue, (1 - level, -child, turn, step))
    return proofs


def steps_of(chain) -> Iterator[tuple[str, str]]:
    while chain is not None:
        side, sibling, chain = chain
        yield side, sibling


def folded(leaf: str, steps: Sequence[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for side, sibling in steps:
        leaf = digest((sibling, leaf) if side == "l" else (leaf, sibling))
    return leaf


def _pack(steps: Sequence[tuple[str, str]]) -> str:
    return "".join(side + sibling for side, sibling in steps)


def _unpacked(text: str):
    """Chain of a packed proof: ``s``, or ``l`` / ``r`` and 64 digits, level by level."""
    steps, at = [], 0
    while at < len(text):
        size = 0 if text[at] == "s" else 64
        steps.append((text[at], text[at + 1:at + 1 + size]))
        at += 1 + size
    chain = None
    for side, sibling in reversed(steps):
        chain = (side, sibling, chain)
    return chain


# ------------------------------------------------------------------ tiers
NODE = "grp string, pos long, n long, digest string"


def _raise(table: pa.Table) -> pa.Table:
    table = table.sort_by("pos")
    grp, pos, n = table["grp"][0].as_py(), table["pos"][0].as_py(), table["n"][0].as_py()
    top = upwards(table["digest"].to_pylist(), levels_of(n))[-1][0]
    return pa.table({"grp": pa.array([grp], pa.string()), "pos": pa.array([pos >> BLOCK_BITS], pa.int64()),
                     "n": pa.array([-(-n // BLOCK)], pa.int64()), "digest": [top]})


def tiers(leaves: DataFrame) -> list[DataFrame]:
    """Checkpointed tables of nodes (grp, pos, n, digest) from the leaves up; the last has one node a group."""
    out = [leaves]
    while (most := out[-1].agg(F.max("n")).first()[0]) is not None and most > 1:
        blocks = out[-1].select("grp", "pos", "n", "digest").withColumn("block", F.shiftright("pos", BLOCK_BITS))
        out.append(blocks.groupBy("grp", "block").applyInArrow(_raise, NODE).checkpoint(eager=True))
    return out


PROVED = "grp string, pos long, proof string, subroot string, root string"


def _proofs(nodes: pa.Table, above: pa.Table) -> tuple[pa.Table, list]:
    """A block's rows in order and the chain of each."""
    nodes = nodes.sort_by("pos")
    levels = upwards(nodes["digest"].to_pylist(), levels_of(nodes["n"][0].as_py()))
    return nodes, downwards(levels, _unpacked(above["proof"][0].as_py()))


def _lower(nodes: pa.Table, above: pa.Table) -> pa.Table:
    nodes, chains = _proofs(nodes, above)
    k = len(chains)
    return pa.table({"grp": nodes["grp"].cast(pa.string()), "pos": nodes["pos"].cast(pa.int64()),
                     "proof": [_pack(list(steps_of(c))) for c in chains],
                     "subroot": pa.array([above["subroot"][0].as_py()] * k, pa.string()), "root": [above["root"][0].as_py()] * k})


def _deliver(lower: DataFrame, above: DataFrame, fn, schema: str) -> DataFrame:
    """The reversed sweep's step: every block of ``lower`` meets the proof of its node above."""
    blocks = lower.withColumn("block", F.shiftright("pos", BLOCK_BITS))
    heads = above.select("grp", F.col("pos").alias("block"), "proof", "subroot", "root")
    return blocks.groupBy("grp", "block").cogroup(heads.groupBy("grp", "block")).applyInArrow(fn, schema)


def proofs(levels: list[DataFrame], heads: DataFrame) -> DataFrame:
    """Proofs of the second-lowest tier's nodes (of the lowest if it is the only one), given those of the top nodes."""
    for lower in reversed(levels[1:-1]):
        heads = _deliver(lower, heads, _lower, PROVED).checkpoint(eager=True)
    return heads


def positioned(nodes: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds pos (from 0) and n (nodes of the group); a group may hold most rows."""
    out = running_sums(nodes.withColumn("one", F.lit(1)), order, ["one"], group_cols=["grp"], out_cols=["upto"], total_cols=["total"])
    return out.select(*nodes.columns, (F.col("upto") - 1).cast("long").alias("pos"), F.col("total").cast("long").alias("n"))


FINAL = ("id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, "
         "proof string")


def _verify(nodes: pa.Table, above: pa.Table) -> pa.Table:
    nodes, chains = _proofs(nodes, above)
    root, subroot = above["root"][0].as_py(), above["subroot"][0].as_py()
    steps = [list(steps_of(c)) for c in chains]
    back = [folded(t or d, s) for d, t, s in zip(nodes["digest"].to_pylist(), nodes["tampered"].to_pylist(), steps)]
    k = len(steps)
    return pa.table({"id": nodes["id"].cast(pa.int64()), "leaf": nodes["digest"].cast(pa.string()), "subroot": [subroot] * k, "root": [root] * k,
                     "proof_sha256": [digest([d for _, d in s]) for s in steps], "folded_root": back,
                     "verified": [b == root for b in back], "proof": [_pack(s) for s in steps]})


def manifest(rows: DataFrame, id_col: str, group_col: str, fields: Sequence[str], tampered: dict[str, Column] | None = None,
             where: Column | None = None) -> DataFrame:
    """Leaf, subroot, root and proof of every row, and whether the row, as it is now, still gives the root.

    ``tampered`` replaces fields of the rows that meet ``where`` before they are verified. ``proof`` lists the
    siblings level by level: ``l`` or ``r`` (their side) and the digest, ``s`` where there is none.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    leaf = leaf_digest([F.col(c) for c in fields])
    other = F.lit(None).cast("string")
    if tampered and where is not None:
        other = F.when(where, leaf_digest([tampered.get(c, F.col(c)) for c in fields]))
    leaves = rows.select(F.col(group_col).cast("string").alias("grp"), F.col(id_col).cast("long").alias("id"), leaf.alias("digest"),
                         other.alias("tampered")).checkpoint(eager=True)
    leaves = positioned(leaves, ["id", "digest"]).checkpoint(eager=True)
    levels = tiers(leaves)

    # the tree of subroots: its nodes are ordered by group, all in one group of their own
    subroots = levels[-1].select(F.lit(None).cast("string").alias("grp"), F.col("grp").alias("name"), "digest")
    subroots = positioned(subroots.withColumn("unnamed", F.col("name").isNotNull()), ["unnamed", "name"]).checkpoint(eager=True)
    upper = tiers(subroots)
    root = upper[-1].first()
    if root is None:  # no rows
        return spark.createDataFrame([], FINAL.replace("id long", f"`{id_col}` long"))
    top = upper[-1].select("grp", "pos", F.lit("").alias("proof"), F.lit(None).cast("string").alias("subroot"), F.lit(root["digest"]).alias("root"))
    heads = proofs(upper, top)
    if len(upper) > 1:
        heads = _deliver(subroots.select("grp", "pos", "n", "digest"), heads, _lower, PROVED)
    # a subroot's proof goes on to the top node of its group
    named = subroots.select("pos", F.col("name").alias("__name"), F.col("digest").alias("__sub"))
    heads = heads.join(named, "pos").select(F.col("__name").alias("grp"), F.lit(0).cast("long").alias("pos"), "proof",
                                            F.col("__sub").alias("subroot"), "root").checkpoint(eager=True)
    heads = proofs(levels, heads)
    out = _deliver(leaves, heads, _verify, FINAL)
    return out.withColumnRenamed("id", id_col)
