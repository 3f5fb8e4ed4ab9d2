"""Random forest with all trees grown level by level together (MOD3).

Every tree sees its own bootstrap: a row counts as often as a Poisson number
drawn from a hash of (row key, seed, tree), which does not depend on
partitioning. A node draws its own share of the columns. A level of all trees
(of all tasks, i.e. folds) is one job: tasks sum (class 0, class 1) weights by
(tree, node, drawn column, bin), the sums of a node meet in one reducer, which
finds its best Gini split; only the splits come back to the driver, and only the
splits go out again. Nodes of a level whose sums would exceed ``NODE_BYTES`` a
partition are taken in several jobs.

A table of at most ``boosting.ALONE_BYTES`` of bins is handed to the tasks whole and each
grows a share of the trees, with the same sums and the same splits: its levels
would be far shorter than a Spark job. Larger tables are never gathered.

A split needs ``min_leaf`` weighted rows on both sides (repeated rows count as
often as they were drawn, as in the reference) and must lower the impurity; the
probability is the mean over trees of the leaf's share of class 1. Missing
values fall into a bin of their own after all others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package
from .boosting import CHUNK_SCHEMA, _packed, _Shared, counted_cut_points, fits_alone, partitions_for, table_facts

#: Bytes of sums that a pass holds in a partition, and bits of a tree's or node's number in its draws.
NODE_BYTES = 128_000_000
TREES_A_TASK = 25
#: Rows whose drawn bins are summed at once.
BLOCK_ROWS = 4_096
#: Sums (of a node, drawn column and bin) that a tree grown by one task holds at once, at least those of one node.
GROUP_CELLS = 250_000
#: Rows from which a node of a tree grown by one task is summed by joint bins, and what a row of class 1 adds to a sum that holds both classes.
JOINT_ROWS, CLASS_1 = 2_048, 2.0**26


@dataclass(frozen=True)
class ForestParams:
    trees: int
    min_leaf: int
    column_share: float
    max_depth: int = 64
    bins: int = 255
    seed: int = 42


@dataclass
class ForestTrees:
    """Flat arrays over all nodes of all trees, 14 bytes a node: ``left`` is 0 in a leaf, the right child is the one after the left.

    ``value`` is a split's threshold (a row goes left if its value is at most that) or a leaf's share of class 1.
    """

    roots: np.ndarray
    feature: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        filled = np.where(np.isnan(x), np.inf, x)
        out, rows = np.zeros(len(x)), np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            open_ = rows[self.left[at] > 0]
            while len(open_):
                node = at[open_]
                at[open_] = self.left[node] + (filled[open_, self.feature[node]] > self.value[node])
                open_ = open_[self.left[at[open_]] > 0]
            out += self.value[at]
        return out / len(self.roots)

    def to_dict(self) -> dict:
        return {k: getattr(self, k).tolist() for k in _NODE}

    @staticmethod
    def from_dict(d: dict) -> ForestTrees:
        return ForestTrees(*[np.array(d[k], kind) for k, kind in _NODE.items()])


_NODE = {"roots": np.int64, "feature": np.uint16, "left": np.uint32, "value": np.float64}


# ------------------------------------------------------------------ draws
def _mix(z: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


#: Poisson(1) by inversion: a uniform number beyond the k-th entry means a weight above k.
_POISSON = np.cumsum(np.exp(-1.0) / np.array([1.0, *np.cumprod(np.arange(1.0, 15.0))]))


def weights(key: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """How often each row counts in a tree."""
    z = _mix(key.view(np.uint64) ^ np.uint64((seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 % 2**64))
    return np.searchsorted(_POISSON, (z >> np.uint64(11)) * 2.0**-53, side="right").astype(np.uint8)


def drawn_columns(seed: int, tree: int, nodes: np.ndarray, columns: int, take: int) -> np.ndarray:
    """(node, take) columns of each node, ascending: those with the smallest hashes. Nodes are numbered by path."""
    with np.errstate(over="ignore"):
        base = _mix(nodes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((seed * 7_368_787 + tree * 1_000_003) % 2**64))
        h = _mix(base[:, None] ^ (np.arange(1, columns + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))[None])
    return np.sort(np.argpartition(h, take - 1, axis=1)[:, :take], axis=1) if take < columns else np.tile(np.arange(columns), (len(nodes), 1))


def child(path: np.ndarray, side: int) -> np.ndarray:
    """A node's number: a hash of its parent's and its side, so that any depth fits 64 bits."""
    with np.errstate(over="ignore"):
        return _mix(path.astype(np.uint64) * np.uint64(2) + np.uint64(side + 1))


# ------------------------------------------------------------------ sums and splits of a level
def _by_node(w: np.ndarray, at: np.ndarray, nodes: int) -> np.ndarray:
    """Drawn rows of the level, node by node; ``at`` is each row's node of the level, -1: none."""
    rows = np.flatnonzero((at >= 0) & (w > 0))
    return rows[np.argsort(at[rows].astype(np.int16) if nodes < 2**15 else at[rows], kind="stable")]


def _node_sums(bins: np.ndarray, y: np.ndarray, w: np.ndarray, at: np.ndarray, columns: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(bin of a drawn column of a node, class) weights, node by node; ``bins`` is row-major, ``at`` is each row's node of the level, -1: none."""
    rows = _by_node(w, at, len(columns))
    return _sums_of(bins, y, w, rows, at[rows], columns, sizes)


def _sums_of(bins: np.ndarray, y: np.ndarray, w: np.ndarray, rows: np.ndarray, at: np.ndarray, columns: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """:func:`_node_sums` of rows that lie node by node, so that the sums of a block of rows lie together; ``at`` are their nodes."""
    wide = sizes[columns]
    start = (np.cumsum(wide) - wide.ravel()).reshape(wide.shape)
    out = np.zeros((2, int(wide.sum())))
    flat, width = bins.ravel(), bins.shape[1]
    label = y[rows]
    for k in (0, 1):
        mine = np.flatnonzero(label == k)
        for s in range(0, len(mine), BLOCK_ROWS):
            block = mine[s:s + BLOCK_ROWS]
            r, own = rows[block], at[block]
            low, high = int(start[own[0], 0]), int(start[own[-1], -1] + wide[own[-1], -1])
            cell = columns[own]
            cell += (r * width)[:, None]
            slot = (start[own[0]:own[-1] + 1] - low)[own - own[0]]
            slot += flat.take(cell)
            out[k, low:high] += np.bincount(slot.ravel(), np.repeat(w[r].astype(float), slot.shape[1]), high - low)
    return out.T


def best_splits(sums: np.ndarray, wide: np.ndarray, min_leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per node: column (place among the drawn, -1: none), bin, (left, right) class weights. ``wide``: (node, column) bins."""
    nodes, take = wide.shape
    flat, per = wide.ravel(), wide.sum(1)
    end = np.cumsum(flat)
    start = end - flat
    # weights are whole numbers: sums and differences are exact; the classes are kept apart
    left, right, total = [], [], []
    for k in (0, 1):
        run = np.cumsum(sums[:, k])
        run -= np.repeat(np.concatenate([[0.0], run])[start], flat)
        total.append(run[end[::take] - 1])
        left.append(run)
        right.append(np.repeat(total[k], per) - run)
    nl, nr, n = (a + b for a, b in (left, right, total))
    with np.errstate(divide="ignore", invalid="ignore"):
        # what the split adds to the sum of squared class weights over the side's weight: falling Gini impurity
        squares = [a * a + b * b for a, b in (left, right, total)]
        gain = squares[0] / nl + squares[1] / nr - np.repeat(squares[2] / n, per)
        gain = np.where((nl >= min_leaf) & (nr >= min_leaf), gain, -np.inf)
    first = start[::take]
    top = np.maximum.reduceat(gain, first)
    hits = np.flatnonzero(gain == np.repeat(top, per))
    best = hits[np.searchsorted(hits, first)]
    place = np.searchsorted(start, best, side="right") - 1
    return (np.where(top > 1e-9 * n, place - np.arange(nodes) * take, -1), best - start[place],
            *(np.stack([side[0][best], side[1][best]], axis=1) for side in (left, right)))


def _joint_sums(shared: _Shared, codes: np.ndarray, both: np.ndarray, rows: np.ndarray, columns: np.ndarray, wide: np.ndarray) -> np.ndarray:
    """:func:`_node_sums` of one node's ``rows``: every group of columns is summed once, both classes in one number (whole, below 2^53)."""
    weight, of = both[rows], {}
    out, begin = np.empty(int(wide.sum())), np.cumsum(wide) - wide
    for c, first in zip(columns.tolist(), begin.tolist()):
        i, after, size = shared.place[c]
        if i not in of:
            of[i] = np.bincount(codes[i].take(rows), weight, math.prod(shared.groups[i][1]))
        out[first:first + size] = of[i].reshape(-1, size, after).sum(axis=(0, 2))
    ones = np.floor(out / CLASS_1)
    return np.stack([out - ones * (CLASS_1 + 1), ones], axis=1)


def _level_splits(bins: np.ndarray, y: np.ndarray, w: np.ndarray, at: np.ndarray, columns: np.ndarray, sizes: np.ndarray, min_leaf: int,
                  shared: _Shared, codes: np.ndarray, both: np.ndarray) -> tuple:
    """Best splits of a level's nodes: large ones by joint bins one at a time, the others a few at a time, so that their sums stay
    in a core's cache and small at any number of nodes."""
    rows = _by_node(w, at, len(columns))
    own, wide = at[rows], sizes[columns]
    edges = np.searchsorted(own, np.arange(len(columns) + 1))
    large = np.diff(edges) >= JOINT_ROWS
    nodes, found = [], []
    for v in np.flatnonzero(large):
        sums = _joint_sums(shared, codes, both, rows[edges[v]:edges[v + 1]], columns[v], wide[v])
        nodes.append([v])
        found.append(best_splits(sums, wide[v:v + 1], min_leaf))
    rest = np.flatnonzero(~large)
    if len(rest):
        if len(nodes):
            mine = ~large[own]
            rows, own = rows[mine], (np.cumsum(~large) - 1)[own[mine]]
        columns, wide = columns[rest], wide[rest]
        group = np.cumsum(wide.sum(1)) // GROUP_CELLS
        edges = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1, [len(columns)]])
        for a, b in zip(edges[:-1], edges[1:]):
            i, j = np.searchsorted(own, (a, b))
            nodes.append(rest[a:b])
            found.append(best_splits(_sums_of(bins, y, w, rows[i:j], own[i:j] - a, columns[a:b], sizes), wide[a:b], min_leaf))
    order = np.argsort(np.concatenate(nodes))
    return tuple(np.concatenate(v)[order] for v in zip(*found))


class _Tree:
    """One growing tree: the driver's, or a task's."""

    def __init__(self, index: int, counts: np.ndarray | None):
        self.index = index
        self.feature, self.cut, self.left, self.right, self.counts = [0], [0], [0], [0], [counts]
        self.paths = {0: np.uint64(1)}
        self.frontier = [0]

    def split(self, nodes: list[int], columns: np.ndarray, place: np.ndarray, cut: np.ndarray, lw: np.ndarray, rw: np.ndarray,
              min_leaf: int, deeper: bool) -> None:
        for i, node in enumerate(nodes):
            if self.counts[node] is None:
                self.counts[node] = lw[i] + rw[i]
        hit = np.flatnonzero(place >= 0)
        if len(hit):
            paths = np.array([self.paths[nodes[i]] for i in hit], np.uint64)
            sides = [(child(paths, k), w[hit], (w[hit].sum(1) >= 2 * min_leaf) & (w[hit].min(1) > 0)) for k, w in ((0, lw), (1, rw))]
            for j, (i, f, c) in enumerate(zip(hit, columns[hit, place[hit]].tolist(), cut[hit].tolist())):
                node, lo = nodes[i], len(self.left)
                self.feature[node], self.cut[node], self.left[node], self.right[node] = f, c, lo, lo + 1
                for side, (path, w, grows) in enumerate(sides):
                    self.feature.append(0), self.cut.append(0), self.left.append(0), self.right.append(0), self.counts.append(w[j])
                    self.paths[lo + side] = path[j]
                    if deeper and grows[j]:
                        self.frontier.append(lo + side)
        for node in nodes:
            self.paths.pop(node)

    def take(self) -> list[int]:
        out, self.frontier = self.frontier, []
        return out


def _moved(bins: np.ndarray, at: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Rows walk on from their nodes to where the tree ends now; ``bins`` is row-major."""
    at = at.copy()
    rows = np.flatnonzero(left[at] > 0)
    while len(rows):
        node = at[rows]
        at[rows] = np.where(bins[rows, feature[node]] <= cut[node], left[node], right[node])
        rows = rows[left[at[rows]] > 0]
    return at


def _grown(bins: np.ndarray, y: np.ndarray, key: np.ndarray, index: int, p: ForestParams, sizes: np.ndarray,
           shared: _Shared | None = None, codes: np.ndarray | None = None) -> _Tree:
    """A whole tree on rows that are all here; ``bins`` is row-major, ``codes`` are its joint bins where trees share them."""
    if codes is None:
        shared = _Shared((sizes - 2).tolist())
        codes = shared.joint(bins.T)
    w = weights(key, p.seed, index)
    columns_all = bins.shape[1]
    take = max(1, int(columns_all * p.column_share))
    total = np.bincount(y, w, 2)
    tree = _Tree(index, total)
    if total.sum() < 2 * p.min_leaf or total.min() == 0:
        return tree
    drawn = np.flatnonzero(w)
    bins, y, w, codes = bins[drawn], y[drawn], w[drawn], np.take(codes, drawn, axis=1)
    both = w * (1.0 + y * CLASS_1)
    at = np.zeros(len(y), np.int64)
    for depth in range(p.max_depth):
        nodes = tree.take()
        if not nodes:
            break
        columns = drawn_columns(p.seed, index, np.array([tree.paths[k] for k in nodes], np.uint64), columns_all, take)
        level = np.full(len(tree.left), -1)
        level[nodes] = np.arange(len(nodes))
        tree.split(nodes, columns, *_level_splits(bins, y, w, level[at], columns, sizes, p.min_leaf, shared, codes, both), p.min_leaf, depth + 1 < p.max_depth)
        at = _moved(bins, at, *(np.array(v) for v in (tree.feature, tree.cut, tree.left, tree.right)))
    return tree


def _bounds(chunk, columns: int):
    """Row-major bins, labels and keys of a chunk."""
    return (np.ascontiguousarray(np.frombuffer(chunk[2], np.uint8).reshape(columns, chunk[1]).T), np.frombuffer(chunk[3], np.uint8).astype(np.int64),
            np.frombuffer(chunk[4], np.int64))


def _packed_tree(t: _Tree) -> tuple[bytes, ...]:
    """(feature, bin, left child, share of class 1) of every node, 15 bytes a node."""
    counts = np.array([c if c is not None else (1.0, 0.0) for c in t.counts])
    total = counts.sum(1)
    share = np.where(total > 0, counts[:, 1] / np.maximum(total, 1e-300), 0.0)
    return np.array(t.feature, np.uint16).tobytes(), np.array(t.cut, np.uint8).tobytes(), np.array(t.left, np.uint32).tobytes(), share.tobytes()


def _alone(sizes: dict[int, np.ndarray], p: ForestParams):
    """Partition function over ((task, first tree), chunk): grows the trees of a share."""
    def run(pairs) -> Iterator[tuple[int, int, tuple]]:
        held: dict[tuple[int, int], list] = {}
        for share, chunk in pairs:
            held.setdefault(share, []).append(_bounds(chunk, len(sizes[chunk[0]])))
        for (task, first), parts in held.items():
            bins, y, key = (np.concatenate(v) for v in zip(*parts))
            shared = _Shared((sizes[task] - 2).tolist())
            codes = shared.joint(bins.T)
            for index in range(first, min(first + TREES_A_TASK, p.trees)):
                yield task, index, _packed_tree(_grown(bins, y, key, index, p, sizes[task], shared, codes))
    return run


# ------------------------------------------------------------------ levels over partitions
def _level_sums(asked: dict[int, list[tuple]], sizes: dict[int, np.ndarray], p: ForestParams):
    """Partition function: ((task, tree, node), (sums, bins of its columns)), summed over the partition's chunks."""
    def run(chunks) -> Iterator[tuple[tuple[int, int, int], tuple]]:
        held: dict[tuple[int, int], tuple] = {}
        for chunk in chunks:
            task = chunk[0]
            bins, y, key = _bounds(chunk, len(sizes[task]))
            for k, (index, arrays, nodes, columns) in enumerate(asked.get(task, ())):
                at = _moved(bins, np.zeros(chunk[1], np.int64), *arrays)
                level = np.full(len(arrays[2]), -1)
                level[nodes] = np.arange(len(nodes))
                got = _node_sums(bins, y, weights(key, p.seed, index), level[at], columns, sizes[task])
                held[task, k] = (held[task, k][0] + got if (task, k) in held else got, index, nodes, sizes[task][columns])
        for (task, _), (got, index, nodes, wide) in held.items():
            for node, own, sums in zip(nodes, wide, np.split(got, np.cumsum(wide.sum(1))[:-1])):
                if sums.any():
                    yield (task, index, node), (sums, own)
    return run


def train(rows: DataFrame, p: ForestParams, alone_rows: int | None = None) -> dict[int, ForestTrees]:
    """A forest per task of ``rows`` (task int, key long, y double, x array<double>; null or NaN: missing)."""
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    rows = rows.select(F.col("task").cast("int"), F.col("key").cast("long"), F.col("y").cast("double"), "x")  # nulls are NaN once packed
    facts, counted = table_facts(rows)
    if not facts:
        return {}
    widths = {t: r["width"] for t, r in facts.items()}
    cuts = counted_cut_points(counted, widths, p.bins)
    sizes = {t: np.array([len(c) + 2 for c in cs]) for t, cs in cuts.items()}
    parts = partitions_for(sum(r["n"] for r in facts.values()), spark.sparkContext.defaultParallelism)
    packed = (rows.repartition(parts, "key").sortWithinPartitions("task", "key")
              .mapInArrow(_packed(cuts, {t: [0.0] for t in facts}), CHUNK_SCHEMA).checkpoint(eager=True))
    trees: dict[int, dict[int, tuple]] = {t: {} for t in facts}
    small = sorted(t for t, r in facts.items() if fits_alone(r["n"], r["width"], alone_rows))
    if small:
        # largest tables first, so the last tasks to end are short ones
        shares = [(t, first) for t in sorted(small, key=lambda t: -facts[t]["n"]) for first in range(0, p.trees, TREES_A_TASK)]
        place = {s: i for i, s in enumerate(shares)}
        dealt = packed.where(F.col("task").isin(small)).rdd.map(tuple).flatMap(
            lambda c: [((c[0], first), c) for first in range(0, p.trees, TREES_A_TASK)]).partitionBy(len(shares), lambda s: place[s])
        for task, index, t in dealt.mapPartitions(_alone(sizes, p)).collect():
            trees[task][index] = t
    large = sorted(set(facts) - set(small))
    if large:
        chunks = packed.where(F.col("task").isin(large)).rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)
        for task, grown in _by_levels(chunks, large, sizes, p, parts).items():
            trees[task] = {t.index: _packed_tree(t) for t in grown}
        chunks.unpersist()
    return {t: _flat([trees[t].pop(i) for i in range(p.trees)], cuts[t]) for t in facts}


def _by_levels(chunks, tasks: list[int], sizes: dict[int, np.ndarray], p: ForestParams, parts: int) -> dict[int, list[_Tree]]:
    trees = {t: [_Tree(i, None) for i in range(p.trees)] for t in tasks}
    for depth in range(p.max_depth):
        asked: dict[int, list] = {}
        held = 0
        for task, tree, nodes in [(t, tree, tree.take()) for t in tasks for tree in trees[t]]:
            take = max(1, int(len(sizes[task]) * p.column_share))
            step = max(1, NODE_BYTES // (take * int(sizes[task].max()) * 16))
            for s in range(0, len(nodes), step):
                some = nodes[s:s + step]
                columns = drawn_columns(p.seed, tree.index, np.array([tree.paths[v] for v in some], np.uint64), len(sizes[task]), take)
                asked.setdefault(task, []).append((tree, some, columns))
                held += int(sizes[task][columns].sum()) * 16
                if held >= NODE_BYTES:
                    _split_nodes(chunks, asked, sizes, p, parts, depth)
                    asked, held = {}, 0
        if asked:
            _split_nodes(chunks, asked, sizes, p, parts, depth)
        if not any(tree.frontier for own in trees.values() for tree in own):
            break
    return trees


def _split_nodes(chunks, asked: dict[int, list], sizes: dict[int, np.ndarray], p: ForestParams, parts: int, depth: int) -> None:
    """One job: sums by node over the partitions, best splits in the reducers, splits to the driver."""
    order = {t: [(tree.index, tuple(np.array(v) for v in (tree.feature, tree.cut, tree.left, tree.right)), nodes, columns)
                 for tree, nodes, columns in entries] for t, entries in asked.items()}
    min_leaf = p.min_leaf

    def best(entry):
        node, (sums, wide) = entry
        place, cut, lw, rw = best_splits(sums, wide[None], min_leaf)
        return node, (int(place[0]), int(cut[0]), lw[0], rw[0])

    sums = chunks.mapPartitions(_level_sums(order, sizes, p)).reduceByKey(lambda a, b: (a[0] + b[0], a[1]), parts)
    found = dict(sums.map(best).collect())
    nothing = (-1, 0, np.zeros(2), np.zeros(2))  # a tree whose bootstrap is empty
    for task, entries in asked.items():
        for tree, nodes, columns in entries:
            got = [found.get((task, tree.index, node), nothing) for node in nodes]
            tree.split(nodes, columns, *(np.array(v) for v in zip(*got)), p.min_leaf, depth + 1 < p.max_depth)


def _flat(trees: list[tuple[bytes, ...]], cuts: list[np.ndarray]) -> ForestTrees:
    """All nodes in one set of arrays; node 0 is unused, so that ``left`` 0 means a leaf."""
    begin = np.concatenate([[1], 1 + np.cumsum([len(t[1]) for t in trees])])  # a byte a node
    total = int(begin[-1])
    if total > np.iinfo(_NODE["left"]).max:
        raise ValueError(f"a forest of {total} nodes")
    out = ForestTrees(begin[:-1], *[np.zeros(total, _NODE[k]) for k in ("feature", "left", "value")])
    # after the last threshold lie the missing values alone
    thresholds = np.concatenate([np.append(c, np.finfo(float).max) for c in cuts])
    first = np.cumsum([0, *(len(c) + 1 for c in cuts)])
    for i, root in enumerate(begin[:-1].tolist()):
        f, b, lo, share = (np.frombuffer(v, kind) for v, kind in zip(trees[i], (np.uint16, np.uint8, np.uint32, np.float64)))
        own, split = slice(root, root + len(f)), lo > 0
        out.feature[own] = f
        out.left[own] = np.where(split, lo + np.uint32(root), 0)
        out.value[own] = np.where(split, thresholds[np.minimum(first[f] + b, first[f + 1] - 1)], share)
        trees[i] = ()
    return out
