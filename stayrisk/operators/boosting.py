"""Second-order histogram boosting with best-first trees (MOD4, MOD5), many models in shared passes.

A *model* is one family on one training table (a *task*: a temporal fold, a
random fold, the whole history). All models of a run are trained together: a
pass over the rows serves, for every model, whatever histograms it needs next,
so the number of Spark jobs is that of the longest model, not the sum.

* Rows are binned once (at most 255 bins a numeric column, one more for missing
  values) and kept as persisted chunks of bytes; a chunk belongs to one task.
* A pass sums gradients, hessians and counts by (node, feature, bin) inside each
  partition (narrow columns share a byte and so one sum) and adds the partitions up; only these sums, of fixed size, reach the
  driver. The larger of two siblings is its parent less the smaller one.
* A tree grows by its best leaf until ``max_leaves``. Children of the leaves that
  may be split next are summed ahead in the same pass, which changes no split.
* A table of at most ``ALONE_BYTES`` of bins (rows x columns) is grown by one task instead, with the
  same sums and the same growth, all models side by side: its passes would be far shorter than a Spark job.
  Larger tables are never gathered.
* The chunks of the passes hold joint bins: columns share a number a row, made once, and a pass sums by these numbers.
* A pass is a function of the chunks and of the trees sent with it: no state
  lives in workers, a lost executor is recomputed. Every ``RESCORE`` rounds the
  scores are brought up to date and the trees before that no longer sent, every
  ``REFRESH`` rounds the chunks are also written to the checkpoint folder.

Gain of a split: ``GL^2/(HL+l2) + GR^2/(HR+l2) - G^2/(H+l2)``; leaf value:
``-learning_rate * G/(H+l2)``; start: log odds of the labels. Missing values go
to the side with the larger gain. Rows and columns of a tree are drawn by hashes
of (row key, seed, round) and (seed, round): neither depends on partitioning.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.counts import value_counts
from ..functions.prefix import running_sums
from ..session import ensure_checkpoint_dir, ship_package

#: Rounds after which scores are refreshed, and those after which the refreshed chunks are also checkpointed.
RESCORE, REFRESH = 2, 25
#: Rows of a chunk, and rows that a partition has at least / at most before more partitions are made.
CHUNK_ROWS, LEAST_ROWS, MOST_ROWS = 65_536, 8_192, 2_000_000
#: Joint bins that columns may share in the chunks of the passes and in a table held whole of ``CHUNK_ROWS`` rows or more (256 in a smaller one).
JOINT_CELLS = 4_096
#: Tables with bins (a byte a row and column) up to this size, half a usual Spark partition, are grown by a task a model.
ALONE_BYTES = 64 * 2**20
#: Partitions whose sums are added on the driver directly; beyond, they are added by a tree of tasks first.
FLAT_PARTITIONS = 32
_SCORES_EPS = 1e-15
#: Gains that differ by less than this share are equal.
_TIE = 1e-9


@dataclass(frozen=True)
class BoostParams:
    rounds: int
    learning_rate: float
    max_leaves: int
    min_leaf: int
    l2: float
    row_share: float = 1.0
    column_share: float = 1.0
    min_hessian: float = 1e-3
    bins: int = 255
    seed: int = 42


@dataclass
class Tree:
    """Splits in the order they were made; children have larger numbers than their parents, 0 is the root."""

    node: list[int] = field(default_factory=list)
    feature: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)  # bin number while training, threshold afterwards
    missing_left: list[bool] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: dict[int, float] = field(default_factory=dict)

    def values(self) -> np.ndarray:
        out = np.zeros(max(self.value) + 1)
        out[list(self.value)] = list(self.value.values())
        return out


@dataclass
class BoostedTrees:
    """A fitted model: ``log odds = start + sum of leaf values``; plain data, see ``to_dict``."""

    start: float
    trees: list[Tree]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        missing = np.isnan(x)
        some = bool(missing.any())
        columns = np.ascontiguousarray(x.T)
        for t in self.trees:
            where = np.zeros(len(x), np.int32)
            for p, f, cut, ml, lo, hi in zip(t.node, t.feature, t.cut, t.missing_left, t.left, t.right):
                goes = columns[f] <= cut
                if some and ml:
                    goes |= missing[:, f]
                here = where == p
                where[here & goes] = lo
                where[here & ~goes] = hi
            out += t.values()[where]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.log_odds(x)))

    def to_dict(self) -> dict:
        return {"start": self.start, "trees": [asdict(t) | {"value": sorted(t.value.items())} for t in self.trees]}

    @staticmethod
    def from_dict(d: dict) -> BoostedTrees:
        return BoostedTrees(d["start"], [Tree(**(t | {"value": {int(k): v for k, v in t["value"]}})) for t in d["trees"]])


# ------------------------------------------------------------------ bins
def cut_points(rows: DataFrame, n_features: dict[int, int], bins: int) -> dict[int, list[np.ndarray]]:
    """Per task and feature the ascending thresholds of its bins (a value goes left of a threshold it does not exceed)."""
    return counted_cut_points(value_counts(rows).checkpoint(eager=True), n_features, bins)


def counted_cut_points(counted: DataFrame, n_features: dict[int, int], bins: int) -> dict[int, list[np.ndarray]]:
    """:func:`cut_points` of distinct values that are counted already: (task, f, v, c).

    Up to ``bins`` distinct values: the midpoints between them; beyond, the values at which the count passes a
    multiple of 1/``bins``. Distinct values are counted and ranked in Spark; at most ``bins`` a column come back.
    """
    counts = counted.where(F.col("v").isNotNull() & ~F.isnan("v"))
    sizes = counts.groupBy("task", "f").agg(F.count(F.lit(1)).alias("n_values"), F.sum("c").alias("n"))
    ranked = running_sums(counts, ["v"], ["c"], group_cols=["task", "f"], out_cols=["cum"])
    passes = F.floor(F.col("cum") * bins / F.col("n")) > F.floor((F.col("cum") - F.col("c")) * bins / F.col("n"))
    kept = ranked.join(F.broadcast(sizes), ["task", "f"]).where(  # a row a column
        (F.col("n_values") <= bins) | passes).select("task", "f", "v", "n_values")
    found: dict[tuple[int, int], list] = {}
    few: dict[tuple[int, int], bool] = {}
    for r in kept.collect():
        found.setdefault((r["task"], r["f"]), []).append(r["v"])
        few[r["task"], r["f"]] = r["n_values"] <= bins
    out = {}
    for task, n in n_features.items():
        cuts = []
        for f in range(n):
            v = np.sort(np.array(found.get((task, f), []), float))
            cuts.append((v[:-1] + v[1:]) / 2 if few.get((task, f), True) else v[:-1])
        out[task] = cuts
    return out


def table_facts(rows: DataFrame) -> tuple[dict, DataFrame]:
    """Per task its rows, label rate, columns and whether values are missing; and the counted values (task, f, v, c).

    The label is counted with the columns, so all of it takes one pass over the rows.
    """
    both = value_counts(rows.select("task", F.concat(F.array("y"), "x").alias("x"))).checkpoint(eager=True)
    label, known = F.col("f") == 0, F.col("v").isNotNull()
    facts = {r["task"]: r for r in both.groupBy("task").agg(
        F.sum(F.when(label, F.col("c"))).cast("long").alias("n"),
        (F.sum(F.when(label & known, F.col("c") * F.col("v"))) / F.sum(F.when(label & known, F.col("c")))).alias("rate"),
        F.max("f").alias("width"), F.max(~label & (~known | F.isnan("v"))).alias("missing")).collect()}
    return facts, both.where(~label).select("task", (F.col("f") - 1).alias("f"), "v", "c")


def _bin_rows(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """uint8 bins, feature-major; a missing value gets the number after the last bin."""
    out = np.empty(x.shape[::-1], np.uint8)
    for f, c in enumerate(cuts):
        b = np.searchsorted(c, x[:, f], side="left")
        b[np.isnan(x[:, f])] = len(c) + 1
        out[f] = b
    return out


def _packed(cuts: dict[int, list[np.ndarray]], starts: dict[int, list[float]]):
    """mapInArrow function: (task, key, y, x) rows sorted by task -> chunks."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def chunk(task, key, y, bins):
            base = np.repeat(np.array(starts[task])[:, None], len(y), axis=1)
            return pa.RecordBatch.from_pydict({
                "task": pa.array([task], pa.int32()), "n": pa.array([len(y)], pa.int32()), "bins": [bins.tobytes()],
                "y": [y.astype(np.uint8).tobytes()], "key": [key.tobytes()], "base": [base.tobytes()]})

        held: dict[int, list] = {}
        for rb in batches:
            tasks = rb.column(0).to_numpy()
            key, y = rb.column(1).to_numpy(), rb.column(2).to_numpy()
            for task in np.unique(tasks):
                at = np.flatnonzero(tasks == task)
                x = rb.column(3).take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), len(cuts[task]))
                held.setdefault(int(task), []).append((key[at], y[at], _bin_rows(x.astype(float), cuts[task])))
                if sum(len(k) for k, _, _ in held[task]) >= CHUNK_ROWS:
                    yield chunk(int(task), *(np.concatenate(p, axis=-1) for p in zip(*held.pop(int(task)))))
        for task in sorted(held):
            yield chunk(task, *(np.concatenate(p, axis=-1) for p in zip(*held[task])))
    return pack


CHUNK_SCHEMA = "task int, n int, bins binary, y binary, key binary, base binary"


# ------------------------------------------------------------------ inside tasks
def _node_of(bins: dict[int, np.ndarray], splits: list, n_cuts: list[int], rows: int) -> np.ndarray:
    """The leaf of every row; ``bins`` is by feature. Right children have numbers one above their left siblings."""
    top = max((s[5] for s in splits), default=0)
    kind = np.uint8 if top < 256 else np.int32
    where = np.zeros(rows, kind)
    for p, f, b, ml, lo, hi in splits:
        right = bins[f] > b
        if ml:
            right &= bins[f] <= n_cuts[f]
        here = where == p
        where += here * kind(lo - p)
        where += (here & right) * kind(hi - lo)
    return where


def _joint(tops: np.ndarray, most: int = 256) -> list[list[int]]:
    """Columns (places in ``tops``, their highest bins) that share one sum: the product of their bins is at most ``most``.

    The widest columns come first; each takes the narrower ones, as one-hot slots are, that still fit beside it.
    """
    groups: list[list[int]] = []
    cells: list[int] = []
    for c in np.argsort(-tops.astype(int), kind="stable"):
        wide = int(tops[c]) + 1
        at = next((i for i, n in enumerate(cells) if n * wide <= most), None)
        if at is None:
            groups.append([int(c)])
            cells.append(wide)
        else:
            groups[at].append(int(c))
            cells[at] *= wide
    return groups


def _codes(drawn: np.ndarray) -> list[tuple[list[int], list[int], np.ndarray]]:
    """(columns, their bins, joint bin of every row) of each group of columns that share one sum."""
    tops = drawn.max(axis=1)
    out = []
    for group in _joint(tops, JOINT_CELLS if drawn.shape[1] >= CHUNK_ROWS else 256):
        sizes = [int(tops[c]) + 1 for c in group]
        kind = np.uint8 if np.prod(sizes) <= 256 else np.uint16
        code = drawn[group[0]].astype(kind)
        for c, size in zip(group[1:], sizes[1:]):
            code = code * kind(size) + drawn[c] if size < 256 else drawn[c]  # 256 bins beside columns of one
        out.append((group, sizes, code))
    return out


def _add_sums(got: np.ndarray, drawn: np.ndarray, begin: np.ndarray, rows: np.ndarray | None, slot: np.ndarray | None, g: np.ndarray, h: np.ndarray) -> None:
    _add_coded(got, _codes(drawn), begin, rows, slot, g, h)


def _add_coded(got: np.ndarray, codes: list, begin: np.ndarray, rows: np.ndarray | None, slot: np.ndarray | None, g: np.ndarray, h: np.ndarray) -> None:
    """Add gradients, hessians and counts of ``rows`` by (node, bin of each column) to ``got``.

    Columns of a group are summed by their joint bin, which is then summed over the others: every row is counted once a group.
    """
    wanted = len(got)
    if rows is not None:
        g, h = g[rows], h[rows]
    for group, sizes, code in codes:
        cells = int(np.prod(sizes))
        if rows is not None:
            code = code[rows]
        code = code.astype(np.intp) if slot is None else code + slot * cells
        n = wanted * cells
        sums = np.stack([np.bincount(code, g, n), np.bincount(code, h, n), np.bincount(code, minlength=n)]).reshape(3, wanted, cells).swapaxes(0, 1)
        after = cells
        for c, size in zip(group, sizes):
            after //= size
            own = sums if len(group) == 1 else sums.reshape(wanted, 3, -1, size, after).sum(axis=(2, 4))
            got[:, :, begin[c]:begin[c] + size] += own


def _drawn(key: np.ndarray, seed: int, turn: int, share: float) -> np.ndarray:
    """Rows in the bag of a round: a 64-bit mix of (key, seed, round) below the share."""
    z = key.view(np.uint64) ^ np.uint64((seed * 1_000_003 + turn) * 0x9E3779B97F4A7C15 % 2**64)
    with np.errstate(over="ignore"):
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    return z < np.uint64(min(share, 1.0 - 2**-53) * 2**64)


@dataclass
class _Request:
    """What one model asks of a pass."""

    slot: int
    since: list  # (splits, leaf values) of the trees the chunks' scores lack
    splits: list  # of the tree that grows
    wanted: list[int]  # nodes to sum
    columns: np.ndarray
    draw: tuple | None


class _Shared:
    """Columns of a task that share one number a row in the passes' chunks: joint bins, made once instead of in every pass."""

    def __init__(self, n_cuts: list[int], missing: bool = True):
        sizes = np.array(n_cuts) + 1 + missing
        self.n_cuts, self.groups, self.place = n_cuts, [], {}
        for i, group in enumerate(_joint(sizes - 1, JOINT_CELLS)):
            own = [int(sizes[c]) for c in group]
            self.groups.append((group, own))
            after = math.prod(own)
            for c, size in zip(group, own):
                after //= size
                self.place[c] = (i, after, size)

    def joint(self, bins: np.ndarray) -> np.ndarray:
        """(group, row) joint bins of feature-major ``bins``."""
        out = np.empty((len(self.groups), bins.shape[1]), np.uint16)
        for code, (group, sizes) in zip(out, self.groups):
            code[:] = bins[group[0]]
            for c, size in zip(group[1:], sizes[1:]):
                code *= np.uint16(size)
                code += bins[c]
        return out

    def coded(self, chunk: tuple) -> tuple:
        """The chunk with joint bins, group by group, instead of one bin a column."""
        bins = np.frombuffer(chunk[2], np.uint8).reshape(len(self.n_cuts), chunk[1])
        return (*chunk[:2], self.joint(bins).tobytes(), *chunk[3:])

    def codes(self, chunk: tuple) -> np.ndarray:
        return np.frombuffer(chunk[2], np.uint16).reshape(len(self.groups), chunk[1])

    def column(self, codes: np.ndarray, c: int) -> np.ndarray:
        i, after, size = self.place[c]
        own = codes[i] if after == 1 else codes[i] // np.uint16(after)
        return own if size * after == math.prod(self.groups[i][1]) else own % np.uint16(size)

    def node_of(self, codes: np.ndarray, splits: list) -> np.ndarray:
        """:func:`_node_of` of joint bins; only the columns that split are taken apart."""
        columns = {s[1]: self.column(codes, s[1]) for s in splits}
        return _node_of(columns, splits, self.n_cuts, codes.shape[1])

    def scores(self, chunk: tuple, codes: np.ndarray, slot: int, since: list) -> np.ndarray:
        raw = np.frombuffer(chunk[5]).reshape(-1, chunk[1])[slot]
        for splits, values in since:
            raw = raw + values[self.node_of(codes, splits)]
        return raw


def _sums(requests: dict[int, list[tuple[int, _Request]]], n_cuts: dict[int, list[int]], shared: dict[int, _Shared] | None = None):
    """Partition function: {model: array (wanted node, [gradient, hessian, count], bin of drawn columns)}.

    Chunks hold the joint bins of ``shared``, or a bin a column without it. Sums are kept by joint bin over the partition's
    chunks and then taken apart by column.
    """
    def run(chunks) -> Iterator[dict[int, np.ndarray]]:
        held: dict[int, tuple[int, _Request, dict[int, np.ndarray]]] = {}
        plain = {t: _Shared(cuts) for t, cuts in n_cuts.items()} if shared is None else shared
        for chunk in chunks:
            own = plain[chunk[0]]
            codes = own.codes(chunk if shared is not None else own.coded(chunk))
            for model, q in requests.get(chunk[0], ()):
                rows, slot = _asked_rows(own, chunk, codes, q)
                raw, y = own.scores(chunk, codes, q.slot, q.since), np.frombuffer(chunk[3], np.uint8)
                if rows is not None:
                    raw, y = raw[rows], y[rows]
                p = 1.0 / (1.0 + np.exp(-raw))
                g, h = p - y, np.maximum(p * (1.0 - p), _SCORES_EPS)
                if model not in held:
                    used = sorted({own.place[c][0] for c in q.columns})
                    held[model] = chunk[0], q, {i: np.zeros((3, len(q.wanted) * math.prod(own.groups[i][1]))) for i in used}
                for i, sums in held[model][2].items():
                    code = codes[i] if rows is None else codes[i].take(rows)
                    code = code.astype(np.intp)
                    if slot is not None:
                        code += slot * (sums.shape[1] // len(q.wanted))
                    sums[0] += np.bincount(code, g, sums.shape[1])
                    sums[1] += np.bincount(code, h, sums.shape[1])
                    sums[2] += np.bincount(code, minlength=sums.shape[1])
        yield {model: _by_column(plain[task], q, sums) for model, (task, q, sums) in held.items()}
    return run


def _asked_rows(own: _Shared, chunk: tuple, codes: np.ndarray, q: _Request) -> tuple[np.ndarray | None, np.ndarray | None]:
    """Rows of the wanted nodes that are in the round's bag (None: every row), and each one's place among the nodes (None: there is one)."""
    bag = None if q.draw is None else _drawn(np.frombuffer(chunk[4], np.int64), *q.draw)
    if q.wanted == [0]:
        return None if bag is None else np.flatnonzero(bag), None
    where = own.node_of(codes, q.splits)
    if len(q.wanted) == 1:
        mine = where == q.wanted[0]
        return np.flatnonzero(mine if bag is None else mine & bag), None
    place = np.full(max(int(where.max(initial=0)), *q.wanted) + 1, -1)
    place[q.wanted] = np.arange(len(q.wanted))
    slot = place[where]
    rows = np.flatnonzero(slot >= 0 if bag is None else (slot >= 0) & bag)
    return rows, slot[rows]


def _by_column(own: _Shared, q: _Request, sums: dict[int, np.ndarray]) -> np.ndarray:
    widths = np.array([own.n_cuts[c] + 2 for c in q.columns])
    begin = dict(zip(map(int, q.columns), np.cumsum(widths) - widths))
    got = np.zeros((len(q.wanted), 3, int(widths.sum())))
    for i, of in sums.items():
        group, sizes = own.groups[i]
        of = of.reshape(3, len(q.wanted), -1).swapaxes(0, 1)
        for c, size in zip(group, sizes):
            if c in begin:
                after = own.place[c][1]
                got[:, :, begin[c]:begin[c] + size] += of.reshape(len(q.wanted), 3, -1, size, after).sum(axis=(2, 4))
    return got


def _refreshed(since: dict[int, list[list]], shared: dict[int, _Shared]):
    """Partition function: chunks whose scores hold every tree so far; ``since``: per task a list by slot."""
    def run(chunks):
        for c in chunks:
            own = shared[c[0]]
            base = np.stack([own.scores(c, own.codes(c), slot, trees) for slot, trees in enumerate(since[c[0]])])
            yield (*c[:5], base.tobytes())
    return run


def _added(a: dict, b: dict) -> dict:
    return {m: a[m] + b[m] if m in a and m in b else a.get(m, b.get(m)) for m in {*a, *b}}


# ------------------------------------------------------------------ growth on the driver
@dataclass
class _Node:
    hist: np.ndarray
    best: tuple | None
    kids: tuple | None = None  # numbers of the children once asked for
    split: tuple | None = None


class _Growth:
    """One model: grows trees from the sums of the passes."""

    def __init__(self, task: int, slot: int, params: BoostParams, n_cuts: list[int], missing: bool, start: float, ahead: bool = True):
        self.task, self.slot, self.p, self.n_cuts, self.missing, self.start = task, slot, params, n_cuts, missing, start
        self.ahead = ahead  # sum the children of several leaves in one pass
        self.trees: list[Tree] = []
        self.since: list = []
        self._root()

    @property
    def done(self) -> bool:
        return len(self.trees) >= self.p.rounds

    def _root(self) -> None:
        turn, n = len(self.trees), len(self.n_cuts)
        take = max(1, int(n * self.p.column_share))
        self.columns = np.arange(n) if take == n else np.sort(
            np.random.default_rng([self.p.seed, turn]).choice(n, take, replace=False))
        self.widths = np.array([self.n_cuts[c] + 2 for c in self.columns])
        self.begin = np.concatenate([[0], np.cumsum(self.widths)[:-1]])
        self.owner = np.repeat(np.arange(len(self.columns)), self.widths)
        # splits lie after a bin but the last; with missing values also between them and all others
        place = np.arange(int(self.widths.sum())) - self.begin[self.owner]
        self.cuttable = place < self.widths[self.owner] - 2 + self.missing
        self.nodes: dict[int, _Node] = {}
        self.known: dict[int, tuple] = {}  # node -> its (gradient, hessian, count)
        self.asked: list[tuple[int | None, int]] = [(None, 0)]
        self.tree, self.heap, self.next_id = Tree(), [], 1

    def request(self) -> _Request:
        draw = (self.p.seed, len(self.trees), self.p.row_share) if self.p.row_share < 1 else None
        accepted = list(zip(self.tree.node, self.tree.feature, self.tree.cut, self.tree.missing_left, self.tree.left, self.tree.right))
        ahead = [self.nodes[p].split for p in sorted({p for p, _ in self.asked if p is not None})]
        return _Request(self.slot, self.since, accepted + ahead, [n for _, n in self.asked], self.columns, draw)

    def receive(self, got: np.ndarray) -> None:
        for (parent, node), hist in zip(self.asked, got):
            if parent is None:
                c = slice(self.begin[0], self.begin[0] + self.widths[0])
                self.known[0] = tuple(hist[:, c].sum(1))
                self.nodes[0] = _Node(hist, self._best(hist, self.known[0]))
            else:
                a, b = self.nodes[parent].kids
                other = b if node == a else a
                self.nodes[node] = _Node(hist, self._best(hist, self.known[node]))
                rest = self.nodes[parent].hist - hist
                self.nodes[other] = _Node(rest, self._best(rest, self.known[other]))
        if self.asked == [(None, 0)]:
            self._push(0)
        self.asked = []
        self._advance()

    def _push(self, node: int) -> None:
        if self.nodes[node].best is not None:
            heapq.heappush(self.heap, (-self.nodes[node].best[0], node))

    def _advance(self) -> None:
        """Split the best leaf as long as it is certain, then ask for the children of the leaves that may be next."""
        while self.heap and len(self.tree.node) + 1 < self.p.max_leaves:
            node = self.heap[0][1]
            left = self.p.max_leaves - len(self.tree.node) - 1  # splits that the tree still takes
            if left > 1 and (self.nodes[node].kids is None or self.nodes[node].kids[0] not in self.nodes):
                for _, n in heapq.nsmallest(left - 1 if self.ahead else 1, self.heap):
                    if self.nodes[n].kids is None:
                        self._open(n)
                        a, b = self.nodes[n].kids
                        self.asked.append((n, a if self.known[a][2] <= self.known[b][2] else b))
                return
            heapq.heappop(self.heap)
            if self.nodes[node].kids is None:
                self._open(node)
            p, f, b, ml, lo, hi = self.nodes[node].split
            t = self.tree
            t.node.append(p), t.feature.append(f), t.cut.append(b), t.missing_left.append(ml), t.left.append(lo), t.right.append(hi)
            if lo in self.nodes:
                self._push(lo)
                self._push(hi)
        self._finish()

    def _open(self, node: int) -> None:
        _, f, b, ml, lsum, rsum = self.nodes[node].best
        lo, hi = self.next_id, self.next_id + 1
        self.next_id += 2
        self.nodes[node].kids, self.nodes[node].split = (lo, hi), (node, f, b, ml, lo, hi)
        self.known[lo], self.known[hi] = lsum, rsum

    def _finish(self) -> None:
        t = self.tree
        leaves = ({0} | set(t.left) | set(t.right)) - set(t.node)
        for n in leaves:
            g, h, _ = self.known[n]
            t.value[n] = -self.p.learning_rate * g / (h + self.p.l2)
        splits = list(zip(t.node, t.feature, t.cut, t.missing_left, t.left, t.right))
        self.trees.append(t)
        self.since.append((splits, t.values()))
        self._root()

    def _best(self, hist: np.ndarray, total: tuple) -> tuple | None:
        """(gain, feature, bin, missing left, left sums, right sums) of the best split; ties to the first column and bin."""
        p, (g, h, c) = self.p, total
        if c < 2 * p.min_leaf or h < p.min_hessian:
            return None
        run = np.cumsum(hist, axis=1)
        run -= np.concatenate([np.zeros((3, 1)), run], axis=1)[:, self.begin][:, self.owner]
        best = None
        for ml in ((False, True) if self.missing else (False,)):
            left = run
            if ml:
                last = self.begin + self.widths - 1
                left = run + hist[:, last][:, self.owner]
            gl, hl, cl = left
            gr, hr, cr = g - gl, h - hl, c - cl
            ok = self.cuttable & (cl >= p.min_leaf) & (cr >= p.min_leaf) & (hl >= p.min_hessian) & (hr >= p.min_hessian)
            if not ok.any():
                continue
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(ok, gl * gl / (hl + p.l2) + gr * gr / (hr + p.l2) - g * g / (h + p.l2), -np.inf)
            at = int(np.argmax(gain >= gain.max() * (1 - _TIE)))  # sums of equal rows differ by rounding: a tie goes to the first
            if gain[at] > 1e-12 and (best is None or gain[at] > best[0] * (1 + _TIE)):
                own = self.owner[at]
                best = (float(gain[at]), int(self.columns[own]), int(at - self.begin[own]), ml,
                        (gl[at], hl[at], cl[at]), (gr[at], hr[at], cr[at]))
        return best


# ------------------------------------------------------------------ training
def partitions_for(rows: int, parallelism: int) -> int:
    """Enough partitions for the cores, none too small, none above ``MOST_ROWS``."""
    return max(1, min(math.ceil(rows / LEAST_ROWS), 2 * parallelism), math.ceil(rows / MOST_ROWS))


def fits_alone(rows: int, width: int, alone_rows: int | None) -> bool:
    """Whether a table is grown by one task a model: up to ``alone_rows`` if given, else up to ``ALONE_BYTES`` of bins."""
    return rows <= alone_rows if alone_rows is not None else rows * width <= ALONE_BYTES


class _HeldRows:
    """A table that one task holds whole: what a tree needs of its rows is kept from one request to the next."""

    def __init__(self, bins: np.ndarray, y: np.ndarray, key: np.ndarray, start: float):
        self.bins, self.y, self.key, self.raw = bins, y, key, np.full(len(y), start)
        self.of: tuple | None = None  # the columns that ``codes`` are of

    def begin(self, q: _Request) -> None:
        """A new tree: gradients, hessians and rows drawn of this round."""
        p = 1.0 / (1.0 + np.exp(-self.raw))
        self.g, self.h = p - self.y, np.maximum(p * (1.0 - p), _SCORES_EPS)
        self.bag = None if q.draw is None else _drawn(self.key, *q.draw)
        if self.of != (columns := tuple(q.columns)):
            self.codes, self.of = _codes(self.bins if len(columns) == len(self.bins) else self.bins[q.columns]), columns
        self.rows: dict[int, np.ndarray | None] = {0: None}  # of each node so far, ascending; None: every row

    def part(self, splits: list, n_cuts: list[int]) -> None:
        """Hand the rows of split nodes to their children; each split is made once."""
        for p, f, b, ml, lo, hi in splits:
            if lo in self.rows:
                continue
            rows = self.rows[p]
            own = self.bins[f] if rows is None else self.bins[f][rows]
            right = own > b
            if ml:
                right &= own <= n_cuts[f]
            for node, side in ((lo, ~right), (hi, right)):
                self.rows[node] = np.flatnonzero(side) if rows is None else rows[side]

    def add(self, got: np.ndarray, begin: np.ndarray, wanted: list[int]) -> None:
        for i, node in enumerate(wanted):
            rows = self.rows[node]
            if self.bag is not None:
                rows = np.flatnonzero(self.bag) if rows is None else rows[self.bag[rows]]
            _add_coded(got[i:i + 1], self.codes, begin, rows, None, self.g, self.h)

    def score(self, splits: list, values: np.ndarray, n_cuts: list[int]) -> None:
        self.part(splits, n_cuts)
        inner = {s[0] for s in splits}
        for node in ({0} | {n for s in splits for n in s[4:]}) - inner:
            rows = self.rows[node]
            if rows is None:
                self.raw += values[node]
            else:
                self.raw[rows] += values[node]


def _alone(models: dict[int, _Growth]):
    """Partition function over (model, chunk): grows the models whose rows it holds, whole."""
    def run(pairs) -> Iterator[tuple[int, list[Tree]]]:
        held: dict[int, list] = {}
        for model, chunk in pairs:
            held.setdefault(model, []).append(chunk)
        for i, parts in held.items():
            m, width = models[i], len(models[i].n_cuts)
            key = np.concatenate([np.frombuffer(c[4], np.int64) for c in parts])
            order = np.argsort(key, kind="stable")  # sums do not depend on the order in which chunks arrive
            bins = np.concatenate([np.frombuffer(c[2], np.uint8).reshape(width, c[1]) for c in parts], axis=1)
            y = np.concatenate([np.frombuffer(c[3], np.uint8) for c in parts])
            table = _HeldRows(np.take(bins, order, axis=1), y[order], key[order], m.start)
            del bins
            while not m.done:
                q = m.request()
                if q.wanted == [0]:
                    table.begin(q)
                table.part(q.splits, m.n_cuts)
                got = np.zeros((len(q.wanted), 3, int(m.widths.sum())))
                table.add(got, m.begin, q.wanted)
                m.receive(got)
                for splits, values in m.since:  # a tree was finished
                    table.score(splits, values, m.n_cuts)
                m.since = []
            yield i, m.trees
    return run


def train(rows: DataFrame, families: dict[str, BoostParams], alone_rows: int | None = None) -> dict[tuple[str, int], BoostedTrees]:
    """Fit every family on every task of ``rows`` (task int, key long, y double, x array<double>; null or NaN: missing).

    ``x`` has one length per task. A task without rows has no model; one with a single label gets leaves that agree.
    """
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    rows = rows.select(F.col("task").cast("int"), F.col("key").cast("long"), F.col("y").cast("double"), "x")  # nulls are NaN once packed
    facts, counted = table_facts(rows)
    if not facts:
        return {}
    bins = {p.bins for p in families.values()}
    if len(bins) != 1 or max(bins) > 255:  # a byte holds 255 bins and the missing value after them
        raise ValueError("the families of a run share one number of bins, at most 255")
    cuts = counted_cut_points(counted, {t: r["width"] for t, r in facts.items()}, bins.pop())
    n_cuts = {t: [len(c) for c in cs] for t, cs in cuts.items()}

    names = list(families)
    starts = {}
    for task, r in facts.items():
        rate = min(max(r["rate"], _SCORES_EPS), 1 - _SCORES_EPS)
        starts[task] = [math.log(rate / (1 - rate))] * len(names)
    parts = partitions_for(sum(r["n"] for r in facts.values()), spark.sparkContext.defaultParallelism)
    packed = (rows.repartition(parts, "key").sortWithinPartitions("task", "key")
              .mapInArrow(_packed(cuts, starts), CHUNK_SCHEMA).checkpoint(eager=True))

    fitted: dict[tuple[str, int], BoostedTrees] = {}
    for small in (True, False):
        tasks = {t for t, r in facts.items() if fits_alone(r["n"], r["width"], alone_rows) == small}
        if not tasks:
            continue
        models = {(name, t): _Growth(t, slot, families[name], n_cuts[t], bool(facts[t]["missing"]), starts[t][slot], ahead=not small)
                  for t in sorted(tasks) for slot, name in enumerate(names)}
        chunks = packed.where(F.col("task").isin(sorted(tasks))).rdd.map(tuple)
        if small:
            _grow_alone(chunks, models)
        else:  # a task a core where that is not too much for one: a pass has a Spark job's fixed cost in every task
            most = max(spark.sparkContext.defaultParallelism, math.ceil(sum(facts[t]["n"] for t in tasks) / MOST_ROWS))
            _grow_by_passes(chunks, models, n_cuts, min(parts, most))
        fitted |= {k: BoostedTrees(m.start, [_real(t, cuts[m.task]) for t in m.trees]) for k, m in models.items()}
    return fitted


def _grow_alone(chunks, models: dict[tuple[str, int], _Growth]) -> None:
    order = list(models)
    of_task: dict[int, list[int]] = {}
    for i, (_, t) in enumerate(order):
        of_task.setdefault(t, []).append(i)
    by_model = chunks.flatMap(lambda c: [(i, c) for i in of_task[c[0]]]).partitionBy(len(order), lambda i: i)
    for i, trees in by_model.mapPartitions(_alone(dict(enumerate(models.values())))).collect():
        models[order[i]].trees = trees


def _grow_by_passes(chunks, models: dict[tuple[str, int], _Growth], n_cuts: dict[int, list[int]], parts: int) -> None:
    order = list(models)
    shared = {m.task: _Shared(m.n_cuts, m.missing) for m in models.values()}
    drawn = any(m.p.row_share < 1 for m in models.values())  # else no pass reads the keys
    held = StorageLevel.MEMORY_AND_DISK_DESER  # chunks are bytes already
    chunks = chunks.map(lambda c: shared[c[0]].coded(c if drawn else (*c[:4], b"", c[5]))).coalesce(parts).persist(held)
    unwritten = 0  # rounds since the chunks were checkpointed
    while any(not m.done for m in models.values()):
        asked: dict[int, list[tuple[int, _Request]]] = {}
        for i, k in enumerate(order):
            if not models[k].done:
                asked.setdefault(k[1], []).append((i, models[k].request()))
        sums = chunks.mapPartitions(_sums(asked, n_cuts, shared))
        if parts > FLAT_PARTITIONS:
            total = sums.treeReduce(_added)
        else:
            total = {}
            for part in sums.collect():
                total = _added(total, part)
        for i, hist in total.items():
            models[order[i]].receive(hist)
        late = max(len(m.since) for m in models.values())
        if late >= min(RESCORE, REFRESH) and any(not m.done for m in models.values()):
            since: dict[int, list] = {}
            for (_, t), m in models.items():  # families are in the order of their slots
                since.setdefault(t, []).append(m.since)
            fresh = chunks.mapPartitions(_refreshed(since, shared)).persist(held)
            unwritten += late
            if unwritten >= REFRESH:
                fresh.checkpoint()
                unwritten = 0
            fresh.count()
            chunks.unpersist()
            chunks = fresh
            for m in models.values():
                m.since = []
    chunks.unpersist()


def _real(t: Tree, cuts: list[np.ndarray]) -> Tree:
    """Thresholds instead of bin numbers; a split of missing against present values has an infinite threshold."""
    cut = [float(cuts[f][int(b)]) if int(b) < len(cuts[f]) else math.inf for f, b in zip(t.feature, t.cut)]
    return Tree(t.node, t.feature, cut, t.missing_left, t.left, t.right, t.value)
