"""Approximate nearest neighbours by learned partitions (op12).

1. A bounded sample of the distinct vectors (drawn by hash) makes a neighbour
   graph; the graph is cut into balanced parts by recursive bisection: a cut at a
   quantile of the main direction, then exchanges of vertices with the largest
   gains, which keep the sizes.
2. A small network (one hidden layer) learns each vector's distribution over the
   parts of itself and its neighbours; held-out sample vectors tell how many parts
   a query must visit for ``TARGET`` of their neighbours (all, if need be).
3. Every vector goes to its most probable part, every query to its most probable
   ones. Parts are dealt into tiles of about ``TILE_ROWS`` vectors and blocks of
   ``QUERY_ROWS`` queries, so no task holds a large part; a tile returns each
   query's best, which are merged and reranked by cosine in double precision.

Copies of a vector are compared once: of their ids the k + 1 smallest can be in an
answer, which are kept (first within each task, then over all). Only the sample's
model and one count a part reach the driver.

Defined results: vectors that are null, zero or hold null or non-finite entries
take no part, nor do those whose length is not the commonest (ties: the longest).
Rows that repeat (id, vector) are one; one id with several vectors are several
rows and, if it is a query, several queries, each only barred from itself. Rows
with a null id are candidates only and come last among ties. Fewer candidates
than k: all of them. Equal scores go to the smaller id. Other columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrisk.session import ensure_checkpoint_dir, ship_package

#: Vectors a part is meant to hold, parts at most, sample rows a part (at least LEAST_SAMPLE in all), and numbers in the sample at most.
PART_ROWS, MAX_PARTS, SAMPLE_ROWS, LEAST_SAMPLE, SAMPLE_VALUES = 2_048, 1_024, 256, 4_096, 6_000_000
TILE_ROWS, QUERY_ROWS = 16_384, 8_192
GRAPH_K, HIDDEN, EPOCHS, RATE, TARGET = 10, 128, 12, 2e-3, 0.97
_MARGIN = 1e-9


# ------------------------------------------------------------------ graph and parts
def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest others of each unit vector, in blocks."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for s in range(0, len(x), 1_024):
        sim = x[s:s + 1_024] @ x.T
        sim[np.arange(len(sim)), np.arange(s, s + len(sim))] = -np.inf
        out[s:s + 1_024] = np.argpartition(-sim, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int) -> np.ndarray:
    """Part of every vertex; sizes differ by at most one per level of bisection."""
    n = len(x)
    heads, tails = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    a, b = np.concatenate([heads, tails]), np.concatenate([tails, heads])  # both directions
    label = np.zeros(n, np.int64)
    todo = [(np.arange(n), 0, parts)]
    while todo:
        own, first, count = todo.pop()
        if count == 1:
            label[own] = first
            continue
        low = count // 2
        size = round(len(own) * low / count)
        side = np.zeros(n, np.int8)  # 0: elsewhere, -1 / 1: the two halves
        axis = _main_direction(x[own])
        order = own[np.argsort(x[own] @ axis, kind="stable")]
        side[order[:size]], side[order[size:]] = -1, 1
        inside = (side[a] != 0) & (side[b] != 0)
        ea, eb = a[inside], b[inside]
        for _ in range(20):
            # edges gained by moving a vertex to the other side
            gain = -np.bincount(ea, side[ea] * side[eb], n)
            left, right = own[side[own] < 0], own[side[own] > 0]
            left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
            m = min(len(left), len(right))
            good = np.flatnonzero(gain[left[:m]] + gain[right[:m]] > 0)
            if not len(good):
                break
            take = max(1, len(good) // 4)  # few at a time: gains of neighbours change with each exchange
            side[left[:take]], side[right[:take]] = 1, -1
        todo += [(own[side[own] < 0], first, low), (own[side[own] > 0], first + low, count - low)]
    return label


def _main_direction(x: np.ndarray) -> np.ndarray:
    x = x - x.mean(0)
    v = np.ones(x.shape[1]) + np.arange(x.shape[1]) / x.shape[1]
    for _ in range(20):
        v = x.T @ (x @ v)
        size = np.linalg.norm(v)
        if size == 0:
            return np.ones(x.shape[1])
        v /= size
    return v


# ------------------------------------------------------------------ classifier
@dataclass
class Router:
    """Unit vector -> log weights of the parts; ``probes`` parts are visited by a query."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int

    @property
    def parts(self) -> int:
        return len(self.b2)

    def weights(self, unit: np.ndarray) -> np.ndarray:
        return np.maximum(unit @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def best(self, unit: np.ndarray) -> np.ndarray:
        return self.weights(unit).argmax(1)

    def visits(self, unit: np.ndarray) -> np.ndarray:
        w = self.weights(unit)
        return np.argsort(-w, axis=1, kind="stable")[:, :self.probes]


def _one_part(d: int) -> Router:
    return Router(np.zeros((d, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), 1)


def train_router(unit: np.ndarray, parts: int, k: int, seed: int = 42) -> Router:
    """Fit on unit vectors; every tenth is kept out of the training and sets the number of probes."""
    n, d = unit.shape
    if parts <= 1 or n < 4 * parts:
        return _one_part(d)
    graph = neighbour_graph(unit, GRAPH_K)
    label = balanced_parts(unit, graph, parts)
    soft = np.zeros((n, parts))
    np.add.at(soft, (np.arange(n), label), 1.0)
    for j in range(graph.shape[1]):
        np.add.at(soft, (np.arange(n), label[graph[:, j]]), 1.0)
    soft /= soft.sum(1, keepdims=True)

    rng = np.random.default_rng(seed)
    p = [rng.normal(0, math.sqrt(2 / d), (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, math.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts)]
    m, v, step = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p], 0
    held = np.arange(n) % 10 == 0
    learn = np.flatnonzero(~held)
    for _ in range(EPOCHS):
        for rows in np.array_split(rng.permutation(learn), max(1, len(learn) // 256)):
            x, t = unit[rows], soft[rows]
            h = np.maximum(x @ p[0] + p[1], 0)
            z = h @ p[2] + p[3]
            z = np.exp(z - z.max(1, keepdims=True))
            dz = (z / z.sum(1, keepdims=True) - t) / len(rows)
            dh = (dz @ p[2].T) * (h > 0)
            step += 1
            for i, g in enumerate((x.T @ dh, dh.sum(0), h.T @ dz, dz.sum(0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p[i] = p[i] - RATE * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    router = Router(*p, parts)
    at = router.best(unit)
    wanted = at[graph[held][:, :max(1, min(k, graph.shape[1]))]]  # parts of the held-out vectors' neighbours
    place = np.argsort(np.argsort(-router.weights(unit[held]), axis=1, kind="stable"), axis=1, kind="stable")
    rank = np.take_along_axis(place, wanted, axis=1)
    reached = [(rank < probes).mean() for probes in range(1, parts + 1)]
    router.probes = next((i + 1 for i, r in enumerate(reached) if r >= TARGET), parts)
    return router


# ------------------------------------------------------------------ inside tasks
def _vectors(column) -> np.ndarray:
    """Rows of a binary column of doubles."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values)).reshape(len(values), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    big = np.abs(x).max(1, keepdims=True)
    x = x / big  # neither tiny nor huge entries overflow in the norm
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def cosine(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Cosine of one vector to each row, summed in the same order wherever a row stands."""
    a, b = q / np.abs(q).max(), c / np.abs(c).max(1, keepdims=True)
    return (b * a).sum(1) / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum(1)))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, c array<double>) -> (id, vec): the doubles as bytes, negative zeros as zeros."""
    for rb in batches:
        c = rb.column(1)
        x = c.flatten().to_numpy(zero_copy_only=False).reshape(len(c), -1) + 0.0
        yield pa.RecordBatch.from_arrays([rb.column(0), pa.array([r.tobytes() for r in np.ascontiguousarray(x)], pa.binary())], names=["id", "vec"])


def _fewest(k: int):
    """Per task, the k smallest ids of each vector (null last): what copies can bring into an answer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(kept):
            return pa.RecordBatch.from_pydict({"vec": pa.array(list(kept), pa.binary()), "ids": pa.array(
                [[{"last": i is None, "id": i} for i in ids] for ids in kept.values()],
                pa.list_(pa.struct([("last", pa.bool_()), ("id", pa.int64())])))})

        kept: dict[bytes, list] = {}
        for rb in batches:
            for i, v in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
                own = kept.setdefault(v, [])
                if i not in own:
                    own.append(i)
                    if len(own) > k:
                        own.sort(key=lambda e: (e is None, e))
                        own.pop()
            if len(kept) >= 65_536:
                yield rows(kept)
                kept = {}
        if kept:
            yield rows(kept)
    return run


def _search(k: int):
    """Cogroup of a tile's candidates and a block of queries: each query's k best entries."""
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        empty = pa.table({"qvec": pa.array([], pa.binary()), "found": pa.array([], FOUND)})
        if not rows.num_rows or not queries.num_rows:
            return empty
        c, q = _vectors(rows["vec"]), _vectors(queries["qvec"])
        ids = rows["ids"].to_pylist()
        raw = rows["vec"].to_pylist()
        copies = np.array([len(i) for i in ids])
        cu, qu = _unit(c), _unit(q)
        names, found = [], []
        for s in range(0, len(q), 256):
            sims = qu[s:s + 256] @ cu.T
            for j, sim in enumerate(sims):
                # the bar is the k-th best vector's score: each vector has at least one id
                bar = np.partition(sim, -k)[-k] if len(sim) > k else -np.inf
                at = np.flatnonzero(sim >= bar - _MARGIN)
                score = cosine(q[s + j], c[at])
                own = queries["qvec"][s + j].as_py()
                # few entries a vector; ties at the bar may be many vectors
                pick = np.repeat(np.arange(len(at)), copies[at])
                entries = [(-score[p], e["last"], e["id"] if e["id"] is not None else 0, raw[at[p]] != own, e["id"])
                           for p, e in zip(pick, (e for a in at for e in ids[a]))]
                entries.sort(key=lambda e: e[:4])
                names.append(own)
                found.append([{"order": float(e[0]), "last": e[1], "id": e[4], "other": bool(e[3])} for e in entries[:k]])
        return pa.table({"qvec": pa.array(names, pa.binary()), "found": pa.array(found, FOUND)})
    return run


FOUND = pa.list_(pa.struct([("order", pa.float64()), ("last", pa.bool_()), ("id", pa.int64()), ("other", pa.bool_())]))
FOUND_SQL = "array<struct<order: double, last: boolean, id: bigint, other: boolean>>"


# ------------------------------------------------------------------ the operator
def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vec) of the rows that take part."""
    c = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    found = rows.select(F.col(id_col).cast("long").alias("id"), c.alias("c")).where(
        F.col("c").isNotNull() & (F.size("c") > 0) & F.forall("c", _finite) & F.exists("c", lambda v: v != 0))
    sizes = found.groupBy(F.size("c").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).first()
    return found.where(F.size("c") == (sizes["d"] if sizes else 0)).mapInArrow(_pack, "id bigint, vec binary")


def fit(vectors: DataFrame, n: int, k: int) -> Router:
    """The router, from a bounded sample of the distinct vectors drawn by their hash."""
    first = vectors.select("vec").first()
    d = len(first["vec"]) // 8
    parts = max(1, min(MAX_PARTS, n // PART_ROWS))
    size = max(1, min(max(LEAST_SAMPLE, parts * SAMPLE_ROWS), SAMPLE_VALUES // d))
    parts = max(1, min(parts, size // 8))
    if parts == 1:
        return _one_part(d)
    drawn = vectors.select("vec", F.xxhash64("vec").alias("h")).orderBy("h", "vec").limit(size).select("vec").toArrow()
    return train_router(_unit(_vectors(drawn["vec"])), parts, k)


def neighbours(rows: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
               router: Router | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row whose id meets ``queries`` (a condition on ``id``)."""
    spark = rows.sparkSession
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    base = usable(rows, id_col, vector_col).checkpoint(eager=True)
    ids = "array<struct<last: boolean, id: bigint>>"
    fewest = base.mapInArrow(_fewest(k + 1), f"vec binary, ids {ids}")
    vectors = fewest.groupBy("vec").agg(
        F.slice(F.array_distinct(F.array_sort(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids")).checkpoint(eager=True)
    n = vectors.count()
    asked = base.where(F.col("id").isNotNull() & queries).select(F.col("id").alias("query_id"), F.col("vec").alias("qvec")).distinct().checkpoint(eager=True)
    out = "query_id bigint, rank int, vec_id bigint, score double"
    if n == 0:
        return spark.createDataFrame([], out)
    router = router or fit(vectors, n, k)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            if rb.num_rows:
                part = router.best(_unit(_vectors(rb.column(0))))
                yield pa.RecordBatch.from_arrays([*rb.columns, pa.array(part, pa.int32())], names=["vec", "ids", "part"])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            if rb.num_rows:
                visits = router.visits(_unit(_vectors(rb.column(0))))
                yield pa.RecordBatch.from_arrays([rb.column(0), pa.array(list(visits.astype(np.int32)), pa.list_(pa.int32()))], names=["qvec", "parts"])

    dealt = vectors.mapInArrow(deal, f"vec binary, ids {ids}, part int").checkpoint(eager=True)
    routed = asked.select("qvec").distinct().mapInArrow(route, "qvec binary, parts array<int>").select(
        "qvec", F.explode("parts").alias("part")).checkpoint(eager=True)
    held = {r["part"]: r["count"] for r in dealt.groupBy("part").count().collect()}  # one count a part
    visits = {r["part"]: r["count"] for r in routed.groupBy("part").count().collect()}
    tiles = F.element_at(F.create_map(*[F.lit(v) for p in range(router.parts) for v in (p, max(1, math.ceil(held.get(p, 0) / TILE_ROWS)))]), F.col("part"))
    blocks = F.element_at(F.create_map(*[F.lit(v) for p in range(router.parts) for v in (p, max(1, math.ceil(visits.get(p, 0) / QUERY_ROWS)))]), F.col("part"))

    cells = dealt.select("vec", "ids", "part", F.pmod(F.xxhash64("vec"), tiles).cast("int").alias("tile"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
    calls = routed.select("qvec", "part", F.explode(F.sequence(F.lit(0), tiles - 1)).alias("tile"), F.pmod(F.xxhash64("qvec"), blocks).cast("int").alias("block"))
    key = ["part", "tile", "block"]
    best = cells.groupBy(*key).cogroup(calls.groupBy(*key)).applyInArrow(_search(k + 1), f"qvec binary, found {FOUND_SQL}")
    merged = best.groupBy("qvec").agg(F.slice(F.array_sort(F.flatten(F.collect_list("found"))), 1, k + 1).alias("found"))
    # a query is barred from its own row alone: the entry with its id and its vector
    answers = asked.join(merged, "qvec").select("query_id", F.slice(F.filter(
        "found", lambda e: e["other"] | ~e["id"].eqNullSafe(F.col("query_id"))), 1, k).alias("found"))
    return answers.select("query_id", F.posexplode("found").alias("at", "e")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("e.id").alias(id_col), (-F.col("e.order")).alias("score"))


def exact(rows: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Brute force in blocks by the same steps: one part, which every query visits; recall is measured against it."""
    first = usable(rows, id_col, vector_col).first()
    d = len(first["vec"]) // 8 if first else 1
    return neighbours(rows, queries, k, id_col, vector_col, _one_part(d))
