"""Approximate nearest neighbours by largest inner product: one hierarchical navigable
small-world graph per shard, shard results merged.

Graphs. Vectors of a shard get one more component so that all have the same length;
inner products with a query (zero there) stay as they are, and nearness among vectors
is their distance. Points enter in batches: a batch descends the layers by beam search,
picks diverse neighbours among what it found and its own members, and links back; full
lists are thinned by the same rule. All steps are numpy over the whole batch. A graph
is stored as flat neighbour arrays, one row of a table per shard.

Data flow. Equal vectors are one point (a vector that a third of all rows share is one
node); a point keeps its smallest ids, as many as a result can hold. Points are dealt to
shards of ``SHARD`` points at most on average, by hashed id. Every query visits every
shard: pairs of a shard and a slice of the queries are dealt to a bounded number of tasks,
which load a graph once and let its queries stream past. Each task returns its exact best per query; a window merges them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import shuffle_partitions, stored

SHARD = 8192  # points of a shard, about
M, M0 = 16, 32  # neighbours of a point on upper layers and on the lowest
SLACK = 12  # links a list may hold beyond that before it is thinned
EF_BUILD, EF_SEARCH = 96, 160  # beam widths
BATCH = 256  # points that enter, or queries that search, at once
EXPAND = 6  # beam entries expanded in one step
SLICE = 2048  # queries of a task, about


def _levels(n: int, seed: int) -> np.ndarray:
    u = np.random.default_rng(seed).random(n)
    return np.minimum((-np.log(np.maximum(u, 1e-12)) / np.log(M)).astype(np.int64), 6)


def beam(points: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, ef: int, half: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``ef`` nearest points each query reaches: ids (-1: none) and products,
    nearest first. ``entries`` are starting points per query (-1: none). With ``half``
    (half the points' squares) nearness is that of ``_nearness``, not the product."""
    own = (queries * queries).sum(axis=1) / 2
    b, n = len(queries), len(points)
    seen = np.zeros((b, n + 1), bool)  # the last column takes the missing ones
    seen[:, n] = True
    ids = np.full((b, ef), -1, np.int64)
    near = np.full((b, ef), -np.inf)
    done = np.ones((b, ef), bool)

    def products(rows: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Unseen, distinct ones of ``found`` and their products with queries ``rows``."""
        found = np.sort(found, axis=1)
        fresh = ~seen[rows[:, None], found]
        fresh[:, 1:] &= found[:, 1:] != found[:, :-1]
        r, c = np.nonzero(fresh)
        at = found[r, c]
        seen[rows[r], at] = True
        value = np.full(found.shape, -np.inf)
        value[r, c] = np.einsum("kd,kd->k", points[at], queries[rows[r]])
        if half is not None:
            value[r, c] -= half[at] + own[rows[r]]
        return np.where(fresh, found, -1), value

    def merge(rows: np.ndarray, found: np.ndarray, value: np.ndarray) -> None:
        all_near = np.concatenate([near[rows], value], axis=1)
        best = np.argpartition(-all_near, ef - 1, axis=1)[:, :ef]
        near[rows] = np.take_along_axis(all_near, best, axis=1)
        ids[rows] = np.take_along_axis(np.concatenate([ids[rows], found], axis=1), best, axis=1)
        done[rows] = np.take_along_axis(np.concatenate([done[rows], found < 0], axis=1), best, axis=1)

    every = np.arange(b)
    merge(every, *products(every, np.where(entries < 0, n, entries)))
    rows = every
    while True:
        open_ = np.where(done[rows], -np.inf, near[rows])
        rows = rows[go := (open_ > -np.inf).any(axis=1)]
        if not len(rows):
            break
        open_ = open_[go]
        width = min(EXPAND, ef)
        pick = np.argpartition(-open_, width - 1, axis=1)[:, :width]
        live = np.take_along_axis(open_, pick, axis=1) > -np.inf
        at = np.where(live, ids[rows[:, None], pick], n)
        done[rows[:, None], pick] = True
        found = links[at].reshape(len(rows), -1)
        merge(rows, *products(rows, np.where(found < 0, n, found)))
    order = np.argsort(-near, axis=1, kind="stable")
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(near, order, axis=1)


def _nearness(products: np.ndarray, half_a: np.ndarray, half_b: np.ndarray) -> np.ndarray:
    """Half the negative squared distance, from products and half the squares."""
    return products - (half_a + half_b)


def diverse(points: np.ndarray, half: np.ndarray, cand: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """Neighbours for a batch: candidates (sorted, nearest first; -1: none) that are
    nearer to the point than to any neighbour picked before; free places go to the
    nearest of the others."""
    b, c = cand.shape
    v, h = points[np.maximum(cand, 0)], half[np.maximum(cand, 0)]
    among = _nearness(v @ v.transpose(0, 2, 1), h[:, :, None], h[:, None, :])
    taken = np.zeros((b, c), bool)
    closest = np.full((b, c), -np.inf)  # to a picked neighbour
    count = np.zeros(b, np.int64)
    valid = cand >= 0
    for j in range(c):
        ok = valid[:, j] & (count < most) & (closest[:, j] < near[:, j])
        taken[:, j] = ok
        count += ok
        closest = np.where(ok[:, None], np.maximum(closest, among[:, j]), closest)
    rank = np.where(taken, 0, np.where(valid, 1, 2)) * c + np.arange(c)
    order = np.argsort(rank, axis=1)[:, :most]
    out = np.where(np.take_along_axis(valid, order, axis=1), np.take_along_axis(cand, order, axis=1), -1)
    if out.shape[1] < most:
        out = np.concatenate([out, np.full((b, most - out.shape[1]), -1, np.int64)], axis=1)
    return out


class Graph:
    """A shard's graph: padded points, neighbour arrays per layer, entry point.

    The padding that gives all points unit length is kept as one minus itself, which
    changes no distance, and points are compared by distance: beside one vector many
    times longer than the rest their products would differ by less than rounding.
    """

    def __init__(self, vectors: np.ndarray):
        v = np.asarray(vectors, np.float64)
        squares = (v * v).sum(axis=1)
        top = float(squares.max()) if len(v) else 1.0
        scale = 1.0 / np.sqrt(top)  # products only need to be comparable
        pad = np.sqrt(np.maximum(0.0, 1.0 - squares / top))
        self.points = np.concatenate([v * scale, (squares / top / (1.0 + pad))[:, None]], axis=1)
        self.half = (self.points * self.points).sum(axis=1) / 2
        self.layers: list[np.ndarray] = []
        self.entry = -1

    def build(self, seed: int = 5) -> Graph:
        n = len(self.points)
        level = _levels(n, seed)
        order = np.random.default_rng(seed + 1).permutation(n)
        # row n of a layer stands for no point
        self.layers = [np.full((n + 1, (M0 if i == 0 else M) + SLACK), -1, np.int64) for i in range(int(level.max(initial=0)) + 1)]
        at = 0
        while at < n:
            self._insert(order[at : at + max(1, min(BATCH, at))], level)
            at += max(1, min(BATCH, at))
        return self

    def _insert(self, new: np.ndarray, level: np.ndarray) -> None:
        if self.entry < 0:
            self.entry, self.height = int(new[0]), int(level[new[0]])
            return
        q = self.points[new]
        entries = np.full((len(new), 1), self.entry, np.int64)
        own = _nearness(q @ q.T, self.half[new][:, None], self.half[new][None, :])
        np.fill_diagonal(own, -np.inf)
        for layer in range(max(self.height, int(level[new].max())), -1, -1):
            here = level[new] >= layer
            if layer <= self.height:
                ids, near = beam(self.points, self.layers[layer], q, entries, EF_BUILD if here.any() else 8, self.half)
                entries = ids[:, :4]
            else:
                ids, near = np.full((len(new), 1), -1, np.int64), np.full((len(new), 1), -np.inf)
            if not here.any():
                continue
            mates = np.where(here[None, :], own, -np.inf)[here]
            k = min(16, mates.shape[1])
            best = np.argpartition(-mates, k - 1, axis=1)[:, :k]
            value = np.take_along_axis(mates, best, axis=1)
            cand = np.concatenate([ids[here], np.where(value > -np.inf, new[best], -1)], axis=1)
            value = np.concatenate([near[here], value], axis=1)
            by = np.argsort(-value, axis=1, kind="stable")
            self._link(layer, new[here], np.take_along_axis(cand, by, axis=1), np.take_along_axis(value, by, axis=1))
        top = int(np.argmax(level[new]))
        if level[new[top]] > self.height:
            self.entry, self.height = int(new[top]), int(level[new[top]])

    def _link(self, layer: int, nodes: np.ndarray, cand: np.ndarray, near: np.ndarray) -> None:
        links, most = self.layers[layer], (M0 if layer == 0 else M)
        picked = diverse(self.points, self.half, cand, near, most // 2 if layer == 0 else most)
        links[nodes, : picked.shape[1]] = picked
        links[nodes, picked.shape[1] :] = -1
        # back links, by the point that receives them
        r, c = np.nonzero(picked >= 0)
        to, by = picked[r, c], nodes[r]
        keep = ~(links[to] == by[:, None]).any(axis=1)  # members of one batch may pick each other
        order = np.argsort(to[keep], kind="stable")
        to, by = to[keep][order], by[keep][order]
        if not len(to):
            return
        targets, first, count = np.unique(to, return_index=True, return_counts=True)
        place = np.arange(len(to)) - np.repeat(first, count)
        room = links.shape[1]
        held = (links[targets] >= 0).sum(axis=1)
        fits = held + count <= room
        rows = np.repeat(np.arange(len(targets)), count)
        ok = fits[rows]
        links[to[ok], (held[rows] + place)[ok]] = by[ok]
        full = np.flatnonzero(~fits)
        for k in range(0, len(full), 512):
            some = full[k : k + 512]
            wide = room + int(count[some].max())
            lists = np.full((len(some), wide), -1, np.int64)
            lists[:, :room] = links[targets[some]]
            for i, t in enumerate(some):  # the receivers of this block
                lists[i, held[t] : held[t] + count[t]] = by[first[t] : first[t] + count[t]]
            v = self.points[targets[some]]
            at = np.maximum(lists, 0)
            value = _nearness(np.einsum("bcd,bd->bc", self.points[at], v), self.half[at], self.half[targets[some]][:, None])
            value[lists < 0] = -np.inf
            sort = np.argsort(-value, axis=1, kind="stable")[:, : 2 * room]
            links[targets[some], :most] = diverse(self.points, self.half, np.take_along_axis(lists, sort, axis=1), np.take_along_axis(value, sort, axis=1), most)
            links[targets[some], most:] = -1

    def search(self, queries: np.ndarray, ef: int = EF_SEARCH) -> tuple[np.ndarray, np.ndarray]:
        """Points near each query, nearest first."""
        q = np.concatenate([np.asarray(queries, np.float64), np.zeros((len(queries), 1))], axis=1)
        entries = np.full((len(q), 1), self.entry, np.int64)
        for layer in range(self.height, 0, -1):
            entries = beam(self.points, self.layers[layer], q, entries, 16)[0][:, :8]
        return beam(self.points, self.layers[0], q, entries, ef)

    def flat(self) -> dict[str, bytes]:
        """Neighbour arrays: the lowest layer in full, of upper ones the points on them."""
        n = len(self.points)
        upper = []
        for links in self.layers[1:]:
            on = np.flatnonzero((links[:n] >= 0).any(axis=1))
            upper.append(np.concatenate([[len(on)], on, links[on].ravel()]))
        head = np.array([self.entry, self.height], "<i4")
        return {
            "links": self.layers[0][:n].astype("<i4").tobytes(),
            "upper": np.concatenate([head, *upper]).astype("<i4").tobytes(),
        }

    @classmethod
    def load(cls, vectors: np.ndarray, links: bytes, upper: bytes) -> Graph:
        g = cls(vectors)
        n = len(g.points)
        none = np.full((1, M0 + SLACK), -1, np.int64)
        g.layers = [np.concatenate([np.frombuffer(links, "<i4").reshape(n, -1).astype(np.int64), none])]
        flat = np.frombuffer(upper, "<i4").astype(np.int64)
        g.entry, g.height = int(flat[0]), int(flat[1])
        at = 2
        while at < len(flat):
            k = int(flat[at])
            on = flat[at + 1 : at + 1 + k]
            at += 1 + k
            layer = np.full((n + 1, M + SLACK), -1, np.int64)
            layer[on] = flat[at : at + k * (M + SLACK)].reshape(k, M + SLACK)
            at += k * (M + SLACK)
            g.layers.append(layer)
        return g


def valid_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, v)`` of the rows that take part, one per id.

    Out: null ids, null and zero vectors, vectors with null or non-finite components, and
    those whose length is not the most frequent one (ties: the longer). Rows with equal
    id count once (the smallest vector).
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0.0)
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(fine)
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    rows = rows.where(F.size("v") == F.lit(common["d"] if common else 0))
    return rows.groupBy("vec_id").agg(F.min(F.transform("v", lambda x: x + 0.0)).alias("v"))


def points_of(rows: DataFrame, k: int) -> DataFrame:
    """``(rep, members, v)``: equal vectors as one point with its ``k + 1`` smallest ids.
    The limit per vector holds before the shuffle, so copies do not meet in one task."""
    w = Window.partitionBy("v").orderBy("vec_id")
    first = rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k + 1)
    return first.groupBy("v").agg(F.min("vec_id").alias("rep"), F.sort_array(F.collect_list("vec_id")).alias("members"))


_INDEX = "shard int, reps binary, sizes binary, members binary, vectors binary, links binary, upper binary"


def build_index(points: DataFrame, shards: int) -> DataFrame:
    """One row per shard: points, their ids and the graph as flat arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in batch.to_pylist()]  # one shard
        if not rows:
            return
        rows.sort(key=lambda r: r["rep"])
        v = np.array([r["v"] for r in rows])
        out = {
            "shard": rows[0]["shard"], "reps": np.array([r["rep"] for r in rows], "<i8").tobytes(),
            "sizes": np.array([len(r["members"]) for r in rows], "<i4").tobytes(),
            "members": np.array([m for r in rows for m in r["members"]], "<i8").tobytes(), "vectors": v.astype("<f8").tobytes(),
        }
        out |= Graph(v).build().flat()
        yield pa.RecordBatch.from_pylist([out], schema=pa.schema([("shard", pa.int32())] + [(c, pa.binary()) for c in list(out)[1:]]))

    dealt = points.withColumn("shard", F.pmod(F.xxhash64("rep"), F.lit(shards)).cast("int"))
    return dealt.select("shard", "rep", "members", "v").repartitionById(shards, "shard").mapInArrow(run, _INDEX)


def _by_graph(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, dict | None]]:
    """Rows sorted by shard, graphs before queries -> (queries, graph) in pieces; the graph is
    given with its first piece only."""
    for batch in batches:
        graphs = np.flatnonzero(batch.column("kind").to_numpy() == 0).tolist()
        cuts = [0, *graphs, batch.num_rows] if not graphs or graphs[0] else [*graphs, batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            rows = batch.slice(a, b - a).to_pylist()
            index = rows.pop(0) if rows and rows[0]["kind"] == 0 else None
            yield rows, index


def _search_stage(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph = None
        for batch, index in _by_graph(batches):
            rows = batch
            if index is not None:
                reps = np.frombuffer(index["reps"], "<i8")
                vectors = np.frombuffer(index["vectors"], "<f8").reshape(len(reps), -1)
                ends = np.cumsum(np.frombuffer(index["sizes"], "<i4"))
                members = np.split(np.frombuffer(index["members"], "<i8"), ends[:-1])
                graph = Graph.load(vectors, index["links"], index["upper"])
            for i in range(0, len(rows) if graph is not None else 0, BATCH):
                block = rows[i : i + BATCH]
                q = np.array([r["v"] for r in block])
                ids, _ = graph.search(q)
                qid, vid, score = [], [], []
                for r, vector, found in zip(block, q, ids):
                    found = found[found >= 0]
                    exact = (vectors[found] * vector).sum(axis=1)
                    # all points that tie with the last one that may be needed (one may be the query's own)
                    least = np.partition(exact, -k - 1)[-k - 1] if len(exact) > k + 1 else -np.inf
                    best = np.flatnonzero(exact >= least)
                    # copies of a point share its score; the query itself is no candidate
                    who = np.concatenate([members[f] for f in found[best]])
                    value = np.repeat(exact[best], [len(members[f]) for f in found[best]])
                    other = who != r["query_id"]
                    who, value = who[other], value[other]
                    top = np.lexsort((who, -value))[:k]
                    qid.append(np.full(len(top), r["query_id"]))
                    vid.append(who[top])
                    score.append(value[top])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(qid), pa.int64()), pa.array(np.concatenate(vid), pa.int64()), pa.array(np.concatenate(score), pa.float64())],
                    names=["query_id", "vec_id", "score"],
                )

    return run


def search_tasks(shards: int, slices: int, partitions: int) -> int:
    """Tasks of a search: a pair of shard and slice each, but no more than a few waves."""
    return min(shards * slices, max(shards, 4 * partitions))


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each vector that ``is_query`` (a condition
    on ``vec_id``) picks, its ``k`` nearest others by inner product, nearest first, ties
    to the smaller id; all others if there are fewer. Approximate: what the graphs
    reach; scores are exact, in double precision.

    See ``valid_vectors`` for rows that take no part; an empty table gives an empty
    table; other columns are not read.
    """
    rows = stored(valid_vectors(vectors, id_col, vector_col), "hnsw-vectors")
    points = stored(points_of(rows, k), "hnsw-points")
    shards = max(1, -(-points.count() // SHARD))
    index = stored(build_index(points, shards), "hnsw-index")
    queries = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "v")
    slices = max(1, -(-queries.count() // SLICE))
    # pairs of shard and slice, dealt in order to a bounded number of tasks: a task loads a
    # shard's graph once and the queries of its slices stream past it
    parts = search_tasks(shards, slices, shuffle_partitions(vectors.sparkSession))
    task = lambda pair: F.expr(f"cast(({pair}) * {parts}L div {shards * slices} as int)")
    slice_ = F.pmod(F.xxhash64("query_id"), F.lit(slices)).alias("slice")
    asked = queries.select("query_id", "v", slice_, F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    asked = asked.select(task(f"shard * {slices}L + slice").alias("task"), "shard", F.lit(1).alias("kind"), "query_id", "v")
    first, last = task(f"shard * {slices}L"), task(f"shard * {slices}L + {slices - 1}")
    graphs = index.withColumn("task", F.explode(F.sequence(first, last)))
    graphs = graphs.select("task", "shard", F.lit(0).alias("kind"), "reps", "sizes", "members", "vectors", "links", "upper")
    both = graphs.unionByName(asked, allowMissingColumns=True)
    tasks = both.repartitionById(parts, "task").sortWithinPartitions("shard", "kind")
    found = tasks.mapInArrow(_search_stage(k), "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    from tidemark.sources.tables import table

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)
