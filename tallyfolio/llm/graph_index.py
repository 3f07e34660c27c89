"""Approximate nearest neighbours on directed graphs with robust-pruned edges.

Vectors are dealt by a hash of their id to shards of about ``SHARD_ROWS``, each a graph of its own, built in one task:
vectors enter in random order, in batches up to the size of what is there. A greedy search on the graph so far proposes
a vector's neighbours; robust pruning keeps the nearest and drops each that a kept one is nearer to by the factor
``ALPHA``; every edge is also offered backwards, and full lists are pruned again. Equal vectors are one node, with
all their ids, so that a thousand copies don't fill each other's lists.

Queries are asked of every shard: they are cut into blocks of about ``BLOCK_QUERIES`` by a hash of their id, and each
block is broadcast and searched by beam in all shards. Nodes of the beam are measured anew in double precision on the
vectors as given. Each shard gives a query its best k ids; a ranking by query, cut to k before rows are shuffled,
takes the best of all shards.

Distances between vectors of different length don't exist: each length has graphs of its own. Vectors that are null,
empty, zero or hold a null or non-finite component take no part, nor do null ids. Of rows that repeat an id the one
with the smallest vector, component by component, counts. Equal distances go by id. An empty table gives no rows;
a query without other vectors of its length gives none. Extra columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfolio.llm.common import map_texts, written

SHARD_ROWS = 8192
BLOCK_QUERIES = 1 << 15
DEGREE = 32
ALPHA = 1.2
BUILD_BEAM = 64
SEARCH_BEAM = 160
EXPAND = 4
"""Nodes of a beam whose edges are followed at once."""
BATCH = 512
FAR = np.float32(np.inf)


class Graph:
    """Nodes are rows of ``points``; ``edges`` holds up to DEGREE neighbours of each, -1 where there are fewer."""

    def __init__(self, points: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA, beam: int = BUILD_BEAM, seed: int = 1):
        self.points = points.astype(np.float32)
        self.norms = (self.points**2).sum(axis=1)
        self.degree, self.alpha = degree, np.float32(alpha)
        n = len(points)
        self.edges = np.full((n, degree), -1, np.int32)
        middle = self.points.mean(axis=0)
        self.start = int(((self.points - middle) ** 2).sum(axis=1).argmin())
        order = np.random.default_rng(seed).permutation(n)
        order = np.concatenate([[self.start], order[order != self.start]])
        done = 1
        while done < n:
            batch = order[done : done + min(max(done, 1), BATCH)]
            found, far = self.beam(self.points[batch], beam)
            # members of a batch don't see one another on the graph, so each proposes some of them itself
            mates, gaps = self._mates(batch)
            self._link(batch, np.concatenate([found, mates], axis=1), np.concatenate([far, gaps], axis=1))
            done += len(batch)

    def _mates(self, batch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = self.points[batch]
        gaps = np.maximum(self.norms[batch][:, None] + self.norms[batch] - 2 * (x @ x.T), 0)
        np.fill_diagonal(gaps, FAR)
        k = min(self.degree // 2, len(batch))
        near = np.argpartition(gaps, k - 1, axis=1)[:, :k]
        gaps = np.take_along_axis(gaps, near, axis=1)
        return np.where(np.isfinite(gaps), batch[near], -1).astype(np.int32), gaps

    def _gaps(self, x: np.ndarray, norms: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Squared distances from each row of x to the nodes of its row."""
        dots = np.matmul(self.points[nodes], x[:, :, None])[:, :, 0]
        return np.maximum(norms[:, None] + self.norms[nodes] - 2 * dots, 0)

    def beam(self, x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest nodes met by greedy searches from the start, and their squared distances, nearest first."""
        many, n = len(x), len(self.points)
        norms = (x**2).sum(axis=1)
        rows = np.arange(many)[:, None]
        seen = np.zeros((many, n), bool)
        seen[:, self.start] = True
        node = np.full((many, width), -1, np.int32)
        gap = np.full((many, width), FAR)
        node[:, 0] = self.start
        gap[:, 0] = self._gaps(x, norms, np.full((many, 1), self.start))[:, 0]
        closed = np.zeros((many, width), bool)
        active = np.arange(many)
        while len(active):
            # the nearest open nodes of each beam; beams are kept sorted
            open_gap = np.where(closed[active] | (node[active] < 0), FAR, gap[active])
            pick = np.argsort(open_gap, axis=1, kind="stable")[:, :EXPAND]
            usable = np.isfinite(np.take_along_axis(open_gap, pick, axis=1))
            going = usable[:, 0]
            active, pick, usable = active[going], pick[going], usable[going]
            if not len(active):
                break
            at = active[:, None]
            closed[at, pick] |= usable
            front = np.where(usable[:, :, None], self.edges[node[at, pick]], -1).reshape(len(active), -1)
            # a node that two lists hold is taken once
            front = np.sort(front, axis=1)
            fresh = front >= 0
            fresh[:, 1:] &= front[:, 1:] != front[:, :-1]
            safe = np.maximum(front, 0)
            fresh &= ~seen[at, safe]
            most = int(fresh.sum(axis=1).max())
            if most == 0:
                continue
            order = np.argsort(~fresh, axis=1, kind="stable")[:, :most]
            safe, fresh = np.take_along_axis(safe, order, axis=1), np.take_along_axis(fresh, order, axis=1)
            r, c = np.nonzero(fresh)
            seen[active[r], safe[r, c]] = True
            new = np.where(fresh, self._gaps(x[active], norms[active], safe), FAR)
            both = np.concatenate([gap[active], new], axis=1)
            order = np.argpartition(both, width - 1, axis=1)[:, :width]
            order = np.take_along_axis(order, np.argsort(np.take_along_axis(both, order, axis=1), axis=1, kind="stable"), axis=1)
            gap[active] = np.take_along_axis(both, order, axis=1)
            node[active] = np.take_along_axis(np.concatenate([node[active], np.where(fresh, safe, -1)], axis=1), order, axis=1)
            closed[active] = np.take_along_axis(np.concatenate([closed[active], np.zeros_like(fresh)], axis=1), order, axis=1)
        return node, gap

    def _prune(self, nodes: np.ndarray, near: np.ndarray, gaps: np.ndarray) -> np.ndarray:
        """Robust pruning of each node's candidates: the edges to keep."""
        order = np.argsort(gaps, axis=1, kind="stable")
        near, gaps = np.take_along_axis(near, order, axis=1), np.take_along_axis(gaps, order, axis=1)
        out = np.full((len(nodes), self.degree), -1, np.int32)
        points = self.points[np.maximum(near, 0)]
        norms = self.norms[np.maximum(near, 0)]
        left = (near >= 0) & (near != nodes[:, None]) & np.isfinite(gaps)
        rows = np.arange(len(nodes))
        for k in range(self.degree):
            first = left.argmax(axis=1)
            some = left[rows, first]
            if not some.any():
                break
            out[:, k] = np.where(some, near[rows, first], -1)
            chosen = points[rows, first]
            between = norms + norms[rows, first][:, None] - 2 * np.matmul(points, chosen[:, :, None])[:, :, 0]
            # squared distances, so the factor is squared
            left &= self.alpha**2 * np.maximum(between, 0) > gaps
            left[rows, first] = False
            left &= near != out[:, k][:, None]
        return out

    def _link(self, batch: np.ndarray, near: np.ndarray, gaps: np.ndarray) -> None:
        self.edges[batch] = self._prune(batch, near, gaps)
        source = np.repeat(batch, self.degree)
        target = self.edges[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        new = (self.edges[target] != source[:, None]).all(axis=1)
        source, target = source[new], target[new]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        nodes, first, many = np.unique(target, return_index=True, return_counts=True)
        held = (self.edges[nodes] >= 0).sum(axis=1)
        for small in (True, False):
            mine = (held + many <= self.degree) == small
            if not mine.any():
                continue
            which, n, h = nodes[mine], many[mine], held[mine]
            row = np.repeat(np.arange(len(which)), n)
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            offered = source[np.repeat(first[mine], n) + place]
            if small:
                self.edges[which[row], h[row] + place] = offered
                continue
            for a in range(0, len(which), BATCH):
                w = which[a : a + BATCH]
                wide = int(n[a : a + BATCH].max())
                more = np.full((len(w), wide), -1, np.int32)
                inside = (row >= a) & (row < a + BATCH)
                more[row[inside] - a, place[inside]] = offered[inside]
                candidates = np.concatenate([self.edges[w], more], axis=1)
                safe = np.maximum(candidates, 0)
                gaps = np.where(candidates >= 0, self._gaps(self.points[w], self.norms[w], safe), FAR)
                self.edges[w] = self._prune(w, candidates, gaps)


class Shard:
    """Vectors of one length: a graph over the distinct ones, and the ids of each, smallest first."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.lexsort((*vectors.T[::-1], ids))
        ids, vectors = ids[order], vectors[order]
        first = np.concatenate([[True], ids[1:] != ids[:-1]])
        ids, vectors = ids[first], vectors[first]
        self.vectors, node = np.unique(vectors, axis=0, return_inverse=True)
        node = node.ravel()
        by = np.lexsort((ids, node))
        self.ids, self.first = ids[by], np.searchsorted(node[by], np.arange(len(self.vectors) + 1))
        self.graph = Graph(self.vectors)

    def search(self, ids: np.ndarray, vectors: np.ndarray, k: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query id, id, distance) of the best k ids of each query in this shard, but its own."""
        node, _ = self.graph.beam(vectors.astype(np.float32), width)
        row, c = np.nonzero(node >= 0)
        node = node[row, c]
        far = np.sqrt(((vectors[row] - self.vectors[node]) ** 2).sum(axis=1))
        # k + 1 ids of a node are enough, one of them may be the query's own
        n = np.minimum(np.diff(self.first)[node], k + 1)
        at = np.repeat(np.arange(len(node)), n)
        found = self.ids[np.repeat(self.first[node], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        row, far = row[at], far[at]
        other = found != ids[row]
        row, found, far = row[other], found[other], far[other]
        order = np.lexsort((found, far, row))
        row, found, far = row[order], found[order], far[order]
        kept = np.arange(len(row)) - np.searchsorted(row, row) < k
        return ids[row[kept]], found[kept], far[kept]


def _usable(rows: DataFrame, id: str, vector: str) -> DataFrame:
    """(id, vector as doubles) of the rows that take part."""
    narrow = rows.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return narrow.filter(F.col("id").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("vector", lambda x: x != 0))


def _arrays(frames: Iterator[pa.RecordBatch]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors by the vectors' length."""
    ids, lists = [], []
    for frame in frames:
        ids.append(frame.column("id").to_numpy())
        lists.append(frame.column("vector"))
    if not ids:
        return {}
    ids = np.concatenate(ids)
    lengths = np.concatenate([x.value_lengths().to_numpy() for x in lists])
    flat = np.concatenate([x.flatten().to_numpy() for x in lists])
    owner = np.repeat(lengths, lengths)
    return {int(d): (ids[lengths == d], flat[owner == d].reshape(-1, d)) for d in np.unique(lengths)}


def build(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(length, shard): a graph and its vectors a row, as a table in the shared folder."""
    usable = _usable(rows, id, vector)
    shards = max(1, -(-rows.count() // shard_rows))

    def grow(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for length, (ids, vectors) in _arrays(frames).items():
            body = pickle.dumps(Shard(ids, vectors))
            yield pa.RecordBatch.from_pylist([{"length": length, "shard": body}], pa.schema([("length", pa.int32()), ("shard", pa.binary())]))

    dealt = usable.repartitionById(shards, F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    return written(map_texts(dealt, grow, "length int, shard binary"), "graph-shards")


def search(index: DataFrame, queries: DataFrame, k: int = 10, id: str = "vec_id", vector: str = "embedding", width: int = SEARCH_BEAM, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest of the index but itself, nearest first."""
    spark = index.sparkSession
    asked = written(_usable(queries, id, vector).groupBy("id").agg(F.min("vector").alias("vector")), "graph-queries")
    blocks = -(-asked.count() // block_queries)
    parts = []
    for k_block in range(blocks):
        block = asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k_block).toArrow()
        shared = spark.sparkContext.broadcast(_arrays(iter(block.to_batches())))

        def ask(frames: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for frame in frames:
                for length, body in zip(frame.column("length").to_pylist(), frame.column("shard"), strict=True):
                    if length in shared.value:
                        shard = pickle.loads(body.as_buffer())
                        ids, vectors = shared.value[length]
                        for a in range(0, len(ids), BATCH):
                            found = shard.search(ids[a : a + BATCH], vectors[a : a + BATCH], k, width)
                            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["query_id", "vec_id", "score"])

        parts.append(written(map_texts(index, ask, "query_id long, vec_id long, score double"), "graph-found"))
        shared.unpersist()
    found = spark.createDataFrame([], "query_id long, vec_id long, score double") if not parts else parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    nearest = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
