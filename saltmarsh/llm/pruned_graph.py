"""Approximate nearest neighbours by inner product over robust-pruned directed graphs.

Vectors are dealt evenly to shards of about ``SHARD`` rows. Each shard has its own graph: points are inserted in batches
of doubling size; a greedy search over the graph so far proposes each point's neighbours, and relaxed pruning keeps one
only if no kept neighbour is closer to it by the factor ``ALPHA``, so edges stay diverse. Edges are made both ways. A
beam search queries each shard; its finds are scored again in double precision on the original vectors.

Inner product becomes distance by one more coordinate, the root of (greatest squared norm - squared norm); queries have 0
there. Equal vectors are one point of the graph with all their ids, so ties are found whole.

Scale: indexing is linear (a shard's cost is fixed). A query visits every shard, as the method says, so searching all
queries against all rows grows with their product over the shard size. The query set travels in blocks, one copy a group of
shards that together take ``GROUP_BYTES``, and a group gives its k best of each query, so neither the copies nor the
finds follow the number of shards. A task holds a group and a block.

Defined cases: vectors that are null, empty, zero, of another length than most, or hold null or non-finite components
take no part, as queries or candidates; rows that repeat an id are one candidate (their best score counts), and one
query (the smallest vector); fewer candidates than asked are all returned; a null id takes no part; empty tables give
no rows; other columns of the input are not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, ship_package, stored

#: Rows of a shard, edges of a point, search width while building and while querying, and pruning's relaxation.
SHARD, DEGREE, BUILD_BEAM, QUERY_BEAM, ALPHA = 5_000, 32, 64, 96, 1.2
QUERY_BLOCK = 1_024
#: Bytes of the shards that one task searches together.
GROUP_BYTES = 48 << 20
_ROWS = 256  # searched or pruned at once


class PrunedGraph:
    """The graph of one shard over distinct vectors."""

    def __init__(self, vectors: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA):
        x = (vectors / np.abs(vectors).max()).astype(np.float32)  # the scale changes no order, and spares overflow
        square = (x.astype(np.float64) ** 2).sum(axis=1)
        self.points = np.concatenate([x, np.sqrt(np.maximum(square.max() - square, 0)).astype(np.float32)[:, None]], axis=1)
        self.degree, self.alpha = degree, alpha
        n = len(x)
        self.edges = np.full((n, degree), -1, np.int32)
        order = np.random.default_rng(7).permutation(n)
        mean = self.points.mean(axis=0)
        self.entry = int(((self.points - mean) ** 2).sum(axis=1).argmin())
        order = np.r_[self.entry, order[order != self.entry]]
        done, size = 1, 8
        while done < n:
            self._insert(order[done : done + size], beam)
            done += size
            size = min(2 * size, _ROWS * 4)
        self._insert(order, beam)  # once more, over the whole graph

    def _insert(self, batch: np.ndarray, beam: int) -> None:
        for at in range(0, len(batch), _ROWS):
            part = batch[at : at + _ROWS]
            found, _ = self.search(self.points[part], beam)
            candidates = np.concatenate([found, self.edges[part]], axis=1)
            self.edges[part] = self._prune(part, candidates)
            self._back(part)

    def _back(self, part: np.ndarray) -> None:
        """Edges from the new neighbours to the points of this batch; full neighbours are pruned again."""
        to, source = self.edges[part].ravel(), np.repeat(part, self.degree)
        to, source = to[to >= 0], source[to >= 0]
        order = np.argsort(to, kind="stable")
        to, source = to[order], source[order]
        first = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else np.empty(0, int)
        nodes, rank = to[first], np.arange(len(to)) - np.repeat(first, np.diff(np.r_[first, len(to)]))
        width = int(rank.max()) + 1 if len(rank) else 0
        incoming = np.full((len(nodes), width), -1, np.int32)
        incoming[np.repeat(np.arange(len(nodes)), np.diff(np.r_[first, len(to)])), rank] = source
        for at in range(0, len(nodes), _ROWS):
            n = nodes[at : at + _ROWS]
            self.edges[n] = self._prune(n, np.concatenate([self.edges[n], incoming[at : at + _ROWS]], axis=1))

    def _prune(self, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """Relaxed pruning: nearest first, each kept candidate removes those that it is much closer to than the node is."""
        p = self.points
        c = np.where(candidates == nodes[:, None], -1, candidates)
        c = np.sort(c, axis=1)
        c[:, 1:][c[:, 1:] == c[:, :-1]] = -1
        d = ((p[c] - p[nodes][:, None]) ** 2).sum(axis=2)
        d[c < 0] = np.inf
        order = np.argsort(d, axis=1)[:, : 4 * self.degree]
        c, d = np.take_along_axis(c, order, 1), np.take_along_axis(d, order, 1)
        near = p[c]
        square = (near**2).sum(axis=2)
        between = square[:, :, None] + square[:, None] - 2 * near @ near.transpose(0, 2, 1)
        alive, rows = np.isfinite(d), np.arange(len(nodes))
        out = np.full((len(nodes), self.degree), -1, np.int32)
        for k in range(self.degree):
            pick = alive.argmax(axis=1)
            ok = alive[rows, pick]
            if not ok.any():
                break
            out[ok, k] = c[rows, pick][ok]
            alive &= ~((self.alpha**2 * between[rows, pick] <= d) & ok[:, None])
            alive[rows, pick] = False
        return out

    def search(self, queries: np.ndarray, beam: int, expand: int = 4) -> tuple[np.ndarray, np.ndarray]:
        """Ids and squared distances of the ``beam`` nearest found for each query, nearest first; -1 where fewer were met."""
        p, n, rows = self.points, len(queries), np.arange(len(queries))
        ids, dist = np.full((n, beam), -1, np.int32), np.full((n, beam), np.inf, np.float32)
        closed = np.ones((n, beam), bool)
        seen = np.zeros((n, len(p)), bool)
        ids[:, 0], closed[:, 0], seen[:, self.entry] = self.entry, False, True
        dist[:, 0] = ((queries - p[self.entry]) ** 2).sum(axis=1)
        own = (queries**2).sum(axis=1)
        square = (p**2).sum(axis=1)
        live = rows
        while len(live):
            open_ = np.where(closed[live], np.inf, dist[live])
            take = np.argsort(open_, axis=1)[:, :expand]
            ok = np.isfinite(np.take_along_axis(open_, take, 1))
            some = ok.any(axis=1)
            live, take, ok = live[some], take[some], ok[some]
            if not len(live):
                break
            closed[live[:, None], take] = True
            near = np.where(ok[:, :, None], self.edges[ids[live[:, None], take]], -1).reshape(len(live), -1)
            near = np.sort(near, axis=1)
            fresh = near >= 0
            fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
            fresh &= ~seen[live[:, None], near]
            seen[live[:, None], np.where(fresh, near, self.entry)] = True
            d = own[live][:, None] + square[near] - 2 * (p[near] @ queries[live][:, :, None])[:, :, 0]
            d = np.where(fresh, d, np.inf).astype(np.float32)
            all_d = np.concatenate([dist[live], d], axis=1)
            best = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
            dist[live] = np.take_along_axis(all_d, best, 1)
            ids[live] = np.take_along_axis(np.concatenate([ids[live], near], axis=1), best, 1)
            closed[live] = np.take_along_axis(np.concatenate([closed[live], ~fresh], axis=1), best, 1)
        return np.where(np.isfinite(dist), ids, -1), dist


class Shard:
    """A graph with the ids of its points and their original vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.vectors, inverse = np.unique(vectors, axis=0, return_inverse=True)
        order = np.lexsort((ids, inverse.ravel()))
        self.ids, inverse = ids[order], inverse.ravel()[order]
        self.first = np.searchsorted(inverse, np.arange(len(self.vectors) + 1))
        self.graph = PrunedGraph(self.vectors)

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query_id, vec_id, score): at least the k best found for each query, itself left out, ties to smaller ids."""
        out: list[tuple] = []
        padded = np.concatenate([(queries / np.abs(queries).max(axis=1, keepdims=True)).astype(np.float32), np.zeros((len(queries), 1), np.float32)], axis=1)
        for at in range(0, len(queries), _ROWS):
            found, _ = self.graph.search(padded[at : at + _ROWS], beam)
            for qid, q, f in zip(query_ids[at : at + _ROWS].tolist(), queries[at : at + _ROWS], found):
                f = f[f >= 0]
                score = (self.vectors[f] * q).sum(axis=1)
                got: list[tuple[float, int]] = []
                for i, s in zip(f.tolist(), score.tolist()):  # ids of one point are sorted, and k + 1 of them suffice
                    got += [(-s, v) for v in self.ids[self.first[i] : min(self.first[i + 1], self.first[i] + k + 1)].tolist() if v != qid]
                out += [(qid, v, -s) for s, v in sorted(set(got))[:k]]
        q, v, s = zip(*out) if out else ((), (), ())
        return np.array(q, np.int64), np.array(v, np.int64), np.array(s, np.float64)


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (lengths.d if lengths else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def build_index(rows: DataFrame, shard: int = SHARD) -> tuple[DataFrame, int]:
    """(index, shards): one row (shard_id, body) a shard, written to the shared folder."""
    ship_package(rows.sparkSession)
    shards = max(1, -(-rows.count() // shard))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        parts = [(b.column(0).to_numpy(), _matrix(b.column(1))) for b in batches if b.num_rows]
        if parts:
            body = Shard(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([pickle.dumps(body, protocol=5)], pa.binary())], names=["shard_id", "body"])

    return stored(rows.repartition(shards).mapInArrow(lean(build), "shard_id int, body binary"), "graph-index"), shards


def best_of(query_id: np.ndarray, vec_id: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best, ties to smaller ids; of an id that comes twice its best score."""
    order = np.lexsort((-score, vec_id, query_id))
    order = order[np.r_[True, (query_id[order][1:] != query_id[order][:-1]) | (vec_id[order][1:] != vec_id[order][:-1])]] if len(order) else order
    order = order[np.lexsort((vec_id[order], -score[order], query_id[order]))]
    head = np.flatnonzero(np.r_[True, query_id[order][1:] != query_id[order][:-1]]) if len(order) else order
    rank = np.arange(len(order)) - np.repeat(head, np.diff(np.r_[head, len(order)]))
    return order[rank < k]


def search_index(index: DataFrame, shards: int, queries: DataFrame, k: int = 20, beam: int = QUERY_BEAM, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's k best over all shards."""
    largest = index.agg(F.max(F.octet_length("body")).alias("n")).first().n or 1
    wanted = max(-(-shards // max(1, group_bytes // largest)), min(shards, index.sparkSession.sparkContext.defaultParallelism))
    each = -(-shards // wanted)
    groups = -(-shards // each)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, QUERY_BLOCK):
                part = batch.slice(at, QUERY_BLOCK)
                body = pickle.dumps((part.column(0).to_numpy(), _matrix(part.column(1))), protocol=5)
                yield pa.RecordBatch.from_arrays([pa.array([int(part.column(0)[0].as_py())], pa.int64()), pa.array([body], pa.binary())], names=["block", "body"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, here = None, []
        for batch in batches:
            for group, block, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if group != at:
                    at, here = group, []
                loaded = pickle.loads(body.as_py())
                if block is None:
                    here.append(loaded)
                elif here:
                    q, v, s = (np.concatenate(c) for c in zip(*(shard.nearest(*loaded, k, beam) for shard in here)))
                    best = best_of(q, v, s, k)
                    yield pa.RecordBatch.from_arrays([pa.array(q[best]), pa.array(v[best]), pa.array(s[best])], names=["query_id", "vec_id", "score"])

    one = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    packed = stored(one.select("vec_id", "v").mapInArrow(lean(blocks), "block long, body binary"), "graph-queries")
    every = packed.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group_id"), "block", "body")
    both = index.select(F.floor(F.col("shard_id") / each).cast("int").alias("group_id"), F.lit(None).cast("long").alias("block"), "body").unionByName(every)
    placed = both.repartitionById(groups, F.col("group_id")).sortWithinPartitions("group_id", F.col("block").asc_nulls_first())
    found = placed.mapInArrow(lean(find), "query_id long, vec_id long, score double").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int")
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(df: DataFrame, every: int = 20, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding", shard: int = SHARD, beam: int = QUERY_BEAM) -> DataFrame:
    """The k nearest of every row whose id is divisible by ``every``, among all other rows."""
    rows = usable(df, vec_id, vector)
    index, shards = build_index(rows, shard)
    return search_index(index, shards, rows.where(F.col("vec_id") % every == 0), k, beam)
