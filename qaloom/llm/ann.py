"""Approximate nearest neighbours: a hierarchical navigable small-world graph for each shard, results merged."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import settle
from .words import tidied

#: Vectors of a shard, queries of a block; both bound what a task holds (some 300 bytes each, at 64 dimensions).
SHARD, BLOCK = 8192, 4096
#: Links of a node in the upper layers (twice that in the lowest), candidates for them, beam of a search.
LINKS, CANDIDATES, BEAM = 16, 64, 160
#: Nodes that a query expands in one step, and queries in one step.
STRIDE, STEP = 4, 256


def _diverse(base: np.ndarray, near: np.ndarray, far: np.ndarray, most: int) -> np.ndarray:
    """Of each row's candidates, nearest first (-1: none), those nearer to the row than to any chosen before."""
    rows, width = near.shape
    vectors = base[np.maximum(near, 0)]
    squares = (vectors**2).sum(axis=2)
    between = squares[:, :, None] + squares[:, None, :] - 2 * vectors @ vectors.transpose(0, 2, 1)
    chosen, count = np.zeros((rows, width), bool), np.zeros(rows, int)
    for c in range(width):
        blocked = (chosen & (between[:, :, c] < far[:, c : c + 1])).any(axis=1)
        take = (near[:, c] >= 0) & ~blocked & (count < most)
        chosen[:, c] = take
        count += take
    # nearest ones fill what is left
    rank = np.where(chosen, 0, np.where(near >= 0, 1, 2)) * width + np.arange(width)
    order = np.argsort(rank, axis=1)[:, :most]
    return np.take_along_axis(near, order, axis=1)


def _layer(base: np.ndarray, nodes: np.ndarray, most: int) -> np.ndarray:
    """Links of each node, as it would get them on insertion in this order with an exact search: diverse ones among
    the nearest that came before; then links back from those, pruned in the same way."""
    own = base[nodes]
    n, squares = len(nodes), (own**2).sum(axis=1)
    ahead = np.full((n, most), -1, np.int64)
    for a in range(0, n, STEP):
        b = min(a + STEP, n)
        far = squares[a:b, None] + squares[None, :b] - 2 * own[a:b] @ own[:b].T
        far[np.arange(b)[None, :] >= np.arange(a, b)[:, None]] = np.inf
        width = min(CANDIDATES, b)
        near = np.argpartition(far, width - 1, axis=1)[:, :width]
        dist = np.take_along_axis(far, near, axis=1)
        order = np.argsort(dist, axis=1)
        near, dist = np.take_along_axis(near, order, axis=1), np.take_along_axis(dist, order, axis=1)
        picked = _diverse(own, np.where(np.isfinite(dist), near, -1), dist, most // 2)
        ahead[a:b, : picked.shape[1]] = picked
    src, slot = np.nonzero(ahead >= 0)
    ends = np.concatenate([np.stack([src, ahead[src, slot]]), np.stack([ahead[src, slot], src])], axis=1)
    ends = np.unique(ends, axis=1)
    dist = ((own[ends[0]] - own[ends[1]]) ** 2).sum(axis=1)
    order = np.lexsort((dist, ends[0]))
    ends, dist = ends[:, order], dist[order]
    place = np.arange(len(dist)) - np.searchsorted(ends[0], ends[0])
    some = place < 3 * most
    near, far = np.full((n, 3 * most), -1, np.int64), np.full((n, 3 * most), np.inf)
    near[ends[0][some], place[some]], far[ends[0][some], place[some]] = ends[1][some], dist[some]
    out = np.full((n, most), -1, np.int64)
    for a in range(0, n, STEP):
        out[a : a + STEP] = _diverse(own, near[a : a + STEP], far[a : a + STEP], most)
    return np.where(out >= 0, nodes[np.maximum(out, 0)], -1)


class Graph:
    """A shard's index. vectors: distinct ones, with one dimension more that makes all norms equal, so that the
    nearest is that of largest inner product. layers: for each layer its nodes (ascending) and their links."""

    def __init__(self, vectors: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]):
        self.vectors, self.layers = vectors, layers

    @staticmethod
    def of(vectors: np.ndarray) -> Graph:
        norms = (vectors.astype(np.float64) ** 2).sum(axis=1)
        base = np.concatenate([vectors, np.sqrt(np.maximum(norms.max() - norms, 0))[:, None]], axis=1).astype(np.float32)
        level = np.floor(-np.log(np.random.default_rng(len(base)).random(len(base))) / np.log(LINKS)).astype(int)
        order = np.argsort(-level, kind="stable")  # nodes of upper layers are the early ones
        layers = []
        for k in range(int(level.max()) + 1):
            nodes = order[level[order] >= k]
            links = _layer(base, nodes, LINKS * (2 if k == 0 else 1))
            by = np.argsort(nodes)
            layers.append((nodes[by].astype(np.int32), links[by].astype(np.int32)))
        return Graph(base, layers)

    def search(self, queries: np.ndarray, beam: int) -> np.ndarray:
        """For each query the nodes of its beam, -1 where there are fewer."""
        return np.concatenate([self._search(queries[a : a + STEP], beam) for a in range(0, len(queries), STEP)])

    def _search(self, queries: np.ndarray, beam: int) -> np.ndarray:
        wide = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1).astype(np.float32)
        far = lambda nodes: (self.vectors[nodes] ** 2).sum(axis=-1) - 2 * np.einsum("q...d,qd->q...", self.vectors[nodes], wide)
        q, n = len(wide), len(self.vectors)
        at = np.full(q, self.layers[-1][0][0], np.int64)
        best = far(at)
        for nodes, links in reversed(self.layers[1:]):
            moved = True
            while moved:
                near = links[np.searchsorted(nodes, at)]
                dist = np.where(near >= 0, far(np.maximum(near, 0)), np.inf)
                pick = dist.argmin(axis=1)
                closer = dist[np.arange(q), pick] < best
                at = np.where(closer, near[np.arange(q), pick], at)
                best = np.where(closer, dist[np.arange(q), pick], best)
                moved = bool(closer.any())
        links = self.layers[0][1]
        seen = np.zeros((q, n + 1), bool)
        seen[:, n] = True
        held, dist, done = np.full((q, beam), n, np.int64), np.full((q, beam), np.inf, np.float32), np.ones((q, beam), bool)
        held[:, 0], dist[:, 0], done[:, 0] = at, best, False
        seen[np.arange(q), at] = True
        row = np.arange(q)[:, None]
        while not done.all():
            open_dist = np.where(done, np.inf, dist)
            pick = np.argpartition(open_dist, STRIDE - 1, axis=1)[:, :STRIDE]
            live = np.isfinite(np.take_along_axis(open_dist, pick, axis=1))
            expand = np.where(live, np.take_along_axis(held, pick, axis=1), n)
            np.put_along_axis(done, pick, True, axis=1)
            near = np.where(live[:, :, None], links[np.minimum(expand, n - 1)], -1).reshape(q, -1)
            near = np.sort(np.where(near >= 0, near, n), axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = n
            near = np.where(seen[row, near], n, near)
            seen[row, near] = True
            new = np.where(near < n, far(np.minimum(near, n - 1)), np.inf).astype(np.float32)
            held, dist, done = np.concatenate([held, near], axis=1), np.concatenate([dist, new], axis=1), np.concatenate([done, new == np.inf], axis=1)
            keep = np.argpartition(dist, beam - 1, axis=1)[:, :beam]
            held, dist, done = (np.take_along_axis(x, keep, axis=1) for x in (held, dist, done))
        return np.where(np.isfinite(dist), held, -1)

    def row(self) -> dict:
        return {
            "n": len(self.vectors), "vectors": self.vectors.tobytes(), "nodes": [nodes.tobytes() for nodes, _ in self.layers], "links": [links.tobytes() for _, links in self.layers],
        }

    @staticmethod
    def read(row: dict) -> Graph:
        layers = [(np.frombuffer(a, np.int32), np.frombuffer(b, np.int32).reshape(len(a) // 4, -1)) for a, b in zip(row["nodes"], row["links"], strict=True)]
        return Graph(np.frombuffer(row["vectors"], np.float32).reshape(row["n"], -1), layers)


def _rows(table: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids, ascending, and vectors; of rows that repeat an id, the least vector."""
    ids = table["_id"].to_numpy()
    vectors = table["_v"].combine_chunks().flatten().to_numpy().reshape(-1, dim)
    order = np.lexsort((*vectors.T[::-1], ids))
    first = np.ones(len(ids), bool)
    first[1:] = ids[order][1:] != ids[order][:-1]
    return ids[order][first], vectors[order][first]


_INDEX = "shard int, n int, vectors binary, nodes array<binary>, links array<binary>, exact binary, ids binary, counts binary"


def _build(dim: int, k: int):
    """Equal vectors are one node, with the k + 1 least of their ids: more can't be among k results."""

    def made(table: pa.Table) -> pa.Table:
        ids, vectors = _rows(table, dim)
        distinct, where = np.unique(vectors, axis=0, return_inverse=True)
        where = where.ravel()
        order = np.lexsort((ids, where))
        place = np.arange(len(ids)) - np.searchsorted(where[order], where[order])
        order = order[place <= k]
        row = {"shard": table["shard"][0].as_py()} | Graph.of(distinct).row()
        row |= {"exact": distinct.tobytes(), "ids": ids[order].tobytes(), "counts": np.bincount(where[order], minlength=len(distinct)).astype(np.int32).tobytes()}
        kinds = {"shard": pa.int32(), "n": pa.int32(), "nodes": pa.list_(pa.binary()), "links": pa.list_(pa.binary())}
        return pa.table({c: pa.array([v], kinds.get(c, pa.binary())) for c, v in row.items()})

    return made


def _pack(dim: int):
    def made(table: pa.Table) -> pa.Table:
        ids, vectors = _rows(table, dim)
        return pa.table({"block": table["block"].slice(0, 1).combine_chunks(), "ids": pa.array([ids.tobytes()], pa.binary()), "vectors": pa.array([vectors.tobytes()], pa.binary())})

    return made


def _search(dim: int, k: int, beam: int):
    def made(index: pa.Table, block: pa.Table) -> pa.Table:
        out = []
        for row in index.to_pylist():
            graph = Graph.read(row)
            exact = np.frombuffer(row["exact"]).reshape(-1, dim)
            ids, counts = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["counts"], np.int32)
            start = np.cumsum(counts) - counts
            for own in block.to_pylist():
                asked, vectors = np.frombuffer(own["ids"], np.int64), np.frombuffer(own["vectors"]).reshape(-1, dim)
                found = graph.search(vectors, min(beam, len(exact)) if len(exact) >= STRIDE else STRIDE)
                for key, vector, nodes in zip(asked, vectors, found, strict=True):
                    nodes = nodes[nodes >= 0]
                    score = (exact[nodes] * vector).sum(axis=1)
                    many = counts[nodes]
                    who = ids[np.repeat(start[nodes] - np.cumsum(many) + many, many) + np.arange(many.sum())]
                    score = np.repeat(score, many)[who != key]
                    who = who[who != key]
                    best = np.lexsort((who, -score))[:k]
                    out.append((np.full(len(best), key), who[best], score[best]))
        if not out:
            out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        q, v, s = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.float64())})

    return made


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """_id, _v (array<double>): rows with an id and a vector of finite components, not all 0."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("_id"), v.alias("_v")).filter(F.coalesce(fine, F.lit(False)))


def search(vectors: DataFrame, every: int = 20, k: int = 20, beam: int = BEAM, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row whose id is divisible by `every`, its k nearest others by
    inner product in double precision, nearest first, ties to the smaller id; all others if there are fewer.

    Rows take no part if their id is null or their vector null, empty, zero or with null or non-finite components,
    or of another length than the commonest (ties: the smaller). Rows that repeat an id count once, with the least
    vector. Equal vectors under different ids are all found. An empty table gives an empty table; other columns
    aren't looked at. What is found is approximate: recall against brute force is tested to be 0.9 or more.

    Plan: rows go to shards of some SHARD rows by hash of the id, so however many copies one vector has, shards
    stay even; each shard's graph is built once and stored as flat arrays in the shared folder; queries are packed
    into blocks of some BLOCK; each (shard, block) pair is searched in one task call; a partial group limit before
    the last shuffle leaves k rows a query and task. Work grows with queries times shards, as the question does.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vec_col).select("_id", "_v", F.size("_v").alias("_d"))
    common = rows.groupBy("_d").agg(F.count("*").alias("n"), F.count(F.when(F.col("_id") % every == 0, 1)).alias("q")).orderBy(F.desc("n"), "_d").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, shards, blocks = common["_d"], -(-common["n"] // SHARD), max(1, -(-common["q"] // BLOCK))
    rows = rows.filter(F.col("_d") == dim).select("_id", "_v")
    hashed = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "_id"), F.lit(n)).cast("int")
    index = settle(rows.withColumn("shard", hashed("shard", shards)).groupBy("shard").applyInArrow(tidied(_build(dim, k)), _INDEX), "graphs")
    packed = settle(rows.filter(F.col("_id") % every == 0).withColumn("block", hashed("block", blocks)).groupBy("block").applyInArrow(tidied(_pack(dim)), "block int, ids binary, vectors binary"), "queries")
    left = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = packed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(tidied(_search(dim, k, beam)), "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def query(vectors: DataFrame) -> DataFrame:
    return search(vectors.select("vec_id", "embedding"))
