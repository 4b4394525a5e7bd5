"""Approximate nearest neighbours by inner product over robust-pruned directed graphs.

Method: vectors are dealt into shards of bounded size. In each shard every vector is
searched for from the medoid by a greedy beam, and the vectors met propose its neighbours.
Pruning keeps the nearest proposal, drops those that lie closer to it, by the factor
`ALPHA`, than to the vector itself, and goes on, so that the edges point in diverse
directions; edges back are added and pruned alike. A query walks each shard's graph with a
beam, and the shards' best are merged.

Inner products become distances by one more component that brings each vector to the
shard's largest norm. Equal vectors are one node, so copies neither fill a node's edges nor
cut the graph.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arealens.llm.common import pack, stored, unpack

SHARD_ROWS = 8192
QUERY_BLOCK = 1024
GROUP_QUERIES = 16_384
DEGREE = 32
BEAM = 64
QUERY_BEAM = 128
ALPHA = 1.2
BATCH = 256


class Graph:
    """A directed graph over unit vectors, built and searched for many vectors at a time."""

    def __init__(self, x: np.ndarray, edges: np.ndarray | None = None, start: int | None = None):
        self.x = x
        self.start = int(np.argmax(x @ x.mean(axis=0))) if start is None else start
        self.edges = edges if edges is not None else self._built()

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The `beam` nearest nodes met from the start for each row of `q`, nearest first: ids (-1: none) and products."""
        n, b = len(self.x), len(q)
        rows = np.arange(b)
        ids = np.full((b, beam), -1)
        near = np.full((b, beam), -np.inf, np.float32)
        done = np.ones((b, beam), bool)
        seen = np.zeros((b, n + 1), bool)
        seen[:, n] = True  # stands for no edge
        ids[:, 0], near[:, 0], done[:, 0] = self.start, q @ self.x[self.start], False
        seen[:, self.start] = True
        while True:
            live = rows[~done.all(axis=1)]
            if not len(live):
                return ids, near
            at = np.argmin(done[live], axis=1)  # the pool is sorted, so the first open node is the nearest
            done[live, at] = True
            found = self.edges[ids[live, at]]
            fresh = ~seen[live[:, None], found]
            seen[live[:, None], found] = True
            product = np.einsum("brd,bd->br", self.x[np.minimum(found, n - 1)], q[live])
            product[~fresh] = -np.inf
            both = np.concatenate([near[live], product], axis=1)
            order = np.argsort(-both, axis=1, kind="stable")[:, :beam]
            pick = np.arange(len(live))[:, None]
            near[live] = both[pick, order]
            ids[live] = np.concatenate([ids[live], np.where(fresh, found, -1)], axis=1)[pick, order]
            done[live] = np.concatenate([done[live], ~fresh], axis=1)[pick, order]

    def _prune(self, nodes: np.ndarray, proposed: np.ndarray, alpha: float) -> np.ndarray:
        """Edges of `nodes` chosen from the proposals in their rows (-1: none, repeats allowed)."""
        n = len(self.x)
        own = np.sort(proposed, axis=1)
        own[:, 1:][own[:, 1:] == own[:, :-1]] = -1
        own[own == nodes[:, None]] = -1
        v = self.x[np.maximum(own, 0)]
        away = np.maximum(2 - 2 * np.einsum("bcd,bd->bc", v, self.x[nodes]), 0)
        away[own < 0] = np.inf
        order = np.argsort(away, axis=1, kind="stable")
        pick = np.arange(len(nodes))[:, None]
        own, away, v = own[pick, order], away[pick, order], v[pick, order]
        apart = np.maximum(2 - 2 * np.matmul(v, v.transpose(0, 2, 1)), 0)
        open_ = own >= 0
        out = np.full((len(nodes), DEGREE), n, np.int32)
        rows = np.arange(len(nodes))
        for k in range(DEGREE):
            live = open_.any(axis=1)
            if not live.any():
                break
            first = np.argmax(open_, axis=1)
            out[live, k] = own[rows, first][live]
            open_ &= alpha * alpha * apart[rows, first] > away
            open_[rows, first] = False
        return out

    def _built(self) -> np.ndarray:
        n = len(self.x)
        rng = np.random.default_rng(n)
        self.edges = rng.integers(0, n, (n, DEGREE)).astype(np.int32)
        self.edges[self.edges == np.arange(n)[:, None]] = n
        self.edges[:, DEGREE // 2:] = n
        for i in range(0, n, 4096):  # an edge twice in a row would be met twice in one step
            part = np.sort(self.edges[i:i + 4096], axis=1)
            part[:, 1:][part[:, 1:] == part[:, :-1]] = n
            self.edges[i:i + 4096] = part
        for alpha in (1.0, ALPHA):
            order = rng.permutation(n)
            for at in range(0, n, BATCH):
                nodes = order[at:at + BATCH]
                met, _ = self.search(self.x[nodes], min(BEAM, n))
                old = np.where(self.edges[nodes] == n, -1, self.edges[nodes])
                self.edges[nodes] = self._prune(nodes, np.concatenate([met, old], axis=1), alpha)
                self._back(nodes, alpha)
        return self.edges

    def _back(self, nodes: np.ndarray, alpha: float) -> None:
        """Edges back from the neighbours of `nodes`; neighbours with too many are pruned."""
        n = len(self.x)
        to = self.edges[nodes].ravel()
        origin = np.repeat(nodes, DEGREE)[to < n]
        to = to[to < n]
        order = np.argsort(to, kind="stable")
        to, origin = to[order], origin[order]
        heads = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else np.zeros(0, int)
        sizes = np.diff(np.r_[heads, len(to)])
        for i in range(0, len(heads), BATCH):
            some, width = heads[i:i + BATCH], sizes[i:i + BATCH]
            grid = np.full((len(some), int(width.max())), -1)
            inside = np.arange(grid.shape[1]) < width[:, None]
            grid[inside] = origin[np.concatenate([np.arange(h, h + w) for h, w in zip(some, width)])]
            targets = to[some]
            all_of = np.concatenate([np.where(self.edges[targets] == n, -1, self.edges[targets]), grid], axis=1)
            self.edges[targets] = self._prune(targets, all_of, alpha)


def _unit(x: np.ndarray) -> np.ndarray:
    """Vectors with one more component that brings all to the largest norm, then scaled to 1."""
    square = (x * x).sum(axis=1)
    most = square.max()
    return (np.concatenate([x, np.sqrt(np.maximum(most - square, 0))[:, None]], axis=1) / np.sqrt(most)).astype(np.float32)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def usable(vec: Column) -> Column:
    """Whether a vector has only finite components that are not all zero."""
    whole = F.forall(vec, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    return F.coalesce(vec.isNotNull() & whole & F.exists(vec, lambda v: v != 0), F.lit(False))


def build_index(vectors: DataFrame, id_col: str, vec_col: str, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int, int]:
    """Graphs of all usable vectors as a written table (shard, body), the number of shards, and the vectors' length.

    Only vectors of the commonest length take part. Rows are dealt out by position, so rows
    that repeat one id or one vector are spread over the shards.
    """
    good = vectors.where(usable(F.col(vec_col))).select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    sizes = good.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not sizes:
        return vectors.sparkSession.createDataFrame([], "shard int, body binary"), 0, 0
    dims, rows = sizes[0]["d"], sizes[0]["n"]
    shards = -(-rows // shard_rows)
    place = F.monotonically_increasing_id()
    dealt = stored(good.where(F.size("vec") == dims).withColumn("shard", F.pmod(place + F.shiftright(place, 33), F.lit(shards)).cast("int")))

    def build(table: pa.Table) -> pa.Table:
        x = _matrix(table["vec"])
        ids = table["id"].to_numpy(zero_copy_only=False)
        distinct, node = np.unique(x, axis=0, return_inverse=True)
        graph = Graph(_unit(distinct))
        by = np.lexsort((ids, node))
        body = pack(pa.table({
            "vec": pa.FixedSizeListArray.from_arrays(pa.array(distinct.ravel()), dims),
            "edges": pa.FixedSizeListArray.from_arrays(pa.array(graph.edges.ravel()), DEGREE),
            "ids": pa.array(np.split(ids[by], np.cumsum(np.bincount(node.ravel(), minlength=len(distinct)))[:-1]), pa.list_(pa.int64())),
        }).replace_schema_metadata({"start": str(graph.start)}))
        return pa.table({"shard": table["shard"].slice(0, 1), "body": pa.array([body], pa.binary())})

    return stored(dealt.groupBy("shard").applyInArrow(build, "shard int, body binary")), shards, dims


def search(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20,
           shard_rows: int = SHARD_ROWS, beam: int = QUERY_BEAM) -> DataFrame:
    """The `k` vectors of largest inner product found for each query, the query's own id left out.

    Returns (query_id, rank, vec_id, score), nearest first, ties to the smaller id; scores are
    exact inner products in double precision. Vectors that are null, zero, of another length
    than most, or hold null or non-finite components take no part. Of query rows that share
    an id the one with the least vector asks; null ids ask nothing and are not found. Empty
    tables give an empty table; other columns are ignored.
    """
    index, shards, dims = build_index(vectors.where(F.col(id_col).isNotNull()), id_col, vec_col, shard_rows)
    result = "query_id long, vec_id long, score double"
    asked = queries.where(usable(F.col(vec_col)) & F.col(id_col).isNotNull() & (F.size(vec_col) == dims))
    one = stored(asked.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(F.col(vec_col).cast("array<double>")).alias("vec")))

    def fold(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, QUERY_BLOCK):
                body = pack(pa.Table.from_batches([batch.slice(at, QUERY_BLOCK)]))
                yield pa.RecordBatch.from_pydict({"block": pa.array([part << 20 | n], pa.int64()), "queries": pa.array([body], pa.binary())})
                n += 1

    groups = max(1, -(-one.count() // GROUP_QUERIES))
    blocks = one.mapInArrow(fold, "block long, queries binary").withColumn("part", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int"))
    # The stated queries meet every shard in blocks.
    blocks = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(max(shards - 1, 0)))))
    graphs = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def walk(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[pa.Table] = []
        for body in left["body"].to_pylist() if right.num_rows else []:
            table = unpack(body)
            x, edges = _matrix(table["vec"]), _matrix(table["edges"]).astype(np.int32)
            members = table["ids"].combine_chunks()
            ends = members.offsets.to_numpy()
            ids = members.flatten().to_numpy()
            graph = Graph(_unit(x), edges, int(table.schema.metadata[b"start"]))
            for packed in right["queries"].to_pylist():
                own = unpack(packed)
                q, names = _matrix(own["vec"]), own["id"].to_pylist()
                for at in range(0, len(q), BATCH):
                    some = q[at:at + BATCH]
                    unit = np.concatenate([some / np.linalg.norm(some, axis=1)[:, None], np.zeros((len(some), 1))], axis=1).astype(np.float32)
                    met, _ = graph.search(unit, min(max(beam, k + 1), len(x)))
                    for name, vec, nodes in zip(names[at:at + BATCH], some, met):
                        nodes = nodes[nodes >= 0]
                        exact = (x[nodes] * vec).sum(axis=1)
                        score, found = [], []
                        for s, node in zip(exact.tolist(), nodes.tolist()):
                            near = [i for i in ids[ends[node]:min(ends[node + 1], ends[node] + k + 1)].tolist() if i != name]
                            found += near
                            score += [s] * len(near)
                        best = np.lexsort((found, -np.array(score)))[:k]
                        out.append(pa.table({"query_id": pa.array([name] * len(best), pa.int64()), "vec_id": pa.array(np.array(found, np.int64)[best], pa.int64()),
                                             "score": pa.array(np.array(score)[best], pa.float64())}))
        return pa.concat_tables(out) if out else pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})

    found = graphs.groupBy("shard", "part").cogroup(blocks.groupBy("shard", "part")).applyInArrow(walk, result)
    # At most k rows per query and shard.
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
