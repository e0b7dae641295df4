"""Exact top-k inner products by branch and bound over a ball tree in each shard.

A node is a range of the shard's vectors with a centre and a radius; no vector
in it scores more than ``q.c + |q| r``. Queries descend in groups: at a node
each group splits by which child has the higher bound and visits that child
first, then the other one if its bound still reaches the current k-th score.
The k-th score is shared: each query first searches one home shard, and the
k-th score found there is where all other shards start pruning. Shards are
coarse clusters, and the same bound on a shard's root ball decides beforehand
which of them a query is sent to at all; tiles that no query asks for are not
shipped.

Scores are integers and exact: components become floor(scale * x), products
are summed in double precision where every partial sum is below 2**53, else
in 64-bit integers; larger components raise.

Defined results: vectors that are null, empty or hold null or non-finite
components, and rows with a null vec_id, take no part; vectors of another
dimension are no candidates; rows that repeat an id and vector count once; a
row is never a candidate of a query with its own vec_id; a query id with
several vectors is asked with the smallest one; ties go to the smaller vec_id;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast.llm.common import cut
from stockcast.llm.tiles import deal_clusters, matrix, pack_shards, packed, ranked, search_tiles, unpacked, vectors

LEAF = 128
GROUP = 1024
ROOT_BYTES = 64 * 1024 * 1024  # root balls of all shards that tasks may hold at once


def build(ids: np.ndarray, v: np.ndarray) -> bytes:
    """Ball tree over integer vectors: halves at the median of the widest component, down to ``LEAF`` rows."""
    if len(v) and float(np.abs(v).max()) > 2.0 ** 31 / max(1, v.shape[1]) ** 0.5:
        raise ValueError("components are too large for exact 64-bit scores")
    order = np.arange(len(ids))
    nodes: list[tuple[int, int, int, int]] = []  # start, end, left child, right child
    centres, radii = [], []
    todo = [(0, len(ids), -1, 0)]
    while todo:
        a, b, parent, side = todo.pop()
        rows = v[order[a:b]].astype(np.float64)
        c = rows.mean(axis=0) if b > a else np.zeros(v.shape[1])
        me = len(nodes)
        nodes.append((a, b, -1, -1))
        centres.append(c)
        radii.append(float(np.sqrt(((rows - c) ** 2).sum(axis=1).max())) if b > a else 0.0)
        if parent >= 0:
            nodes[parent] = (*nodes[parent][:2], me, nodes[parent][3]) if side == 0 else (*nodes[parent][:3], me)
        if b - a > LEAF:
            wide = int(np.argmax(rows.max(axis=0) - rows.min(axis=0)))
            m = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(rows[:, wide], m)]
            todo += [(a, a + m, me, 0), (a + m, b, me, 1)]
    return packed(ids=ids[order], v=v[order], nodes=np.array(nodes, np.int64), c=np.array(centres), r=np.array(radii))


class Search:
    """Branch and bound of a group of queries over one tree."""

    def __init__(self, tree: dict, ids: np.ndarray, q: np.ndarray, k: int, floor: np.ndarray):
        self.ids, self.v, self.nodes, self.c, self.r = (tree[x] for x in ("ids", "v", "nodes", "c", "r"))
        self.qid, self.k = ids, k
        top = max(float(np.abs(self.v).max(initial=0)), float(np.abs(q).max(initial=0)))
        kind = np.float64 if top * top * q.shape[1] < 2 ** 53 else np.int64
        self.q, self.v = q.astype(kind), self.v.astype(kind)
        self.qf = q.astype(np.float64)
        self.norm = np.sqrt((self.qf ** 2).sum(axis=1))
        self.score = np.full((len(ids), k), np.iinfo(np.int64).min, np.int64)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max, np.int64)
        self.floor = floor  # the k-th score known from elsewhere

    def kth(self, g: np.ndarray) -> np.ndarray:
        return np.maximum(self.score[g, -1], self.floor[g]).astype(np.float64)

    def bound(self, g: np.ndarray, node: int) -> np.ndarray:
        b = self.qf[g] @ self.c[node] + self.norm[g] * self.r[node]
        return b + 1e-9 * (1 + np.abs(b) + self.norm[g] * (self.r[node] + 1))

    def leaf(self, g: np.ndarray, a: int, b: int) -> None:
        s = (self.q[g] @ self.v[a:b].T).astype(np.int64)
        own = self.qid[g][:, None] == self.ids[None, a:b]
        s[own] = np.iinfo(np.int64).min
        some = np.flatnonzero(s.max(axis=1) >= np.maximum(self.score[g, -1], self.floor[g]))
        if not len(some):
            return
        g, s = g[some], s[some]
        allow = np.concatenate([self.score[g], s], axis=1)
        names = np.concatenate([self.found[g], np.broadcast_to(self.ids[a:b], s.shape)], axis=1)
        names = np.where(allow == np.iinfo(np.int64).min, np.iinfo(np.int64).max, names)
        best = np.lexsort((names, -np.maximum(allow, -np.iinfo(np.int64).max)), axis=1)[:, :self.k]
        self.score[g], self.found[g] = np.take_along_axis(allow, best, 1), np.take_along_axis(names, best, 1)

    def visit(self) -> None:
        stack = [(0, np.arange(len(self.qid)))]
        while stack:
            node, g = stack.pop()
            g = g[self.bound(g, node) >= self.kth(g)]
            if not len(g):
                continue
            a, b, left, right = self.nodes[node]
            if left < 0:
                if b > a:
                    self.leaf(g, a, b)
                continue
            first = self.bound(g, left) >= self.bound(g, right)
            # the last pushed is visited first
            for near, far, part in ((left, right, g[first]), (right, left, g[~first])):
                if len(part):
                    stack += [(far, part), (near, part)]


def search(tree: dict, ids: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int) -> tuple:
    out: tuple[list, list, list] = ([], [], [])
    for at in range(0, len(ids), GROUP):
        s = Search(tree, ids[at:at + GROUP], q[at:at + GROUP], k, floor[at:at + GROUP])
        s.visit()
        ok = s.found != np.iinfo(np.int64).max
        out[0].append(np.broadcast_to(s.qid[:, None], ok.shape)[ok])
        out[1].append(s.found[ok])
        out[2].append(s.score[ok])
    return tuple(np.concatenate(x) for x in out)


def bounds(q: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """Upper bound of every query's (row) score in every ball (column)."""
    norm = np.sqrt((q ** 2).sum(axis=1))[:, None]
    b = q @ centres.T + norm * radii
    return b + 1e-9 * (1 + np.abs(b) + norm * (radii + 1))


def _roots(trees: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] | None:
    """dim -> (shards, centres, radii) of the root balls; None if they are too many to hold."""

    def root(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tree = unpacked(batch.column("data")[i].as_py())
                yield pa.RecordBatch.from_arrays([batch.column("dim").slice(i, 1), batch.column("shard").slice(i, 1),
                                                  pa.array([tree["c"][0].tolist()], pa.list_(pa.float64())), pa.array([float(tree["r"][0])])],
                                                 names=["dim", "shard", "c", "r"])

    found = cut(trees.mapInArrow(root, "dim int, shard int, c array<double>, r double"))
    size = found.agg(F.coalesce(F.sum(F.col("dim") + 4), F.lit(0))).first()[0] * 8
    if size > ROOT_BYTES:
        return None
    out: dict[int, list] = {}
    for r in found.orderBy("dim", "shard").collect():
        out.setdefault(r["dim"], []).append((r["shard"], r["c"], r["r"]))
    return {d: (np.array([s for s, _, _ in x], np.int32), np.array([c for _, c, _ in x]), np.array([r for _, _, r in x])) for d, x in out.items()}


def shards_to_visit(queries: DataFrame, trees: DataFrame, shards: int) -> DataFrame:
    """``queries`` with ``shards``: those other than ``home`` whose root ball may reach the query's ``floor``."""
    roots = _roots(trees)
    if roots is None:
        return queries.withColumn("shards", F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != F.col("home")))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, home, floor = (batch.column(c).to_numpy() for c in ("dim", "home", "floor"))
            out: list = [None] * len(dims)
            for dim in np.unique(dims).tolist():
                which = np.flatnonzero(dims == dim)
                names, centres, radii = roots[dim]
                q = matrix(pa.table({"v": batch.column("v").take(pa.array(which))}), "v", dim).astype(np.float64)
                reach = bounds(q, centres, radii) >= floor[which].astype(np.float64)[:, None]
                for i, ok in zip(which.tolist(), reach & (names != home[which][:, None]), strict=True):
                    out[i] = names[ok].tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int32()))], names=[*batch.schema.names, "shards"])

    ddl = ", ".join(f"{n} {t}" for n, t in queries.dtypes)
    return queries.mapInArrow(visit, f"{ddl}, shards array<int>")


def top_k(embeddings: DataFrame, every: int = 50, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose vec_id is divisible by ``every``."""
    rows = vectors(embeddings, lambda x: F.floor(x * scale).cast("long"))
    dealt, queries, shards = deal_clusters(rows, every)
    trees = pack_shards(dealt, build, "int64")
    none = F.lit(np.iinfo(np.int64).min).cast("long")
    queries = cut(queries.withColumn("floor", none))

    def run(tree, ids, q, floor):
        return search(tree, ids, q, floor, k)

    first = cut(search_tiles(trees, queries.withColumn("shards", F.array("home")), run, ["floor"], "long"))
    if shards == 1:
        return ranked(first, k)
    floors = first.groupBy("query_id").agg(F.min("score").alias("floor"), F.count("*").alias("n"))
    known = queries.drop("floor").join(
        floors.filter(F.col("n") >= k).select(F.col("query_id").alias("vec_id"), "floor"), "vec_id", "left")
    known = known.withColumn("floor", F.coalesce("floor", none))
    rest = search_tiles(trees, cut(shards_to_visit(known, trees, shards)), run, ["floor"], "long")
    return ranked(first.unionByName(rest), k)


OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""
