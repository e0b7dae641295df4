"""Vectors dealt into shards and blocks of queries; one task works on one (shard, block) tile.

Rows that repeat an id and a vector are reduced to one before anything is
dealt. Shards are dealt by a hash of id and vector (``deal``), which spreads a
hot id, vector or cluster over all of them, or by coarse clusters that are split
by that hash where they are large (``deal_clusters``). Each shard is packed (with its index) into one row once;
a tile joins that row with one block of queries, if one of them asks for it. Shards and blocks have a
bounded number of rows, and their number grows with the input.
"""

from __future__ import annotations

import io
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockcast.llm.common import cut, ship_package, slices

SHARD_ROWS = 65_536
SHARD_LEAST = 4_096
BLOCK_ROWS = 4_096
PIVOTS = 64           # clusters: the sample of vectors that rows are dealt to by nearness
TILES = 1_000_000     # (shard, block) pairs that may be broadcast


def vectors(embeddings: DataFrame, part: Callable[[Column], Column], nonzero: bool = False) -> DataFrame:
    """vec_id, v, dim: rows whose vector and vec_id are usable; ``part`` maps a component (double) to a number."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"),
                             F.col("embedding").cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).filter(~bad)
    if nonzero:
        rows = rows.filter(F.exists("v", lambda x: x != 0))
    return rows.select("vec_id", F.transform("v", part).alias("v"), F.size("v").alias("dim"))


def packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as z:
        return dict(z)


def matrix(table: pa.Table, column: str, dim: int) -> np.ndarray:
    values = table.column(column).combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """Each (vec_id, v) once; an id or a vector that repeats without end is reduced where it lies."""
    return rows.dropDuplicates(["vec_id", "v"])


def _spread(parts: Column | int) -> Column:
    """A number below ``parts`` from id and vector."""
    return F.pmod(F.xxhash64("vec_id", "v"), F.lit(parts) if isinstance(parts, int) else parts).cast("int")


def _asked(rows: DataFrame, every: int) -> DataFrame:
    return rows.filter(F.col("vec_id") % every == 0)


def deal(rows: DataFrame, every: int) -> tuple[DataFrame, DataFrame, int]:
    """(rows with their shard, queries with their block, number of shards)."""
    rows = cut(distinct_vectors(rows))
    n = rows.agg(F.count("*"), F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    shards = max(1, -(-n[0] // SHARD_ROWS), min(slices(rows.sparkSession), -(-n[0] // SHARD_LEAST)))
    blocks = max(1, -(-n[1] // BLOCK_ROWS))
    queries = (_asked(rows, every).groupBy("vec_id", "dim").agg(F.min("v").alias("v"))
               .withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int")))
    return rows.withColumn("shard", _spread(shards)), queries, shards


def deal_clusters(rows: DataFrame, every: int) -> tuple[DataFrame, DataFrame, int]:
    """As ``deal``, by nearness to at most ``PIVOTS`` sampled vectors; queries also have ``home``, a shard of their cluster."""
    ship_package(rows.sparkSession)
    rows = cut(distinct_vectors(rows))
    pivots = min(PIVOTS, max(1, rows.count() // SHARD_LEAST))
    least = F.xxhash64("vec_id", "v")
    sample = _chained([(r["dim"], r["v"]) for r in rows.withColumn("h", least).orderBy("h").limit(pivots).select("dim", "v").collect()])

    def nearest(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            out = np.zeros(len(dims), np.int32)
            for dim in np.unique(dims).tolist():
                near = [k for k, (d, _) in enumerate(sample) if d == dim]
                if near:
                    which = np.flatnonzero(dims == dim)
                    v = matrix(pa.table({"v": batch.column("v").take(pa.array(which))}), "v", dim).astype(np.float64)
                    pivots = np.array([sample[k][1] for k in near], np.float64)
                    out[which] = np.array(near, np.int32)[((pivots ** 2).sum(axis=1) - 2 * v @ pivots.T).argmin(axis=1)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("vec_id", "v", "dim")] + [pa.array(out)], names=["vec_id", "v", "dim", "pivot"])

    kind = dict(rows.dtypes)["v"]
    rows = cut(rows.select("vec_id", "v", "dim").mapInArrow(nearest, f"vec_id long, v {kind}, dim int, pivot int"))
    asks = F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("asked")
    # one row per pivot; queries of neighbouring small clusters share a block
    counts = sorted((r["pivot"], r["n"], r["asked"]) for r in rows.groupBy("pivot").agg(F.count("*").alias("n"), asks).collect())
    places, shards, block = [], 0, _Filler(BLOCK_ROWS)
    for pivot, n, asked in counts:
        parts = -(-n // SHARD_ROWS)
        places.append((pivot, shards, parts, *block.take(asked)))
        shards += parts
    table = F.broadcast(rows.sparkSession.createDataFrame(places, "pivot int, shard0 int, parts int, block0 int, block_parts int"))  # a row per pivot
    placed = rows.join(table, "pivot")
    queries = (_asked(placed, every).groupBy("vec_id", "dim").agg(F.min(F.struct("v", "shard0", "block0", "block_parts")).alias("q"))
               .select("vec_id", "dim", "q.v", (F.col("q.block0") + F.pmod(F.xxhash64("vec_id", F.lit(1)), F.col("q.block_parts"))).cast("int").alias("block"),
                       F.col("q.shard0").alias("home")))
    return placed.select("vec_id", "v", "dim", (F.col("shard0") + _spread(F.col("parts"))).cast("int").alias("shard")), queries, max(1, shards)


def _chained(sample: list[tuple[int, list]]) -> list[tuple[int, list]]:
    """The sample in an order in which the next vector is the nearest one not yet taken, dimension by dimension."""
    out: list[tuple[int, list]] = []
    left = sorted(sample, key=lambda x: x[0])
    while left:
        dim = left[0][0]
        group = np.array([v for d, v in left if d == dim], np.float64)
        rest, at = list(range(len(group))), 0
        while rest:
            rest.remove(at)
            out.append((dim, group[at]))
            if rest:
                at = rest[int(((group[rest] - group[at]) ** 2).sum(axis=1).argmin())]
        left = [x for x in left if x[0] != dim]
    return out


class _Filler:
    """Numbers bins of about ``size`` rows: small groups share one, a large group gets several of its own."""

    def __init__(self, size: int):
        self.size, self.bins, self.room = size, 1, size

    def take(self, rows: int) -> tuple[int, int]:
        """(first bin, number of bins) of a group."""
        if rows > self.room and self.room < self.size:
            self.bins, self.room = self.bins + 1, self.size
        first, parts = self.bins - 1, max(1, -(-rows // self.size))
        self.bins += parts - 1
        self.room = self.room - rows if parts == 1 else 0
        return first, parts


def pack_shards(dealt: DataFrame, build: Callable[[np.ndarray, np.ndarray], bytes], kind: str) -> DataFrame:
    """dim, shard, data: ``build(ids, vectors)`` of each shard, as one row."""
    ship_package(dealt.sparkSession)

    def run(key, t):
        dim = key[0].as_py()
        ids = t.column("vec_id").to_numpy()
        v = matrix(t, "v", dim).astype(kind)
        # rows that repeat count once
        order = np.lexsort((*v.T, ids))
        ids, v = ids[order], v[order]
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (v[1:] != v[:-1]).any(axis=1)
        return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int32()),
                         "data": pa.array([build(ids[new], v[new])], pa.binary())})

    return cut(dealt.groupBy("dim", "shard").applyInArrow(run, "dim int, shard int, data binary"))


def search_tiles(packed_shards: DataFrame, queries: DataFrame, search: Callable[..., tuple], extra: list[str], score: str) -> DataFrame:
    """query_id, vec_id, score: ``search(shard data, query ids, query matrix, extras)`` of every tile that is asked for.

    queries: vec_id, dim, v, block, shards (array of shards to visit) and the ``extra`` columns.
    """
    asked = queries.select("vec_id", "dim", "v", "block", F.explode("shards").alias("shard"), *extra)
    tiles = cut(asked.select(*(F.col(c).alias(f"of_{c}") for c in ("dim", "shard", "block"))).distinct())
    small = tiles.limit(TILES + 1).count() <= TILES
    same = (F.col("dim") == F.col("of_dim")) & (F.col("shard") == F.col("of_shard"))
    every = packed_shards.join(F.broadcast(tiles) if small else tiles, same).select("dim", "shard", F.col("of_block").alias("block"), "data")

    def run(key, left, right):
        got = ([], [], [])
        if left.num_rows and right.num_rows:
            dim = key[0].as_py()
            got = search(unpacked(left.column("data")[0].as_py()), right.column("vec_id").to_numpy(),
                         matrix(right, "v", dim), *(right.column(c).to_numpy(zero_copy_only=False) for c in extra))
        kind = pa.int64() if score == "long" else pa.float64()
        return pa.table({"query_id": pa.array(got[0], pa.int64()), "vec_id": pa.array(got[1], pa.int64()),
                         "score": pa.array(got[2], kind)})

    keys = ("dim", "shard", "block")
    return every.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(
        run, f"query_id long, vec_id long, score {score}")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of each query, ties to the smaller vec_id."""
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
