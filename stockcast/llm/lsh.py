"""Approximate nearest neighbours by multiprobe p-stable hashing.

Largest inner product becomes nearest Euclidean neighbour on the unit sphere:
rows are divided by M, the largest norm of their band, and get one more
component that fills them up to norm 1; queries are divided by their own norm.
A band holds the rows of a shard whose squared norms round to the same power
of two, so a few long vectors do not draw the others to the pole; a query's
probes are the same in every band.
Each of ``tables`` hash tables cuts ``functions`` random Gaussian projections
into slots of width ``width``. A query visits, in
every table, the ``probes`` buckets with the best estimated success: moving a
slot down or up costs the squared distance to that slot's edge, and buckets
are taken in order of total cost. Candidates of all tables are merged, scored
exactly in double precision on the original vectors, and ranked. Bands of fewer
than ``SMALL`` distinct vectors are candidates of every query, and a query that
found fewer than k rows in a shard is scored against all rows of that shard, so
it gets min(k, candidates) rows whatever its probes hit.

Every row is indexed. The tables are kept per shard, and shards are dealt by a
hash of vec_id and vector, so a bucket that holds a third of all rows is spread over all
shards. Equal vectors of a shard are one entry with its k + 1 smallest ids,
which is all that a top-k with ties to the smaller id can need.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null vec_id, take no part; vectors of another
dimension are no candidates; rows that repeat an id and vector count once; a
row is never a candidate of a query with its own vec_id; a query id with
several vectors is asked with the smallest one; ties go to the smaller vec_id;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import product

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast.llm.common import cut
from stockcast.llm.tiles import deal, pack_shards, packed, ranked, search_tiles, vectors

TABLES, FUNCTIONS, WIDTH, PROBES, SEED = 8, 6, 1.6, 96, 20240101
SMALL = 256  # bands with fewer distinct vectors are scored whole
SCORES, GROUP = 4_000_000, 1024  # scores and queries held at once


def norms(v: np.ndarray) -> np.ndarray:
    """Euclidean norms, also where the squares are too large or too small for a double."""
    big = np.abs(v).max(axis=1)
    return big * np.sqrt(((v / big[:, None]) ** 2).sum(axis=1))


class Hashes:
    """The projections of all tables for one dimension."""

    def __init__(self, dim: int, tables: int, functions: int, width: float):
        rng = np.random.default_rng([SEED, dim])
        self.a = rng.normal(size=(tables, dim + 1, functions))
        self.width = width
        self.b = rng.uniform(0, width, size=(tables, functions))
        self.mix = rng.integers(1, 2 ** 62, size=functions, dtype=np.int64) * 2 + 1
        self.moves = np.array(list(product((0, -1, 1), repeat=functions)), np.int64)

    def places(self, table: int, v: np.ndarray, top: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(slot, place inside the slot from 0 to 1) of every projection; ``top`` is M of each row, a query's own norm."""
        extra = np.sqrt(np.maximum(0.0, 1.0 - (norms(v) / top) ** 2))
        p = (np.column_stack([v / top[:, None], extra]) @ self.a[table] + self.b[table]) / self.width
        slot = np.floor(p)
        return slot.astype(np.int64), p - slot

    def keys(self, slots: np.ndarray) -> np.ndarray:
        """One number per slot combination; two that share a number share a bucket."""
        return (slots * self.mix).sum(axis=-1)

    def probes(self, table: int, q: np.ndarray, many: int) -> np.ndarray:
        """Bucket keys of each query, best first."""
        slot, inside = self.places(table, q, norms(q))
        cost = inside ** 2 @ (self.moves == -1).T + (1 - inside) ** 2 @ (self.moves == 1).T
        many = min(many, len(self.moves))
        best = np.argsort(cost, axis=1, kind="stable")[:, :many]
        return self.keys(slot[:, None, :] + self.moves[best])


def build(ids: np.ndarray, v: np.ndarray, hashes: Hashes, keep: int) -> bytes:
    """Index of a shard: distinct vectors, their smallest ids, and bucket keys in every table."""
    distinct, which = np.unique(v, axis=0, return_inverse=True)
    which = which.reshape(-1)
    order = np.lexsort((ids, which))
    first = np.flatnonzero(np.diff(which[order], prepend=-1))
    nth = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    order = order[nth < keep]
    norm = norms(distinct)
    _, band, many = np.unique(np.rint(2 * np.log2(norm)), return_inverse=True, return_counts=True)
    top = np.zeros(len(many))
    np.maximum.at(top, band, norm)
    keys = np.stack([hashes.keys(hashes.places(t, distinct, top[band])[0]) for t in range(len(hashes.a))])
    return packed(v=distinct, ids=ids[order], of=which[order], keys=keys, whole=np.flatnonzero(many[band] < SMALL))


def search(shard: dict, ids: np.ndarray, q: np.ndarray, hashes: Hashes, probes: int, k: int) -> tuple:
    v, names, of, keys = shard["v"], shard["ids"], shard["of"], shard["keys"]
    start = np.searchsorted(of, np.arange(len(v) + 1))
    orders = np.argsort(keys, axis=1, kind="stable")
    many, by_name = np.diff(start), np.sort(names)
    out: tuple[list, list, list] = ([], [], [])
    step = max(1, min(GROUP, SCORES // max(1, len(v))))
    for at in range(0, len(ids), step):
        part = q[at:at + step]
        score = np.full((len(part), len(v)), -np.inf)
        score[:, shard["whole"]] = part @ v[shard["whole"]].T
        for t in range(len(keys)):
            order = orders[t]
            held, edge = np.unique(keys[t][order], return_index=True)
            edge = np.append(edge, len(order))
            asked = hashes.probes(t, part, probes)
            where = np.minimum(np.searchsorted(held, asked), len(held) - 1)
            who, nth = np.nonzero(held[where] == asked)
            bucket = where[who, nth]
            by = np.argsort(bucket, kind="stable")
            who, bucket = who[by], bucket[by]
            cuts = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                rows = order[edge[bucket[a]]:edge[bucket[a] + 1]]
                score[np.ix_(who[a:b], rows)] = part[who[a:b]] @ v[rows].T
        own = np.searchsorted(by_name, ids[at:at + step], "right") - np.searchsorted(by_name, ids[at:at + step], "left")
        few = np.flatnonzero((score > -np.inf) @ many < k + own)
        score[few] = part[few] @ v.T
        for i in range(len(part)):
            _ranked(score[i], part[i], ids[at + i], v, names, start, k, out)
    return tuple(np.concatenate(x) if x else [] for x in out)


def _ranked(score, q, own, v, names, start, k, out) -> None:
    """Append the k best of one query: all candidates that may be among them are scored again, one sum per pair."""
    near = np.flatnonzero(score > -np.inf)
    if len(near) > k + 1:
        edge = np.partition(score[near], len(near) - k - 1)[len(near) - k - 1]  # its own vector may be one of them
        near = near[score[near] >= edge - 1e-9 * (1 + abs(edge))]
    exact = (v[near] * q).sum(axis=1)
    n = start[near + 1] - start[near]
    entry = np.repeat(start[near] - np.cumsum(n) + n, n) + np.arange(n.sum())
    who, s = names[entry], np.repeat(exact, n)
    other = who != own
    who, s = who[other], s[other]
    best = np.lexsort((who, -s))[:k]
    out[0].append(np.full(len(best), own))
    out[1].append(who[best])
    out[2].append(s[best])


def nearest(embeddings: DataFrame, every: int = 20, k: int = 20, tables: int = TABLES, functions: int = FUNCTIONS,
            width: float = WIDTH, probes: int = PROBES) -> DataFrame:
    """query_id, rank, vec_id, score for the rows whose vec_id is divisible by ``every``."""
    rows = vectors(embeddings, lambda x: x, nonzero=True)
    dealt, queries, shards = deal(rows, every)

    def hashes(dim: int) -> Hashes:
        return Hashes(dim, tables, functions, width)

    index = pack_shards(dealt, lambda ids, v: build(ids, v, hashes(v.shape[1]), k + 1), "float64")
    queries = queries.withColumn("shards", F.sequence(F.lit(0), F.lit(shards - 1)))
    found = search_tiles(index, cut(queries),
                         lambda shard, ids, q: search(shard, ids, q, hashes(q.shape[1]), probes, k), [], "double")
    return ranked(found, k)
