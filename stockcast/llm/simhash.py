"""SimHash fingerprints and their near-duplicate classes by a binary trie self-join.

Fingerprint: A-Z lower-cased, words are runs without white space (space and
the bytes 9 to 13), shingles of ``width`` words joined by a space (a shorter
text is one shingle, a text without words has fingerprint zero), XXH64 with
seed 42 of each; a bit is set if it is set in over half of the hashes.

Join: distinct fingerprints are dealt by each of ``budget + 1`` bit blocks, one
of which must be equal in any two that link. The fingerprints with one block
value form a binary trie over the remaining bits (their sorted order). Pairs
of trie nodes are walked together from (root, root): the children of both
sides are paired, each pairing of unequal bits adds one to the differing bits,
and a pair over the budget is dropped with all below it. Leaf pairs are links.

Only a spanning forest of the links of a task leaves it, so output is at most
one row per fingerprint and block however large a group is. A block value
with more than ``HOT_GROUP`` fingerprints is split: by the bits that divide
it best, each fingerprint goes to the pairs of sub-codes within the budget,
so no task holds the whole group and no pair is lost.

Components of the link graph come from alternating large-star and small-star
rounds over shuffled tables (checkpointed; nothing of it reaches the driver
but a count).

Defined results: null text has no words; texts of any length are read whole; a
null doc_id is a document like any other (the smallest known doc_id names its class; null if there is none);
rows that repeat are one class; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast.llm.common import cut, ship_package
from stockcast.llm.words import some

BITS = 64
HOT_GROUP = 512
LEAF_PAIRS = 64
FRONTIER = 1 << 16
SALTS = 8

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: str | None, width: int) -> int:
    """Unsigned 64-bit fingerprint of a text."""
    import xxhash

    words = (text or "").encode().translate(_LOWER).split()  # bytes.split cuts at space and 9 to 13
    if not words:
        return 0
    if len(words) <= width:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)], np.uint64)
    else:
        digest, join = xxhash.xxh64_intdigest, b" ".join
        hashes = np.array([digest(join(g), 42) for g in zip(*(words[i:] for i in range(width)))], np.uint64)  # noqa: B905
    set_ = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at:at + 8192].view(np.uint8).reshape(-1, 8)
        set_ += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * set_ > len(hashes)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def fingerprints(documents: DataFrame, width: int = 3) -> DataFrame:
    """doc_id, text_hash, fp (the 64 bits as a signed long) of whole texts."""
    ship_package(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in some(batch):
                fps = np.array([fingerprint(t, width) for t in part.column(1).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(fps.view(np.int64))],
                                                 names=["doc_id", "text_hash", "fp"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.withColumn("text_hash", F.xxhash64("text")).mapInArrow(run, "doc_id long, text_hash long, fp long")


def blocks(budget: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of the ``budget + 1`` blocks."""
    edges = [round(i * BITS / (budget + 1)) for i in range(budget + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]  # noqa: B905


def trie_links(keys: np.ndarray, roots: list[tuple[int, int, int, int]], budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of sorted unsigned ``keys`` within ``budget`` bits, for root pairs (lo, hi, lo, hi) of key ranges.

    A node is a range of keys equal above its depth; a node pair carries the
    bits that differ so far.
    """
    start = np.array(roots, np.int64).reshape(-1, 4)
    stack = [(start[i:i + FRONTIER], np.zeros(len(start[i:i + FRONTIER]), np.int64), BITS - 1)
             for i in range(0, len(start), FRONTIER)]
    while stack:
        pairs, diff, bit = stack.pop()
        size = (pairs[:, 1] - pairs[:, 0]) * (pairs[:, 3] - pairs[:, 2])
        done = size <= LEAF_PAIRS if bit >= 0 else np.ones(len(pairs), bool)
        if done.any():
            p = pairs[done]
            wide = p[:, 3] - p[:, 2]
            n = size[done]
            which = np.repeat(np.arange(len(p)), n)
            nth = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            a, b = p[which, 0] + nth // wide[which], p[which, 2] + nth % wide[which]
            ok = (np.bitwise_count(keys[a] ^ keys[b]) <= budget) & (a < b)
            if ok.any():
                yield a[ok], b[ok]
        pairs, diff = pairs[~done], diff[~done]
        if not len(pairs):
            continue
        # where the bit turns to one inside each range: keys below share the bits above
        mids = []
        for lo, hi in ((pairs[:, 0], pairs[:, 1]), (pairs[:, 2], pairs[:, 3])):
            turn = ((keys[lo] >> np.uint64(bit)) | np.uint64(1)) << np.uint64(bit)
            mids.append(np.clip(np.searchsorted(keys, turn), lo, hi))
        m1, m2 = mids
        same = (pairs[:, 0] == pairs[:, 2]) & (pairs[:, 1] == pairs[:, 3])
        zero = np.stack([pairs[:, 0], m1, pairs[:, 2], m2], 1), diff
        one = np.stack([m1, pairs[:, 1], m2, pairs[:, 3]], 1), diff
        cross = np.stack([pairs[:, 0], m1, m2, pairs[:, 3]], 1), diff + 1
        back = np.stack([m1, pairs[:, 1], pairs[:, 2], m2], 1)[~same], (diff + 1)[~same]
        nxt = np.concatenate([x[0] for x in (zero, one, cross, back)])
        errs = np.concatenate([x[1] for x in (zero, one, cross, back)])
        keep = (errs <= budget) & (nxt[:, 1] > nxt[:, 0]) & (nxt[:, 3] > nxt[:, 2])
        nxt, errs = nxt[keep], errs[keep]
        for i in range(0, len(nxt), FRONTIER):
            stack.append((nxt[i:i + FRONTIER], errs[i:i + FRONTIER], bit - 1))


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = int(up[x])
        return x

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            x, y = self.find(x), self.find(y)
            if x != y:
                self.up[max(x, y)] = min(x, y)


def local_edges(fp: np.ndarray, group: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges (signed) of the links inside each group of unsigned fingerprints."""
    order = np.lexsort((fp, group))
    fp, group = fp[order], group[order]
    cuts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
    big = [(int(a), int(b)) for a, b in zip(cuts, cuts[1:]) if b - a > 1]  # noqa: B905
    forest = Forest(len(fp))
    small = [(a, b, a, b) for a, b in big if (b - a) ** 2 <= LEAF_PAIRS]  # compared at the root, in one go
    for x, y in trie_links(fp, small, budget):
        forest.join(x, y)
    for a, b in big:
        if (b - a) ** 2 <= LEAF_PAIRS:
            continue
        for x, y in trie_links(fp[a:b], [(0, b - a, 0, b - a)], budget):
            forest.join(x + a, y + a)
    root = np.array([forest.find(i) for i in range(len(fp))], np.int64)
    linked = root != np.arange(len(fp))
    return fp[linked].view(np.int64), fp[root[linked]].view(np.int64)


def _block_rows(distinct: DataFrame, budget: int) -> DataFrame:
    """fp, block, value: a row per fingerprint and block."""
    parts = [F.struct(F.lit(i).alias("block"),
                      F.shiftrightunsigned("fp", low).bitwiseAND((1 << width) - 1).alias("value"))
             for i, (low, width) in enumerate(blocks(budget))]
    return distinct.select("fp", F.explode(F.array(*parts)).alias("b")).select("fp", "b.block", "b.value")


def links(distinct: DataFrame, budget: int) -> DataFrame:
    """a, b: edges that connect all fingerprints of ``distinct`` (fp) within ``budget`` bits."""
    spark = distinct.sparkSession
    ship_package(spark)
    rows = _block_rows(distinct, budget)
    ones = [F.sum(F.shiftrightunsigned("fp", i).bitwiseAND(1)).alias(f"n{i}") for i in range(BITS)]
    sizes = rows.groupBy("block", "value").agg(F.count("*").alias("n"), *ones).filter("n > 1")
    # bits that divide a hot group best, enough of them for parts of HOT_GROUP
    balance = F.array_sort(F.array(*(F.struct(F.abs(2 * F.col(f"n{i}") - F.col("n")).alias("off"), F.lit(i).alias("bit"))
                                     for i in range(BITS))))
    splits = F.when(F.col("n") > HOT_GROUP, F.ceil(F.log2(F.col("n") / HOT_GROUP)) + 1).otherwise(0).cast("int")
    sizes = cut(sizes.select("block", "value", "n",
                             F.slice(F.transform(balance, lambda s: s["bit"]), F.lit(1), splits).alias("by")))
    small = rows.join(sizes.filter(F.size("by") == 0).select("block", "value"), ["block", "value"])
    large = rows.join(sizes.filter(F.size("by") > 0).select("block", "value", "by"), ["block", "value"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row per fingerprint and pair of sub-codes within the budget that holds it."""
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                some_rows = batch.slice(at, 200)
                many, parts = [], []
                for fp, by in zip(some_rows.column(0).to_pylist(), some_rows.column(3).to_pylist(), strict=True):
                    code = sum(((fp >> bit) & 1) << j for j, bit in enumerate(by))
                    codes = [code]
                    reach = [code]
                    for _ in range(budget):
                        reach = sorted({c ^ (1 << j) for c in reach for j in range(len(by))} - set(codes))
                        codes += reach
                    many.append(len(codes))
                    parts += [(min(code, c) << 20) | max(code, c) for c in codes]
                which = pa.array(np.repeat(np.arange(len(many)), many))
                yield pa.RecordBatch.from_arrays([*(some_rows.column(i).take(which) for i in range(3)), pa.array(parts, pa.int64())],
                                                 names=["fp", "block", "value", "part"])

    wide = large.select("fp", "block", "value", "by").mapInArrow(spread, "fp long, block int, value long, part long")
    dealt = small.select("fp", "block", "value", F.lit(-1).cast("long").alias("part")).unionByName(wide)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns) for batch in batches if batch.num_rows]
        if got:
            fp = np.concatenate([g[0] for g in got]).view(np.uint64)
            group = np.concatenate([g[1] for g in got])
            a, b = local_edges(fp, group, budget)
            for i in range(0, len(a), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(a[i:i + 50_000]), pa.array(b[i:i + 50_000])], names=["a", "b"])

    # the group number only has to keep groups of one task apart; equal numbers cost time, not results
    dealt = dealt.repartition("block", "value", "part").select(
        "fp", F.xxhash64("block", "value", "part").alias("group"))
    return dealt.mapInArrow(join, "a long, b long")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, root (smallest node of its component) for the nodes of ``edges`` (a, b)."""
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if not large:
            both = both.filter("b <= a")
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        # the neighbours of one node may be a large part of all edges: they are spread over SALTS keys
        salted = both.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))
        copies = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        hooked = salted.join(copies, ["a", "salt"]).drop("salt")
        if large:
            return hooked.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        kept = hooked.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        own = least.select("a", F.col("m").alias("b"))
        return kept.unionByName(own).filter("a <> b").distinct()

    now = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    sign = None
    for _ in range(rounds):
        now = cut(star(star(now, True), False))
        seen = now.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x")).first()
        if sign == tuple(seen):
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        sign = tuple(seen)
    raise RuntimeError("components did not settle")


def _classes(documents: DataFrame, width: int, budget: int) -> tuple[DataFrame, DataFrame]:
    """(fingerprints of all rows; fp, root, least of each distinct fingerprint).

    least: struct<none, doc_id, text_hash> of the fingerprint's first document,
    by doc_id with null ones last, then by text hash.
    """
    fps = cut(fingerprints(documents, width))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    distinct = cut(fps.groupBy("fp").agg(first.alias("least")))
    roots = components(links(distinct.select("fp"), budget))
    return fps, distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))


def near_duplicates(documents: DataFrame, width: int = 3, budget: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id linked to the document, itself included."""
    fps, named = _classes(documents, width, budget)
    least = named.groupBy("root").agg(F.min("least.doc_id").alias("component_id"))
    table = named.join(least, "root").select("fp", "component_id")
    return fps.join(table, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(documents: DataFrame, width: int = 3, budget: int = 2) -> DataFrame:
    """The first document of each class (smallest doc_id, then text hash), with all columns of ``documents``."""
    _, named = _classes(documents, width, budget)
    kept = named.groupBy("root").agg(F.min("least").alias("least")).select(
        F.col("least.doc_id").alias("kept_id"), F.col("least.text_hash").alias("kept_hash"))
    rows = documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row")).select(
        "row", F.col("row.doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("row.text").cast("string")).alias("text_hash"))
    found = rows.join(kept, rows["doc_id"].eqNullSafe(kept["kept_id"]) & (rows["text_hash"] == kept["kept_hash"]), "left_semi")
    # rows that repeat a kept document's id and text are one document
    return found.dropDuplicates(["doc_id", "text_hash"]).select("row.*")
