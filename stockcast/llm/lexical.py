"""Ranked lexical search by scanning the texts: no index of the documents is built.

The terms of the items form an Aho-Corasick automaton in which every term is
guarded by a blank on either side. A text is brought to the same form (A-Z in
lower case, every byte that no term may hold a blank), so an occurrence of a
guarded term is exactly one whole term, and one walk over the text counts all
of them. The automaton's outputs are term numbers; a table of term to items
turns term counts into scores.

Items are dealt into blocks of about ``BLOCK_TERMS`` (item, term) pairs, so what
is broadcast is bounded whatever the number of items; all documents are scanned
for every block. A block takes two scans: the first counts documents, terms
and, per term, the documents that hold it (pre-aggregated per task), the second
scores each document and keeps the best ``k`` per item and task. These are
reduced per (item, slice of doc_id) and then per item, so no task receives the
candidates of all tasks for an item at once.

Defined results: a null text has no terms; a document without a doc_id takes no
part; documents that repeat a row are ranked each; a null item_id takes no part;
rows that repeat an item_id are one item with the terms of all its texts; items
without terms and items that match nothing give no rows, as do empty tables;
scores tie to the smaller doc_id; texts are scanned whole; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockcast.llm.common import cut, ship_package, slices
from stockcast.llm.words import some

#: What a term is made of, after A-Z became a-z.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BLOCK_TERMS = 100_000
KEEP_ROWS = 200_000  # candidates a task holds before it drops those below the k-th
COUNTS = "term int, n long"
HITS = "item_id long, doc_id long, score long"

_FORM = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20
              for b in range(256))


def guarded(term: bytes) -> str:
    """A term between blanks, one character per byte."""
    return f" {term.decode('latin-1')} "


def scannable(text: str | None) -> bytes:
    """The text as the automaton reads it; its terms are what stands between blanks."""
    return b" " + (text or "").encode().translate(_FORM) + b" "


class Automaton:
    """Terms of a block of items, and the items of every term (a row of numbers per term)."""

    def __init__(self, item_terms: list[tuple[int, list[str]]]):
        import ahocorasick

        self.items = np.array([i for i, _ in item_terms], np.int64)
        terms = sorted({t.encode() for _, ts in item_terms for t in ts})
        number = {t: i for i, t in enumerate(terms)}
        self.size = len(terms)
        self.machine = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for t, i in number.items():
            self.machine.add_word(guarded(t), i)
        self.machine.make_automaton()
        pairs = np.array(sorted({(number[t.encode()], k) for k, (_, ts) in enumerate(item_terms) for t in ts}), np.int64).reshape(-1, 2)
        self.edge = np.searchsorted(pairs[:, 0], np.arange(self.size + 1))
        self.of_term = pairs[:, 1]

    def count(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, term, tf) of all terms found, ordered by text and term."""
        found = np.fromiter(chain.from_iterable(self.machine.iter(b"".join(texts).decode("latin-1"))), np.int64).reshape(-1, 2)
        ends = np.cumsum([len(t) for t in texts])
        key = np.searchsorted(ends, found[:, 0], side="right") * self.size + found[:, 1]
        key, tf = np.unique(key, return_counts=True)
        return key // self.size, key % self.size, tf

    def scores(self, texts: list[bytes], lengths: list[int], weight: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
        """Score of every text (row) for every item (column)."""
        doc, term, tf = self.count(texts)
        m = np.array([100 - 50 + (50 * n * n_docs) // n_terms for n in lengths], np.int64)
        part = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
        many = self.edge[term + 1] - self.edge[term]
        out = np.zeros(len(texts) * len(self.items), np.int64)
        if len(doc):
            skip = np.cumsum(many) - many
            item = self.of_term[np.repeat(self.edge[term] - skip, many) + np.arange(many.sum())]
            np.add.at(out, np.repeat(doc, many) * len(self.items) + item, np.repeat(part, many))
        return out.reshape(len(texts), len(self.items))


class Best:
    """The ``k`` best (score, then smaller id) of each item, from any number of scored texts."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.floor = np.ones(items, np.int64)  # a score below it is not among the k best
        self.held = np.empty((3, 0), np.int64)  # item, id, score

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        row, item = np.nonzero(scores >= self.floor)
        self.held = np.concatenate([self.held, np.stack([item, ids[row], scores[row, item]])], axis=1)
        if self.held.shape[1] > KEEP_ROWS + 2 * self.k * len(self.floor):
            self.reduce()

    def reduce(self) -> np.ndarray:
        item, ids, score = self.held
        order = np.lexsort((ids, -score, item))
        item = item[order]
        first = np.searchsorted(item, item)
        order = order[np.arange(len(item)) - first < self.k]
        self.held = self.held[:, order]
        item = self.held[0]
        full = np.flatnonzero(np.arange(len(item)) - np.searchsorted(item, item) == self.k - 1)
        self.floor[item[full]] = self.held[2][full]
        return self.held


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, terms (distinct, of all rows of the item)."""
    lower = F.translate(F.col("text").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return (items.filter("item_id is not null and text is not null")
            .select(F.col("item_id").cast("long").alias("item_id"), F.explode(F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))).alias("term"))
            .groupBy("item_id").agg(F.collect_set("term").alias("terms")))


def _best_of_block(documents: DataFrame, automaton: Automaton, k: int) -> DataFrame:
    """HITS: the best ``k`` documents per task for every item of the automaton."""
    shared = documents.sparkSession.sparkContext.broadcast(automaton)
    docs, terms = -1, -2

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        df = np.zeros(found.size, np.int64)
        n_docs = n_terms = 0
        for batch in batches:
            for part in some(batch):
                texts = [scannable(t) for t in part.column(1).to_pylist()]
                lengths = [len(t.split()) for t in texts]
                n_docs, n_terms = n_docs + sum(n > 0 for n in lengths), n_terms + sum(lengths)
                df += np.bincount(found.count(texts)[1], minlength=found.size)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([[docs, terms], held]).astype(np.int32)),
                                          pa.array(np.concatenate([[n_docs, n_terms], df[held]]))], names=["term", "n"])

    # one row per term of the block, which is bounded
    counts = {r["term"]: r["n"] for r in documents.mapInArrow(count, COUNTS).groupBy("term").agg(F.sum("n").alias("n")).collect()}
    n_docs, n_terms = counts.pop(docs, 0), counts.pop(terms, 0)
    weight = np.zeros(automaton.size, np.int64)
    for term, df in counts.items():
        weight[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        best = Best(len(found.items), k)
        for batch in batches:
            for part in some(batch):
                texts = [scannable(t) for t in part.column(1).to_pylist()]
                # a batch of scores stays small whatever the number of items
                rows = max(1, 4_000_000 // max(1, len(found.items)))
                for at in range(0, len(texts), rows):
                    now = texts[at:at + rows]
                    ids = part.column(0).slice(at, rows).to_numpy(zero_copy_only=False)
                    best.add(ids, found.scores(now, [len(t.split()) for t in now], weight, n_docs, max(n_terms, 1)))
        item, ids, score = best.reduce()
        yield pa.RecordBatch.from_arrays([pa.array(found.items[item]), pa.array(ids), pa.array(score)], names=["item_id", "doc_id", "score"])

    return documents.mapInArrow(search, HITS)


def rank_documents(documents: DataFrame, items: DataFrame, k: int = 50, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every item."""
    spark = documents.sparkSession
    ship_package(spark)
    docs = documents.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    terms = cut(item_terms(items))
    total = terms.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("n")).head()["n"]
    blocks = max(1, -(-total // block_terms))
    hits = None
    for b in range(blocks if total else 0):
        # about block_terms pairs (an item stays whole); the driver holds one block at a time
        mine = [(r["item_id"], r["terms"]) for r in terms.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).collect()]
        if mine:
            found = _best_of_block(docs, Automaton(mine), k)
            found = cut(found) if blocks > 1 else found
            hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")

    def best(rows: DataFrame, *keys) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("doc_id"))
        return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    part = F.pmod(F.xxhash64("doc_id"), F.lit(slices(spark)))
    return best(best(hits, "item_id", part).drop("rank"), "item_id").select("item_id", "rank", "doc_id", "score")


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL
), i AS (
  SELECT DISTINCT item_id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL
), g AS (
  SELECT count(*)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0
), t AS (
  SELECT doc_id, row_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT doc_id, row_id, len(terms)::BIGINT AS n, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM i) GROUP BY ALL
), w AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM t, g GROUP BY term, n_docs
), s AS (
  SELECT item_id, doc_id, row_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM i JOIN t USING (term) JOIN w USING (term), g GROUP BY ALL
), r AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM r WHERE rank <= 50
"""
