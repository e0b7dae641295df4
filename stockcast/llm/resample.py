"""Importance resampling towards a target: array-scored weights, then a distributed LSD radix sort.

Weights. Texts are cut into words and their runs (features), each feature falls
into a bucket by the CRC-32 of its bytes, all with numpy on the bytes of a
batch. Tasks count buckets of the documents and of the target texts; the sums
(one row per bucket, so bounded) give an array of one gain per bucket, and a
second scan scores every document by indexing that array.

Order. The rows to draw from are sorted on a composite key, highest score, then
smallest doc_id, then fewest features, split into digits of ``DIGIT_BITS`` bits.
Each pass from the lowest digit up is a stable counting sort: rows lie in blocks
of ``BLOCK_ROWS`` by their place in the order so far; the digits of each block
are counted; prefix sums over (digit, block) give the place where the rows of a
digit of a block start; and each row goes to its place. Blocks are ranges of
places, so none is larger than another however often a key repeats. After the
last pass a row's place is its rank.

Defined results: a null text has no features and weight 0; a null doc_id is
never drawn, does not count among the rows to draw from and has no score;
repeated rows are ranked each, one after the other; empty tables give no rows,
an empty target gives the gains of T = t = 0; whole texts of any length; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockcast.llm.common import cut, ship_package
from stockcast.llm.words import some

BUCKETS = 10_000
DIGIT_BITS = 12
BLOCK_ROWS = 1 << 16
LONG_FEATURE = 64  # bytes; longer ones go through zlib one by one
COUNTS = "bucket int, n long"
SCORED = "doc_id long, n_features long, n_words long, weight long, score long"

#: Word characters: digits, letters (A-Z as a-z) and every byte beyond ASCII; the rest is blank.
_FORM = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20
              for b in range(256))


def _crc_table() -> np.ndarray:
    """CRC-32 of every single byte's step (polynomial 0xEDB88320)."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1)
    return out


_CRC = _crc_table()


def crc32(b: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of the stretches [start, end) of the bytes ``b``."""
    size = end - start
    order = np.argsort(-np.minimum(size, LONG_FEATURE + 1), kind="stable")
    at, size = start[order], size[order]
    short = np.searchsorted(-size, -LONG_FEATURE)
    crc = np.full(len(at), 0xFFFFFFFF, np.uint32)
    for j in range(int(size[short]) if short < len(size) else 0):
        n = np.searchsorted(-size[short:], -j) + short  # those longer than j come first
        now = crc[short:n]
        crc[short:n] = _CRC[(now ^ b[at[short:n] + j]) & 0xFF] ^ (now >> np.uint32(8))
    crc = ~crc
    for i in range(short):
        crc[i] = zlib.crc32(b[at[i]:at[i] + size[i]])
    out = np.empty(len(at), np.uint32)
    out[order] = crc
    return out


def features(texts: list[str | None], longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words per text, features per text, bucket of each feature in the order of texts) of runs of 1 to ``longest`` words."""
    data = [b" ".join((t or "").encode().translate(_FORM).split()) + b" " for t in texts]
    doc = np.cumsum([0, *map(len, data)])
    b = np.frombuffer(b"".join(data), np.uint8)
    end = np.flatnonzero(b == 0x20)
    start = np.concatenate([[0], end[:-1] + 1])
    first = np.searchsorted(end, doc)  # words of text i: first[i] to first[i + 1]
    empty = end == start  # a text without words is one blank
    words = np.diff(first) - np.add.reduceat(empty, first[:-1]) if len(texts) else np.zeros(0, np.int64)
    of = np.repeat(np.arange(len(texts)), np.diff(first))
    starts, ends, owner = [], [], []
    for n in range(1, longest + 1):
        a, z = np.arange(len(start) - n + 1), np.arange(n - 1, len(start))
        ok = (of[a] == of[z]) & ~empty[a] if n <= len(start) else np.zeros(0, bool)
        a, z = a[ok], z[ok]
        starts.append(start[a]), ends.append(end[z]), owner.append(of[a])
    owner_ = np.concatenate(owner)
    order = np.argsort(owner_, kind="stable") if longest > 1 else slice(None)
    bucket = crc32(b, np.concatenate(starts)[order], np.concatenate(ends)[order]) % np.uint32(buckets)
    return words, np.bincount(owner_, minlength=len(texts)), bucket.astype(np.int64)


def bucket_counts(texts: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """Features per bucket over the one text column of ``texts``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in some(batch, text=0):
                n += np.bincount(features(part.column(0).to_pylist(), longest, buckets)[2], minlength=buckets)
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(n[held])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in texts.mapInArrow(count, COUNTS).groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row per bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed share of a bucket in the target over its share in the source)."""
    s_all, t_all, n = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + n) / ((s + 1) * (t_all + n))))
                     for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: int, seed: int) -> int:
    """Gumbel noise of a document, in thousandths."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score_documents(documents: DataFrame, gain: np.ndarray, longest: int, seed: int) -> DataFrame:
    """SCORED: weight and score of every row of ``documents``."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in some(batch):
                words, n, bucket = features(part.column(1).to_pylist(), longest, len(gain))
                total = np.concatenate([[0], np.cumsum(gain[bucket])])
                edge = np.concatenate([[0], np.cumsum(n)])
                weight = (total[edge[1:]] - total[edge[:-1]]) // np.maximum(n, 1)
                scores = [None if d is None else w + noise(d, seed) for d, w in zip(part.column(0).to_pylist(), weight.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n.astype(np.int64)), pa.array(words.astype(np.int64)), pa.array(weight), pa.array(scores, pa.int64())],
                    names=[f.split()[0] for f in SCORED.split(", ")])

    return documents.mapInArrow(score, SCORED)


def digits(key: list[tuple[Column, int]], bits: int = DIGIT_BITS) -> list[Column]:
    """Digits, lowest first, of a composite key: (non-negative column, its width in bits), most significant first."""
    out, low, parts = [], 0, []
    for column, width in reversed(key):
        parts.append((column, low, low + width))
        low += width
    for a in range(0, low, bits):
        digit = F.lit(0).cast("long")
        for column, lo, hi in parts:
            begin, end = max(a, lo), min(a + bits, hi)
            if begin < end:
                piece = F.shiftright(column, begin - lo).bitwiseAND(F.lit((1 << (end - begin)) - 1))
                digit = digit.bitwiseOR(F.shiftleft(piece, begin - a))
        out.append(digit.cast("int"))
    return out


def radix_places(rows: DataFrame, key: list[tuple[Column, int]], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows`` with ``place`` (long, from 0): their place in ascending order of ``key``.

    ``rows`` holds only columns of its own (not block, place or digit).
    """
    columns = rows.columns
    # the first blocks: any, as long as none is large; written, so that they stay what they are
    at = F.monotonically_increasing_id()
    now = cut(rows.select(*columns, at.alias("place")).select(*columns, F.expr(f"place div {block_rows}").alias("block"), "place"))
    schema = now.schema
    out_names = schema.names

    for digit in digits(key):
        now = now.select(*out_names, digit.alias("digit"))
        counts = cut(now.groupBy("block", "digit").agg(F.count(F.lit(1)).alias("n")))
        # a row per digit, of which there are at most 2 ** DIGIT_BITS
        totals = sorted((r["digit"], r["n"]) for r in counts.groupBy("digit").agg(F.sum("n").alias("n")).collect())
        base, starts = 0, []
        for d, n in totals:
            starts.append((d, base))
            base += n
        before = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        offsets = (counts.join(F.broadcast(rows.sparkSession.createDataFrame(starts, "digit int, base long")), "digit")
                   .select(F.col("block").alias("of"), F.col("digit").alias("value"), (F.col("base") + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("start")))

        def move(block: pa.Table, offset: pa.Table) -> pa.Table:
            block = block.take(pa.array(np.argsort(block.column("place").to_numpy(), kind="stable")))
            digit = block.column("digit").to_numpy()
            order = np.argsort(digit, kind="stable")  # the counting sort within the block
            found, first, many = np.unique(digit[order], return_index=True, return_counts=True)
            to = dict(zip(offset.column("value").to_pylist(), offset.column("start").to_pylist(), strict=True))
            place = np.repeat([to[d] for d in found.tolist()] - first, many) + np.arange(len(order))
            block = block.take(pa.array(order)).select(columns)
            return block.append_column("block", pa.array(place // block_rows)).append_column("place", pa.array(place))

        now = cut(now.groupBy("block").cogroup(offsets.groupBy("of")).applyInArrow(move, schema))
    return now.drop("block")


def resample(documents: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS, seed: int = 2024,
             least_words: int = 20, percent: int = 10, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, n_features, weight, score, rank: every document, ranked if drawn.

    The documents with at least ``least_words`` words are drawn from, ``percent`` of them.
    """
    ship_package(documents.sparkSession)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    gain = gains(bucket_counts(docs.select("text"), longest, buckets),
                 bucket_counts(target.select(F.col("text").cast("string").alias("text")), longest, buckets))
    scored = cut(score_documents(docs, gain, longest, seed))
    able = (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull()
    pool = scored.filter(able).select("doc_id", "n_features", "weight", "score")
    low = pool.agg(F.count(F.lit(1)).alias("n"), *(f(c).alias(f"{f.__name__}_{c}") for c in ("score", "doc_id", "n_features") for f in (F.min, F.max))).head()
    rest = scored.filter(~able).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    if not low["n"]:
        return rest

    def wide(name: str) -> int:
        return (low[f"max_{name}"] - low[f"min_{name}"]).bit_length()

    def above(name: str) -> Column:
        return F.col(name) - F.lit(low[f"min_{name}"])

    if wide("doc_id") > 63:
        raise ValueError("doc_id spans more than 63 bits")
    places = radix_places(pool, [(F.lit(low["max_score"]) - F.col("score"), wide("score")), (above("doc_id"), wide("doc_id")),
                                 (above("n_features"), wide("n_features"))], block_rows)
    drawn = percent * low["n"] // 100
    ranked = places.select("doc_id", "n_features", "weight", "score", F.when(F.col("place") < drawn, F.col("place") + 1).alias("rank"))
    return ranked.unionByName(rest)


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words
  FROM documents
), b AS (
  SELECT regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark WHERE text IS NOT NULL
), dw AS (
  SELECT row_id, word, count(*) AS n FROM (SELECT row_id, unnest(words) AS word FROM d) GROUP BY ALL
), bw AS (
  SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM b) GROUP BY ALL
), steps AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
           lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t
), crc AS (
  SELECT word, xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(range(strlen(word)), lambda i: ('0x' || substr(hex(word), (2 * i + 1)::INT, 2))::BIGINT)),
           lambda a, c: xor(t[(xor(a, c) & 255) + 1], a >> 8))) % 10000 AS bucket
  FROM (SELECT word FROM dw UNION SELECT word FROM bw), steps
), s AS (
  SELECT bucket, sum(n) AS s FROM dw JOIN crc USING (word) GROUP BY ALL
), t AS (
  SELECT bucket, sum(n) AS t FROM bw JOIN crc USING (word) GROUP BY ALL
), gain AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000))::DOUBLE
                                 / ((s + 1) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000))::DOUBLE))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket)
), w AS (
  SELECT row_id, floor(sum(n * gain)::DOUBLE / sum(n)::DOUBLE)::BIGINT AS weight FROM dw JOIN crc USING (word) JOIN gain USING (bucket) GROUP BY ALL
), scored AS (
  SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score,
         len(words) >= 20 AND doc_id IS NOT NULL AS able
  FROM d LEFT JOIN w USING (row_id)
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN able AND row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id, n_features) <= 10 * (sum(able::INT) OVER ()) // 100
            THEN row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id, n_features) END::BIGINT AS rank
FROM scored
"""
