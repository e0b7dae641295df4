"""Line dedup by pairwise alignment: a later document loses the blocks it shares with an earlier one.

Lines are compared by their MD5. The result: a line of a document goes if it
lies in a run of lines that an earlier document (smaller doc_id) holds too,
contiguous in both (blank lines aside), with at least ``min_words`` words
together. Words are separated by blanks; two characters of a script without
blanks count as a word, and so do 20 characters of any text whose words are
longer.

Overlapping documents are found through hashes of windows: the shortest
stretches of consecutive lines, from each line onward and from each line back,
that have ``min_words`` words together (a line that has them alone is its own
window). Any run of that size holds a window around each of its lines. Windows
of which ``RARE`` or fewer exist come first: each of their documents is paired
with the window's first holder. What these alignments leave of the more common
windows is then paired in the same way, by the common lines alone. So there is
at most one pair per window and later document, however common a line is.

Each pair is aligned by patience diff: lines that occur once on both sides are
put in a longest increasing order, the stretches between two of them are
aligned in the same way, and equal lines at the ends of a stretch extend the
match. Runs of aligned lines that are contiguous on both sides and large enough
are deleted from the later document. A shared window that crosses this
alignment is then aligned by itself with its place in the earlier document, and
so goes as well.

Defined results: null text stays null; a null doc_id has no place in the order,
so that row neither loses lines nor takes any; rows that repeat a doc_id are
never aligned with each other, and rows with the same doc_id and text come out
alike; common runs of fewer words stay; an empty text is one blank line and
stays; whole texts of any length; an empty table gives no rows; other columns of
``documents`` are returned as they are, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast.llm.common import cut, ship_package
from stockcast.llm.words import some

MIN_WORDS = 5
RARE = 32  # windows of which more exist are asked last, dealt over as many salts
#: Characters of the scripts that put no blanks between words: Thai, Lao, Tibetan, Myanmar, Khmer, kana, Han.
DENSE = re.compile("[\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")
LINES = "doc_id long, text_hash long, nth int, i int, line binary, size int"


def longest_increasing(values: list[int]) -> list[int]:
    """Places of a longest strictly increasing subsequence (patience sorting)."""
    tops: list[int] = []      # last value of each pile
    top_at: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(tops, v)
        if k == len(tops):
            tops.append(v)
            top_at.append(i)
        else:
            tops[k], top_at[k] = v, i
        before[i] = top_at[k - 1] if k else -1
    out = []
    i = top_at[-1] if top_at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places (i in a, j in b), increasing on both sides."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {x: i for i, x in enumerate(a[a0:a1], a0) if in_a[x] == 1}
        once = [(place[x], j) for j, x in enumerate(b[b0:b1], b0) if in_b[x] == 1 and x in place]
        anchors = [once[k] for k in longest_increasing([i for i, _ in once])]
        if not anchors:
            continue
        found += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]  # noqa: B905
    return sorted(found)


def shared_blocks(earlier: list[tuple], later: list[tuple], least: int = 1) -> list[int]:
    """Numbers to delete from ``later``; both are (number, line, size) of shared lines in order."""
    gone: list[int] = []
    run: list[int] = []
    size, last = 0, None
    for i, j in patience([x[1] for x in earlier], [x[1] for x in later]):
        at = (earlier[i][0], later[j][0])
        if last is None or at != (last[0] + 1, last[1] + 1):
            gone += run if size >= least else []
            run, size = [], 0
        run.append(at[1])
        size += later[j][2]
        last = at
    return gone + (run if size >= least else [])


def words(line: str) -> int:
    """Size of a line in words."""
    dense = 0 if line.isascii() else len(DENSE.findall(line)) // 2
    return max(len(line.split()) + dense, len(line) // 20, 1)


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """LINES of every line that is not blank; nth counts those, i all lines."""
    for batch in batches:
        for part in some(batch, text=2):
            held = [[(i, x) for i, x in enumerate(t.split("\n")) if x.strip(" ")] for t in part.column(2).to_pylist()]
            flat = [x for lines in held for x in lines]
            many = [len(lines) for lines in held]
            which = pa.array(np.repeat(np.arange(len(held)), many))
            nth = np.arange(len(flat)) - np.repeat(np.cumsum(many) - many, many)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(which), part.column(1).take(which), pa.array(nth, pa.int32()),
                 pa.array([i for i, _ in flat], pa.int32()), pa.array([md5(x.encode()).digest() for _, x in flat], pa.binary()),
                 pa.array([words(x) for _, x in flat], pa.int32())], names=[f.split()[0] for f in LINES.split(", ")])


def _rows(col: pa.ListArray) -> list[list[tuple]]:
    edge = [0, *pa.compute.cumulative_sum(pa.compute.list_value_length(col)).to_pylist()]
    flat = list(zip(*(part.to_pylist() for part in col.flatten().flatten()), strict=True))
    return [flat[a:b] for a, b in zip(edge, edge[1:])]  # noqa: B905


def windows(lines: list[tuple], least: int) -> list[tuple[int, int, int]]:
    """(key, first, last) of the shortest windows that start or end at each line; lines: (order, line, size, number)."""
    found = set()
    for at in range(len(lines)):
        for step in (1, -1):
            size, k = lines[at][2], at
            while size < least and 0 <= k + step < len(lines) and lines[k + step][0] == lines[k][0] + step:
                k += step
                size += lines[k][2]
            if size >= least:
                found.add((min(at, k), max(at, k)))
    return [(int.from_bytes((lines[a][1] if a == b else md5(b"".join(x[1] for x in lines[a:b + 1])).digest())[:8], "big", signed=True), a, b)
            for a, b in sorted(found)]


def common_lines(theirs: list[tuple], ours: list[tuple], least: int) -> list[int]:
    """Numbers of the lines that ``ours`` loses to the earlier ``theirs``."""
    gone = set(shared_blocks(theirs, ours, least))
    crossing = [w for w in windows(ours, least) if any(x[0] not in gone for x in ours[w[1]:w[2] + 1])]
    if crossing:  # each is aligned with its place in the earlier document
        place = {key: (a, b) for key, a, b in reversed(windows(theirs, least))}
        for key, a, b in crossing:
            if key in place:
                first, last = place[key]
                gone.update(shared_blocks(theirs[first:last + 1], ours[a:b + 1], least))
    return [x[3] for x in ours if x[0] in gone]


def _aligned(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 200):
            batch = whole.slice(at, 200)
            gone = [common_lines(theirs, ours, least) for ours, theirs in zip(_rows(batch.column(2)), _rows(batch.column(3)), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(gone, pa.list_(pa.int32()))],
                                             names=["doc_id", "text_hash", "gone"])


def _keys(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 200):
            batch = whole.slice(at, 200)
            rows = _rows(batch.column(2))
            found = [windows(x, least) for x in rows]
            which = pa.array([k for k, x in enumerate(found) for _ in x], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(which), batch.column(1).take(which), pa.array([k for x in found for k, _, _ in x], pa.int64()),
                 pa.array([[r[3] for r in lines[a:b + 1]] for lines, x in zip(rows, found, strict=True) for _, a, b in x], pa.list_(pa.int32()))],
                names=["doc_id", "text_hash", "key", "at"])


def lines_to_delete(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text_hash, gone (line numbers, from 0) for documents that lose lines."""
    ship_package(documents.sparkSession)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    lines = docs.filter("doc_id is not null and text is not null").select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(_lines, LINES)
    holders = lines.groupBy("line").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n"))
    # written once: the join then has an exchange of its own on both sides, and a line in very many documents is split
    holders = cut(holders.filter("first < last").select("line", (F.col("n") > RARE).alias("common")))
    docs_ = cut(lines.join(holders, "line").groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_set(F.struct("nth", "line", "size", "i", "common"))).alias("lines")))  # a set: rows may repeat

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _aligned(batches, min_words)

    def keys_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _keys(batches, min_words)

    def align(asked: DataFrame, held: DataFrame) -> DataFrame:
        """doc_id, text_hash, gone of every (later document, partner) in ``asked``, by the lines in ``held``."""
        earlier = held.select(F.col("doc_id").alias("partner"), F.col("lines").alias("theirs"))
        both = (held.join(asked.select("doc_id", "text_hash", "partner").distinct(), ["doc_id", "text_hash"])
                .join(earlier, "partner").select("doc_id", "text_hash", "lines", "theirs"))
        return cut(both.mapInArrow(aligned, "doc_id long, text_hash long, gone array<int>").filter(F.size("gone") > 0))

    keys = cut(docs_.select("doc_id", "text_hash", "lines").mapInArrow(keys_of, "doc_id long, text_hash long, key long, at array<int>"))
    firsts = keys.groupBy("key").agg(F.min("doc_id").alias("partner"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n"))
    firsts = cut(firsts.filter("partner < last").select("key", "partner", "n"))
    rare = keys.join(firsts.filter(F.col("n") <= RARE).drop("n"), "key").filter("partner < doc_id")
    gone = align(rare, docs_)

    # a common window's rows are dealt over RARE salts; there are fewer copies of its first holder than rows
    salts = F.explode(F.sequence(F.lit(0), F.lit(RARE - 1)))
    common = firsts.filter(F.col("n") > RARE).select("key", "partner", salts.alias("salt"))
    asked = (keys.withColumn("salt", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(RARE)).cast("int"))
             .join(common, ["key", "salt"]).filter("partner < doc_id"))
    lost = gone.groupBy("doc_id", "text_hash").agg(F.array_distinct(F.flatten(F.collect_list("gone"))).alias("gone"))
    asked = asked.join(lost, ["doc_id", "text_hash"], "left").filter(F.col("gone").isNull() | (F.size(F.array_except("at", "gone")) > 0))
    frequent = docs_.select("doc_id", "text_hash", F.filter("lines", lambda x: x["common"]).alias("lines")).filter(F.size("lines") > 0)
    gone = gone.unionByName(align(asked, frequent))
    return (gone.select("doc_id", "text_hash", F.explode("gone").alias("i"))
            .groupBy("doc_id", "text_hash").agg(F.collect_set("i").alias("gone")))


def _without(texts: pa.Array, gone: pa.Array) -> pa.Array:
    out = []
    for text, numbers in zip(texts, gone, strict=True):
        if numbers.is_valid and text.is_valid:
            drop = set(numbers.as_py())
            out.append("\n".join([x for i, x in enumerate(text.as_py().split("\n")) if i not in drop]))
        else:
            out.append(None)
    return pa.array(out, pa.string())


def delete_lines(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``row`` (a struct of all columns of ``documents``), ``text`` without the deleted lines, ``n_lines``, ``n_deleted``."""
    gone = lines_to_delete(documents, min_words)
    docs = documents.select(F.struct(*(F.col(f"`{c}`") for c in documents.columns)).alias("row")).select(
        "row", F.col("row.doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("row.text").cast("string")).alias("text_hash"))
    both = docs.join(gone, ["doc_id", "text_hash"], "left")
    text = F.col("row.text").cast("string")
    # not deterministic for the planner: a filter on the result must not run it a second time
    kept = F.arrow_udf(_without, "string").asNondeterministic()(F.when(F.col("gone").isNotNull(), text), F.col("gone"))
    return both.select("row", F.when(F.col("gone").isNull(), text).otherwise(kept).alias("text"),
                       F.coalesce(F.length(text) - F.length(F.translate(text, "\n", "")) + 1, F.lit(0)).cast("long").alias("n_lines"),
                       F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_deleted"))


def dedup_lines(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text (after deletion), n_lines, n_deleted: one row per row of ``documents``."""
    return delete_lines(documents, min_words).select(F.col("row.doc_id").cast("long").alias("doc_id"), "text", "n_lines", "n_deleted")


def without_repeats(documents: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``documents`` with all columns, texts without the deleted lines; a document that lost all its text goes."""
    out = delete_lines(documents, min_words).filter((F.col("n_deleted") == 0) | (F.trim("text") != ""))
    text = F.when(F.col("n_deleted") == 0, F.col("row.text")).otherwise(F.col("text"))
    return out.select(F.col("row").withField("text", text).alias("row")).select("row.*")
