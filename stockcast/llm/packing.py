"""Best-two-fit packing of tokenised documents into sequences of a fixed capacity.

How a sequence is filled: take the longest remaining piece that fits until
none fits; if a gap stays, take out the sequence's smallest piece and look for
two unpacked pieces whose sum fills the expanded gap more tightly; keep the
tighter of the two.

What a sequence holds depends on piece lengths alone, so the choice is made on
the counts of the ``capacity`` possible lengths. As long as enough pieces of
each chosen length remain, the next sequence would be filled in the same way;
a filling is therefore repeated as often as the counts allow, which gives the
sequences of the one-by-one procedure with at most a few thousand distinct
fillings whatever the number of documents. Pieces then take their places by
their rank among the pieces of equal length, computed from per-task counts.

The driver holds the ``capacity`` counts and the fillings only, both bounded
by the capacity, not by the data. One length may be a third of all pieces: no
step gathers the pieces of one length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockcast.llm.common import cut, ship_package
from stockcast.llm.words import byte_bpe, some

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task long, nth long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def cut_pieces(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: full ones, but the first may be shorter."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def tokenised_pieces(documents: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """One row per piece, with the task that made it and its number among that task's pieces of its length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, task = byte_bpe(path), TaskContext.get().partitionId()
        tail = int(end_id).to_bytes(4, "little")
        made = [0] * (capacity + 1)
        for batch in batches:
            for part in some(batch):
                out: list[tuple] = []
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc, found in zip(part.column(0).to_pylist(), bpe.ids(texts), strict=True):
                    ids = found.astype("<u4").tobytes() + tail
                    for k, (s, n) in enumerate(cut_pieces(len(ids) // 4, capacity)):
                        out.append((doc, k, s, n, zlib.crc32(ids[4 * s:4 * (s + n)]), task, made[n]))
                        made[n] += 1
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.int32()] + [pa.int64()] * 5, strict=True)],
                    names=[f.split()[0] for f in PIECES.split(", ")])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, PIECES)


def best_pair(counts: np.ndarray, room: int, above: int) -> tuple[int, int] | None:
    """Two unpacked lengths with the largest sum over ``above`` and up to ``room``."""
    have = counts > 0
    for total in range(min(room, 2 * (len(counts) - 1)), above, -1):
        a = np.arange(max(1, total - len(counts) + 1), total // 2 + 1)
        ok = have[a] & have[total - a]
        if total % 2 == 0 and len(a) and a[-1] * 2 == total:
            ok[-1] = counts[total // 2] >= 2
        if ok.any():
            x = int(a[np.flatnonzero(ok)[-1]])
            return total - x, x
    return None


def filling(counts: np.ndarray, capacity: int) -> list[int]:
    """Lengths of the next sequence, longest first."""
    left, lengths, gap = counts.copy(), [], capacity
    while gap:
        fits = np.flatnonzero(left[:gap + 1])
        if not len(fits):
            break
        n = int(fits[-1])
        lengths.append(n)
        left[n] -= 1
        gap -= n
    if gap and lengths:
        small = min(lengths)
        pair = best_pair(left, gap + small, small)
        if pair:
            lengths.remove(small)
            lengths += pair
    return sorted(lengths, reverse=True)


def plan(counts: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """(filling, how often) until no piece is left. counts[n]: pieces of length n."""
    left, out = counts.copy(), []
    while left.any():
        lengths = filling(left, capacity)
        need = np.bincount(lengths, minlength=capacity + 1)
        used = need > 0
        times = int((left[used] // need[used]).min())
        left -= times * need
        out.append((lengths, times))
    return out


def places(fillings: list[tuple[list[int], int]], capacity: int) -> dict[int, list[tuple[int, int, int, list[int]]]]:
    """length -> [(rank of its first piece, pieces a sequence, first sequence, offsets)] in order of rank."""
    out: dict[int, list] = {}
    taken, first = [0] * (capacity + 1), 0
    for lengths, times in fillings:
        at: dict[int, list[int]] = {}
        offset = 0
        for n in lengths:
            at.setdefault(n, []).append(offset)
            offset += n
        for n, offsets in at.items():
            out.setdefault(n, []).append((taken[n], len(offsets), first, offsets))
            taken[n] += times * len(offsets)
        first += times
    return out


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """Places for ``pieces`` (see ``tokenised_pieces``), which must be materialised."""
    per_task = pieces.groupBy("length", "task").count()
    # a window holds one row per task of a length, never the pieces themselves
    before = F.coalesce(F.sum("count").over(W.partitionBy("length").orderBy("task")
                                            .rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ahead = per_task.select("length", "task", before.cast("long").alias("ahead"))
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in per_task.groupBy("length").agg(F.sum("count").alias("n")).collect():  # at most ``capacity`` rows
        counts[r["length"]] = r["n"]
    table = places(plan(counts, capacity), capacity)
    starts = {n: [r[0] for r in rows] for n, rows in table.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seq, off = [], []
            for n, nth, ahead_of in zip(*(batch.column(c).to_pylist() for c in ("length", "nth", "ahead")), strict=True):
                rank = nth + ahead_of
                base, per, first, offsets = table[n][bisect_right(starts[n], rank) - 1]
                turn, slot = divmod(rank - base, per)
                seq.append(first + turn)
                off.append(offsets[slot])
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(seq, pa.int64()), pa.array(off, pa.int64())],
                                             names=[f.split()[0] for f in PLACED.split(", ")])

    return pieces.join(ahead, ["length", "task"]).mapInArrow(place, PLACED)


def pack_documents(documents: DataFrame, path: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Pack whole documents (doc_id, text) into sequences of at most ``capacity`` tokens.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset. Null text counts as empty (one piece, the end id alone); rows that
    repeat are packed once each; a null doc_id stays null; equal lengths are
    told apart by task and place in it; an empty table gives no rows; other
    columns are ignored. Texts longer than ``capacity`` ids are cut into full
    pieces, the first one taking the remainder.
    """
    ship_package(documents.sparkSession)
    return pack(cut(tokenised_pieces(documents, path, capacity, end_id)), capacity)
