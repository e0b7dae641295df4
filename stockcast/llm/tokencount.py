"""Token counts of whole texts; huge texts by overlap resynchronisation.

Texts up to ``chunk`` characters are counted whole. A longer text is encoded
in chunks that overlap, with the offsets of every token. Two neighbouring
chunks are spliced at a boundary inside their overlap that is proven stable:
a white-space character (the tokenizer drops white space and never joins, case
folds or composes across it) after which both chunks have the same tokens at
the same offsets for ``PROOF`` tokens or until the overlap ends. Tokens before
the boundary count from the left chunk, those after it from the right one. If
no such place is found the overlap is doubled, at most to the whole text, and
both are encoded again. One chunk pair is held at a time.

Defined results: null text counts as empty (0 bytes, 0 tokens); a null doc_id
stays null; repeated rows are counted each; an empty table gives no rows; other
columns are ignored. Strings of added tokens inside texts count as the library
counts them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast.llm.common import ship_package
from stockcast.llm.words import BatchEncoder, bare_words, library, some

CHUNK = 65_536
OVERLAP = 512
PROOF = 8
COUNTS = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def _encoded(lib, text: str, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """(offset in the whole text, id) of the tokens of text[start:end]."""
    got = lib.encode(text[start:end], add_special_tokens=False)
    return np.array([a for a, _ in got.offsets], np.int64) + start, np.array(got.ids, np.int64)


def _splice(text: str, left, right, low: int, high: int) -> int | None:
    """A stable boundary in [low, high): both sides have the same tokens from there on."""
    for p in range(low + 1, high):
        if not text[p - 1].isspace() or text[p].isspace():
            continue
        i, j = np.searchsorted(left[0], p), np.searchsorted(right[0], p)
        a, b = np.searchsorted(left[0], high), np.searchsorted(right[0], high)
        n = min(PROOF, a - i, b - j)
        if n < 1 or (n < PROOF and a - i != b - j):
            continue
        if (left[0][i:i + n] == right[0][j:j + n]).all() and (left[1][i:i + n] == right[1][j:j + n]).all():
            return p
    return None


def count_huge(lib, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Number of tokens of a text by overlapping chunks."""
    total, done = 0, 0           # tokens that start before ``done`` are counted
    start, end = 0, min(chunk, len(text))
    left = _encoded(lib, text, start, end)
    while end < len(text):
        wide = overlap
        while True:
            nxt = max(start, end - wide)
            stop = min(len(text), max(nxt + chunk, end + wide))
            right = _encoded(lib, text, nxt, stop)
            # the last characters of the left chunk may be half a word: leave them out of the proof
            p = None if nxt == start else _splice(text, left, right, max(nxt, done), end)
            if p is not None or nxt == start:
                break
            wide *= 2
        if p is None:  # the overlap has grown over the whole left chunk: the wider chunk takes its place
            end, left = stop, right
            continue
        total += int(np.searchsorted(left[0], p) - np.searchsorted(left[0], done))
        done, start, end = p, p, stop
        keep = np.searchsorted(right[0], p)
        left = (right[0][keep:], right[1][keep:])
    return total + int(len(left[0]) - np.searchsorted(left[0], done))


@lru_cache(maxsize=2)
def lower_bpe(path: str) -> BatchEncoder:
    """Encoder of a lower-casing word BPE file, one per worker."""
    lib = library(path)
    added = [t.content for t in lib.get_added_tokens_decoder().values()]
    return BatchEncoder(bare_words, lambda w: lib.encode(w.decode(), add_special_tokens=False).ids,
                        lambda t: lib.encode(t, add_special_tokens=False).ids, added, lower=True)


def count_tokens(documents: DataFrame, path: str, limit: int = 2048, chunk: int = CHUNK,
                 overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of whole texts by the file at ``path``."""
    ship_package(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, lib = lower_bpe(path), library(path)
        for batch in batches:
            for part in some(batch):
                texts = [t or "" for t in part.column(1).to_pylist()]
                short = iter(bpe.counts([t for t in texts if len(t) <= chunk]))
                n = [next(short) if len(t) <= chunk else count_huge(lib, t, chunk, overlap) for t in texts]
                size = [len(t.encode()) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n])],
                    names=[f.split()[0] for f in COUNTS.split(", ")])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, COUNTS)
