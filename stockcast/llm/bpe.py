"""Byte-pair encoding as a streaming transducer with bounded lookahead, and an incremental decoder.

Sufficient lookahead. Let bytes arrive after a buffer. A merge that happens in
only one of the two runs (buffer alone, buffer and what follows) can be traced
to the right: the earliest differing merge that overlaps the bytes of a merge
``e`` is a merge ``(s, z)`` of lower rank that takes the token ``s`` at the
right edge of ``e`` before ``e``'s own derivation does, so ``s`` is on the
right spine of ``e``. Hence the farthest byte left of the buffer's end that a
merge can disturb is::

    reach(e) = max(len(e) - 1, max over spine tokens s of e and merges m = (s, z)
                   that come before the merge consuming s in e: reach(m) + len(e) - len(s))

computed in rank order from the merge list. Tokens that end at least
``max(reach)`` bytes before the buffer's end are final; they are emitted, and
encoding goes on from the last emitted boundary, which no merge crosses. The
buffer never holds more than a window and the lookahead. No merge crosses the
end of a word either, so all its tokens are final there.

A text is read in pieces of about ``PIECE`` characters that end where the
pre-tokenizer ends a word whatever follows; ids and decoded text are hashed as
they come, so memory does not grow with the text (a word without any such place
is fed to the transducer whole). Words of plain text that a worker has met
before are looked up in a bounded table instead of being fed again.

Decoding feeds the bytes of each id to a UTF-8 state machine that holds at
most an unfinished character; invalid bytes become U+FFFD.

Defined results: null text counts as empty (no ids); a null doc_id stays null;
repeated rows are encoded each; an empty table gives no rows; other columns are
ignored. Strings of added tokens inside texts give their ids, as the library's
default does.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast.llm.common import ship_package
from stockcast.llm.words import BatchEncoder, Vocabulary, library, some, spaced_words

WINDOW = 256
PIECE = 65_536       # characters read at once
GROUP = 1_000_000    # characters encoded at once, of one text or several
#: Places where a word ends whatever follows: before a single blank, and where the class of characters changes
#: (but for an apostrophe and the letters after it).
WORD_END = regex.compile(r"(?<=\S)(?=\s\S)|(?<=\p{L})(?=[^\s\p{L}])|(?<=\p{N})(?=[^\s\p{N}])|(?<=[^\s\p{L}\p{N}'])(?=[\p{L}\p{N}])")
CODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Merges:
    """Merge table of a vocabulary: (left id, right id) -> (rank, merged id), and its sufficient lookahead."""

    def __init__(self, vocab: Vocabulary):
        self.byte_ids = [vocab.ids[bytes([b])] for b in range(256)]
        self.size = {i: len(t) for t, i in vocab.ids.items()}
        self.table: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(vocab.merges):
            self.table.setdefault((vocab.ids[a], vocab.ids[b]), (rank, vocab.ids[a + b]))
        self.lookahead = self._lookahead()

    def _lookahead(self) -> int:
        made: dict[int, tuple[int, int, int]] = {}      # token -> (left, right, rank) of the merge that makes it
        far: dict[int, tuple[list[int], list[int]]] = {}  # s -> ranks of merges (s, z), and the largest reach so far
        most = 0
        for (a, b), (rank, c) in sorted(self.table.items(), key=lambda x: x[1][0]):
            size = self.size[c]
            reach, taker, s = size - 1, rank, b
            while True:
                ranks, best = far.get(s, ((), ()))
                k = bisect_left(ranks, taker)
                if k:
                    reach = max(reach, best[k - 1] + size - self.size[s])
                if s not in made:
                    break
                _, s, taker = made[s]
            made.setdefault(c, (a, b, rank))
            ranks, best = far.setdefault(a, ([], []))
            ranks.append(rank)
            best.append(max(reach, best[-1] if best else 0))
            most = max(most, reach)
        return most

    def merge(self, data: bytes) -> list[int]:
        """Ids of a buffer: the leftmost pair of the lowest rank is merged until none is left."""
        ids = [self.byte_ids[b] for b in data]
        get, none = self.table.get, (1 << 60, -1)
        pairs = [get(p, none) for p in zip(ids, ids[1:])]  # noqa: B905
        while pairs:
            best = min(pairs)
            if best is none:
                break
            i = pairs.index(best)
            ids[i:i + 2] = [best[1]]
            del pairs[i]
            if i:
                pairs[i - 1] = get((ids[i - 1], ids[i]), none)
            if i < len(pairs):
                pairs[i] = get((ids[i], ids[i + 1]), none)
        return ids


class Encoder:
    """Streaming transducer for one pre-tokenized word: feed bytes, get final ids."""

    def __init__(self, merges: Merges, window: int = WINDOW):
        self.merges, self.window = merges, window
        self.buffer = b""

    def feed(self, data: bytes) -> list[int]:
        out: list[int] = []
        at = 0
        while at < len(data):
            full = self.window + self.merges.lookahead
            take = data[at:at + full - len(self.buffer)]
            at += len(take)
            self.buffer += take
            if len(self.buffer) >= full:
                out += self._stable()
        return out

    def _stable(self) -> list[int]:
        ids, size = self.merges.merge(self.buffer), self.merges.size
        end, n = 0, 0
        safe = len(self.buffer) - self.merges.lookahead
        while end + size[ids[n]] <= safe:
            end += size[ids[n]]
            n += 1
        self.buffer = self.buffer[end:]
        if not n:  # one token is as long as the window: widen it
            self.window *= 2
        return ids[:n]

    def finish(self) -> list[int]:
        out, self.buffer = self.merges.merge(self.buffer), b""
        return out


class Decoder:
    """Incremental byte-to-text machine: feed ids, get the text that is certain so far."""

    def __init__(self, token_bytes: dict[int, bytes]):
        self.token_bytes = token_bytes
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.state.decode(b"".join(map(self.token_bytes.__getitem__, ids)))

    def finish(self) -> str:
        return self.state.decode(b"", final=True)


class Codec:
    """Encoder and decoder of a byte-level BPE file for whole texts."""

    def __init__(self, path: str):
        vocab = Vocabulary(path)
        self.merges = Merges(vocab)
        self.added = vocab.added
        self.token_bytes = {i: t for t, i in vocab.ids.items()} | {i: t.encode() for t, i in vocab.added.items()}
        self.special = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.cut = library(path).pre_tokenizer.pre_tokenize_str
        self.batch = BatchEncoder(spaced_words, self.word_ids, self.text_ids, self.added)

    def word_ids(self, word: bytes) -> list[int]:
        stream = Encoder(self.merges)
        return stream.feed(word) + stream.finish()

    def pieces(self, text: str) -> Iterator[str]:
        """The text in pieces that are encoded independently."""
        at = 0
        while at < len(text):
            special = self.special.search(text, at) if self.special else None
            end = special.start() if special else len(text)
            while at < end:
                found = WORD_END.search(text, at + PIECE, end) if at + PIECE < end else None
                to = found.start() if found else end
                yield text[at:to]
                at = to
            if special:
                yield special.group()
                at = special.end()

    def text_ids(self, text: str) -> list[int]:
        """Ids of any text: added strings first, then the file's own pre-tokenizer, then the transducer."""
        out: list[int] = []
        for part in self.pieces(text):
            if part in self.added:
                out.append(self.added[part])
            else:
                for _, (a, b) in self.cut(part):
                    out += self.word_ids(part[a:b].encode())
        return out

    def coded(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """(number of ids, SHA-256 of the ids, SHA-256 of the decoded text) of each text, streamed."""
        total = [0] * len(texts)
        ids_hash, text_hash = [hashlib.sha256() for _ in texts], [hashlib.sha256() for _ in texts]
        back = [Decoder(self.token_bytes) for _ in texts]
        held: list[tuple[int, str]] = []
        size = 0

        def flush() -> None:
            for (i, _), ids in zip(held, self.batch.ids([p for _, p in held]), strict=True):
                total[i] += len(ids)
                ids_hash[i].update(ids.astype("<u4").tobytes())
                text_hash[i].update(back[i].feed(ids.tolist()).encode())
            held.clear()

        for i, text in enumerate(texts):
            for piece in self.pieces(text):
                held.append((i, piece))
                size += len(piece)
                if size >= GROUP:
                    flush()
                    size = 0
        flush()
        for h, b in zip(text_hash, back, strict=True):
            h.update(b.finish().encode())
        return [(n, i.hexdigest(), t.hexdigest()) for n, i, t in zip(total, ids_hash, text_hash, strict=True)]


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker and file."""
    return Codec(path)


def encode_and_decode(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of whole texts by the file at ``path``."""
    ship_package(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in batches:
            for part in some(batch):
                n, ids, text = zip(*bpe.coded([t or "" for t in part.column(1).to_pylist()]), strict=True)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(text)],
                                                 names=[f.split()[0] for f in CODED.split(", ")])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, CODED)
