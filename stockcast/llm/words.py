"""Token ids and token counts of whole texts through a bounded table of words.

A pre-tokenizer cuts a text into words that are encoded one by one, so the ids
of a text are the ids of its words in order. For text of plain characters
(ASCII and Latin letters) the word boundaries of a whole batch are found with
numpy from byte classes, and each distinct word is encoded once per worker: an
open-addressing table keyed by the word's bytes (exact, up to 24 bytes; longer
words go through a dict) holds its ids. Text with any other character goes to
the tokenizers library whole. The table is emptied when ``TABLE_WORDS`` words
are in it, so memory is bounded whatever the vocabulary of the corpus.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np

TABLE_BITS = 20
TABLE_WORDS = 500_000
LONG_WORDS = 50_000
KEY_BYTES = 24

#: Any character outside these sends the text to the library.
NOT_PLAIN = re.compile("[^\t\n\r -~À-ÖØ-öø-įı-ſ]")

SPACE, BREAK, LETTER, DIGIT, OTHER = 0, 1, 2, 3, 4


def _classes() -> np.ndarray:
    out = np.full(256, OTHER, np.uint8)
    out[0x80:] = LETTER  # every character beyond ASCII that NOT_PLAIN lets through is a letter
    for b in range(128):
        out[b] = (SPACE if b == 0x20 else BREAK if b in b"\t\n\r" else LETTER if chr(b).isalpha()
                  else DIGIT if chr(b).isdigit() else OTHER)
    return out


CLASSES = _classes()


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level vocabularies."""
    kept = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Vocabulary:
    """A byte-level BPE file: id of every token's bytes, merges by rank, added strings."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        back = {c: b for b, c in byte_alphabet().items()}
        self.added = {a["content"]: a["id"] for a in data["added_tokens"]}
        self.ids = {bytes(back[c] for c in t): i for t, i in data["model"]["vocab"].items() if t not in self.added}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in data["model"]["merges"]]
        self.merges = [(bytes(back[c] for c in a), bytes(back[c] for c in b)) for a, b in pairs]


def _contractions(b: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of apostrophes at ``at``: which start 's 't 'm 'd 're 've 'll, and the length."""
    one, two = b[at + 1], b[at + 2]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = (((one == ord("r")) | (one == ord("v"))) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    return at[short | long], np.where(short, 2, 3)[short | long]


def spaced_words(b: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the words of byte-level pre-tokenization: a space belongs to the word after it.

    ``b``: bytes of the batch plus 32 zero bytes; ``doc``: where texts start, plus the end.
    """
    n = doc[-1]
    c = CLASSES[b[:n]]
    blank = c <= BREAK
    first = np.zeros(n + 1, bool)
    first[doc] = True  # also the place after the last
    prev_blank = np.empty(n, bool)
    prev_blank[0], prev_blank[1:] = True, blank[:-1]
    next_word = np.zeros(n, bool)  # followed by a word's character of the same text
    next_word[:-1] = ~blank[1:] & ~first[1:n]
    after_space = np.zeros(n, bool)
    after_space[1:] = (c[:-1] == SPACE) & ~first[1:n]
    change = np.ones(n, bool)
    change[1:] = c[1:] != c[:-1]
    start = first[:n] | np.where(blank, ~prev_blank | next_word, change & ~after_space)
    at = np.flatnonzero((b[:n] == ord("'")) & start)
    at, size = _contractions(b, at)
    if len(at):
        text_end = doc[np.searchsorted(doc, at, side="right")]
        ok = at + size <= text_end
        at, size = at[ok], size[ok]
        start[at + 1] = False
        more = (at + size)[at + size < n]
        same = ~first[more] & (c[more] == LETTER)
        start[more[same]] = True
    where = np.flatnonzero(start)
    return where, np.append(where[1:], n)


def bare_words(b: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of runs of letters, of single digits, of runs of other signs, and of contractions; no blanks."""
    n = doc[-1]
    c = CLASSES[b[:n]]
    blank = c <= BREAK
    first = np.zeros(n + 1, bool)
    first[doc] = True
    cut = np.ones(n + 1, bool)
    cut[1:n] = (c[1:] != c[:-1]) | (c[1:] == DIGIT) | first[1:n]
    at = np.flatnonzero((b[:n] == ord("'")) & cut[:n])
    at, size = _contractions(b, at)
    if len(at):
        text_end = doc[np.searchsorted(doc, at, side="right")]
        ok = at + size <= text_end
        at, size = at[ok], size[ok]
        cut[at + 1] = False
        cut[at + size] = True
    where = np.flatnonzero(cut)
    start, end = where[:-1], where[1:]
    word = ~blank[start]
    return start[word], end[word]


class WordTable:
    """Ids of words, each encoded once by ``encode`` (bytes -> list of ids)."""

    def __init__(self, encode: Callable[[bytes], list[int]]):
        self.encode = encode
        self._clear()

    def _clear(self) -> None:
        size = 1 << TABLE_BITS
        self.key = np.zeros((3, size), np.uint64)
        self.slot = np.full(size, -1, np.int32)
        self.at = np.zeros(TABLE_WORDS, np.int64)    # where a word's ids start in the pool
        self.many = np.zeros(TABLE_WORDS, np.int32)  # how many ids it has
        self.pool = np.zeros(1 << 20, np.uint32)
        self.words = self.used = 0
        self.long: dict[bytes, list[int]] = {}

    def _store(self, ids: list[int]) -> int:
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), len(ids)), np.uint32)])
        w = self.words
        self.at[w], self.many[w] = self.used, len(ids)
        self.pool[self.used:self.used + len(ids)] = ids
        self.used += len(ids)
        self.words += 1
        return w

    def _find(self, k: np.ndarray) -> np.ndarray:
        """Word number of each key (columns of ``k``), -1 where it is not in the table; leaves places in self.place."""
        mix = (k[0] * np.uint64(0x9E3779B97F4A7C15)) ^ (k[1] * np.uint64(0xC2B2AE3D27D4EB4F)) \
            ^ (k[2] * np.uint64(0x165667B19E3779F9))
        mix ^= mix >> np.uint64(29)
        place = ((mix * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        out = self.slot[place]
        open_ = np.flatnonzero(out >= 0)
        while len(open_):
            p = place[open_]
            wrong = (self.key[0][p] != k[0][open_]) | (self.key[1][p] != k[1][open_]) | (self.key[2][p] != k[2][open_])
            open_ = open_[wrong]
            place[open_] = (place[open_] + 1) & ((1 << TABLE_BITS) - 1)
            out[open_] = self.slot[place[open_]]
            open_ = open_[out[open_] >= 0]
        self.place = place
        return out

    def lookup(self, b: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pool, first id, number of ids) of each word; fills the table."""
        raw = b.tobytes()
        size = end - start
        short = np.flatnonzero(size <= KEY_BYTES)
        eight = np.ndarray((len(b) - 7,), "<u8", b.tobytes(), strides=(1,))
        s, m = start[short], size[short]
        k = np.empty((3, len(short)), np.uint64)
        for j in range(3):
            have = np.clip(m - 8 * j, 0, 8)
            k[j] = eight[s + 8 * j] & _MASKS[have]
        if self.words + len(short) // 4 > TABLE_WORDS or len(self.long) > LONG_WORDS:
            self._clear()
        found = self._find(k)
        miss = np.flatnonzero(found < 0)
        while len(miss):
            # one of each missing key; every key goes to the first free place of its walk
            _, one = np.unique(self.place[miss], return_index=True)
            new = miss[one]
            if self.words + len(new) > TABLE_WORDS:
                self._clear()
                found = self._find(k)
                miss = np.flatnonzero(found < 0)
                continue
            for i in new.tolist():
                a = int(s[i])
                w = self._store(self.encode(raw[a:a + int(m[i])]))
                p = self.place[i]
                self.slot[p] = w
                self.key[0][p], self.key[1][p], self.key[2][p] = k[0][i], k[1][i], k[2][i]
            found[miss] = self._find(k[:, miss])
            again = miss[found[miss] < 0]
            if len(again):
                place = self.place[found[miss] < 0]
                full = np.zeros(len(found), np.int64)
                full[again] = place
                self.place = full
            miss = again
        at, many = np.empty(len(start), np.int64), np.empty(len(start), np.int64)
        at[short], many[short] = self.at[found], self.many[found]
        pool = self.pool[:self.used]
        long = np.flatnonzero(size > KEY_BYTES)
        if len(long):
            extra, base = [], len(pool)
            for i in long.tolist():
                word = raw[int(start[i]):int(end[i])]
                ids = self.long.get(word)
                if ids is None:
                    ids = self.encode(word)
                    if len(word) <= 200:
                        self.long[word] = ids
                at[i], many[i] = base + len(extra), len(ids)
                extra += ids
            pool = np.concatenate([pool, np.array(extra, np.uint32)])
        return pool, at, many


_MASKS = np.array([(1 << (8 * i)) - 1 for i in range(9)], np.uint64)


class BatchEncoder:
    """Ids of batches of whole texts.

    words: ``spaced_words`` or ``bare_words``; word_ids: ids of one word;
    text_ids: ids of a text by the library; added: strings of added tokens.
    """

    def __init__(self, words, word_ids, text_ids, added, lower: bool = False):
        self.words, self.text_ids, self.lower = words, text_ids, lower
        self.table = WordTable(word_ids)
        self.special = re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None

    def plain(self, text: str) -> bool:
        return not NOT_PLAIN.search(text) and not (self.special and self.special.search(text))

    def _spans(self, texts: list[str]):
        data = [(t.lower() if self.lower else t).encode() for t in texts]
        doc = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
        b = np.frombuffer(b"".join(data) + bytes(32), np.uint8)
        start, end = self.words(b, np.unique(doc))
        pool, at, many = self.table.lookup(b, start, end)
        edge = np.searchsorted(start, doc)  # words of text i: edge[i] to edge[i + 1]
        total = np.concatenate([[0], np.cumsum(many)])
        return pool, at, many, total[edge]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Unsigned 32-bit ids of each text."""
        easy = [i for i, t in enumerate(texts) if t and self.plain(t)]
        out: list = [None] * len(texts)
        if easy:
            pool, at, many, edge = self._spans([texts[i] for i in easy])
            skip = np.cumsum(many) - many
            flat = pool[np.repeat(at - skip, many) + np.arange(edge[-1])]
            for j, i in enumerate(easy):
                out[i] = flat[edge[j]:edge[j + 1]]
        for i, t in enumerate(texts):
            if out[i] is None:
                out[i] = np.array(self.text_ids(t) if t else [], np.uint32)
        return out

    def counts(self, texts: list[str]) -> list[int]:
        """Number of ids of each text."""
        easy = [i for i, t in enumerate(texts) if t and self.plain(t)]
        out: list = [None] * len(texts)
        if easy:
            edge = self._spans([texts[i] for i in easy])[3]
            for i, n in zip(easy, np.diff(edge).tolist(), strict=True):
                out[i] = n
        return [(len(self.text_ids(t)) if t else 0) if n is None else n for n, t in zip(out, texts, strict=True)]


def library(path: str):
    """The tokenizer of a file, without truncation and padding."""
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    return out


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> BatchEncoder:
    """Encoder of a byte-level BPE file, one per worker; its table lives on between tasks."""
    import tiktoken

    vocab, lib = Vocabulary(path), library(path)
    # the file's merges as ranks: the 256 bytes, then the merges in their order
    ranks = {bytes([b]): b for b in range(256)} | {a + b: 256 + i for i, (a, b) in enumerate(vocab.merges)}
    assert len(ranks) == 256 + len(vocab.merges), "two merges give the same token"
    ids = [vocab.ids[t] for t in ranks]
    core = tiktoken.Encoding("ranks", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})

    def word_ids(word: bytes) -> list[int]:
        return [ids[r] for r in core.encode_ordinary(word.decode())]

    return BatchEncoder(spaced_words, word_ids, lambda t: lib.encode(t, add_special_tokens=False).ids, vocab.added)


def some(batch, rows: int = 1000, chars: int = 2_000_000, text: int = 1):
    """Slices of an Arrow batch of at most ``rows`` rows and, but for single rows, about ``chars`` bytes of text."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    at = 0
    while at < batch.num_rows:
        inside = int(np.searchsorted(np.cumsum(sizes[at:at + rows]), chars, side="right"))
        n = min(max(1, inside), batch.num_rows - at)
        yield batch.slice(at, n)
        at += n
