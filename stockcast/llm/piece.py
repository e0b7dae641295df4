"""SentencePiece encoding by backtracking, exact for merge-type (BPE) models, and decoding.

A sequence of pieces is what merging gives if and only if every two neighbours
are: merging the characters of both together gives the two again. So no merge
is played through for a whole word. An Aho-Corasick automaton of all pieces
finds the longest piece at every place; the encoder appends it where it is
compatible with the piece before it, goes on to the next shorter piece at that
place where not, and steps back one piece where none is left. A bit per place
marks those that were left in failure, so each is entered once and the work is
linear. Whether two pieces are compatible is settled by merging them, once per
pair (a bounded table).

Merge order: the highest score first, the leftmost of equal ones.

No piece holds a blank sign after another character (held against the model when
it is loaded), so no merge crosses the place before a run of blanks: texts are
encoded in such stretches, each distinct stretch once per worker while it is in
a table of at most ``TABLE_WORDS``. Characters without a piece become the
pieces of their UTF-8 bytes.

Defined results: null text counts as empty (no ids, empty text); a null doc_id
stays null; repeated rows are encoded each; whole texts of any length; an empty
table gives no rows; other columns are ignored, whatever their names. Blank
signs (U+2581) inside texts decode to blanks, as the library's do.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast.llm.common import ship_package
from stockcast.llm.words import some

BLANK = "\u2581"
TABLE_WORDS = 500_000
TABLE_PAIRS = 500_000
LONG_WORD = 64      # longer stretches are encoded each time
SLICE = 1_000_000   # characters of a text that are hashed at once
NEVER = float("-inf")
CODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Pieces:
    """Pieces of a merge-type model with byte pieces, their scores, and the encoder."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.normalize = model.normalize
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.byte_ids = [0] * 256
        self.surface: dict[int, str | bytes] = {}  # text of a piece, or its one byte
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.surface[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[piece], self.score[piece] = i, model.get_score(i)
                self.surface[i] = piece.replace(BLANK, " ")
        if any(BLANK in p.lstrip(BLANK) for p in self.ids):
            raise ValueError("a piece holds a blank after another character: texts can't be cut at blanks")
        self.machine = ahocorasick.Automaton()
        for p in self.ids:
            self.machine.add_word(p, p)
        self.machine.make_automaton()
        self.shorter: dict[str, str | None] = {}  # the longest piece that starts a piece
        for p in self.ids:
            self.shorter[p] = next((p[:n] for n in range(len(p) - 1, 0, -1) if p[:n] in self.ids), None)
        self.id_text = {p: str(i) for p, i in self.ids.items()}
        self.text = {p: self.surface[i] for p, i in self.ids.items()}
        self.fits: dict[str, dict[str, bool]] = {}  # piece -> piece after it -> whether they are compatible
        self.pairs = 0                              # number of those
        self.table: dict[str, tuple[int, str, str]] = {}

    def stays(self, left: str, right: str) -> bool:
        """Whether merging the characters of both together gives the two again, by playing the merges through."""
        parts, get = [*left, *right], self.score.get
        edge = len(left)  # parts before it belong to ``left``
        gain = [get(a + b, NEVER) for a, b in zip(parts, parts[1:])]  # noqa: B905
        while gain and (best := max(gain)) != NEVER:
            i = gain.index(best)
            if i == edge - 1:
                return False
            edge -= i < edge
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del gain[i]
            if i:
                gain[i - 1] = get(parts[i - 1] + parts[i], NEVER)
            if i < len(gain):
                gain[i] = get(parts[i] + parts[i + 1], NEVER)
        return parts == [left, right]

    def compatible(self, left: str, right: str) -> bool:
        found = self.fits.get(left, {}).get(right)
        if found is None:
            if self.pairs >= TABLE_PAIRS:
                self.fits.clear()
                self.pairs = 0
            found = self.fits.setdefault(left, {})[right] = self.stays(left, right)
            self.pairs += 1
        return found

    def pieces(self, word: str) -> list[str]:
        """Pieces of a stretch; characters without a piece stand for themselves."""
        size = len(word)
        longest: list[str] = list(word)
        for last, p in self.machine.iter(word):  # in the order of their ends: the longest at a place comes last
            longest[last - len(p) + 1] = p
        out: list[str] = []
        failed, stepped = bytearray(size // 8 + 1), False  # a bit per place, and whether one is set
        fits, shorter, none = self.fits, self.shorter, {}
        at, p, before = 0, longest[0], None
        while True:
            end = at + len(p)
            if before is None:
                fit = True
            else:
                fit = fits.get(before, none).get(p)
                if fit is None:
                    fit = self.compatible(before, p)
            if fit and not (stepped and failed[end >> 3] >> (end & 7) & 1):
                out.append(p)
                if end == size:
                    return out
                at, before, p = end, p, longest[end]
                continue
            p = shorter.get(p)
            if p is None:  # nothing fits here: never come back, shorten the piece before
                failed[at >> 3] |= 1 << (at & 7)
                stepped = True
                p = out.pop()
                before = out[-1] if out else None
                at -= len(p)

    def word_ids(self, word: str) -> list[int]:
        out: list[int] = []
        for p in self.pieces(word):
            i = self.ids.get(p)
            out += [i] if i is not None else [self.byte_ids[b] for b in p.encode()]
        return out

    def text_of(self, ids: list[int]) -> str:
        """Text of a stretch's ids; a run of byte pieces is read as UTF-8."""
        out, held = [], b""
        for i in ids:
            s = self.surface[i]
            if isinstance(s, bytes):
                held += s
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held = b""
            out.append(s)
        return "".join(out) + held.decode("utf-8", "replace")

    def coded(self, word: str) -> tuple[int, str, str]:
        """(number of ids, ids as text, decoded text) of a stretch."""
        found = self.pieces(word)
        try:
            out = (len(found), ",".join([self.id_text[p] for p in found]), "".join([self.text[p] for p in found]))
        except KeyError:  # a character without a piece
            ids = self.word_ids(word)
            out = (len(ids), ",".join(map(str, ids)), self.text_of(ids))
        if len(word) <= LONG_WORD:
            if len(self.table) >= TABLE_WORDS:
                self.table.clear()
            self.table[word] = out
        return out

    def encode(self, text: str) -> list[int]:
        return [i for w in STRETCH.findall(self.normalize(text)) for i in self.word_ids(w)]

    def decode(self, ids: list[int]) -> str:
        return self.text_of(ids).removeprefix(" ")

    def digests(self, text: str) -> tuple[int, str, str]:
        """(number of ids, SHA-256 of the ids, SHA-256 of the decoded text), a slice of the text at a time."""
        total, ids_hash, text_hash = 0, hashlib.sha256(), hashlib.sha256()
        whole, get = self.normalize(text), self.table.get
        at = 0
        while at < len(whole):
            end = at + SLICE
            if end < len(whole):  # go on to the next place where stretches begin
                cut = EDGE.search(whole, end)
                end = cut.start() + 1 if cut else len(whole)
            parts = [get(w) or self.coded(w) for w in STRETCH.findall(whole, at, end)]
            if at:
                ids_hash.update(b",")
            ids_hash.update(",".join([p[1] for p in parts]).encode())
            back = "".join([p[2] for p in parts])
            text_hash.update((back if at else back.removeprefix(" ")).encode())
            total += sum([p[0] for p in parts])
            at = end
        return total, ids_hash.hexdigest(), text_hash.hexdigest()


#: A run of blanks with what follows it, and the end of such a stretch before the next blank.
STRETCH = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
EDGE = re.compile(f"[^{BLANK}](?={BLANK})")


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    """One model per worker and file; its tables live on between tasks."""
    return Pieces(path)


def encode_and_decode(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of whole texts by the model at ``path``."""
    ship_package(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            for part in some(batch):
                n, ids, text = zip(*(model.digests(t or "") for t in part.column(1).to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(text)],
                                                 names=[f.split()[0] for f in CODED.split(", ")])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, CODED)
