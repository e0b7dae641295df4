"""The streaming byte-pair codec and the SentencePiece encoder against their libraries."""

import hashlib
import random
import struct
import tracemalloc

import public_tokenizers as P
import pyarrow.parquet as pq
import pytest
import sentencepiece

from stockcast.llm import bpe, piece
from stockcast.llm.words import library

BYTE, PIECE = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
ALPHABET = [*"ab'stvlmreÉİß  \n\t.,!12é<|>日🦆\x85\xa0 ", "<|endoftext|>", "'ll", "   ", "''"]
PIECE_ALPHABET = [" ", "  ", "a", "b", "the", "\n", "日", "本", "🤖", "é", "▁", "\0", "½", "A", "in", "ing", "_", "0", "1", "ñ", "　",
                  "\t", "<s>", "<0x0A>", " " * 17]


def byte_digests(lib, text):
    ids = lib.encode(text, add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
            hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest())


def piece_digests(lib, text):
    ids = lib.encode(text)
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest()


# byte-pair codec ----------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("size", [1, 2, 7, 65_536])
def test_codec_pieces_of_any_size(monkeypatch, size):
    monkeypatch.setattr(bpe, "PIECE", size)
    lib, rng = library(BYTE), random.Random(size)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["a'b'c's''t" * 5, "'''s", "12ab34!?'s  \n x", "", "<|endoftext|>", "x<|endoftext|><|endoftext|> "]
    assert bpe.codec(BYTE).coded(texts) == [byte_digests(lib, t) for t in texts]


def test_codec_ids_all_come_from_the_transducer(monkeypatch):
    fed, emitted = [], []
    feed, finish = bpe.Encoder.feed, bpe.Encoder.finish

    def count_feed(self, data):
        out = feed(self, data)
        fed.append(data)
        emitted.append(len(out))
        return out

    def count_finish(self):
        out = finish(self)
        emitted.append(len(out))
        return out
    monkeypatch.setattr(bpe.Encoder, "feed", count_feed)
    monkeypatch.setattr(bpe.Encoder, "finish", count_finish)
    codec = bpe.Codec(BYTE)  # no word met before
    texts = [r or "" for r in pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()]
    lib, distinct = library(BYTE), set()
    for t in texts:
        distinct.update(t[a:b] for _, (a, b) in lib.pre_tokenizer.pre_tokenize_str(t))
    total = sum(n for n, *_ in codec.coded(texts))
    assert {w.encode() for w in distinct} == set(fed)
    assert sum(emitted) >= sum(len(lib.encode(w, add_special_tokens=False).ids) for w in distinct)
    assert total == sum(len(e.ids) for e in lib.encode_batch(texts, add_special_tokens=False))


def test_codec_memory_does_not_grow_with_the_text():
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(5000)]
    codec, peaks = bpe.codec(BYTE), []
    codec.coded([" ".join(words)])
    for n in (300_000, 1_800_000):
        text = " ".join(rng.choice(words) for _ in range(n))
        tracemalloc.start()
        codec.coded([text])
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.3 * peaks[0]


def test_transducer_buffer_is_bounded_on_a_word_of_a_million_bytes():
    codec = bpe.codec(BYTE)
    stream, most, ids = bpe.Encoder(codec.merges), 0, 0
    for _ in range(1000):
        ids += len(stream.feed(b"abcde" * 200))
        most = max(most, len(stream.buffer))
    assert most <= stream.window + codec.merges.lookahead and stream.window == bpe.WINDOW
    assert ids + len(stream.finish()) == len(library(BYTE).encode("abcde" * 200_000, add_special_tokens=False).ids)


# SentencePiece ------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("size", [3, 1_000_000])
def test_piece_encoder_against_the_library(monkeypatch, size):
    monkeypatch.setattr(piece, "SLICE", size)
    lib, model, rng = sentencepiece.SentencePieceProcessor(model_file=PIECE), piece.pieces(PIECE), random.Random(1)
    texts = ["".join(rng.choice(PIECE_ALPHABET) for _ in range(rng.randint(0, 25))) for _ in range(4000)]
    texts += ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += [" " * n + end for n in range(40) for end in ("", "a", "the", "_")] + ["", "▁", "▁▁x ▁", "日 本", "x" * 5000]
    for t in texts:
        ids = lib.encode(t)
        assert model.encode(t) == ids and model.decode(ids) == lib.decode(ids)
        assert model.digests(t) == piece_digests(lib, t)


def test_piece_encoder_takes_shorter_pieces_where_the_longest_does_not_fit():
    model, lib, rng = piece.Pieces(PIECE), sentencepiece.SentencePieceProcessor(model_file=PIECE), random.Random(5)
    shorter = 0
    for _ in range(300):
        word = "".join(rng.choice("abcdeinorstu") for _ in range(rng.randint(2, 14)))
        found, at = model.pieces(word), 0
        for p in found:
            shorter += p != max((q for q in model.ids if word.startswith(q, at)), key=len)
            at += len(p)
        assert "".join(found) == word and model.encode(word) == lib.encode(word)
    assert shorter > 50
    text = "".join(rng.choice("abcdeinorstu日本") for _ in range(200_000))  # one word
    assert model.encode(text) == lib.encode(text)


def test_neighbours_are_compatible_if_merging_gives_them_again():
    model, lib, rng = piece.pieces(PIECE), sentencepiece.SentencePieceProcessor(model_file=PIECE), random.Random(8)
    # after a line break, which has no piece of its own, no blank is put before the text
    plain = [p for p in model.ids if "▁" not in p and lib.encode("\n" + p, out_type=str)[2:] == [p]]
    fits = 0
    for _ in range(5000):
        a, b = rng.choice(plain), rng.choice(plain)
        want = lib.encode("\n" + a + b, out_type=str)[2:] == [a, b]
        assert model.compatible(a, b) == want
        fits += want
    assert 100 < fits < 4900


def test_piece_tables_are_bounded(monkeypatch):
    monkeypatch.setattr(piece, "TABLE_WORDS", 50)
    monkeypatch.setattr(piece, "TABLE_PAIRS", 50)
    model, lib, rng = piece.Pieces(PIECE), sentencepiece.SentencePieceProcessor(model_file=PIECE), random.Random(7)
    text = " ".join("".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 8))) for _ in range(2000)) + " " + "x" * 100
    assert model.digests(text) == piece_digests(lib, text)
    assert len(model.table) <= 50 and model.pairs <= 50 and sum(map(len, model.fits.values())) <= 50 and "▁" + "x" * 100 not in model.table


def test_piece_query_rows(spark):
    lib, rng = sentencepiece.SentencePieceProcessor(model_file=PIECE), random.Random(3)
    texts = ["".join(rng.choice(PIECE_ALPHABET) for _ in range(rng.randint(0, 25))) for _ in range(60)]
    texts += [None, "", "same text", "same text", "word " * 3000, "x" * 4000 + " end"]
    rows = [(i if i != 5 else None, t, "clash") for i, t in enumerate(texts)]
    rows.append(rows[7])
    df = spark.createDataFrame(rows, "doc_id long, text string, ids_sha256 string")
    got = [str(tuple(r)) for r in piece.encode_and_decode(df, PIECE).collect()]
    assert sorted(got) == sorted(str((r[0], *piece_digests(lib, r[1] or ""))) for r in rows)
    assert piece.encode_and_decode(df.filter("false"), PIECE).count() == 0


def test_piece_query_on_whole_documents(spark):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {r["doc_id"]: piece_digests(lib, r["text"] or "") for r in docs.collect()}
    assert {r["doc_id"]: tuple(r)[1:] for r in piece.encode_and_decode(docs, PIECE).collect()} == want
