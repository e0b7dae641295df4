"""Chat formatting, packing, token counts, BPE and language ID against brute force and the libraries."""

import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from stockcast.llm import bpe, chat, langid, packing, tokencount
from stockcast.llm.words import byte_bpe, library

BYTE, WORD = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, piece int, fingerprint string"
ALPHABET = list("ab'stvlmreÉİß  \n\t.,!12é<|>日🦆\x85\xa0 ")


def odd_texts(n=1500, seed=3):
    rng = random.Random(seed)
    out = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30))) for _ in range(n)]
    return out + ["", " ", "<|endoftext|>a<|endoftext|> <|endoftext|>x", "<|startoftext|> A", "'s 'S it's ''ll", "x" * 5000,
                  "日本語 é x", "  x\n\n y", "a" * 40 + "'ll " + "b" * 60]


@pytest.fixture(scope="module")
def docs(spark):
    texts = odd_texts(60) + [None, None, "same text here", "same text here", "word " * 3000, "x" * 4000 + " end"]
    rows = [(i if i != 5 else None, t, None, None, 1, "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + [rows[-3]], DOCS), rows + [rows[-3]]


# chat ---------------------------------------------------------------------------------------------------------------

CONTROL = ["<s>", "</s>", "[INST]", "[/INST]"]
CHATS = [
    (1, 0, "user", "hello"), (1, 1, "assistant", "hi there"),
    (2, 0, "system", ""), (2, 1, "user", None), (2, 2, "assistant", None), (2, 2, "assistant", None),
    (3, 1, "assistant", "</s>[INST] ok [/INST]"), (3, 0, "user", "\\[INST] a \\\\</s> b \\"),
    (4, 0, None, " lead and trail "), (4, 1, "tool [INST]\nx</s>", "line\nbreak <s>"), (4, 2, "assistant", " </s>"),
    (5, 0, "assistant", "\\"), (5, 1, "user", "[INST] x\ny [/INST][INST] z [/INST]"), (5, 2, "assistant", "<s> 🦆 </s>"),
    (None, 0, "user", "no id"), (6, None, "user", "no turn"), (6, 0, "assistant", "x" * 20000 + "[/INST]"),
]


def test_chat_round_trip_of_conflicting_content(spark):
    rows = spark.createDataFrame([(*r, "x") for r in CHATS], "conv_id long, turn long, role string, text string, formatted string")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(rows)).collect()}
    assert len(got) == 7
    for conv, r in got.items():
        said = sorted((t if t is not None else -1, role or "", text or "") for c, t, role, text in CHATS if c == conv)
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(role, text) for _, role, text in said]
        assert r["loss_text"] == "".join(text for _, role, text in said if role == "assistant")
    assert got[1]["formatted"] == "[INST] user\nhello [/INST]<s> hi there </s>"


def test_chat_spans_cover_the_masked_text(spark):
    rows = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(rows)
    texts = {r["conv_id"]: r["formatted"] for r in formatted.collect()}
    spans = {}
    for r in chat.loss_spans(formatted).collect():
        spans.setdefault(r["conv_id"], []).append(texts[r["conv_id"]][r["start"]:r["start"] + r["length"]])
    assert spans[1] == ["hi there"] and spans[3] == ["\\</s>\\[INST] ok \\[/INST]"]


def test_chat_main_path_has_no_python_and_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    out = chat.op7(spark, empty)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
    rows = out.collect()
    assert [r["conv_id"] for r in rows] == [-1]
    text = "</s>[INST] ok [/INST]"
    assert rows[0]["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest() and rows[0]["loss_chars"] == len(text)
    said = f"user\n{text}\nassistant\n{text}\n"
    assert rows[0]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest() and rows[0]["n_turns"] == 2
    assert chat.format_conversations(empty).count() == 0


# words, packing -----------------------------------------------------------------------------------------------------

def test_word_table_gives_the_library_ids():
    lib, texts = library(BYTE), odd_texts()
    for t, ids in zip(texts, byte_bpe(BYTE).ids(texts), strict=True):
        assert ids.tolist() == lib.encode(t, add_special_tokens=False).ids


def one_by_one(lengths, capacity):
    """The procedure itself, one sequence at a time."""
    left, out = sorted(lengths), []
    while left:
        bin_, gap = [], capacity
        while (fit := [x for x in left if x <= gap]):
            left.remove(fit[-1])
            bin_.append(fit[-1])
            gap -= fit[-1]
        small = min(bin_)
        pairs = [(a + b, max(a, b), min(a, b)) for i, a in enumerate(left) for b in left[i + 1:] if small < a + b <= gap + small]
        if gap and pairs:
            total = max(p[0] for p in pairs)
            _, a, b = min((p for p in pairs if p[0] == total), key=lambda p: p[1] - p[2])
            bin_.remove(small)
            left.append(small)
            left.remove(a)
            left.remove(b)
            left.sort()
            bin_ += [a, b]
        out.append(sorted(bin_, reverse=True))
    return sorted(out)


@pytest.mark.parametrize("seed", range(6))
def test_plan_on_counts_is_the_procedure_one_by_one(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([rng.randint(1, 32), rng.randint(1, 10), 17]) for _ in range(120)]
    counts = np.bincount(lengths, minlength=33)
    got = sorted(f for f, n in packing.plan(counts, 32) for _ in range(n))
    assert got == one_by_one(lengths, 32)


def test_packing_places_every_piece_once(spark, docs):
    df, rows = docs
    got = packing.pack_documents(df, BYTE, 64, 2).toPandas()
    lib = library(BYTE)
    want = []
    for r in rows:
        ids = lib.encode(r[1] or "", add_special_tokens=False).ids + [2]
        for k, (s, n) in enumerate(packing.cut_pieces(len(ids), 64)):
            want.append((str(r[0]), k, s, n, zlib.crc32(struct.pack(f"<{n}I", *ids[s:s + n]))))
        assert all(n == 64 for _, n in packing.cut_pieces(len(ids), 64)[1:])
    ids = [None if x != x else int(x) for x in got.doc_id]
    assert sorted(zip(map(str, ids), got.piece, got.start, got.length, got.ids_crc32, strict=True)) == sorted(want)
    got = got.sort_values(["sequence_id", "offset"])
    assert ((got.groupby("sequence_id").length.cumsum() - got.length) == got.offset).all()
    assert got.groupby("sequence_id").length.sum().max() <= 64
    assert packing.pack_documents(df.filter("false"), BYTE, 64, 2).count() == 0


# token counts -------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("chunk,overlap", [(300, 16), (1000, 64)])
def test_huge_texts_splice_to_the_library_count(chunk, overlap):
    lib, rng = library(WORD), random.Random(5)
    words = ["the", "Ering", "Straße", "日本", "x'll", "12", "...", "<|endoftext|>", "\n\n", "  "]
    for text in ["".join(rng.choice(words) + rng.choice([" ", ""]) for _ in range(2500)), "ab" * 1500,
                 " " * 2000 + "a" * 900 + " " * 3000 + ".", "x<|endoftext|>" * 150, "<|endoftext|> a" * 150, "日本 é" * 700]:
        assert tokencount.count_huge(lib, text, chunk, overlap) == len(lib.encode(text, add_special_tokens=False).ids)


def test_token_counts(spark, docs):
    df, rows = docs
    lib = library(WORD)
    got = sorted(map(str, (tuple(r) for r in tokencount.count_tokens(df, WORD, 100, chunk=2000, overlap=32).collect())))
    want = []
    for r in rows:
        n = len(lib.encode(r[1] or "", add_special_tokens=False).ids)
        want.append(str((r[0], len((r[1] or "").encode()), n, n > 100)))
    assert got == sorted(want)
    assert tokencount.count_tokens(df.filter("false"), WORD).count() == 0


# BPE ----------------------------------------------------------------------------------------------------------------

def test_transducer_is_stable_on_long_words():
    lib, codec, rng = library(BYTE), bpe.codec(BYTE), random.Random(9)
    longest = max(codec.merges.size[c] for _, c in codec.merges.table.values())
    assert longest <= codec.merges.lookahead + 1 < 4 * longest
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1500)), "a" * 900, "=" * 900, "e" * 777,
             "".join(rng.choice(["the", "ing", "tion", "er", "ations", "aaaa"]) for _ in range(300)), "____--" * 150]
    for text in texts:
        for window in (1, 40):
            out, held = [], 0
            for _, (a, b) in codec.cut(text):
                stream, data = bpe.Encoder(codec.merges, window), text[a:b].encode()
                for at in range(0, len(data), 37):
                    out += stream.feed(data[at:at + 37])
                    held = max(held, len(stream.buffer))
                out += stream.finish()
            assert out == lib.encode(text, add_special_tokens=False).ids
            assert held <= max(window, longest) * 2 + codec.merges.lookahead


def test_decoder_one_id_at_a_time():
    lib, codec, rng = library(BYTE), bpe.codec(BYTE), random.Random(4)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(20)]
        d = bpe.Decoder(codec.token_bytes)
        assert "".join(d.feed([i]) for i in ids) + d.finish() == lib.decode(ids, skip_special_tokens=False)


def test_encode_and_decode(spark, docs):
    df, rows = docs
    lib, want = library(BYTE), []
    for r in rows:
        ids = lib.encode(r[1] or "", add_special_tokens=False).ids
        back = lib.decode(ids, skip_special_tokens=False)
        want.append(str((r[0], len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                         hashlib.sha256(back.encode()).hexdigest())))
    got = [str(tuple(r)) for r in bpe.encode_and_decode(df, BYTE).collect()]
    assert sorted(got) == sorted(want)
    assert bpe.encode_and_decode(df.filter("false"), BYTE).count() == 0


# language ID --------------------------------------------------------------------------------------------------------

def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in langid._weights(rng, 3).items()}
    x, y = rng.integers(1, 256, (7, 5)), rng.integers(0, 3, 5)
    x[5:, 2] = 0
    _, grad = langid.gradients(p, x, y)
    for k in p:
        for _ in range(3):
            i = tuple(rng.integers(s) for s in p[k].shape)
            i = (i[0], x[rng.integers(5), 0]) if k.endswith("w") else i
            kept, e = p[k][i], 1e-3
            p[k][i] = kept + e
            up = langid.gradients(p, x, y)[0]
            p[k][i] = kept - e
            down = langid.gradients(p, x, y)[0]
            p[k][i] = kept
            assert abs((up - down) / 2 / e - grad[k][i]) < 2e-3 * max(0.02, abs(grad[k][i]))


def test_labeller_is_the_trained_network():
    rng = np.random.default_rng(1)
    p = langid._weights(rng, 3)
    x = rng.integers(1, 256, (9, 6))
    f, b = langid._read(p, "f", x), langid._read(p, "b", x)
    logits = p["fv"] @ f["state"] + p["bv"] @ b["state"] + p["bias"]
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    want = (e / e.sum(axis=1, keepdims=True)).sum(axis=0)
    got = langid.Labeller({"weights": p}).sums(x, np.ones(x.shape, np.float32))
    assert np.allclose(got, want, atol=1e-4)


def test_language_id_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.model_of(docs)
    odd = spark.createDataFrame([(None, None), (1, ""), (2, "12 34 !!"), (3, "..."), (3, "...")], "doc_id long, text string")
    got = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    held = got[got.held_out & got.lang.notna()]
    assert len(held) > 100 and (held.lang == held.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all() and len(got) == docs.count()
    assert [(r["lang_pred"], r["score"]) for r in langid.identify(odd, model).collect()] == [("und", 0.0)] * 5
    assert langid.keep_identified(odd, model, 0.0).count() == 0
    extra = docs.limit(5).selectExpr("source as score", "doc_id", "text", "lang as lang_pred")
    assert langid.keep_identified(extra, model, 0.0).columns == ["score", "doc_id", "text", "lang_pred"]


def test_language_id_without_labels(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id long, text string, lang string")
    model = langid.model_of(docs)
    assert {r["lang_pred"] for r in langid.identify(docs, model).collect()} == {"und"}
    assert langid.identify(docs.filter("false"), langid.model_of(docs.filter("false"))).count() == 0
    assert [r["doc_id"] for r in langid.keep_identified(docs, model, 0.4).collect()] == [1]
    assert langid.keep_identified(docs.filter("false"), langid.model_of(docs.filter("false")), 0.4).count() == 0


def test_language_id_of_signs_that_are_no_letters(spark):
    docs = spark.createDataFrame([(i, "a b c " * 20, lang) for i, lang in enumerate(["en", "fr"] * 20)], "doc_id long, text string, lang string")
    model = langid.model_of(docs)
    signs = ["½ ²", "Ⅷ", "①②", "1 ٣", "\u0301", "ª", "日", "ʰ", "ǅ"]
    odd = spark.createDataFrame(list(enumerate(signs)), "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(odd, model).collect()}
    letter = {r["doc_id"] for r in odd.filter(odd.text.rlike(r"\p{L}")).collect()}
    assert {i for i, lang in got.items() if lang != "und"} == letter == {5, 6, 7, 8}


def test_language_id_of_a_column_that_holds_no_languages(spark):
    docs = spark.range(5000).selectExpr("id as doc_id", "'some text' as text", "cast(id as string) as lang")
    with pytest.raises(ValueError, match="more than 256"):
        langid.model_of(docs)
