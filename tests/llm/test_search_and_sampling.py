"""Ranked lexical search and importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockcast.llm import lexical, resample

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
DOCS = "doc_id long, text string, item_id string, term string, rank int, score double"
SIGNS = ["the", "The", "of", "É", "é", "日本", "x1", "İ", "a", "b", "ß", "\x80", "c-d", "e_f", "g'h", " ", "i\nj", "\t", "1,2", "٣", "[k]"]


def rows(seed=4, n=150):
    rng = random.Random(seed)
    text = lambda m: " ".join(rng.choice(SIGNS) for _ in range(m))
    texts = [text(rng.randint(0, 60)) for _ in range(n)]
    texts += [None, "", " .,", "the", "the", "THE the " * 3000, texts[3], texts[3], "word" * 500]
    out = [(i * 3 - 50, t, "clash", "clash", 1, 0.5) for i, t in enumerate(texts)]
    return [*out, out[4], out[4], (None, texts[3], "", "", 1, 0.5), (None, None, "", "", 1, 0.5)]


def items(seed=5):
    rng = random.Random(seed)
    out = [(i, " ".join(rng.choice(SIGNS) for _ in range(rng.randint(1, 12)))) for i in range(20)]
    return [*out, (20, "nowhere"), (21, None), (22, ""), (23, "the the THE"), (2, "more of item two x1"), (None, "the"), out[7], (24, out[3][1])]


# ranked search ------------------------------------------------------------------------------------------------------

def plain_ranking(documents, queries, k):
    """Every document scored for every item, by the formula."""
    cut = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    docs = [(i, cut.findall((t or "").translate(LOWER))) for i, t, *_ in documents if i is not None]
    docs = [(i, t) for i, t in docs if t]
    n_docs, n_terms = len(docs), sum(len(t) for _, t in docs)
    df = {}
    for _, terms in docs:
        for t in set(terms):
            df[t] = df.get(t, 0) + 1
    asked = {}
    for i, t in queries:
        if i is not None:
            asked.setdefault(i, set()).update(cut.findall((t or "").translate(LOWER)))
    out = []
    for item, terms in asked.items():
        found = []
        for doc, words in docs:
            m, score = 50 + (50 * len(words) * n_docs) // n_terms, 0
            for t in terms:
                tf = words.count(t)
                if tf:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                found.append((-score, doc))
        out += [(item, r, doc, -s) for r, (s, doc) in enumerate(sorted(found)[:k], 1)]
    return out


@pytest.mark.parametrize(("block", "keep"), [(100_000, 200_000), (10, 0)])
def test_ranked_search(spark, monkeypatch, block, keep):
    monkeypatch.setattr(lexical, "KEEP_ROWS", keep)
    documents, queries = rows(), items()
    docs = spark.createDataFrame(documents, DOCS).repartition(5)
    asked = spark.createDataFrame([(i, t, 7) for i, t in queries], "item_id long, text string, doc_id int")
    for k in (1, 50):
        got = [tuple(r) for r in lexical.rank_documents(docs, asked, k, block).collect()]
        want = plain_ranking(documents, queries, k)
        assert sorted(got) == sorted(want) and len(want) > 10
    assert lexical.rank_documents(docs, asked, 50).schema.simpleString() == "struct<item_id:bigint,rank:int,doc_id:bigint,score:bigint>"


def test_ranked_search_of_empty_tables(spark):
    docs = spark.createDataFrame(rows(), DOCS)
    asked = spark.createDataFrame(items(), "item_id long, text string")
    assert lexical.rank_documents(docs.filter("false"), asked).count() == 0
    assert lexical.rank_documents(docs, asked.filter("false")).count() == 0
    assert lexical.rank_documents(docs, asked.filter("item_id in (21, 22)")).count() == 0


def test_automaton_counts_whole_terms_only():
    found = lexical.Automaton([(1, ["a", "ab", "é"]), (2, ["ab", "b"])])
    texts = [lexical.scannable(t) for t in ("a ab abc a-b A", "", None, "éé é É", "aé")]
    doc, term, tf = found.count(texts)
    names = sorted(["a".encode(), "ab".encode(), "é".encode(), "b".encode()])
    assert [(d, names[t].decode(), n) for d, t, n in zip(doc.tolist(), term.tolist(), tf.tolist(), strict=True)] == \
        [(0, "a", 3), (0, "ab", 1), (0, "b", 1), (3, "é", 1)]


# resampling ---------------------------------------------------------------------------------------------------------

def plain_resample(documents, target, longest, buckets, least, percent):
    cut = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def read(text):
        words = cut.findall((text or "").translate(LOWER))
        runs = [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]
    s, t = [0] * buckets, [0] * buckets
    for table, column in ((documents, s), (target, t)):
        for _, text, *_ in table:
            for b in read(text)[1]:
                column[b] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t, strict=True)]
    out, pool = [], []
    for i, text, *_ in documents:
        n, found = read(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
        row = [i, len(found), weight, None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), None]
        out.append(row)
        if i is not None and n >= least:
            pool.append(row)
    pool.sort(key=lambda r: (-r[3], r[0], r[1]))
    for rank, row in enumerate(pool[:percent * len(pool) // 100], 1):
        row[4] = rank
    return [tuple(r) for r in out]


@pytest.mark.parametrize(("longest", "buckets", "block"), [(1, 10_000, 1 << 16), (3, 97, 10)])
def test_resampling(spark, longest, buckets, block):
    documents, target = rows(), items()
    docs = spark.createDataFrame(documents, DOCS).repartition(5)
    wanted = spark.createDataFrame(target, "item_id long, text string")
    got = resample.resample(docs, wanted, longest, buckets, 2024, 20, 40, block)
    want = plain_resample(documents, target, longest, buckets, 20, 40)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert sum(r[4] is not None for r in want) > 20
    assert got.schema.simpleString() == "struct<doc_id:bigint,n_features:bigint,weight:bigint,score:bigint,rank:bigint>"


def test_resampling_of_empty_tables(spark):
    docs = spark.createDataFrame(rows(), DOCS)
    wanted = spark.createDataFrame(items(), "item_id long, text string")
    assert resample.resample(docs.filter("false"), wanted).count() == 0
    empty = [tuple(r) for r in resample.resample(docs, wanted.filter("false"), percent=40).collect()]
    assert sorted(map(str, empty)) == sorted(map(str, plain_resample(rows(), [], 1, 10_000, 20, 40)))
    short = [tuple(r) for r in resample.resample(docs, wanted, least_words=10 ** 6).collect()]
    assert len(short) == len(rows()) and all(r[4] is None for r in short)


def test_resampling_does_not_depend_on_the_partitioning(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    wanted = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    out = {tuple(sorted(map(str, resample.resample(docs.repartition(n), wanted, block_rows=64).collect()))) for n in (1, 7)}
    assert len(out) == 1


def test_radix_places_of_hot_and_wide_keys(spark):
    rng = random.Random(1)
    data = [(rng.choice([0, 0, 0, 5, 1 << 40, (1 << 62) + 3]), rng.randrange(3), i) for i in range(3000)]
    df = spark.createDataFrame(data, "a long, b long, i long").repartition(6)
    got = resample.radix_places(df, [(F.col("a"), 63), (F.col("b"), 2)], block_rows=100)
    placed = sorted((r["place"], r["a"], r["b"]) for r in got.collect())
    assert [p for p, *_ in placed] == list(range(3000))
    assert [(a, b) for _, a, b in placed] == sorted((a, b) for a, b, _ in data)


def test_digits_cut_a_composite_key(spark):
    parts = resample.digits([(F.col("a"), 7), (F.col("b"), 18)], 12)
    got = spark.createDataFrame([(0b1010101, 0b110011001100110011)], "a long, b long").select(*parts).first()
    whole = 0b1010101 << 18 | 0b110011001100110011
    assert list(got) == [whole & 4095, whole >> 12 & 4095, whole >> 24]


def test_crc32_of_short_and_long_features():
    rng = random.Random(2)
    words = [bytes(rng.randrange(256) for _ in range(n)) for n in [0, 1, 2, 63, 64, 65, 200, *range(30)]]
    ends = np.cumsum([len(w) for w in words])
    got = resample.crc32(np.frombuffer(b"".join(words) + b"x", np.uint8), ends - [len(w) for w in words], ends)
    assert got.tolist() == [zlib.crc32(w) for w in words]
