"""Deduplication, vector search, WARC and the pipeline against brute force."""

import base64
import hashlib
import random
import sys
from pathlib import Path

import numpy as np
import public_tokenizers as P
import pytest
import xxhash
import zstandard

from stockcast.llm import balltree, linededup, lsh, packing, simhash, warc
from stockcast.llm.common import shared_dir

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402

DOCS = "doc_id long, text string, row string, fp string, gone string"


def doc_rows(seed=11):
    """Small documents with exact and near copies, shared passages, nulls, repeats and empty texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7)))
    line = lambda n=9: " ".join(word() for _ in range(n))
    passage = [line(20) for _ in range(3)]
    texts = ["\n".join(line() for _ in range(rng.randint(1, 8))) for _ in range(40)]
    texts += [texts[3], texts[3], texts[5] + "\n" + line(), line() + "\n" + texts[5]]
    texts += ["\n".join([line(), *passage, line()]) for _ in range(6)]
    texts += ["\n".join(reversed(passage)), "\n".join([passage[0], "x", passage[1]]), "a b", "A B", "a\tb", "", "  ", None, None,
              "one\n" + texts[7] + "\n\none", "\n\n\n", passage[0] + " "]
    rows = [(i, t, "r", "f", "g") for i, t in enumerate(texts)]
    return rows + [(3, texts[3], "r", "f", "g"), (3, texts[5], "r", "f", "g"), (None, texts[3], "r", "f", "g"), (None, None, "r", "f", "g")]


# SimHash ------------------------------------------------------------------------------------------------------------

def plain_fingerprint(text, width=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    grams = [b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(fps, budget):
    up = list(range(len(fps)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= budget:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def test_trie_walk_finds_every_pair():
    rng = np.random.default_rng(1)
    keys = [int(x) for x in rng.integers(0, 2 ** 64, 20, dtype=np.uint64)]
    for _ in range(500):
        x = keys[rng.integers(len(keys))]
        for _ in range(rng.integers(1, 4)):
            x ^= 1 << int(rng.integers(64))
        keys.append(x)
    k = np.unique(np.array(keys, np.uint64))
    got = {p for a, b in simhash.trie_links(k, [(0, len(k), 0, len(k))], 2) for p in zip(a.tolist(), b.tolist(), strict=True)}
    near = np.bitwise_count(k[:, None] ^ k[None, :]) <= 2
    assert got == {(i, j) for i, j in zip(*(x.tolist() for x in np.nonzero(near)), strict=True) if i < j}


@pytest.mark.parametrize("hot", [512, 3])
def test_links_and_components_of_dense_groups(spark, monkeypatch, hot):
    monkeypatch.setattr(simhash, "HOT_GROUP", hot)
    rng = np.random.default_rng(2)
    fps = {int(x) for x in rng.integers(0, 2 ** 63, 30)}
    base = sorted(fps)[0]
    fps |= {base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 63, (60, 2))}
    chain = sorted(fps)[5]
    for i in range(0, 40, 2):
        chain ^= (1 << i) | (1 << (i + 1))
        fps.add(chain)
    fps = sorted(fps)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {r["node"]: r["root"] for r in simhash.components(simhash.links(df, 2)).collect()}
    want = linked(fps, 2)
    assert [got.get(f, f) for f in fps] == [fps[r] for r in want]


def test_near_duplicates(spark):
    rows = doc_rows()
    got = simhash.near_duplicates(spark.createDataFrame(rows, DOCS), 3, 2).collect()
    fps = [plain_fingerprint(r[1]) for r in rows]
    roots = linked(fps, 2)
    first = {}
    for r, root in zip(rows, roots, strict=True):
        if r[0] is not None:
            first[root] = min(first.get(root, r[0]), r[0])
    want = [str((r[0], f"{f:016x}", first.get(root))) for r, f, root in zip(rows, fps, roots, strict=True)]
    assert sorted(str(tuple(r)) for r in got) == sorted(want)
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


# line dedup ---------------------------------------------------------------------------------------------------------

def test_patience_alignment():
    assert linededup.patience(list("abcde"), list("abcde")) == [(i, i) for i in range(5)]
    assert linededup.patience(list("xabcy"), list("pabcq")) == [(1, 1), (2, 2), (3, 3)]
    assert linededup.patience(list("abab"), list("abxab")) == [(0, 0), (1, 1), (2, 3), (3, 4)]
    assert linededup.patience([], list("a")) == []
    rng = random.Random(0)
    for _ in range(300):
        a, b = ([rng.choice("abcdef") for _ in range(rng.randint(0, 9))] for _ in range(2))
        got = linededup.patience(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))  # noqa: B905
    values = [5, 1, 4, 2, 3, 9, 0]
    assert [values[i] for i in linededup.longest_increasing(values)] == [1, 2, 3, 9]


def plain_line_dedup(rows, min_words=5):
    """(doc_id, text, lines gone): every run of lines that an earlier document holds too, found by comparing all pairs of places."""
    def size(x):
        return max(len(x.split()) + sum("\u3000" < c for c in x) // 2, len(x) // 20, 1)
    cuts = [(i, text, [(k, x) for k, x in enumerate(text.split("\n")) if x.strip(" ")] if text is not None else []) for i, text, *_ in rows]
    holders = {}
    for n, (i, _, lines) in enumerate(cuts):
        for j, (_, x) in enumerate(lines):
            if i is not None:
                holders.setdefault(x, []).append((i, n, j))
    out = []
    for i, text, lines in cuts:
        gone = set()
        if i is not None:
            at = {}  # a place in both: (earlier row, its place, our place) that are equal
            for j, (_, x) in enumerate(lines):
                for other, n, k in holders[x]:
                    if other < i:
                        at[n, k, j] = x
            for n, k, j in at:
                if (n, k - 1, j - 1) not in at:  # a run starts here
                    m = 0
                    while (n, k + m, j + m) in at:
                        m += 1
                    if sum(size(at[n, k + x, j + x]) for x in range(m)) >= min_words:
                        gone |= {lines[j + x][0] for x in range(m)}
        out.append((i, text if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone), len(gone)))
    return out


def test_line_dedup(spark):
    rows = doc_rows()
    got = linededup.dedup_lines(spark.createDataFrame(rows, DOCS))
    want = plain_line_dedup(rows)
    assert sorted(str((r["doc_id"], r["text"], r["n_deleted"])) for r in got.collect()) == sorted(map(str, want))
    assert sum(n for *_, n in want) > 25
    assert linededup.dedup_lines(spark.createDataFrame([], DOCS)).count() == 0
    kept = linededup.without_repeats(spark.createDataFrame(rows, DOCS))
    assert kept.columns == ["doc_id", "text", "row", "fp", "gone"]
    assert kept.count() == sum(n == 0 or t.strip(" ") != "" for _, t, n in want)


def test_line_dedup_of_a_line_in_very_many_documents(spark):
    common = "this line is in every one of the documents here"
    rows = [(i, f"{common}\nown line number {i} of the document at hand", "", "", "") for i in range(400)]
    got = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[0].startswith(common) and all(common not in got[i] for i in range(1, 400))


@pytest.mark.parametrize("rare", [1, 32])
def test_line_dedup_of_crossing_lines(spark, monkeypatch, rare):
    monkeypatch.setattr(linededup, "RARE", rare)
    a, b, c = ("line one of the common ones here", "line two of the common ones here", "line three of the common ones here")
    # the second line crosses in the first holder of both, and goes with a later one
    rows = [(1, f"{a}\n{b}"), (2, f"{c}\n{b}\n{a}"), (3, f"{b}\nx\n{a}\ny\n{c}"), (4, f"{b}\n{a}"), (5, f"{c}\nz\n{a}\nz\n{b}")]
    rng = random.Random(8)
    for i in range(6, 60):
        rows.append((i, "\n".join(rng.choice((a, b, c, f"own line {i} {rng.random()} of this one")) for _ in range(rng.randint(1, 6)))))
    got = linededup.dedup_lines(spark.createDataFrame([(*r, "", "", "") for r in rows], DOCS))
    want = plain_line_dedup(rows)
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["text"], r["n_deleted"])) for r in got.collect())
    assert sum(n for *_, n in want) > 100


def test_line_dedup_of_passages_in_short_lines(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    verse = [" ".join(word() for _ in range(rng.randint(1, 4))) for _ in range(15)]
    dense = ["春眠不覚暁処処聞啼鳥夜来風雨声", "花落知多少"]
    blob = "x" * 150
    own = lambda: f"{word()} {word()}"
    texts = ["\n".join([*verse, own()]), "\n".join([own(), *verse]), "\n".join([own(), "\n\n".join(verse[3:9])]),
             "\n".join(dense), "\n".join([own(), dense[0], own(), dense[1], own()]), blob, f"{own()}\n{blob}",
             f"{own()}\nlist of\n{own()}", f"{own()}\nlist of", "\n".join([own(), verse[12], own()])]
    # the tail of a block whose long line has another first holder
    texts += ["a line that is long enough alone\nx", f"{own()}\na line that is long enough alone\nshort tail", "a line that is long enough alone\nshort tail"]
    rows = list(enumerate(texts))
    got = {r["doc_id"]: (r["text"], r["n_deleted"]) for r in linededup.dedup_lines(spark.createDataFrame([(*r, "", "", "") for r in rows], DOCS)).collect()}
    assert got == {i: (t, n) for i, t, n in plain_line_dedup(rows)}
    assert [got[i][1] for i in range(13)] == [0, 15, 6, 0, 1, 0, 1, 0, 0, 0, 0, 1, 2]


# vector search ------------------------------------------------------------------------------------------------------

def vector_rows(n=400, dim=12, seed=0):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim)).astype(np.float32)
    v[50:150] = v[50]  # a hot vector
    rows = [(i, [float(x) for x in r], "x", 0.5) for i, r in enumerate(v)]
    rows += [(n, None, "x", 0.5), (n + 1, [], "x", 0.5), (n + 2, [None] * dim, "x", 0.5), (n + 3, [float("nan")] * dim, "x", 0.5),
             (n + 4, [float("inf")] + [0.0] * (dim - 1), "x", 0.5), (n + 5, [0.0] * dim, "x", 0.5), (None, [1.0] * dim, "x", 0.5),
             (n + 20, [1.0, 2.0], "x", 0.5), (n + 40, [3.0, 1.0], "x", 0.5), rows[7], rows[100]]
    return rows


VECS = "vec_id long, embedding array<float>, query_id string, score double"


def usable(rows, nonzero):
    seen = {}
    for i, v, *_ in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and (any(v) or not nonzero):
            seen[(i, tuple(np.float32(x) for x in v))] = np.array(v, np.float32).astype(np.float64)
    return [(i, v) for (i, _), v in seen.items()]


@pytest.mark.parametrize("least", [4096, 64])
def test_exact_top_k(spark, monkeypatch, least):
    monkeypatch.setattr("stockcast.llm.tiles.SHARD_LEAST", least)
    monkeypatch.setattr(balltree, "LEAF", 16)
    rows = vector_rows()
    vecs = [(i, np.floor(256 * v).astype(np.int64)) for i, v in usable(rows, False)]
    want = []
    for i, q in vecs:
        if i % 10 == 0:
            near = sorted((-int(q @ v), j) for j, v in vecs if j != i and len(v) == len(q))[:5]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(near)]
    got = balltree.top_k(spark.createDataFrame(rows, VECS), every=10, k=5)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert balltree.top_k(spark.createDataFrame([], VECS)).count() == 0


def test_nearest_neighbours_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr("stockcast.llm.tiles.SHARD_LEAST", 128)
    rows = vector_rows(n=600, dim=24)
    vecs = usable(rows, True)
    at = {}
    for r in lsh.nearest(spark.createDataFrame(rows, VECS), every=20, k=20).collect():
        at.setdefault(r["query_id"], []).append(r)
    hit = total = 0
    by_id = dict(vecs)
    for i, q in vecs:
        if i % 20 == 0:
            near = sorted((-float((q * v).sum()), j) for j, v in vecs if j != i and len(v) == len(q))[:20]
            got = sorted(at.get(i, []), key=lambda r: r["rank"])
            assert [(r["score"], r["vec_id"]) for r in got] == sorted(((r["score"], r["vec_id"]) for r in got), key=lambda x: (-x[0], x[1]))
            assert all(abs(r["score"] - float((q * by_id[r["vec_id"]]).sum())) < 1e-12 for r in got)
            hit += len({j for _, j in near} & {r["vec_id"] for r in got})
            total += len(near)
    assert hit / total >= 0.9
    assert lsh.nearest(spark.createDataFrame([], VECS)).count() == 0


def test_recall_on_the_testdata(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    p = df.toPandas()
    v = np.array(p.embedding.tolist(), np.float64)
    got = lsh.nearest(df).toPandas().groupby("query_id").vec_id.apply(set)
    hits = []
    for k in np.flatnonzero(p.vec_id % 20 == 0):
        s = v @ v[k]
        s[k] = -np.inf
        hits.append(len(got[p.vec_id[k]] & set(p.vec_id[np.lexsort((p.vec_id, -s))[:20]])) / 20)
    assert np.mean(hits) >= 0.9


def recall(spark, v, k=20, every=20):
    """(share of the true neighbours found, numbers of rows per query) over all queries."""
    ids = np.arange(len(v))
    df = spark.createDataFrame([(int(i), [float(x) for x in r]) for i, r in zip(ids, v, strict=True)], "vec_id long, embedding array<double>")
    got = {}
    for r in lsh.nearest(df, every=every, k=k).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = []
    for q in ids[::every]:
        s = v @ v[q]
        s[q] = -np.inf
        want = set(np.lexsort((ids, -s))[:min(k, len(v) - 1)].tolist())
        hits.append(len(got.get(int(q), set()) & want) / len(want) if want else 1.0)
    return np.mean(hits), [len(got.get(int(q), ())) for q in ids[::every]]


def test_nearest_neighbours_with_unequal_norms(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(2000, 64))
    v /= np.linalg.norm(v, axis=1)[:, None]
    one = v.copy()
    one[7] *= 100
    for rows in (v, one, v * rng.lognormal(size=2000)[:, None], one * 1e100):
        share, many = recall(spark, rows)
        assert share >= 0.9 and set(many) == {20}


def test_nearest_neighbours_of_small_tables_are_all_rows(spark, monkeypatch):
    rng = np.random.default_rng(6)
    assert recall(spark, rng.normal(size=(15, 64)), every=1) == (1.0, [14] * 15)
    assert recall(spark, rng.normal(size=(1, 8)), every=1)[1] == [0]
    # no bucket is ever hit and no band is small: the rows come from the exact way
    monkeypatch.setattr(lsh, "SMALL", 0)
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(rng.normal(size=(40, 8)))], "vec_id long, embedding array<double>")
    got = lsh.nearest(df, every=1, k=20, tables=1, functions=6, width=1e-9, probes=1).collect()
    assert len(got) == 40 * 20


# WARC ---------------------------------------------------------------------------------------------------------------

def test_warc_round_trip(spark):
    same = "<html>" + "copy " * 300 + "</html>"
    rows = [(i, f"http://h/{i}?a=ü b\r\nX: 1", same if i % 3 == 0 else f"<p>page {i} é</p>" + "filler " * i, "clash") for i in range(90)]
    rows += [(200, None, None, ""), (201, "u", "", ""), (None, "u", "no id", ""), (None, "u", same, ""), rows[4], rows[87]]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, keeper string")
    folder = f"{shared_dir(spark)}/warc-test-{random.random()}"
    manifest = warc.write_archives(df.coalesce(1), folder, 0)
    keeper = {}
    for i, _, html, _ in rows:
        if i is not None:
            keeper[html or ""] = max(keeper.get(html or "", i), i)
    want = []
    for i, _, html, _ in rows:
        data = (html or "").encode()
        k = keeper.get(html or "")
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append(str((i, len(data), digest, "response" if i == k else "revisit", None if i == k else k)))
    assert sorted(str(tuple(r)) for r in warc.read_archives(manifest).collect()) == sorted(want)
    assert warc.read_archives(warc.write_archives(df.filter("false"), folder, 0)).count() == 0


def test_warc_small_payloads_are_all_responses_and_the_dictionary_leads(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(800)]
    rows = [(i, "http://h/", " ".join(rng.choice(words) for _ in range(400))) for i in range(200)] + [(900, "", "x"), (901, "", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    manifest = warc.write_archives(df, f"{shared_dir(spark)}/warc-test-{random.random()}", 2)
    got = warc.read_archives(manifest).collect()
    assert len(got) == 202 and {r["record_type"] for r in got} == {"response"}
    assert sum(len(r) for r in raw_archives(manifest)) == 202


def raw_archives(manifest):
    """Records of every archive, read from the plain file: each frame is decompressed alone, from its offset."""
    out = []
    for r in manifest.collect():
        data = Path(r["path"].removeprefix("file://")).read_bytes()
        assert data[:4] == warc.SKIPPABLE.to_bytes(4, "little")
        at = 8 + int.from_bytes(data[4:8], "little")
        found, offsets, records = zstandard.ZstdCompressionDict(data[8:at]), [], []
        while at < len(data):
            offsets.append(at)
            one = zstandard.ZstdDecompressor(dict_data=found).decompressobj()
            one.decompress(data[at:])
            at = len(data) - len(one.unused_data)
        for a, b in reversed(list(zip(offsets, [*offsets[1:], len(data)], strict=True))):  # in any order
            records.append(zstandard.ZstdDecompressor(dict_data=found).decompress(data[a:b]))
        assert len(records) == r["records"] and all(x.startswith(b"WARC/1.1\r\n") for x in records)
        out.append(records)
    return out


def test_warc_files_are_dictionary_compressed_at_every_size(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    archives = raw_archives(warc.write_archives(pages, f"{shared_dir(spark)}/warc-test-{random.random()}", 0))
    records = [x for a in archives for x in a]
    assert len(records) == pages.count()
    held = {x.split(b"\r\n\r\n", 2)[2].removesuffix(b"\r\n\r\n").decode() for x in records if b"WARC-Type: response" in x}
    assert held == {r["html"] or "" for r in pages.collect()}
    one = spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string")
    assert [len(a) for a in raw_archives(warc.write_archives(one, f"{shared_dir(spark)}/warc-test-{random.random()}", 0))] == [1]


def test_warc_a_payload_of_a_third_of_the_pages_is_moved_once(spark):
    hot = "<html>" + "hot " * 2000 + "</html>"
    df = spark.createDataFrame([(i, "u", hot if i % 3 == 0 else f"page {i}") for i in range(3000)], "page_id long, url string, html string")
    archives = raw_archives(warc.write_archives(df.repartition(7), f"{shared_dir(spark)}/warc-test-{random.random()}", 0))
    records = [x for a in archives for x in a]
    assert len(records) == 3000 and sum(hot.encode() in x for x in records) == 1


# pipeline -----------------------------------------------------------------------------------------------------------

def test_pipeline_stages_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = spark.createDataFrame([(100001, None, None, "s", 0), (100002, "", "en", "s", 0), (100003, "12 !!", "en", "s", 5), (None, "and the words of it", "en", "s", 19)], docs.schema)
    docs = docs.unionByName(odd).unionByName(docs.limit(3))
    at = docs
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        before = at
        at = stage(spark, before, "/root/testdata/sf0.001").cache()
        seen.append(at.count())
        if name != "packing":
            assert at.columns == docs.columns
        if name == "line_dedup":
            want = [(i, t) for i, t, n in plain_line_dedup([(r["doc_id"], r["text"]) for r in before.collect()]) if n == 0 or t.strip(" ")]
            assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["text"])) for r in at.collect())
        if name == "simhash":
            rows = before.collect()
            roots = linked([plain_fingerprint(r["text"]) for r in rows], 2)
            first = {}
            for r, root in zip(rows, roots, strict=True):
                key = (r["doc_id"] is None, r["doc_id"] or 0)
                first[root] = min(first.get(root, key), key)
            assert sorted(first.values()) == sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in at.collect())
    assert seen[1] >= docs.count() - 6 and at.select("doc_id").distinct().count() == seen[3]
    assert packing.pack_documents(docs.filter("false"), P.path("byte_bpe_50k.json")).count() == 0


# vector tiles -------------------------------------------------------------------------------------------------------

def test_top_k_ships_only_tiles_that_can_hold_a_result(spark, monkeypatch):
    from stockcast.llm import tiles
    monkeypatch.setattr(tiles, "SHARD_LEAST", 100)
    monkeypatch.setattr(tiles, "SHARD_ROWS", 300)
    monkeypatch.setattr(tiles, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 16)) * 4
    v = centres[rng.integers(0, 12, 3000)] + rng.normal(size=(3000, 16)) * 0.1
    df = spark.createDataFrame([(i, [float(x) for x in r], "x", 0.5) for i, r in enumerate(v)], VECS)
    visited, search = [], tiles.search_tiles

    def watch(packed_shards, queries, *args):
        tile = queries.selectExpr("block", "explode(shards) as shard").distinct().count()
        visited.append((tile, packed_shards.count() * queries.select("block").distinct().count()))
        return search(packed_shards, queries, *args)
    monkeypatch.setattr(balltree, "search_tiles", watch)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in balltree.top_k(df, every=10, k=5).collect()}
    x = np.floor(256 * v).astype(np.int64)
    for i in range(0, 3000, 10):
        s = x @ x[i]
        best = sorted((-int(s[j]), j) for j in range(3000) if j != i)[:5]
        assert [got[i, k + 1] for k in range(5)] == [(j, -t) for t, j in best]
    shipped, every = visited[1]
    assert every >= 60 and shipped < 0.5 * every


def test_a_vec_id_in_a_third_of_all_rows_is_spread(spark, monkeypatch):
    from stockcast.llm import tiles
    monkeypatch.setattr(tiles, "SHARD_LEAST", 100)
    monkeypatch.setattr(tiles, "SHARD_ROWS", 400)
    rng = np.random.default_rng(8)
    v = rng.normal(size=(3000, 6))
    rows = [(7 if i % 3 == 0 else i, [float(x) for x in r], "x", 0.5) for i, r in enumerate(v)]
    rows += [rows[1]] * 2000  # a repeated row
    df = spark.createDataFrame(rows, VECS).repartition(6)
    for deal in (tiles.deal, tiles.deal_clusters):
        dealt, *_ = deal(tiles.vectors(df, lambda x: x), 20)
        sizes = [r["count"] for r in dealt.groupBy("shard").count().collect()]
        assert sum(sizes) == 3000 and max(sizes) < 700
    got = balltree.top_k(df, every=20, k=3).collect()
    x = [(i, np.floor(256 * np.array(r)).astype(np.int64)) for i, r, *_ in {(i, tuple(r)) for i, r, *_ in rows}]
    asked = {i: min(tuple(r) for j, r in x if j == i) for i in {i for i, _ in x} if i % 20 == 0}
    for i, q in asked.items():
        best = sorted((-int(np.array(q) @ r), j) for j, r in x if j != i)[:3]
        assert [(r["vec_id"], r["score"]) for r in sorted((r for r in got if r["query_id"] == i), key=lambda r: r["rank"])] == [(j, -s) for s, j in best]
