"""WARC archives with dictionary compression, and their reader.

An archive is a ``.warc.zst`` file: a leading skippable frame (magic
0x184D2A5D) that holds a Zstandard dictionary, then one Zstandard frame per
record, so that a record can be read from its offset with the dictionary alone.
The dictionary is trained on records of that archive: the first ``DICT_SAMPLE``
bytes of records it will hold. Of archives that hold too little to train on, the
dictionary is plain content instead, the starts of their records.

Among pages with equal payloads (SHA-1 and length) the one with the largest
page_id is a ``response``; the others are ``revisit`` records of the
identical-payload-digest profile that refer to it and carry only the HTTP
head. Tasks write their archives straight to shared storage under a name of
their own attempt; only archives of successful attempts are in the manifest,
which is checkpointed, so a lost executor costs its running tasks only. A
payload is moved once, under its own page's key: pages that repeat it are joined
to its response without it, from two written tables, so that the join of a
frequent payload is split.

Defined results: null html is an empty payload; rows that repeat the
response's page_id with the same payload are responses too; a null page_id is
written without an id and is a response only if its payload has no other page;
a null url is written as ``about:blank``; a payload of any size is one record;
an empty table gives no archive; columns beyond page_id, url and html are
ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockcast.llm.common import cut, shared_dir, ship_package

SKIPPABLE = 0x184D2A5D
DICT_BYTES = 32 * 1024
DICT_SAMPLE = 2 * 1024 * 1024
ARCHIVE_BYTES = 64 * 1024 * 1024
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
MANIFEST = "path string, records long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _page_uri(page_id: int | None) -> str:
    return "urn:page:" + ("unknown" if page_id is None else str(page_id))


def record(page_id: int | None, url: str | None, size: int, sha1: str, keeper: int | None, payload: bytes) -> bytes:
    """One WARC/1.1 record; ``keeper`` is the response's page for a revisit, else None."""
    digest = "sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    target = quote(url, safe="%/:?#[]@!$&'()*+,;=~-._") if url is not None else "about:blank"
    head = ["WARC/1.1", f"WARC-Type: {'response' if keeper is None else 'revisit'}",
            f"WARC-Record-ID: <{_page_uri(page_id)}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}",
            "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: {digest}"]
    if keeper is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{_page_uri(keeper)}>"]
    block = http + (payload if keeper is None else b"")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class ArchiveWriter:
    """One archive: holds back records until the dictionary is trained, then compresses each by itself."""

    def __init__(self, out, level: int = 3):
        self.out, self.level = out, level
        self.held: list[bytes] = []
        self.held_bytes = self.records = self.written = 0
        self.compress = None

    def add(self, data: bytes) -> None:
        self.records += 1
        if self.compress is not None:
            self._frame(data)
            return
        self.held.append(data)
        self.held_bytes += len(data)
        if self.held_bytes >= DICT_SAMPLE:
            self._start()

    def _frame(self, data: bytes) -> None:
        packed = self.compress(data)
        self.out.write(packed)
        self.written += len(packed)

    def _dictionary(self):
        """Trained on the held records, or cut from their starts where the trainer can't work with them."""
        import zstandard

        if self.held_bytes >= 8 * DICT_BYTES and len(self.held) >= 16:
            try:
                return zstandard.train_dictionary(DICT_BYTES, self.held, k=512, d=8)
            except zstandard.ZstdError:  # nothing repeats in them
                pass
        each = max(64, min(DICT_BYTES, self.held_bytes // 4) // len(self.held))
        plain = b"".join(data[:each] for data in self.held)[-DICT_BYTES:]
        return zstandard.ZstdCompressionDict(plain, dict_type=zstandard.DICT_TYPE_RAWCONTENT)

    def _start(self) -> None:
        import zstandard

        found = self._dictionary()
        raw = found.as_bytes()
        self.out.write(SKIPPABLE.to_bytes(4, "little") + len(raw).to_bytes(4, "little") + raw)
        self.compress = zstandard.ZstdCompressor(level=self.level, dict_data=found, write_checksum=True,
                                                 write_content_size=True).compress
        for data in self.held:
            self._frame(data)
        self.held = []

    def close(self) -> None:
        if self.compress is None:
            self._start()
        self.out.close()


def read_archive(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive, reading one record at a time."""
    import zstandard

    lead = stream.read(8)
    if int.from_bytes(lead[:4], "little") != SKIPPABLE:
        raise ValueError("the archive doesn't start with a dictionary's frame")
    found = zstandard.ZstdCompressionDict(stream.read(int.from_bytes(lead[4:], "little")))

    class Source(io.RawIOBase):
        def readable(self):
            return True

        def readinto(self, into):
            got = stream.read(len(into))
            into[:len(got)] = got
            return len(got)

    plain = io.BufferedReader(zstandard.ZstdDecompressor(dict_data=found).stream_reader(
        io.BufferedReader(Source(), 1 << 16), read_across_frames=True), 1 << 18)
    while line := plain.readline():
        if line.rstrip(b"\r\n") != b"WARC/1.1":
            raise ValueError(f"no WARC record starts with {line[:40]!r}")
        head: dict[str, str] = {}
        while (line := plain.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(":")
            head[name.lower()] = value.strip()
        block = plain.read(int(head["content-length"]))
        if plain.read(4) != b"\r\n\r\n":
            raise ValueError("a WARC record doesn't end where its length says")
        yield head, block


def read_record(head: dict[str, str], block: bytes) -> tuple:
    """A row of RECORDS; a response's payload is held against its digest."""
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = dict(x.split(b": ", 1) for x in http.split(b"\r\n")[1:])
    size, kind = int(fields[b"Content-Length"]), head["warc-type"]
    digest = head["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"payload of {head['warc-record-id']} doesn't match its digest")

    def page(uri: str | None) -> int | None:
        name = uri.strip("<>").removeprefix("urn:page:") if uri else "unknown"
        return None if name == "unknown" else int(name)

    return page(head["warc-record-id"]), size, digest, kind, page(head.get("warc-refers-to"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write all ``pages`` (page_id, url, html) as archives under ``folder``; return the manifest (path, records)."""
    ship_package(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.select("*", F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("size"))
    repeats = F.col("size") >= least_bytes
    heads = cut(rows.filter(repeats).drop("payload"))
    keepers = cut(heads.groupBy("sha1", "size").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")))
    own = keepers.select(F.col("sha1").alias("sha1_"), F.col("size").alias("size_"), "keeper")
    same = (F.col("sha1") == F.col("sha1_")) & (F.col("size") == F.col("size_")) & F.col("page_id").eqNullSafe(F.col("keeper"))
    responses = rows.filter(repeats).join(own, same, "left_semi").unionByName(rows.filter(~repeats))
    revisits = heads.join(keepers.filter("n > 1"), ["sha1", "size"]).filter(~F.col("page_id").eqNullSafe(F.col("keeper")))
    columns = ("page_id", "url", "size", "sha1")
    nothing = F.lit(None)
    rows = responses.select(*columns, nothing.cast("long").alias("keeper"), "payload").unionByName(
        revisits.select(*columns, "keeper", nothing.cast("binary").alias("payload")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, root = fs.FileSystem.from_uri(folder)
        place.create_dir(root, recursive=True)
        done: list[tuple[str, int]] = []
        name = writer = None

        def finish() -> None:
            writer.close()
            done.append((name, writer.records))

        for batch in batches:
            cols = [batch.column(i) for i in range(batch.num_columns)]
            for i in range(batch.num_rows):
                page_id, url, size, sha1, keeper, payload = (c[i].as_py() for c in cols)
                if writer is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    writer = ArchiveWriter(place.open_output_stream(f"{root}/{name}", compression=None))
                writer.add(record(page_id, url, size, sha1, keeper, payload or b""))
                if writer.written >= ARCHIVE_BYTES:
                    finish()
                    writer = None
        if writer is not None:
            finish()
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{p}" for p, _ in done], pa.string()),
                                          pa.array([n for _, n in done], pa.int64())], names=["path", "records"])

    return cut(rows.mapInArrow(run, MANIFEST))


def read_archives(manifest: DataFrame) -> DataFrame:
    """RECORDS of every archive in ``manifest``; raises if an archive lacks records."""
    ship_package(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = [f.split()[0] for f in RECORDS.split(", ")]
        for batch in batches:
            for path, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                place, where = fs.FileSystem.from_uri(path)
                out, n = [], 0
                with place.open_input_stream(where, compression=None) as stream:
                    for head, block in read_archive(stream):
                        out.append(read_record(head, block))
                        n += 1
                        if len(out) >= 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
                            out = []
                if n != expected:
                    raise ValueError(f"{path} holds {n} records, not {expected}")
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return manifest.select("path", "records").mapInArrow(run, RECORDS)


def archive_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"


OP10_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest FROM pages
), k AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS keeper FROM p
)
SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                ((('0x' || substr(digest, (10 * (i // 8) + 1)::INT, 10))::BIGINT >> (35 - 5 * (i % 8))::INT) & 31)::INT + 1, 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM k
"""
