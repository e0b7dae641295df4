"""Lines and records of CSV files with their places, split between tasks.

A file is read in blocks (byte ranges), many at once, and Spark hands over the
lines that begin in a block in their order. What a reader needs to know beyond
its own block is little, so it takes two passes over the text:

1. ``block_table``: one row per block. Number of lines, the header where the
   block starts a file, whether bytes are not UTF-8: an aggregation, with which no
   line leaves the JVM. With a delimiter, where
   a line break inside quotes does not end a record, also what the block does to
   the state "inside quotes": where it leaves a reader that comes from outside and
   one that comes from inside, and how many records start on the way in each case.
   A block either leaves both states as they are, swaps them, or ends both in one
   state (after a quote that is no delimiter's), so the state at the start of every
   block is a prefix sum of swaps since the last block of the third kind; lines
   and records before a block are prefix sums too.
2. ``records_with_places``: every block is read again, now from a known state, and cuts its
   lines into records with global numbers. A record that goes on in the next
   blocks is sent on in pieces, one per block, and put together by its number;
   only files with such blocks are read once more for it.

Python gets as few columns beside the lines as will do, for each costs as much as
the lines do: what concerns a block comes with its first line. It works on whole
Arrow batches: where every opening quote stands at the
start of a field, a reader's state is the parity of the quotes so far; stretches
of ``CHUNK`` lines where one does not are read line by line.

No pass gathers the lines of a file in one task. The blocks of a file must be
the same in both passes, so ``spark.sql.files.minPartitionNum`` is pinned to the
session's parallelism if it is unset; should they differ all the same (files or
settings that changed in between), the read raises.

Without quoted line breaks every line is a record (``lines_with_places``); lines
end at LF, CRLF or CR then, and at LF or CRLF otherwise.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockcast.functions.materialize import materialize

BROADCAST_BLOCKS = 200_000  # rows of the block table (about 200 bytes each) that may be broadcast
_PIN = "spark.sql.files.minPartitionNum"
CHUNK = 1000  # lines whose quotes are looked at together
_BLANK = b" \t\n\r\x0b\x0c"
_FACTS = {"first": pa.int64(), "counted": pa.int64(), "header": pa.binary(), "header_records": pa.int64(),
          "from_outside": pa.bool_(), "from_inside": pa.bool_(), "starts_outside": pa.int64(), "starts_inside": pa.int64()}
_RECORDS = {"place": pa.int64(), "row": pa.int64(), "part": pa.int64(), "value": pa.binary()}
_SQL = {pa.string(): "string", pa.int64(): "long", pa.bool_(): "boolean", pa.binary(): "binary"}


def _ddl(fields: dict[str, pa.DataType]) -> str:
    return ", ".join(f"{n} {_SQL[t]}" for n, t in fields.items())


def _batch(rows: list[tuple], fields: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), fields.values(), strict=True)], names=list(fields))


class QuoteState:
    """Whether a line ends inside quotes, from either state; doubled quotes are text, and so are
    quotes that do not open a field."""

    def __init__(self, sep: str):
        s = re.escape(sep.encode())
        field = rb'(?>"(?:[^"]|"")*+"[^%s]*+|[^"%s][^%s]*+)?+' % (s, s, s)
        self.closed = re.compile(rb'%s(?:%s%s)*+' % (field, s, field), re.DOTALL).fullmatch
        self.closes = re.compile(rb'(?:[^"]|"")*+"[^%s]*+(?:%s%s)*+' % (s, s, field), re.DOTALL).fullmatch
        self.sep = ord(sep) if len(sep.encode()) == 1 else None

    def after(self, line: bytes, inside: bool) -> bool:
        return not (self.closes(line) if inside else self.closed(line))

    def ends(self, values: pa.Array, inside: bool) -> np.ndarray:
        """``after`` of every line, each from the state that the one before it left."""
        out = np.empty(len(values), bool)
        for at in range(0, len(values), CHUNK):
            part = values.slice(at, CHUNK)
            states = self._by_parity(part, inside)
            if states is None:
                states = self._by_line(part, inside)
            out[at:at + len(part)] = states
            inside = bool(states[-1])
        return out

    def _by_parity(self, values: pa.Array, inside: bool) -> np.ndarray | None:
        """None if an opening quote does not start a field (or go on in quoted text, being the second of two)."""
        offsets = np.frombuffer(values.buffers()[1], np.int64 if pa.types.is_large_binary(values.type) else np.int32)
        offsets = offsets[values.offset:values.offset + len(values) + 1]
        if offsets[0] == offsets[-1]:
            return np.full(len(values), inside)
        data = np.frombuffer(values.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
        offsets = offsets - offsets[0]
        quotes = np.flatnonzero(data == ord('"'))
        opening = quotes[int(inside)::2]
        before = data[opening - 1]  # of a quote that begins a line, this is another line's
        field = (before == ord('"')) | (before == self.sep if self.sep is not None else False)
        if not field.all() and not np.isin(opening[~field], offsets).all():
            return None
        return (np.searchsorted(quotes, offsets[1:]) + inside) % 2 == 1

    def _by_line(self, values: pa.Array, inside: bool) -> np.ndarray:
        out, last = np.empty(len(values), bool), 0
        marked = _quoted(values)
        for i, line in zip(marked, values.take(pa.array(marked, pa.int64())).to_pylist(), strict=True):
            out[last:i] = inside
            inside = out[i] = self.after(line, inside)
            last = i + 1
        out[last:] = inside
        return out


def text_lines(spark: SparkSession, files: str | Sequence[str], quoted_breaks: bool) -> DataFrame:
    """file, block (its first byte), nth (grows in reading order inside a block), value (bytes), bad (not UTF-8)."""
    if spark.conf.get(_PIN, None) is None:
        spark.conf.set(_PIN, spark.conf.get("spark.sql.leafNodeDefaultParallelism", None) or str(spark.sparkContext.defaultParallelism))
    reader = spark.read.option("lineSep", "\n") if quoted_breaks else spark.read
    return reader.text(files).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("nth"), F.col("value").cast("binary").alias("value"),
        (~F.is_valid_utf8("value")).alias("bad"))


def _runs(first: np.ndarray) -> Iterator[tuple[bool, int, int]]:
    """(begins a block, from, to) of the stretches of a batch that lie in one block; ``first``: whether a line is its block's first."""
    edges = [0, *(np.flatnonzero(first[1:]) + 1).tolist(), len(first)]
    for a, b in zip(edges, edges[1:]):
        if a < b:
            yield bool(first[a]), a, b


def _quoted(values: pa.Array) -> list[int]:
    """Places of the lines that hold a quote."""
    return np.flatnonzero(pc.match_substring(values, '"').to_numpy(zero_copy_only=False)).tolist()


def _begun(ends: np.ndarray, inside: bool) -> np.ndarray:
    """Which lines begin a record, where ``inside`` is the state before the first one."""
    return ~np.concatenate(([inside], ends[:-1]))


class _Block:
    """What the first pass learns about the quotes of one block."""

    def __init__(self, starts_file: bool, first: int, quotes: QuoteState):
        self.starts_file, self.first, self.quotes = starts_file, first, quotes
        self.lines = 0
        self.header: list[bytes] = []
        self.blank, self.header_open = 0, starts_file
        self.inside = [False, True]  # now, of a reader that came from outside and of one from inside
        self.starts = [0, 0]

    def add(self, values: pa.Array) -> None:
        n = len(values)
        at = 0
        while self.header_open and at < n:
            line = values[at].as_py()
            at += 1
            if not self.header and not line.strip(_BLANK):  # blank lines before the header are passed over
                self.blank += 1
                continue
            self.header.append(line)
            self.header_open = self.quotes.after(b"\n".join(self.header), False)
        self.lines += n
        at = 0
        while at < n and self.inside[0] != self.inside[1]:
            part = values.slice(at, CHUNK)
            for k in (0, 1):
                self._read(k, part)
            at += len(part)
        if at < n:  # both readers have met: they go on as one
            before = self.starts[0]
            self._read(0, values.slice(at))
            self.inside[1] = self.inside[0]
            self.starts[1] += self.starts[0] - before

    def _read(self, k: int, values: pa.Array) -> None:
        ends = self.quotes.ends(values, self.inside[k])
        self.starts[k] += int(_begun(ends, self.inside[k]).sum())
        self.inside[k] = bool(ends[-1])

    def row(self) -> tuple:
        if self.starts_file and self.header_open and self.header:
            raise ValueError("the header of a file does not end in its first block")
        head = (b"\n".join(self.header), self.blank + bool(self.header)) if self.starts_file else (None, None)
        return (self.first, self.lines, *head, *self.inside, *self.starts)


def block_bounds(lines: DataFrame) -> DataFrame:
    """One row per block of ``text_lines``, written once: file, block, first (nth of its first line),
    lines, bad, head (nth of the first line that is not blank, where the block starts a file)."""
    visible = (F.col("value") > F.lit(b" \xff")) | F.col("value").cast("string").rlike(r"[^ \t\n\r\x0B\f]")  # most by their first byte
    head = (F.col("block") == 0) & visible
    return materialize(lines.groupBy("file", "block").agg(
        F.min("nth").alias("first"), F.count(F.lit(1)).alias("lines"), F.max(F.col("bad").cast("int")).cast("boolean").alias("bad"),
        F.min(F.when(head, F.col("nth"))).alias("head")))


def first_lines(lines: DataFrame, bounds: DataFrame) -> DataFrame:
    """file, bad (a line of it is), header (its first line that is not blank; empty if all are), of every file."""
    heads = bounds.filter("head is not null").select(F.col("head").alias("nth"))
    found = lines.join(F.broadcast(heads) if _small(heads) else heads, "nth").select(F.col("nth").alias("found"), F.col("value").alias("header"))
    files = bounds.groupBy("file").agg(F.max(F.col("bad").cast("int")).cast("boolean").alias("bad"), F.min("head").alias("head"))
    return files.join(found, F.col("head") == F.col("found"), "left").select("file", "bad", F.coalesce("header", F.lit(b"")).alias("header"))


def _quote_facts(lines: DataFrame, bounds: DataFrame, sep: str) -> DataFrame:
    """``bounds`` with the facts of ``_Block``."""

    def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quotes = QuoteState(sep)
        nth = TaskContext.get().partitionId() << 33  # as ``monotonically_increasing_id`` counts
        last, now, rows = None, None, []
        for batch in batches:
            of = batch.column("of").to_numpy()
            first = np.concatenate(([last is None or of[0] != last], np.diff(of) != 0)) if len(of) else np.empty(0, bool)
            for begins, a, b in _runs(first):
                if begins:
                    if now is not None:
                        rows.append(now.row())
                    now, last = _Block(bool(of[a] & 1), nth + a, quotes), of[a]
                now.add(batch.column("value").slice(a, b - a))
            nth += len(of)
        if now is not None:
            yield _batch([*rows, now.row()], _FACTS)

    # the hash only tells neighbours apart, its last bit says that a file starts; were two alike, a block would be missing below
    of = F.shiftleft(F.xxhash64("file", "block"), 1).bitwiseOR((F.col("block") == 0).cast("long"))
    found = lines.select(of.alias("of"), "value").mapInArrow(facts, _ddl(_FACTS))
    out = bounds.join(found, "first", "left")
    known = F.coalesce(F.col("counted") == F.col("lines"), F.lit(False))
    return out.withColumn("lines", F.when(known, F.col("lines")).otherwise(_changed()))


def block_table(lines: DataFrame, sep: str | None = None, bounds: DataFrame | None = None) -> DataFrame:
    """One row per block of ``text_lines``, written once; ``sep`` is needed where quotes may hold line breaks.

    file, block, first (nth of its first line), lines, bad, header (where the
    block starts a file), inside / open (its first / last line is met or left
    inside quotes), place (records before the block, of all files in the order
    of their names), file_place (of the file's first record), skip (of the
    first one after the header). ``bounds``: those of these lines, if they are there.
    """
    bounds = block_bounds(lines) if bounds is None else bounds
    if sep:
        found = _quote_facts(lines, bounds, sep)
    else:
        header = F.when(F.col("block") == 0, F.col("header"))
        records = F.when(F.col("block") == 0, F.coalesce(F.col("head") - F.col("first") + 1, F.col("lines")))
        found = bounds.join(first_lines(lines, bounds).select("file", "header"), "file").withColumns({
            "header": header, "header_records": records, "from_outside": F.lit(False), "from_inside": F.lit(True),
            "starts_outside": F.col("lines"), "starts_inside": F.lit(0).cast("long")})
    found = materialize(found)
    # one row per block: small whatever a block holds
    file = Window.partitionBy("file")
    before = file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    swap = (F.col("from_outside") & ~F.col("from_inside")).cast("int")
    out = found.withColumn("swaps", F.sum(swap).over(file.orderBy("block")))
    # after a block that ends both states in one: that state, less the swaps so far
    out = out.withColumn("fixed", F.when(F.col("from_outside") == F.col("from_inside"), F.col("from_outside").cast("int") - F.col("swaps")))
    earlier = F.coalesce(F.last("fixed", ignorenulls=True).over(before), F.lit(0))
    out = out.withColumn("inside", F.pmod(earlier + F.col("swaps") - swap, F.lit(2)) == 1)
    starts = F.when(F.col("inside"), F.col("starts_inside")).otherwise(F.col("starts_outside"))
    out = out.withColumn("open", F.when(F.col("inside"), F.col("from_inside")).otherwise(F.col("from_outside")))
    out = out.withColumn("place", F.coalesce(F.sum(starts).over(everywhere), F.lit(0)))
    out = out.withColumn("file_place", F.min("place").over(file))
    out = out.withColumn("skip", F.col("file_place") + F.coalesce(F.max("header_records").over(file), F.lit(0)))
    return materialize(out.select("file", "block", "first", "lines", "bad", "header", "inside", "open", "place", "file_place", "skip"))


def _changed() -> Column:
    return F.raise_error(F.lit("the files were split differently in two passes: they changed, or spark.sql.files.* settings did"))


def _small(blocks: DataFrame) -> bool:
    return blocks.limit(BROADCAST_BLOCKS + 1).count() <= BROADCAST_BLOCKS


def _with_blocks(lines: DataFrame, blocks: DataFrame, columns: list[str], small: bool) -> DataFrame:
    """``lines`` with ``number`` in their block and columns of it; a line of a block that is not in the table raises."""
    table = blocks.select("file", "block", "first", F.col("lines").alias("in_block"), *columns)
    out = lines.join(F.broadcast(table) if small else table, ["file", "block"], "left")
    number = F.col("nth") - F.col("first")
    known = F.coalesce((number >= 0) & (number < F.col("in_block")), F.lit(False))
    # around every column of the block: a filter on a bare one would make this an inner join, which drops such lines unseen
    return out.select(*lines.columns, *(F.when(known, c).otherwise(_changed()).alias(n)
                                        for n, c in {"number": number, **{c: F.col(c) for c in columns}}.items()))


def lines_with_places(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """file, place, row (place in the file), value of every line after the headers."""
    out = _with_blocks(lines, blocks, ["place", "file_place", "skip"], _small(blocks))
    place = F.col("place") + F.col("number")
    return out.filter(place >= F.col("skip")).select("file", place.alias("place"), (place - F.col("file_place")).alias("row"), "value")


def _cut(batches: Iterator[pa.RecordBatch], sep: str, pieces: bool) -> Iterator[pa.RecordBatch]:
    """_RECORDS of blocks whose lines come in order: whole records (part is null), or the pieces of split ones."""
    quotes = QuoteState(sep)
    block, base = 0, 0       # the block, the place of the file's first record
    inside, place, skip = False, 0, 0
    held: list[bytes] = []   # lines of the record that is open
    begun = False            # whether it began in an earlier block

    def record(part: int | None) -> Iterator[pa.RecordBatch]:
        if place >= skip:
            yield _batch([(place, place - base, part, b"\n".join(held))], _RECORDS)

    for batch in batches:
        entry = batch.column("entry")
        for begins, a, b in _runs(entry.is_valid().to_numpy(zero_copy_only=False)):
            if begins:
                if pieces and held:  # what is open goes on in the next block
                    yield from record(block)
                held = []
                block, base, place, skip, state = map(int, entry[a].as_py().split())
                inside, begun, place = bool(state), bool(state), place - 1
            values = batch.column("value").slice(a, b - a)
            ends = quotes.ends(values, inside)
            first, last = np.flatnonzero(_begun(ends, inside)), np.flatnonzero(~ends)  # lines of the records
            if inside:
                here = int(last[0]) + 1 if len(last) else len(values)
                held += values.slice(0, here).to_pylist()
                if len(last):
                    if pieces == begun:
                        yield from record(block if begun else None)
                    held, last = [], last[1:]
            n = len(last)
            if not pieces and (passed := min(max(skip - place - 1, 0), n)) < n:
                places = np.arange(place + 1 + passed, place + 1 + n)
                edges = np.append(first[passed:n], last[-1] + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(places), pa.array(places - base), pa.nulls(n - passed, pa.int64()), _joined_lines(values, edges)], names=list(_RECORDS))
            place += len(first)
            if len(first) > n:  # the last one goes on
                held, begun = values.slice(int(first[-1])).to_pylist(), False
            inside = bool(ends[-1])
    if pieces and held:
        yield from record(block)


def _joined_lines(values: pa.Array, edges: np.ndarray) -> pa.Array:
    """The lines between neighbouring edges with line breaks between them."""
    if edges[-1] - edges[0] == len(edges) - 1:
        return values.slice(int(edges[0]), len(edges) - 1)
    lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), values)
    return pc.binary_join(lists, pa.scalar(b"\n", values.type))


def records_with_places(lines: DataFrame, blocks: DataFrame, sep: str) -> DataFrame:
    """file, place, row, value of every record after the headers; quotes may hold line breaks."""
    small = _small(blocks)

    def cut(pieces: bool) -> DataFrame:
        known = _with_blocks(lines, blocks, ["inside", "open", "place", "file_place", "skip"], small)
        if pieces:  # the same scan; only blocks that a record enters or leaves reach Python
            known = known.filter("inside or open")
        if not small:  # a broadcast keeps the scan's order, a shuffle does not
            known = known.sortWithinPartitions("file", "block", "number")
        entry = F.when(F.col("number") == 0, F.concat_ws(" ", "block", "file_place", "place", "skip", F.col("inside").cast("int")))
        return (known.select(entry.alias("entry"), "value")
                .mapInArrow(lambda batches: _cut(batches, sep, pieces), _ddl(_RECORDS)))

    out = cut(False).select("place", "row", "value")
    if not blocks.filter("inside or open").isEmpty():
        merged = (cut(True).groupBy("place", "row")
                  .agg(F.sort_array(F.collect_list(F.struct("part", "value"))).alias("parts"))
                  .select("place", "row", _joined(F.transform("parts", lambda p: p["value"])).alias("value")))
        out = out.unionByName(merged)
    # a file's first record has a place of its own, since every file here has a line
    files = blocks.filter("block = 0").select("file", F.col("file_place").alias("of"))
    files = F.broadcast(files) if _small(files) else files
    return out.join(files, F.col("place") - F.col("row") == F.col("of"), "left").select("file", "place", "row", "value")


def _joined(parts: Column) -> Column:
    """Binary pieces with line breaks between them."""
    return F.aggregate(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), F.element_at(parts, 1),
                       lambda a, x: F.concat(a, F.lit(b"\n"), x))


def without_return(value: Column) -> Column:
    """A record without the CR of its CRLF."""
    return F.when(F.substring(value, -1, 1) == F.lit(b"\r"), F.substring(value, F.lit(1), F.octet_length(value) - 1)).otherwise(value)
