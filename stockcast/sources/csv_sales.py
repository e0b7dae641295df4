"""Sales lines from CSV files.

A first pass over the lines gives every file's header and encoding (a file with
bytes that are not UTF-8 is read as Latin-1, S2) and the number of lines per
block (``records``). Files are then grouped by encoding, delimiter and column
names; each group is parsed with its own names and the groups are united by
name, so files may order their columns differently. With ``multiline=True`` line
breaks inside quotes are part of a field; files are split between tasks all the
same.

Every record keeps its place in the input (files by name, records in their
order), so that "first" can mean the first in the file. Every field is read as
text and the numeric columns are converted afterwards. One spare column catches
records with more fields than the header. ``strict`` raises on such a record and
on a number that cannot be read, from the one parse whose result it then
returns; ``lenient`` drops the record, makes the number NULL, and ``read_report``
counts both; ``read_with_faults`` gives them as rows. Short records are padded
with NULL and kept, blank ones are passed over. The texts in ``MISSING_TEXT`` are
missing values.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockcast.functions.materialize import materialize
from stockcast.operators.clean import with_invoice_timestamp
from stockcast.operators.features import distinct_descriptions, first_description, first_description_by_place
from stockcast.sources.records import block_bounds, block_table, first_lines, lines_with_places, records_with_places, text_lines, without_return

#: Place of a record in the input (files by name); kept by ``sales(places=True)``.
PLACE = "_place"
_EXTRA, _FILE, _ROW, _RAW = "_extra", "_file", "_row", "_raw"
_HIDDEN = (_EXTRA, PLACE, _FILE, _ROW, _RAW)
_DELIMITERS = (",", ";", "\t", "|")
_NUMERIC = ("Quantity", "Price")
UTF8, LATIN1 = "UTF-8", "ISO-8859-1"

# The texts that the original's reader takes for a missing value.
MISSING_TEXT = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def sniff_delimiter(header: str) -> str:
    """The candidate delimiter that occurs most often in the header line, outside quotes."""
    bare = re.sub(r'"[^"]*"', "", header)
    counts = {d: bare.count(d) for d in _DELIMITERS}
    best = max(_DELIMITERS, key=lambda d: counts[d])
    return best if counts[best] > 0 else ","


def _split_header(header: str, sep: str) -> tuple[str, ...]:
    fields = next(csv.reader([header.removeprefix("\ufeff")], delimiter=sep, quotechar='"', doublequote=True), [])
    return tuple(h.strip() for h in fields)


def _headers(blocks: DataFrame) -> list[tuple[str, bytes, bool]]:
    """(file, header line, holds bytes that are not UTF-8) of every file that has a line.

    One row per file comes to the driver, as many as the file listing that
    planning a read needs anyway.
    """
    facts = blocks.groupBy("file").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    heads = blocks.filter("block = 0").select("file", "header")
    return _collected(facts.join(heads, "file"))


def _collected(files: DataFrame) -> list[tuple[str, bytes, bool]]:
    return sorted((r["file"], bytes(r["header"] or b""), bool(r["bad"])) for r in files.select("file", "header", "bad").collect())


def _first_of(line: bytes) -> bytes:
    """The first line of a line that ends at LF, where CR ends one too."""
    return next((part for part in line.split(b"\r") if part.strip()), b"")


class _Group:
    """Files of one encoding, delimiter and header, and where their records lie."""

    def __init__(self, lines: DataFrame, blocks: DataFrame, encoding: str, sep: str, names: tuple[str, ...], multiline: bool):
        self.lines, self.blocks, self.encoding, self.sep, self.names, self.multiline = lines, blocks, encoding, sep, names, multiline

    def records(self) -> DataFrame:
        if self.multiline:
            return records_with_places(self.lines, self.blocks, self.sep)
        return lines_with_places(self.lines, self.blocks)


def _groups(spark: SparkSession, path: str, encoding: str, sep: str | None, multiline: bool = False) -> list[_Group]:
    lines = text_lines(spark, path, multiline)
    bounds = block_bounds(lines)
    blocks = None if multiline else block_table(lines, bounds=bounds)
    seen = [(f, _first_of(h), b) for f, h, b in _collected(first_lines(lines, bounds))] if multiline else _headers(blocks)
    if not seen:
        raise ValueError(f"empty input: {path}")
    if encoding == UTF8 and (bad := [f for f, _, b in seen if b]):
        raise ValueError(f"bytes that are not {encoding} in {bad[:3]}; name the encoding or use 'auto'")
    formats: dict[tuple[str, str], dict[str, bytes]] = {}  # (encoding, delimiter) -> file -> header line
    for file, header, bad in seen:
        enc = encoding if encoding != "auto" else LATIN1 if bad else UTF8
        formats.setdefault((enc, sep or sniff_delimiter(header.decode(enc))), {})[file] = header
    out = []
    for (enc, delim), headers in formats.items():
        files = path if len(formats) == 1 else sorted(headers)
        table = blocks if len(formats) == 1 else None
        if multiline:  # with the delimiter known, what quotes hold is known too; a header may go on in the next line
            if len(formats) > 1:
                lines, bounds = text_lines(spark, files, True), None
            table = block_table(lines, delim, bounds)
            headers = {f: h for f, h, _ in _headers(table)}
        names: dict[tuple[str, ...], list[str]] = {}
        for file, header in headers.items():
            names.setdefault(_split_header(header.decode(enc), delim), []).append(file)
        for columns, of in names.items():
            if len(names) == 1 and table is not None:  # the very read that the blocks were counted in
                out.append(_Group(lines, table, enc, delim, columns, multiline))
            else:
                read = text_lines(spark, sorted(of), multiline)
                out.append(_Group(read, block_table(read, delim if multiline else None), enc, delim, columns, multiline))
    return out


def _raw(spark: SparkSession, path: str, encoding: str, sep: str | None, multiline: bool) -> DataFrame:
    """All records as text columns plus the hidden ones; the files' groups united by name."""
    parts = []
    for g in _groups(spark, path, encoding, sep, multiline):
        value = without_return(F.col("value"))
        text = value.cast("string") if g.encoding == UTF8 else F.decode(value, g.encoding)
        # fields by number: names may repeat or hold any character
        fields = ", ".join(f"c{i} string" for i in range(len(g.names) + 1))
        options = {"sep": g.sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": str(multiline).lower()}
        # inline: no filter on a field moves below it, where the record would be parsed again for every field it names
        df = (g.records().select("file", "place", "row", text.alias("text")).filter(F.trim("text") != "")
              .select("file", "place", "row", "text", F.inline(F.array(F.from_csv("text", fields, options)))))
        columns = [F.when(~F.col(f"c{i}").isin(*MISSING_TEXT), F.col(f"c{i}")).alias(n) for i, n in enumerate(g.names)]
        parts.append(df.select(*columns, F.col(f"c{len(g.names)}").isNotNull().alias(_EXTRA), F.col("place").alias(PLACE),
                               F.col("file").alias(_FILE), F.col("row").alias(_ROW), F.col("text").alias(_RAW)))
    out = parts[0]
    for i, p in enumerate(parts[1:], 1):
        # places of different reads: one read's files come before the next one's
        out = out.unionByName(p.withColumn(PLACE, F.col(PLACE) + F.lit(i << 48)), allowMissingColumns=True)
    return out


def _unreadable(c: str) -> Column:
    return F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()


def _numeric(df: DataFrame) -> list[str]:
    return [c for c in _NUMERIC if c in df.columns]


def _typed(raw: DataFrame) -> DataFrame:
    """Kept records with their numbers and places, without the other hidden columns."""
    kept = raw.where(~F.col(_EXTRA)).drop(_EXTRA, _FILE, _ROW, _RAW)
    return kept.withColumns({c: F.col(c).try_cast("double") for c in _numeric(raw)})


def read_places(spark: SparkSession, path: str, mode: str = "lenient", encoding: str = UTF8,
                sep: str | None = None, multiline: bool = False) -> DataFrame:
    """``read_sales`` with the column ``PLACE``, the record's place in the input."""
    raw = _raw(spark, path, encoding, sep, multiline)
    if mode != "strict":
        return _typed(raw)
    raw = materialize(raw.drop(_FILE, _ROW, _RAW))  # parsed once: counted and then read
    bad = {k: n for k, n in _losses(raw).first().asDict().items() if k != "lines" and n}
    if bad:
        raise ValueError(f"{path}: {bad}")
    return _typed(raw)


def read_sales(spark: SparkSession, path: str, mode: str = "lenient", encoding: str = UTF8,
               sep: str | None = None, multiline: bool = False) -> DataFrame:
    """S1 (lenient) / S3 (strict) / S2 (encoding 'auto' or 'ISO-8859-1', sep=None sniffs)."""
    return read_places(spark, path, mode, encoding, sep, multiline).drop(PLACE)


def read_with_faults(spark: SparkSession, path: str, encoding: str = "auto", sep: str | None = None,
                     multiline: bool = False) -> tuple[DataFrame, DataFrame]:
    """(kept records, faults): what ``lenient`` keeps, and a row per fault of a record.

    A fault: ``file``, ``row`` (place in the file, the header's is counted),
    ``raw`` (the record as it stands there), ``reason``, ``kept``. Records with
    too many fields are not kept; those with a number that cannot be read are,
    with NULL for it. Both tables come from one parse, written once.
    """
    raw = _raw(spark, path, encoding, sep, multiline)
    reasons = [F.when(F.col(_EXTRA), F.lit("too many fields"))]
    reasons += [F.when(~F.col(_EXTRA) & _unreadable(c), F.lit(f"unreadable {c}")) for c in _numeric(raw)]
    written = raw.withColumn("_reasons", F.array_compact(F.array(*reasons)))
    written = materialize(written.withColumn(_RAW, F.when(F.size("_reasons") > 0, F.col(_RAW))))
    faults = written.where(F.size("_reasons") > 0).select(
        F.col(_FILE).alias("file"), F.col(_ROW).alias("row"), F.col(_RAW).alias("raw"),
        F.explode("_reasons").alias("reason"), (~F.col(_EXTRA)).alias("kept"))
    return _typed(written.drop("_reasons")).drop(PLACE), faults


def overlong_lines(spark: SparkSession, path: str, encoding: str = UTF8, sep: str | None = None,
                   multiline: bool = False) -> DataFrame:
    """Records with more fields than the header (what lenient mode drops)."""
    return _raw(spark, path, encoding, sep, multiline).where(F.col(_EXTRA)).drop(*_HIDDEN)


def read_report(spark: SparkSession, path: str, encoding: str = "auto", sep: str | None = None,
                multiline: bool = False) -> DataFrame:
    """One row: lines, overlong_lines, and unreadable_<column> per numeric column; what lenient mode loses."""
    return _losses(_raw(spark, path, encoding, sep, multiline))


def _losses(raw: DataFrame) -> DataFrame:
    return raw.agg(F.count("*").alias("lines"), F.count(F.when(F.col(_EXTRA), 1)).alias("overlong_lines"),
                   *[F.count(F.when(~F.col(_EXTRA) & _unreadable(c), 1)).alias(f"unreadable_{c}") for c in _numeric(raw)])


def detect_format(spark: SparkSession, path: str) -> tuple[str, str]:
    """S2 trigger: (encoding, delimiter) of the input, from all lines; raises if its files differ."""
    found = {(g.encoding, g.sep) for g in _groups(spark, path, "auto", None)}
    if len(found) > 1:
        raise ValueError(f"files of different formats: {sorted(found)}")
    return found.pop()


def read_sales_auto(spark: SparkSession, path: str, mode: str = "lenient", multiline: bool = False) -> DataFrame:
    """S1 with the S2 fallback: each file's encoding and delimiter, then read."""
    return read_sales(spark, path, mode=mode, encoding="auto", multiline=multiline)


class CsvSales:
    """Sales lines from CSV; descriptions come from the lines themselves."""

    def __init__(self, spark: SparkSession, path: str, mode: str = "lenient",
                 encoding: str = "auto", sep: str | None = None, multiline: bool = False):
        self.spark, self.path = spark, path
        self.mode, self.encoding, self.sep, self.multiline = mode, encoding, sep, multiline
        self._lines: DataFrame | None = None  # the plan, so that the files are looked at once

    def sales(self, columns=None, places: bool = False) -> DataFrame:
        """The lines; with ``places`` also the column ``PLACE``."""
        if self._lines is None:
            self._lines = read_places(self.spark, self.path, self.mode, self.encoding, self.sep, self.multiline)
        df = self._lines if places else self._lines.drop(PLACE)
        return df if columns is None else df.select(*[c for c in columns if c in df.columns], *([PLACE] if places else []))

    def report(self) -> DataFrame:
        return read_report(self.spark, self.path, self.encoding, self.sep, self.multiline)

    def faults(self) -> DataFrame:
        """The records behind ``report``'s counts, see ``read_with_faults``."""
        return read_with_faults(self.spark, self.path, self.encoding, self.sep, self.multiline)[1]

    def first_descriptions(self, clean: DataFrame | None = None, order: str = "file") -> DataFrame:
        """The first description per code, of all raw lines unless ``clean`` is given.

        order "file": the first line of the input. Lines in ``clean`` that lost
        their places (see ``sales(places=True)``), and order "date", go by date,
        then invoice, then text.
        """
        src = clean if clean is not None else self.sales(["StockCode", "Description", "InvoiceDate", "Invoice"], places=True)
        if "Description" not in src.columns:
            return self.spark.createDataFrame([], "StockCode string, Description string, n_described long")
        if order == "file" and PLACE in src.columns:
            return first_description_by_place(src, PLACE)
        return first_description(with_invoice_timestamp(src, strict=False))

    def description_pairs(self, clean: DataFrame) -> DataFrame:
        return distinct_descriptions(clean)
