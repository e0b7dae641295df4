"""CSV records split between tasks: places, quoted line breaks, headers, faults, first description."""

import csv
import io
import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast.sources import records as R
from stockcast.sources.csv_sales import PLACE, CsvSales, read_places, read_report, read_sales, read_with_faults

HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"


def put(folder, name, text, encoding="utf-8"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as fh:
        fh.write(text.encode(encoding))
    return folder


@pytest.fixture()
def small_blocks(spark):
    """Blocks of a few dozen bytes, so that small files are split."""
    keys = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def rows_of(n, seed=3):
    rng = random.Random(seed)
    words = ["plain", 'say "hi"', "two\nlines", "a, b", "\n", '"', "x\n\ny", "", 'end"\n"start', "é", "long " * 30, ",\n,", '12" RULER', "\n" * 5]
    return [[str(i), f"S{i % 7}", rng.choice(words) + (str(i) if i % 3 else ""), str(rng.randint(1, 9)), "01/12/09 07:45", "1.5", "1", "X"] for i in range(n)]


def text_of(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_line_breaks_in_several_tasks(spark, tmpdir_path, small_blocks, end):
    rows = rows_of(120)
    p = put(f"{tmpdir_path}/m", "a.csv", HEADER.replace("\n", end) + text_of(rows, end))
    put(p, "b.csv", HEADER.replace("\n", end) + text_of(rows[:3], end).removesuffix(end))  # no line break at the end
    lines = R.text_lines(spark, p, True)
    assert lines.rdd.getNumPartitions() > 50
    got = read_places(spark, p, mode="strict", multiline=True)
    whole = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(p)
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    columns = ["Invoice", "StockCode", "Description", "InvoiceDate", "Country"]
    assert sorted(map(key, got.select(*columns).collect())) == sorted(map(key, whole.select(*columns).collect()))
    assert [(r.Invoice, r.Description or "") for r in got.orderBy(PLACE).collect()] == [(r[0], r[2]) for r in [*rows, *rows[:3]]]


@pytest.mark.parametrize("seed", range(3))
def test_state_of_every_block_against_one_reader(spark, tmpdir_path, small_blocks, seed):
    """Stray quotes too: quotes inside an unquoted field, and text behind a closing quote."""
    rng = random.Random(seed)
    parts = ['"', "a", ",", "\n", '""', "b c", '12" ', ',"x\ny",', "\n", "zz\n"]
    text = "h,i\n" + "".join(rng.choice(parts) for _ in range(600)) + "\n"
    p = put(f"{tmpdir_path}/s{seed}", "a.csv", text)
    want, inside, held, state = [], False, [], R.QuoteState(",")
    for line in text.encode().removesuffix(b"\n").split(b"\n"):
        held.append(line)
        inside = state.after(line, inside)
        if not inside:
            want.append(b"\n".join(held))
            held = []
    if held:
        want.append(b"\n".join(held))
    lines = R.text_lines(spark, p, True)
    got = R.records_with_places(lines, R.block_table(lines, ","), ",").orderBy("place").collect()
    assert [bytes(r["value"]) for r in got] == want[1:]
    assert [r["place"] for r in got] == [r["row"] for r in got] == list(range(1, len(want)))


def test_quote_state_of_lines():
    s = R.QuoteState(",")
    after = {b"": (False, True), b"a,b": (False, True), b'"a': (True, False), b'"a"': (False, False), b'a"b': (False, False),
             b'"a""': (True, False), b'x,"': (True, False), b'"",""': (False, True), b'12" x, 3"': (False, False), b'"a"b"c,"': (True, True)}
    assert {line: (s.after(line, False), s.after(line, True)) for line in after} == after


def test_records_beyond_the_broadcast_limit(spark, tmpdir_path, small_blocks, monkeypatch):
    monkeypatch.setattr(R, "BROADCAST_BLOCKS", 0)
    rows = rows_of(80, seed=8)
    p = put(f"{tmpdir_path}/big", "a.csv", HEADER + text_of(rows))
    got = read_places(spark, p, multiline=True).orderBy(PLACE).collect()
    assert [(r.Invoice, r.Description or "") for r in got] == [(r[0], r[2]) for r in rows]


def test_a_changed_split_raises(spark, tmpdir_path, small_blocks):
    p = put(f"{tmpdir_path}/c", "a.csv", HEADER + text_of(rows_of(50)))
    lines = R.text_lines(spark, p, False)
    blocks = R.block_table(lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "61")
    with pytest.raises(Exception, match="split differently"):
        R.lines_with_places(R.text_lines(spark, p, False), blocks).collect()


def test_quoted_header(spark, tmpdir_path):
    p = put(f"{tmpdir_path}/h", "a.csv", '﻿"Invoice","Description, long",Quantity,"say ""q""",InvoiceDate\n1,"a, b",2,x,01/12/09 07:45\n')
    df = read_sales(spark, p, mode="strict")
    assert df.columns == ["Invoice", "Description, long", "Quantity", 'say "q"', "InvoiceDate"]
    assert tuple(df.first()) == ("1", "a, b", 2.0, "x", "01/12/09 07:45")
    p = put(f"{tmpdir_path}/h2", "a.csv", '"Invoice";"one, two, three, four";Quantity\n1;x;2\n')
    assert tuple(CsvSales(spark, p).sales().first()) == ("1", "x", 2.0)
    p = put(f"{tmpdir_path}/h3", "a.csv", '\n\n"Inv\noice",Quantity\n1,2\n')
    assert read_sales(spark, p, multiline=True).count() == 1


def test_header_and_encoding_take_no_sort_of_the_lines(spark, tmpdir_path):
    p = put(f"{tmpdir_path}/plan", "a.csv", HEADER + text_of(rows_of(20)))
    plan = R.text_lines(spark, p, False).mapInArrow(lambda b: b, "file string, block long, nth long, value binary, bad boolean")
    for text in (plan, read_sales(spark, p), read_report(spark, p)):
        assert "Sort" not in text._jdf.queryExecution().executedPlan().toString()


def test_faults_and_kept_records_are_all_records(spark, tmpdir_path, small_blocks):
    p = put(f"{tmpdir_path}/f", "a.csv", HEADER + "1,A,ok,2,01/12/09 07:45,1,1,X\n2,A,bad,two,01/12/09 07:45,x,1,X\n\n"
            "4,A,long,2,01/12/09 07:45,1,1,X,more\n5,A,short,2\n")
    put(p, "b.csv", HEADER + '7,A,"é, é",2,01/12/09 07:45,1,1,X,9,9\n', "latin-1")
    kept, faults = read_with_faults(spark, p)
    got = sorted((os.path.basename(r.file), r.row, r.raw, r.reason, r.kept) for r in faults.collect())
    assert got == [("a.csv", 2, "2,A,bad,two,01/12/09 07:45,x,1,X", "unreadable Price", True),
                   ("a.csv", 2, "2,A,bad,two,01/12/09 07:45,x,1,X", "unreadable Quantity", True),
                   ("a.csv", 4, "4,A,long,2,01/12/09 07:45,1,1,X,more", "too many fields", False),
                   ("b.csv", 1, '7,A,"é, é",2,01/12/09 07:45,1,1,X,9,9', "too many fields", False)]
    assert {r.Invoice for r in kept.collect()} == {"1", "2", "5"} and "_place" not in kept.columns
    assert kept.count() + faults.where(~F.col("kept")).count() == read_report(spark, p).first().lines == 5


def test_first_description_in_file_order(spark, tmpdir_path, small_blocks):
    rows = rows_of(90, seed=5)
    rng = random.Random(2)
    for r in rows:  # dates out of file order
        r[4] = f"{rng.randint(1, 28):02d}/12/09 07:45"
    p = put(f"{tmpdir_path}/o", "b.csv", HEADER + text_of(rows[:45]))
    put(p, "a.csv", HEADER + text_of(rows[45:]))
    want, counts = {}, {}
    for r in rows[45:] + rows[:45]:  # files by name
        want.setdefault(r[1], r[2] or None)
        counts[r[1]] = counts.get(r[1], 0) + (r[2] != "")
    source = CsvSales(spark, p, multiline=True)
    assert {r.StockCode: (r.Description, r.n_described) for r in source.first_descriptions().collect()} == {c: (d, counts[c]) for c, d in want.items()}
    clean = source.sales(places=True).where("Quantity > 4")
    want = {}
    for r in rows[45:] + rows[:45]:
        if int(r[3]) > 4:
            want.setdefault(r[1], r[2] or None)
    assert {r.StockCode: r.Description for r in source.first_descriptions(clean).collect()} == want
    by_date = {r.StockCode: r.Description for r in source.first_descriptions(order="date").collect()}
    assert by_date == {r.StockCode: r.Description for r in source.first_descriptions(source.sales()).collect()} != want


def test_first_description_by_date_decides_ties(spark):
    from stockcast.operators.features import first_description
    rows = [("A", "late", 2, "9"), ("A", "b", 1, "3"), ("A", "a", 1, "4"), ("A", None, 1, "5"), ("B", "x", None, "1"), ("B", "y", 1, "0"),
            ("C", "p", 1, "1"), ("C", "o", 1, "1"), ("D", None, 1, "2"), ("E", "m", 1, None), ("E", "n", 1, "1"), (None, "z", 1, "1"), ("F", "q", 5, "1")]
    df = spark.createDataFrame(rows, "StockCode string, Description string, day int, Invoice string").selectExpr(
        "StockCode", "Description", "timestamp_seconds(day * 86400) as InvoiceDate", "Invoice")
    got = {r.StockCode: (r.Description, r.n_described) for r in first_description(df).collect()}
    want = {r.StockCode: (r.Description, r.n) for r in df.where("StockCode is not null").groupBy("StockCode").agg(
        F.min_by("Description", F.struct("InvoiceDate", "Invoice", "Description")).alias("Description"), F.count("Description").alias("n")).collect()}
    assert got == want and len(got) == 6


@pytest.mark.parametrize("text", [",\"\n\n ab\n", "\"\",x\n", "a\"b,\"\n"])
def test_states_of_many_lines_are_those_of_single_ones(monkeypatch, text):
    """By parity where opening quotes start fields, line by line elsewhere, over stretches of any length."""
    rng = random.Random(4)
    quotes = R.QuoteState(",")
    for chunk in (1, 3, 1000):
        monkeypatch.setattr(R, "CHUNK", chunk)
        for _ in range(60):
            lines = "".join(rng.choice(text) for _ in range(150)).encode().split(b"\n")
            for inside in (False, True):
                want, state = [], inside
                for line in lines:
                    state = quotes.after(line, state)
                    want.append(state)
                values = pa.array([b'"', *lines, b'"'], pa.binary()).slice(1, len(lines))
                assert quotes.ends(values, inside).tolist() == want


def test_well_formed_records_are_not_read_line_by_line(monkeypatch):
    rows = rows_of(3000, seed=6)
    lines = text_of(rows).encode().removesuffix(b"\n").split(b"\n")
    entries = ["0 0 0 2 0", *[None] * (len(lines) - 1)]  # block, the file's place, the block's place, skip, inside
    batches = [pa.RecordBatch.from_arrays([pa.array(entries[a:b], pa.string()), pa.array(lines[a:b], pa.binary())], names=["entry", "value"])
               for a, b in ((0, 1700), (1700, 1701), (1701, len(lines)))]
    monkeypatch.setattr(R.QuoteState, "after", lambda *a: pytest.fail("a line by itself"))
    got = [r for b in R._cut(iter(batches), ",", False) for r in b.to_pylist()]
    assert [r["place"] for r in got] == [r["row"] for r in got] == list(range(2, len(rows)))
    assert [next(csv.reader(io.StringIO(r["value"].decode(), newline=""))) for r in got] == rows[2:]
    assert list(R._cut(iter(batches), ",", True)) == []


def test_a_record_is_parsed_once_and_lines_without_quoted_breaks_stay_in_the_jvm(spark, tmpdir_path, monkeypatch):
    p = put(f"{tmpdir_path}/once", "a.csv", HEADER + text_of(rows_of(20, seed=9)[:1]))
    monkeypatch.setattr(DataFrame, "mapInArrow", lambda *a, **k: pytest.fail("lines go to Python"))
    sales = CsvSales(spark, p).sales().where("StockCode is not null and Quantity > 0")
    plan = sales._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_csv") == 1
    assert sales.count() == 1


def test_quoted_line_breaks_in_files_of_two_formats(spark, tmpdir_path, small_blocks):
    rows = [[c.replace("\xa0", " ") for c in r] for r in rows_of(40, seed=2)]
    p = put(f"{tmpdir_path}/two", "a.csv", HEADER + text_of(rows[:20]))
    out = io.StringIO()
    csv.writer(out, delimiter=";", lineterminator="\n").writerows(rows[20:])
    put(p, "b.csv", "\n" + HEADER.replace(",", ";") + out.getvalue() + "99;S9;\xe9t\xe9;1;01/12/09 07:45;1;1;X\n", "latin-1")
    got = read_places(spark, p, encoding="auto", multiline=True).orderBy(PLACE).collect()
    assert [(r.Invoice, r.Description or "") for r in got] == [(r[0], r[2]) for r in rows] + [("99", "\xe9t\xe9")]
