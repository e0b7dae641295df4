"""CSV sources and sinks: delimiter sniffing, Latin-1, round trips, data checks."""

from stockcast.sources.csv_sales import CsvSales, read_sales, sniff_delimiter
from stockcast.sources.quality import dataset_shape, malformed_invoices, schema_report
from stockcast.sources.sinks import write_by_priority, write_sales_csv


def test_sniff():
    assert sniff_delimiter("a;b;c") == ";" and sniff_delimiter("a,b") == "," and sniff_delimiter("a\tb") == "\t"


def test_latin1_semicolon(spark, tmpdir_path):
    p = f"{tmpdir_path}/l1.csv"
    with open(p, "wb") as fh:
        fh.write("Invoice;StockCode;Description;Quantity;InvoiceDate;Price;Customer ID;Country\n".encode("latin-1"))
        fh.write("1;A;CAFÉ CUP;2;01/12/09 07:45;1,5;10;España\n".encode("latin-1"))
    r = read_sales(spark, p, encoding="ISO-8859-1").first()
    assert r.Description == "CAFÉ CUP" and r.Country == "España"


def test_checks_on_f1(spark, f1):
    bad = {r.Invoice for r in malformed_invoices(f1).collect()}
    assert bad == {"A506401", None}
    s = dataset_shape(f1).first()
    assert (s.rows, s.columns) == (8, 8)
    rep = schema_report(spark, f1.drop("Country").withColumn("Extra", f1.Invoice)).collect()
    assert {(r.column, r.status) for r in rep} == {("Extra", "unexpected"), ("Country", "missing")}


def test_round_trip(spark, f1, tmpdir_path):
    from stockcast.operators.clean import with_invoice_timestamp
    src = with_invoice_timestamp(f1)
    write_sales_csv(src, f"{tmpdir_path}/rt")
    back = with_invoice_timestamp(CsvSales(spark, f"{tmpdir_path}/rt").sales())
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    assert sorted(map(key, back.collect())) == sorted(map(key, src.collect()))


def test_write_by_priority(spark, f2, tmpdir_path):
    from pyspark.sql import functions as F
    res = f2.withColumn("priority", F.when(F.col("recommended_restock") > 60, "High").otherwise("Low"))
    write_by_priority(res, f"{tmpdir_path}/bp")
    import os
    assert sorted(d for d in os.listdir(f"{tmpdir_path}/bp") if d.startswith("priority=")) == \
        ["priority=High", "priority=Low"]


def test_auto_detects_latin1_and_semicolon(spark, tmpdir_path):
    from stockcast.sources.csv_sales import detect_format
    p = f"{tmpdir_path}/auto.csv"
    with open(p, "wb") as fh:
        fh.write("Invoice;StockCode;Description;Quantity;InvoiceDate;Price;Customer ID;Country\n".encode("latin-1"))
        fh.write("1;A;CRÈME JAR;2;01/12/09 07:45;1.5;10;France\n".encode("latin-1"))
    assert detect_format(spark, p) == ("ISO-8859-1", ";")
    r = CsvSales(spark, p).sales().first()
    assert r.Description == "CRÈME JAR" and r.Price == 1.5 and r.Quantity == 2.0


def test_features_partitioned_and_pruned(spark, tmpdir_path):
    import datetime as dt

    from stockcast.plans import registry as R
    from stockcast.sources.sinks import read_features_since, write_features
    f = R.features(spark, "/root/testdata/sf0.001", R.TRAINING)
    write_features(f, f"{tmpdir_path}/feat")
    start = dt.date(2001, 6, 1)
    back = read_features_since(spark, f"{tmpdir_path}/feat", start)
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Year" in plan or "PartitionFilters: [" in plan and "Year" in plan
    assert back.count() == f.where(f.Date >= start).count()


def test_csv_source_gives_the_same_restock_table(spark, tmpdir_path):
    from stockcast.config import PREDICT, TRAINING
    from stockcast.operators.clean import clean_sales
    from stockcast.operators.features import engineer_features
    from stockcast.operators.restock import baseline_scorer, restock_recommendations
    from stockcast.plans import registry as R
    from stockcast.sources.star import StarSales

    star = StarSales(spark, "/root/testdata/sf0.001")
    write_sales_csv(star.sales(), f"{tmpdir_path}/lines")
    csv = CsvSales(spark, f"{tmpdir_path}/lines")
    for cfg in (PREDICT, TRAINING):
        clean = clean_sales(csv.sales(), cfg)
        pairs = csv.description_pairs(clean) if cfg.descriptions == "fanout" else None
        feats = engineer_features(clean, cfg, description_pairs=pairs)
        descs = csv.first_descriptions(clean if cfg.variant == "training" else None)
        got = restock_recommendations(feats, cfg, baseline_scorer, descriptions=descs).collect()
        exp = R.restock(spark, "/root/testdata/sf0.001", cfg).collect()
        key = lambda r: tuple("" if v is None else str(v) for v in r)
        assert sorted(map(key, got)) == sorted(map(key, exp))


HEADER = "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"


def _file(folder, name, text, encoding="utf-8"):
    import os
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "wb") as fh:
        fh.write(text.encode(encoding))
    return folder


def test_awkward_texts_survive_the_round_trip(spark, tmpdir_path):
    texts = ['12" RULER, RED', 'back\\slash "q", z', 'SAY "HI"', "  PAD ME  ", "CAFÉ", "\\", '"', "a,b;c"]
    src = spark.createDataFrame([(str(i), "A", t, 1.0, "01/12/09 07:45", 1.0, "1", "X") for i, t in enumerate(texts)],
                                "Invoice string, StockCode string, Description string, Quantity double, InvoiceDate string, "
                                "Price double, `Customer ID` string, Country string")
    write_sales_csv(src, f"{tmpdir_path}/texts")
    back = read_sales(spark, f"{tmpdir_path}/texts", mode="strict")
    assert sorted(r.Description for r in back.collect()) == sorted(texts)


def test_latin1_far_behind_the_first_lines(spark, tmpdir_path):
    lines = "".join(f"{i},A,PLAIN,1,01/12/09 07:45,1,1,X\n" for i in range(1500))
    p = _file(f"{tmpdir_path}/late", "a.csv", HEADER + lines + "9,A,CAFÉ,1,01/12/09 07:45,1,1,X\n", "latin-1")
    assert "CAFÉ" in {r.Description for r in CsvSales(spark, p).sales().collect()}


def test_files_with_their_own_column_order_and_encoding(spark, tmpdir_path):
    p = _file(f"{tmpdir_path}/mixed", "a.csv", HEADER + "1,A,one,2,01/12/09 07:45,7.5,1,X\n")
    _file(p, "b.csv", "Invoice;StockCode;Description;Price;InvoiceDate;Quantity;Customer ID;Country\n"
                      "2;B;DÉJÀ;7.5;01/12/09 07:45;2;1;X\n", "latin-1")
    got = CsvSales(spark, p).sales().orderBy("Invoice").collect()
    assert [(r.Description, r.Quantity, r.Price) for r in got] == [("one", 2.0, 7.5), ("DÉJÀ", 2.0, 7.5)]


def test_unreadable_numbers_and_overlong_lines_are_counted_or_raise(spark, tmpdir_path):
    import pytest

    from stockcast.sources.csv_sales import overlong_lines, read_report
    p = _file(f"{tmpdir_path}/bad", "a.csv", HEADER + "1,A,ok,2,01/12/09 07:45,1,1,X\n2,A,bad,two,01/12/09 07:45,NA,1,X\n"
              '3,A,"a ""b"", c",2,01/12/09 07:45,1,1,X\n4,A,long,2,01/12/09 07:45,1,1,X,more\n5,A,short,2\n')
    r = read_report(spark, p).first()
    assert (r.lines, r.overlong_lines, r.unreadable_Quantity, r.unreadable_Price) == (5, 1, 1, 0)
    assert [x.Invoice for x in overlong_lines(spark, p).collect()] == ["4"]
    lenient = {x.Invoice: x for x in read_sales(spark, p).collect()}
    assert set(lenient) == {"1", "2", "3", "5"} and lenient["2"].Quantity is None and lenient["3"].Description == 'a "b", c'
    with pytest.raises(ValueError, match="overlong_lines.*unreadable_Quantity"):
        read_sales(spark, p, mode="strict")


def test_quoted_line_breaks_and_missing_words(spark, tmpdir_path):
    p = _file(f"{tmpdir_path}/breaks", "a.csv", HEADER + '1,A,"two\nlines",2,01/12/09 07:45,1,NULL,nan\n')
    r = read_sales(spark, p, mode="strict", multiline=True).first()
    assert r.Description == "two\nlines" and r["Customer ID"] is None and r.Country is None


def test_first_description_from_csv_by_date_goes_by_date_not_text(spark, tmpdir_path):
    p = _file(f"{tmpdir_path}/first", "a.csv", HEADER + "1,A,NEW NAME,2,02/01/11 07:45,1,1,X\n2,A,OLD NAME,2,31/12/09 07:45,1,1,X\n")
    assert CsvSales(spark, p).first_descriptions(order="date").first().Description == "OLD NAME"


def test_by_priority_has_no_null_folder(spark, tmpdir_path):
    import os
    res = spark.createDataFrame([("A", "High"), ("B", None), ("C", "Low")], "StockCode string, priority string")
    write_by_priority(res, f"{tmpdir_path}/bpn")
    assert sorted(d for d in os.listdir(f"{tmpdir_path}/bpn") if "=" in d) == ["priority=High", "priority=Low"]
    assert spark.read.option("header", True).csv(f"{tmpdir_path}/bpn").count() == 2


def test_summary_and_restock_files(spark, f2, tmpdir_path):
    from pyspark.sql import functions as F

    from stockcast.operators.report import cost_column, demand_column, priority_summary
    from stockcast.sources.sinks import write_restock, write_summary
    assert f2.select(demand_column(f2).alias("d")).agg(F.sum("d")).first()[0] == 248.0
    priced = f2.withColumn("avg_price", F.lit(2.0))
    assert priced.select(cost_column(priced).alias("c")).agg(F.sum("c")).first()[0] == 620.0
    res = f2.withColumnRenamed("predicted_demand", "predicted_weekly_demand").withColumns({
        "priority": F.when(F.col("recommended_restock") > 60, "High").otherwise("Low"), "avg_price": F.lit(2.0),
        "estimated_cost": F.col("recommended_restock") * 2})
    write_summary(res, f"{tmpdir_path}/sum")
    want = {tuple(str(v) for v in r) for r in priority_summary(res).drop("position").collect()}
    assert {tuple(r) for r in spark.read.option("header", True).csv(f"{tmpdir_path}/sum").collect()} == want
    write_restock(res, f"{tmpdir_path}/res")
    got = {r.StockCode: r.recommended_restock for r in spark.read.option("header", True).csv(f"{tmpdir_path}/res").collect()}
    assert got == {"A001": "100", "B002": "50", "C003": "75", "D004": "25", "E005": "60"}
