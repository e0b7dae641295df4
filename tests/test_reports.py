"""Report tables on the demo frames F2 / F3 and on small hand-made results."""

from pyspark.sql import functions as F

from stockcast.operators import report as RP


def test_kpis_on_f2(f2):
    k = RP.restock_kpis(f2).first()
    assert (k.total_items, k.urgent_items, k.total_units, k.mean_restock) == (5, 2, 310, 62)


def test_ranges_on_f2(f2):
    rows = {r.range_label: (r.product_count, r.share_pct) for r in RP.restock_ranges(f2).collect()}
    assert rows["Low (0-10)"] == (0, 0.0)
    assert rows["Medium (11-50)"] == (2, 40.0)
    assert rows["High (51-200)"] == (3, 60.0)
    assert rows["Very High (>200)"] == (0, 0.0)


def test_ranges_gap_values_fall_nowhere(spark):
    df = spark.createDataFrame([(10.5,), (200.5,)], "recommended_restock double")
    assert sum(r.product_count for r in RP.restock_ranges(df).collect()) == 0


def test_histogram_bins(spark):
    vals = [0.0, 9.0, 10.0, 49.0, 50.0, 1000.0, 1500.0]
    df = spark.createDataFrame([(v,) for v in vals], "recommended_restock double")
    got = {r.bin_label: r.product_count for r in RP.restock_histogram(df).collect()}
    assert got == {"0-10": 2, "11-50": 2, "51-100": 1, "101-200": 0, "201-500": 0,
                   "501-1000": 0, ">1000": 2}


def test_demand_and_cost_fallbacks(f2):
    assert RP.demand_column(f2)._jc.toString() == "predicted_demand"
    costs = f2.withColumn("avg_price", F.lit(2.0)).select(RP.cost_column(
        f2.withColumn("avg_price", F.lit(2.0))).alias("c")).collect()
    assert [r.c for r in costs] == [200.0, 100.0, 150.0, 50.0, 120.0]


def test_no_priority_falls_back_to_top(f2):
    res = f2.withColumn("priority", F.lit(None).cast("string"))
    rows = RP.restock_by_priority(res, (4, 3, 3), fallback=10).orderBy("rank").collect()
    assert [r.StockCode for r in rows] == ["A001", "C003", "E005", "B002", "D004"]


def test_stratified_picks(spark):
    rows = [(f"P{i:02d}", float(i), "High" if i >= 20 else "Medium" if i >= 10 else "Low") for i in range(30)]
    res = spark.createDataFrame(rows, "StockCode string, recommended_restock double, priority string")
    got = RP.restock_by_priority(res, (2, 2, 1), fallback=None).collect()
    by = {}
    for r in got:
        by.setdefault(r.priority, []).append(r.StockCode)
    assert sorted(by["High"]) == ["P28", "P29"] and sorted(by["Medium"]) == ["P18", "P19"] and by["Low"] == ["P09"]


def test_priority_summary_empty_groups(spark):
    res = spark.createDataFrame([("A", 10.0, 5.0, "High")],
                                "StockCode string, recommended_restock double, estimated_cost double, priority string")
    rows = {r.priority: (r.item_count, r.total_units, r.total_cost) for r in RP.priority_summary(res).collect()}
    assert rows == {"Low": (0, 0, 0.0), "Medium": (0, 0, 0.0), "High": (1, 10, 5.0)}
    console = RP.priority_summary(res.withColumn("avg_price", F.lit(0.5)), style="console").collect()
    assert [(r.priority, r.total_cost) for r in console] == [("High", 5.0)]


def test_labels_and_names(spark):
    res = spark.createDataFrame([("1", None), ("2", "Unknown"), ("3", "x" * 40)], "StockCode string, Description string")
    names = {r.StockCode: r.display_name for r in RP.with_display_name(res).collect()}
    assert names == {"1": "Product 1", "2": "Product 2", "3": "x" * 40}
    labels = {r.StockCode: r for r in RP.with_labels(res).collect()}
    assert labels["3"].chart_label == "x" * 25 + "..."
    assert labels["2"].console_label == "Unknown".ljust(37)
    assert labels["1"].dashboard_label == "nan"


def test_search_and_sort(f2):
    assert [r.StockCode for r in RP.search_restock(f2, "widget c").collect()] == ["C003"]
    assert [r.StockCode for r in RP.search_restock(f2, "004").collect()] == ["D004"]
    # the term is lower-cased before it is looked for in the code, so capitals in a code never match
    assert RP.search_restock(f2, "D00").count() == 0
    rows = RP.sort_restock(f2, "safety_stock", ascending=False).orderBy("position").collect()
    assert [r.StockCode for r in rows] == ["A001", "C003", "E005", "B002", "D004"]


def test_trend_and_extremes(spark):
    import datetime as dt
    d = [dt.date(2024, 1, i) for i in range(1, 9)]
    q = [5.0, 9.0, 1.0, 9.0, 1.0, 6.0, 7.0, 8.0]
    f = spark.createDataFrame([("A", x, y) for x, y in zip(d, q)], "StockCode string, Date date, Quantity double")
    t = RP.product_trend(f).first()
    assert t.avg_quantity == sum(q) / 8 and t.recent_quantity == sum(q[-5:]) / 5 and t.trend == "increasing"
    e = RP.trend_extremes(f).first()
    assert (e.max_date, e.max_quantity, e.min_date, e.min_quantity) == (d[1], 9.0, d[2], 1.0)
    one = spark.createDataFrame([("B", d[0], 3.0)], "StockCode string, Date date, Quantity double")
    e1 = RP.trend_extremes(one).first()
    assert e1.min_date is None and e1.max_quantity == 3.0


def test_summary_text_f3(spark):
    f3 = spark.createDataFrame([("A001", "Widget A", 100.0), ("B002", "Widget B", 50.0), ("C003", "Widget C", 25.0)],
                               "StockCode string, Description string, recommended_restock double")
    r = RP.summary_text(f3).first()
    assert r.urgent_items == 1 and r.top_items == "Widget A, Widget B, Widget C"
    assert r.summary.startswith("The system has identified 3 products")


def test_two_places_like_python(spark):
    from stockcast.operators.report import two_places
    vals = [n / 200 for n in range(-50, 3000)] + [1.115, 2.675, 0.125, 0.375, 1e-9, 123456789.995, 0.995, 99.995, 1e15, -0.001]
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = {r.x: r.t for r in df.select("x", two_places(df.x).alias("t")).collect()}
    assert [got[float(v)] for v in vals] == [f"{v:.2f}" for v in vals]


def test_json_text_is_valid_for_any_characters(spark):
    import json

    from stockcast.operators.report import _json_text
    texts = ['tab\there', 'line\nbreak', 'quote " and \\ slash', "[x]", "é 🦆", "", "\x01"]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    assert [json.loads(r.j) for r in df.select(_json_text(df.t).alias("j")).collect()] == [*texts, None]


def test_search_lower_cases_the_term_before_the_code(spark):
    from stockcast.operators.report import search_restock
    res = spark.createDataFrame([("M", "Manual", 2.0), ("85099B", "BAG", 1.0)], "StockCode string, Description string, recommended_restock double")
    assert [r.StockCode for r in search_restock(res, "M").collect()] == ["M"]      # by its description
    assert search_restock(res, "B").count() == 1 and search_restock(res, "85099B").count() == 0
    assert [r.StockCode for r in search_restock(res, "85099").collect()] == ["85099B"]
