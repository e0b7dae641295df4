"""The SQL text per query name (pairs with ``registry.QUERIES``)."""

from __future__ import annotations

from stockcast.plans.oracle import RESTOCK_PREDICT, RESTOCK_TRAINING, r6

ORACLE: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    ORACLE[name] = text


sql("restock_recommendations", RESTOCK_PREDICT + f"""
SELECT "StockCode", predicted_weekly_demand, safety_stock, recommended_restock,
       {r6('avg_price')} AS avg_price, estimated_cost, "Description", priority
FROM restock""")

sql("restock_training", RESTOCK_TRAINING + f"""
SELECT "StockCode", predicted_weekly_demand, safety_stock, recommended_restock,
       {r6('avg_price')} AS avg_price, "Description", {r6('estimated_cost')} AS estimated_cost, priority
FROM restock""")

# ---------------------------------------------------------------------------
from stockcast.plans.oracle import (  # noqa: E402
    DAILY_SQL, FEAT_PREDICT_SQL, FEAT_TRAINING_SQL, FIRST_DESC_RAW_SQL, base, clean_sql, dow,
    r4, scorer_sql, with_,
)
from stockcast.sources.star import SALES_SQL  # noqa: E402

S = with_(SALES_SQL)
CP = with_(SALES_SQL, clean_sql(False))
CT = with_(SALES_SQL, clean_sql(True))
DAILY = with_(SALES_SQL, clean_sql(False), DAILY_SQL)
FP = with_(*base(False))
FT = with_(*base(True))
SALES_COLS = '"Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price", "Customer ID", "Country"'

sql("malformed_invoices", S + f"""
SELECT {SALES_COLS} FROM sales
WHERE NOT regexp_full_match(coalesce("Invoice", 'nan'), '^[0-9C]+$')""")

sql("dataset_shape", S + 'SELECT count(*) AS n_rows, CAST(8 AS INTEGER) AS n_columns FROM sales')

sql("parse_invoice_date", S + """
SELECT "Invoice", "StockCode", strftime("InvoiceDate", '%d/%m/%y %H:%M') AS "InvoiceText",
       strptime(strftime("InvoiceDate", '%d/%m/%y %H:%M'), '%d/%m/%y %H:%M') AS "Parsed"
FROM sales""")

sql("date_parts", S + f"""
SELECT "Invoice", "StockCode", "InvoiceDate",
       CAST(year("InvoiceDate") AS INTEGER) AS "Year", CAST(month("InvoiceDate") AS INTEGER) AS "Month",
       CAST(day("InvoiceDate") AS INTEGER) AS "Day", {dow('"InvoiceDate"')} AS "DayOfWeek",
       CAST(hour("InvoiceDate") AS INTEGER) AS "Hour"
FROM sales""")

sql("total_price", S + 'SELECT "Invoice", "StockCode", "Quantity", "Price", "Quantity" * "Price" AS "TotalPrice" FROM sales')
sql("drop_returns", S + 'SELECT "Invoice", "StockCode", "Quantity" FROM sales WHERE "Quantity" > 0')
sql("drop_cancelled", S + """SELECT "Invoice", "StockCode", "Quantity" FROM sales
WHERE NOT starts_with(coalesce("Invoice", 'nan'), 'C')""")
sql("numeric_customer", S + 'SELECT "Invoice", "StockCode", TRY_CAST("Customer ID" AS DOUBLE) AS "Customer ID" FROM sales')
sql("clean_sales", CT + "SELECT * FROM clean")


def _describe_one(c: str) -> str:
    return f"""
SELECT '{c}' AS "column", count("{c}") AS "count", {r6(f'avg("{c}")')} AS mean,
       {r6(f'stddev_samp("{c}")')} AS std, {r6(f'min("{c}")')} AS "min",
       {r6(f'quantile_cont("{c}", 0.25)')} AS p25, {r6(f'quantile_cont("{c}", 0.5)')} AS p50,
       {r6(f'quantile_cont("{c}", 0.75)')} AS p75, {r6(f'max("{c}")')} AS "max"
FROM clean"""


sql("describe_sales", CP + " UNION ALL ".join(_describe_one(c) for c in ("Quantity", "Price", "TotalPrice")))

sql("top_products", CP + """
SELECT "StockCode", coalesce(sum("Quantity"), 0.0) AS "Quantity" FROM clean WHERE "StockCode" IS NOT NULL
GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")

sql("sales_by_country", CP + f"""
SELECT "Country", {r4('t')} AS "TotalPrice" FROM (
  SELECT "Country", coalesce(sum("TotalPrice"), 0.0) AS t FROM clean WHERE "Country" IS NOT NULL
  GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)""")

for key, col in (("monthly_sales", "Month"), ("weekday_sales", "DayOfWeek")):
    sql(key, CP + f"""
SELECT "{col}", {r4('coalesce(sum("TotalPrice"), 0.0)')} AS "TotalPrice" FROM clean
WHERE "{col}" IS NOT NULL GROUP BY 1""")

FEAT_OUT = f"""SELECT * REPLACE ({r6('"Price"')} AS "Price", {r6('"Rolling7_Quantity"')} AS "Rolling7_Quantity",
                      {r4('"TotalPrice"')} AS "TotalPrice") FROM feat"""

sql("product_daily", DAILY + f"""SELECT * REPLACE ({r6('"Price"')} AS "Price", {r4('"TotalPrice"')} AS "TotalPrice") FROM daily""")
sql("lag1", DAILY + 'SELECT "StockCode", "Date", "Lag1_Quantity" FROM feat_all')
sql("rolling7", DAILY + f'SELECT "StockCode", "Date", {r6(chr(34) + "Rolling7_Quantity" + chr(34))} AS "Rolling7_Quantity" FROM feat_all')
sql("features_predict", FP + FEAT_OUT)
sql("features_training", FT + FEAT_OUT)
sql("attach_descriptions", DAILY + """, pairs AS (SELECT DISTINCT "StockCode", "Description" FROM clean)
SELECT d."StockCode", d."Date", d."Quantity", p."Description" FROM daily d LEFT JOIN pairs p ON d."StockCode" = p."StockCode" """)
sql("distinct_descriptions", CP + 'SELECT DISTINCT "StockCode", "Description" FROM clean WHERE "StockCode" IS NOT NULL')
sql("first_description", with_(SALES_SQL, FIRST_DESC_RAW_SQL) + "SELECT * FROM first_desc")

# --- restock steps (predict variant) -------------------------------------------------
RP_ = RESTOCK_PREDICT

sql("latest_date", FP + 'SELECT max("Date") AS latest FROM feat')
sql("recent_window", FP + """SELECT "StockCode", "Date", "Quantity" FROM feat
WHERE "Date" >= (SELECT max("Date") FROM feat) - 30""")
sql("product_stats", FP + f""", recent AS (SELECT * FROM feat WHERE "Date" >= (SELECT max("Date") FROM feat) - 30)
SELECT "StockCode", sum("Quantity") AS "Total_Quantity", {r6('avg("Quantity")')} AS "Avg_Daily_Quantity",
       {r6('stddev_samp("Quantity")')} AS "Std_Daily_Quantity", {r6('avg("Price")')} AS "Avg_Price"
FROM recent GROUP BY 1""")
sql("enough_history", RP_ + 'SELECT "StockCode", n_rows FROM prof WHERE n_rows >= 5')
sql("latest_row", RP_ + 'SELECT "StockCode", "Last_Date", "Last_Quantity" FROM prof')
sql("active_products", RP_ + 'SELECT "StockCode", n_rows, n_recent FROM active')
sql("forecast_grid", RP_ + 'SELECT "StockCode", "ForecastDate" FROM grid')
sql("forecast_inputs", RP_ + f"""SELECT "StockCode", "ForecastDate", "Lag1_Quantity",
  {r6('"Rolling7_Quantity"')} AS "Rolling7_Quantity", "Month", "Day", "DayOfWeek" FROM inputs""")
sql("weekly_demand", RP_ + f'SELECT "StockCode", {r6("d")} AS predicted_weekly_demand FROM demand')
sql("safety_stock", RP_ + f"""SELECT "StockCode",
  {r6('CAST(1.5 AS DOUBLE) * "Std_Daily_Quantity" * sqrt(CAST(7 AS DOUBLE))')} AS safety_stock FROM demand""")
sql("safety_fallback", RP_ + f'SELECT "StockCode", {r6("s")} AS safety_stock FROM raw')
sql("estimated_cost", RP_ + f"""SELECT nb."StockCode", nb.estimated_cost AS cost_predict,
  {r6('round_even(r.restock_raw, 0) * r."Avg_Price"')} AS cost_training
FROM numbers nb JOIN raw2 r ON nb."StockCode" = r."StockCode" """)
sql("priority_tertiles", RP_ + "SELECT n, e1, e2 FROM edges")

# --- report tables -------------------------------------------------------------
RES = RP_ + f""", res AS (SELECT * REPLACE ({r6('avg_price')} AS avg_price) FROM restock),
ranked AS (SELECT *, CAST(row_number() OVER (ORDER BY recommended_restock DESC NULLS LAST, "StockCode") AS INTEGER) AS position FROM res),
prank AS (SELECT *, CAST(row_number() OVER (PARTITION BY priority ORDER BY recommended_restock DESC NULLS LAST, "StockCode") AS INTEGER) AS "rank",
                 CAST(CASE priority WHEN 'High' THEN 0 WHEN 'Medium' THEN 1 ELSE 2 END AS INTEGER) AS group_order
          FROM res WHERE priority IS NOT NULL)
"""
RES_COLS = '"StockCode", predicted_weekly_demand, safety_stock, recommended_restock, avg_price, estimated_cost, "Description", priority'


def picks_sql(kh: int, km: int, kl: int, fallback: int | None) -> str:
    q = f"""SELECT {RES_COLS}, "rank", group_order FROM prank
WHERE "rank" <= CASE priority WHEN 'High' THEN {kh} WHEN 'Medium' THEN {km} WHEN 'Low' THEN {kl} ELSE 0 END"""
    if fallback is not None:
        q += f"""
UNION ALL SELECT {RES_COLS}, position AS "rank", CAST(0 AS INTEGER) AS group_order FROM ranked
WHERE position <= {fallback} AND NOT EXISTS (SELECT 1 FROM res WHERE priority IS NOT NULL)"""
    return q


sql("priority_summary", RES + f""", pr(priority, position) AS (VALUES ('Low', 0), ('Medium', 1), ('High', 2))
SELECT pr.priority, CAST(pr.position AS INTEGER) AS position,
       count(r.recommended_restock) AS item_count,
       CAST(coalesce(sum(CAST(trunc(r.recommended_restock) AS BIGINT)), 0) AS BIGINT) AS total_units,
       {r4('coalesce(sum(r.estimated_cost), 0.0)')} AS total_cost
FROM pr LEFT JOIN res r ON r.priority = pr.priority GROUP BY pr.priority, pr.position""")

sql("summary_round_trip", "SELECT priority, item_count, total_units, total_cost FROM (" + ORACLE["priority_summary"] + ")")
sql("restock_kpis", RES + """SELECT count(*) AS total_items,
  count(*) FILTER (WHERE recommended_restock > (SELECT avg(recommended_restock) FROM res)) AS urgent_items,
  CAST(trunc(sum(recommended_restock)) AS BIGINT) AS total_units,
  CAST(trunc(avg(recommended_restock)) AS BIGINT) AS mean_restock FROM res""")

sql("restock_ranges", RES + f""", rg(range_label, position, lo, hi) AS (VALUES
  ('Low (0-10)', 0, 0, 10), ('Medium (11-50)', 1, 11, 50), ('High (51-200)', 2, 51, 200),
  ('Very High (>200)', 3, 201, NULL)),
tot AS (SELECT count(*) AS total FROM res)
SELECT rg.range_label, CAST(rg.position AS INTEGER) AS position,
  (SELECT count(*) FROM res WHERE recommended_restock >= rg.lo AND (rg.hi IS NULL OR recommended_restock <= rg.hi)) AS product_count,
  {r6('CASE WHEN tot.total > 0 THEN CAST((SELECT count(*) FROM res WHERE recommended_restock >= rg.lo AND (rg.hi IS NULL OR recommended_restock <= rg.hi)) AS DOUBLE) / tot.total * 100.0 ELSE 0.0 END')} AS share_pct
FROM rg, tot""")

sql("restock_histogram", RES + """, bins(bin_label, position, lo, hi) AS (VALUES
  ('0-10', 0, 0, 10), ('11-50', 1, 10, 50), ('51-100', 2, 50, 100), ('101-200', 3, 100, 200),
  ('201-500', 4, 200, 500), ('501-1000', 5, 500, 1000), ('>1000', 6, 1000, NULL)),
mx AS (SELECT max(recommended_restock) + 1 AS top FROM res)
SELECT b.bin_label, CAST(b.position AS INTEGER) AS position,
  (SELECT count(*) FROM res WHERE recommended_restock >= b.lo AND
     ((b.hi IS NOT NULL AND recommended_restock < b.hi) OR (b.hi IS NULL AND recommended_restock <= mx.top))) AS product_count
FROM bins b, mx""")

sql("priority_counts", RES + """, pr(priority, position) AS (VALUES ('High', 0), ('Medium', 1), ('Low', 2))
SELECT pr.priority, CAST(pr.position AS INTEGER) AS position, count(r."StockCode") AS item_count
FROM pr LEFT JOIN res r ON r.priority = pr.priority GROUP BY pr.priority, pr.position""")

sql("top_restock", RES + f"SELECT {RES_COLS}, position FROM ranked WHERE position <= 10")
sql("restock_by_priority", RES + picks_sql(5, 5, 5, 10))
sql("urgent_flag", RES + f"SELECT {RES_COLS} FROM res WHERE recommended_restock > (SELECT avg(recommended_restock) FROM res)")
sql("search_restock", RES + f"""SELECT {RES_COLS}, position FROM ranked WHERE position <= 50
  AND coalesce(contains(lower("Description"), lower('Gear')) OR contains("StockCode", 'Gear'), false)""")
sql("sort_restock", RES + f"""SELECT {RES_COLS}, CAST(row_number() OVER (ORDER BY coalesce(safety_stock, 0.0), "StockCode") AS INTEGER) AS position
FROM ranked WHERE position <= 50""")
sql("sort_restock_all", RES + ", top AS (SELECT * FROM ranked WHERE position <= 50)\n" + "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS sorted_by, {up} AS ascending, CAST(row_number() OVER (ORDER BY coalesce("{c}", {missing}) {way}, "StockCode") AS INTEGER) AS position,
  "StockCode" FROM top""" for c, missing in (("StockCode", "'0'"), ("Description", "'0'"), ("predicted_weekly_demand", "0.0"), ("safety_stock", "0.0"),
                                              ("recommended_restock", "0.0")) for up, way in (("TRUE", "ASC"), ("FALSE", "DESC"))))
sql("demand_and_cost_columns", RES + "\nUNION ALL\n".join(
    f"""SELECT "StockCode", '{name}' AS "columns", predicted_weekly_demand AS demand, {cost} AS cost FROM res"""
    for name, cost in (("all", "estimated_cost"), ("price", "avg_price * recommended_restock"), ("none", "0.0 * recommended_restock"))))
sql("dashboard_records", RES + """SELECT position, CAST(to_json({'StockCode': "StockCode",
  'predicted_weekly_demand': predicted_weekly_demand, 'safety_stock': safety_stock,
  'recommended_restock': recommended_restock, 'avg_price': avg_price, 'estimated_cost': estimated_cost,
  'Description': "Description", 'priority': priority}) AS VARCHAR) AS record FROM ranked WHERE position <= 50""")

DISPLAY = """CASE WHEN "Description" IS NULL OR "Description" = 'Unknown' THEN 'Product ' || "StockCode" ELSE "Description" END"""
sql("display_name", RES + f'SELECT "StockCode", {DISPLAY} AS display_name FROM res')


def trunc_sql(x: str, n: int, pad: bool = False) -> str:
    short = f"rpad({x}, {n}, ' ')" if pad else x
    return f"CASE WHEN length({x}) > {n} THEN substr({x}, 1, {n}) || '...' ELSE {short} END"


_NAME_NULL_ONLY = """CASE WHEN "Description" IS NULL THEN 'Product ' || "StockCode" ELSE "Description" END"""
_D = """coalesce("Description", 'nan')"""
sql("truncate_label", RES + f"""SELECT "StockCode", {trunc_sql(_NAME_NULL_ONLY, 37, True)} AS console_label,
  {trunc_sql(_D, 30)} AS dashboard_label, {trunc_sql(_D, 25)} AS chart_label FROM res""")

TREND = """, tr AS (SELECT "StockCode", "Quantity",
         row_number() OVER (PARTITION BY "StockCode" ORDER BY "Date" DESC) AS rn FROM {src}),
trend AS (SELECT "StockCode", avg("Quantity") AS avg_quantity, max("Quantity") AS max_quantity,
          avg("Quantity") FILTER (WHERE rn <= 5) AS recent_quantity FROM tr GROUP BY 1),
trend2 AS (SELECT *, CASE WHEN recent_quantity > avg_quantity THEN 'increasing' ELSE 'decreasing' END AS trend FROM trend)
"""
sql("product_trend", FP + TREND.format(src="feat") + f"""SELECT "StockCode", {r6('avg_quantity')} AS avg_quantity,
  max_quantity, {r6('recent_quantity')} AS recent_quantity, trend FROM trend2""")

sql("trend_extremes", FP + """, mm AS (SELECT "StockCode", max("Quantity") AS mq, min("Quantity") AS nq FROM feat GROUP BY 1),
ex AS (SELECT f."StockCode", min(f."Date") FILTER (WHERE f."Quantity" = m.mq) AS max_date, m.mq AS max_quantity,
              min(f."Date") FILTER (WHERE f."Quantity" = m.nq) AS mn_date, m.nq AS mn_q
       FROM feat f JOIN mm m ON f."StockCode" = m."StockCode" GROUP BY f."StockCode", m.mq, m.nq)
SELECT "StockCode", max_date, max_quantity,
       CASE WHEN mn_date = max_date THEN NULL ELSE mn_date END AS min_date,
       CASE WHEN mn_date = max_date THEN NULL ELSE mn_q END AS min_quantity FROM ex""")

PICKS_TREND = RES + f", picks AS ({picks_sql(2, 2, 1, None)})\n"
sql("product_history", PICKS_TREND + "SELECT * REPLACE (" + f"""{r6('"Price"')} AS "Price", {r6('"Rolling7_Quantity"')} AS "Rolling7_Quantity",
  {r4('"TotalPrice"')} AS "TotalPrice") FROM feat WHERE "StockCode" IN (SELECT "StockCode" FROM picks)""")
sql("chart_product_series", PICKS_TREND + """SELECT "StockCode", "Date", "Quantity" FROM feat
WHERE "StockCode" IN (SELECT "StockCode" FROM picks)""")
sql("report_picks", PICKS_TREND + """, hist AS (SELECT * FROM feat WHERE "StockCode" IN (SELECT "StockCode" FROM picks))"""
    + TREND.format(src="hist") + f"""SELECT p."StockCode", {DISPLAY.replace('"Description"', 'p."Description"').replace('"StockCode"', 'p."StockCode"')} AS display_name,
  p.priority, p."rank", p.group_order, p.recommended_restock, p.predicted_weekly_demand, p.safety_stock,
  {r6('t.avg_quantity')} AS avg_quantity, t.max_quantity, {r6('t.recent_quantity')} AS recent_quantity, t.trend
FROM picks p LEFT JOIN trend2 t ON p."StockCode" = t."StockCode" """)

sql("chart_top_restock", RES + f", picks AS ({picks_sql(4, 3, 3, 10)})\n" + f"""SELECT "StockCode", priority, "rank", group_order,
  {trunc_sql(_D, 25)} AS label, recommended_restock AS value,
  {r6('recommended_restock / (SELECT max(recommended_restock) FROM picks)')} AS fill FROM picks""")

sql("summary_text", RES + """SELECT count(*) AS total_items,
  count(*) FILTER (WHERE recommended_restock > (SELECT avg(recommended_restock) FROM res)) AS urgent_items,
  printf('The system has identified %d products that need restocking, with %d items requiring urgent attention (above average restock amounts).',
         count(*), count(*) FILTER (WHERE recommended_restock > (SELECT avg(recommended_restock) FROM res))) AS summary,
  (SELECT string_agg("Description", ', ' ORDER BY position) FROM ranked WHERE position <= 3) AS top_items
FROM res""")

sql("product_text", RES + TREND.format(src="feat") + f"""SELECT r."StockCode",
  printf('Analysis for %s: Sales averaging %s units daily, with a %s trend.',
         {DISPLAY.replace('"Description"', 'r."Description"').replace('"StockCode"', 'r."StockCode"')},
         printf('%.2f', t.avg_quantity), t.trend) AS trend_text,
  'Recommendation based on historical demand patterns and safety stock calculations.' AS reasoning_text
FROM res r JOIN trend2 t ON r."StockCode" = t."StockCode" """)

sql("sample_rows", S + f"""SELECT {SALES_COLS} FROM sales ORDER BY md5(concat_ws('|', "Invoice", "StockCode", "Description",
  CAST("Quantity" AS VARCHAR), CAST("InvoiceDate" AS VARCHAR), CAST("Price" AS VARCHAR), "Customer ID", "Country", '42'))
LIMIT 500""")

sql("sample_round_trip", ORACLE["sample_rows"])
SPLIT = """CASE WHEN (('0x' || substr(md5(concat_ws('|', "StockCode", CAST("Date" AS VARCHAR), '42')), 1, 8))::BIGINT % 100) < 80
  THEN 'train' ELSE 'test' END"""
sql("train_test_split", FT + f'SELECT "StockCode", "Date", "Quantity", {SPLIT} AS split FROM feat')
sql("train_test_split_exact", FT + """, ranked AS (
  SELECT "StockCode", "Date", "Quantity", row_number() OVER (ORDER BY md5(concat_ws('|', "StockCode", CAST("Date" AS VARCHAR), '42'))) AS position,
         count(*) OVER () AS n FROM feat)
SELECT "StockCode", "Date", "Quantity", CASE WHEN position <= n - (n + 4) // 5 THEN 'train' ELSE 'test' END AS split FROM ranked""")
sql("regression_metrics", FT + f""", te AS (SELECT "Quantity" AS y, "Lag1_Quantity" AS yhat FROM feat WHERE {SPLIT} = 'test')
SELECT {r6('avg((y - yhat) * (y - yhat))')} AS mse, {r6('avg(abs(y - yhat))')} AS mae,
  {r6('1.0 - sum((y - yhat) * (y - yhat)) / sum((y - (SELECT avg(y) FROM te)) * (y - (SELECT avg(y) FROM te)))')} AS r2,
  count(*) AS n FROM te""")

# the round trip gives back the sales lines unchanged
sql("csv_round_trip", S + f"SELECT {SALES_COLS} FROM sales")

# --- N6 prompt table -----------------------------------------------------------------
from stockcast.config import PROMPT_FORECAST, PROMPT_OVERALL, PROMPT_REASONING, PROMPT_TREND  # noqa: E402


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_ITEM = lit('  {\n    "Description": %s,\n    "recommended_restock": %s\n  }')
_JSON_DESC = """CASE WHEN "Description" IS NULL THEN 'null'
  ELSE '"' || replace(replace("Description", '\\', '\\\\'), '"', '\\"') || '"' END"""
_TWO = "printf('%.2f', t.avg_quantity)"
_RDESC = """coalesce(r."Description", 'nan')"""
_RDISPLAY = DISPLAY.replace('"Description"', 'r."Description"').replace('"StockCode"', 'r."StockCode"')

sql("prompt_table", RES + TREND.format(src="feat") + f""",
kp AS (SELECT count(*) AS total_items,
  count(*) FILTER (WHERE recommended_restock > (SELECT avg(recommended_restock) FROM res)) AS urgent_items FROM res),
items AS (SELECT '[' || chr(10) || string_agg(printf({_ITEM}, {_JSON_DESC}, CAST(recommended_restock AS VARCHAR)),
                 ',' || chr(10) ORDER BY position) || chr(10) || ']' AS x FROM ranked WHERE position <= 5),
per AS (SELECT r.*, t.avg_quantity, t.max_quantity, t.trend FROM res r JOIN trend2 t ON r."StockCode" = t."StockCode")
SELECT 'overall_summary' AS kind, CAST(NULL AS VARCHAR) AS "StockCode",
       printf({lit(PROMPT_OVERALL)}, CAST(total_items AS VARCHAR), CAST(urgent_items AS VARCHAR), x) AS prompt
FROM kp, items
UNION ALL
SELECT 'product_trend', r."StockCode", printf({lit(PROMPT_TREND)}, {_RDISPLAY}, {_TWO}, CAST(t.max_quantity AS VARCHAR), t.trend)
FROM per r, (SELECT 1) d, LATERAL (SELECT r.avg_quantity AS avg_quantity, r.max_quantity AS max_quantity, r.trend AS trend) t
UNION ALL
SELECT 'restock_reasoning', r."StockCode", printf({lit(PROMPT_REASONING)}, {_RDESC}, CAST(r.predicted_weekly_demand AS VARCHAR),
       CAST(r.safety_stock AS VARCHAR), CAST(r.recommended_restock AS VARCHAR)) FROM per r
UNION ALL
SELECT 'product_forecast', r."StockCode", printf({lit(PROMPT_FORECAST)}, {_RDESC},
       printf('%.2f', r.avg_quantity), CAST(r.recommended_restock AS VARCHAR), '7')
FROM per r""")

sql("schema_report", S + """
SELECT * FROM (VALUES ('Invoice', 'expected'), ('StockCode', 'expected'), ('Description', 'expected'),
  ('Quantity', 'expected'), ('InvoiceDate', 'expected'), ('Price', 'expected'), ('Customer ID', 'expected'),
  ('Country', 'expected')) v("column", status)
JOIN (UNPIVOT (SELECT count("Invoice") AS "Invoice", count("StockCode") AS "StockCode",
  count("Description") AS "Description", count("Quantity") AS "Quantity", count("InvoiceDate") AS "InvoiceDate",
  count("Price") AS "Price", count("Customer ID") AS "Customer ID", count("Country") AS "Country" FROM sales)
  ON COLUMNS(*) INTO NAME "column" VALUE non_null_rows) c USING ("column")""")

sql("to_int", RES + """SELECT "StockCode", CAST(predicted_weekly_demand AS BIGINT) AS predicted_weekly_demand,
  CAST(safety_stock AS BIGINT) AS safety_stock, CAST(recommended_restock AS BIGINT) AS recommended_restock,
  avg_price, estimated_cost, "Description", priority FROM res""")
sql("by_priority", RES + f"SELECT {RES_COLS} FROM res WHERE priority = 'High'")
sql("lookup_description", RP_ + """SELECT nb."StockCode", coalesce(fd."Description", 'Unknown') AS "Description"
FROM numbers nb LEFT JOIN first_desc fd ON nb."StockCode" = fd."StockCode" """)
sql("concat_priorities", RES + picks_sql(5, 4, 3, None))


# --- the closed-form model (M2, M5, M7): least squares by normal equations --------------
from stockcast.config import PREDICT, TRAINING  # noqa: E402
from stockcast.plans.oracle import linear_sql, linear_value, restock_pieces  # noqa: E402


def r3(x: str) -> str:
    return f"(floor(({x}) * 1e3 + 0.5) / 1e3)"


LINEAR = FT + f""", parts AS (SELECT *, {SPLIT} AS split FROM feat), tr AS (SELECT * FROM parts WHERE split = 'train'),
{linear_sql('tr')},
te AS (SELECT "StockCode", "Date", "Quantity", {linear_value()} AS prediction FROM parts, w WHERE split = 'test')
"""
sql("linear_regression", LINEAR + f'SELECT "StockCode", "Date", "Quantity", {r3("prediction")} AS prediction FROM te')
sql("model_round_trip", ORACLE["linear_regression"])
sql("linear_metrics", LINEAR + f"""
SELECT 'Linear Regression' AS model, CAST(0 AS INTEGER) AS position,
  {r4('avg(("Quantity" - prediction) * ("Quantity" - prediction))')} AS mse,
  {r4('avg(abs("Quantity" - prediction))')} AS mae,
  {r4('1.0 - sum(("Quantity" - prediction) * ("Quantity" - prediction)) / sum(("Quantity" - (SELECT avg("Quantity") FROM te)) * ("Quantity" - (SELECT avg("Quantity") FROM te)))')} AS r2,
  count(*) AS n FROM te""")
sql("score", with_(*base(False), f"""
tf AS (SELECT * FROM feat_all WHERE "Lag1_Quantity" IS NOT NULL),
tr AS (SELECT * FROM tf WHERE {SPLIT} = 'train'),
{linear_sql('tr')}""", *restock_pieces(PREDICT, f"SELECT inputs.*, {linear_value()} AS prediction FROM inputs, w")) + f"""
SELECT "StockCode", predicted_weekly_demand, safety_stock, recommended_restock,
       {r6('avg_price')} AS avg_price, estimated_cost, "Description", priority FROM restock""")

# --- sources and sinks on derived lines -------------------------------------------------
AWKWARD = """CASE l_linenumber WHEN 1 THEN '12" ' || p_name || ', RED' WHEN 2 THEN 'back\\' || p_name || ' "q", z'
  WHEN 3 THEN '  ' || p_name || '  ' WHEN 4 THEN 'CAFÉ ' || p_name WHEN 5 THEN 'SAY "HI"' WHEN 6 THEN NULL ELSE p_name END"""
LINES = with_(SALES_SQL.replace("WITH ", ""), f"""
lines AS (
  SELECT CASE WHEN l.l_linenumber = 3 THEN NULL WHEN l.l_linenumber = 4 THEN 'A' ELSE '' END || CAST(l.l_orderkey AS VARCHAR) AS "Invoice",
         CAST(l.l_partkey AS VARCHAR) AS "StockCode", {AWKWARD} AS "Description",
         CAST(l.l_quantity AS DOUBLE) AS "Quantity", l.l_shipdate AS "InvoiceDate", l.l_linenumber AS line
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
)""")
sql("malformed_lines", LINES + """SELECT "Invoice", "StockCode", "Description", "Quantity", "InvoiceDate" FROM lines
WHERE NOT regexp_full_match(coalesce("Invoice", 'nan'), '^[0-9C]+$')""")
sql("awkward_round_trip", LINES + """SELECT "Invoice", "StockCode", "Description", "Quantity", "InvoiceDate" FROM lines""")
sql("csv_first_description", LINES + """
SELECT "StockCode", first("Description" ORDER BY "InvoiceDate", "Invoice" NULLS FIRST, "Description" NULLS FIRST) AS "Description",
       count("Description") AS n_described FROM lines WHERE "StockCode" IS NOT NULL GROUP BY 1""")
sql("csv_first_in_file", LINES + """
SELECT "StockCode", first("Description" ORDER BY md5(concat_ws('-', coalesce("Invoice", ''), "StockCode", coalesce("Description", ''),
         CAST(CAST("Quantity" AS INTEGER) AS VARCHAR), strftime("InvoiceDate", '%Y-%m-%d')))) AS "Description",
       count("Description") AS n_described FROM lines WHERE "StockCode" IS NOT NULL GROUP BY 1""")
sql("csv_line_breaks", LINES + """
SELECT "Invoice", "StockCode", CASE WHEN length("Description") % 2 = 0 THEN "Description" || chr(10) || '"x", y' || chr(10)
  ELSE "Description" END AS "Description", "Quantity", "InvoiceDate" FROM lines""")
sql("csv_faults", """
WITH lines AS (SELECT CAST(l_orderkey AS VARCHAR) AS "Invoice", CAST(l_partkey AS VARCHAR) AS "StockCode", l_quantity, l_linenumber,
  concat_ws(',', l_orderkey, l_partkey, CASE WHEN l_linenumber = 6 THEN 'two' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END,
            CASE WHEN l_linenumber = 7 THEN 'more' END) AS raw FROM lineitem)
SELECT 'kept' AS kind, "Invoice", "StockCode", CASE WHEN l_linenumber <> 6 THEN CAST(l_quantity AS DOUBLE) END AS "Quantity",
  CAST(NULL AS VARCHAR) AS raw FROM lines WHERE l_linenumber <> 7
UNION ALL SELECT 'unreadable Quantity', NULL, NULL, NULL, raw FROM lines WHERE l_linenumber = 6
UNION ALL SELECT 'too many fields', NULL, NULL, NULL, raw FROM lines WHERE l_linenumber = 7""")
sql("schema_faults", LINES + """
SELECT 'Item name' AS "column", 'unexpected' AS status, count("Description") AS non_null_rows FROM lines
UNION ALL SELECT unnest(['Description', 'Quantity', 'Price', 'Customer ID', 'Country']), 'missing', NULL""")
sql("fanout_descriptions", LINES + """
, named AS (SELECT DISTINCT "StockCode", "Description" FROM lines),
days AS (SELECT DISTINCT "StockCode", CAST("InvoiceDate" AS DATE) AS "Date" FROM lines)
SELECT d."StockCode", d."Date", n."Description" FROM days d LEFT JOIN named n ON d."StockCode" = n."StockCode" """)

# codes with up to four names, a missing one among them
SEVERAL = [SALES_SQL.replace("sales AS (", "one_name AS (", 1), """
sales AS (SELECT * REPLACE (CASE CAST("Quantity" AS INTEGER) % 4 WHEN 1 THEN 'RED ' || "Description" WHEN 2 THEN 'BLUE ' || "Description"
  WHEN 3 THEN NULL ELSE "Description" END AS "Description") FROM one_name)""", *base(True)[1:]]
sql("restock_several_names", with_(*SEVERAL, *[p.replace('"Invoice", "Description") AS', '"Invoice" NULLS FIRST, "Description" NULLS FIRST) AS')
                                               for p in restock_pieces(TRAINING)]) + f"""
SELECT "StockCode", predicted_weekly_demand, safety_stock, recommended_restock, {r6('avg_price')} AS avg_price, "Description",
       {r6('estimated_cost')} AS estimated_cost, priority FROM restock""")
sql("linear_metrics_several_names", ORACLE["linear_metrics"].replace(SALES_SQL.replace("WITH ", "").strip("\n"), ",".join(p.strip("\n") for p in SEVERAL[:2]), 1))
sql("write_restock_round_trip", RP_ + """
SELECT "StockCode", CAST(predicted_weekly_demand AS BIGINT) AS predicted_weekly_demand, CAST(safety_stock AS BIGINT) AS safety_stock,
       CAST(recommended_restock AS BIGINT) AS recommended_restock, "Description", priority FROM restock""")
sql("by_priority_round_trip", RESTOCK_TRAINING + """
SELECT "StockCode", recommended_restock, priority FROM restock WHERE priority IS NOT NULL""")
