"""DuckDB text of every checked query, built from shared CTE pieces.

Each piece restates the meaning of an operator in plain SQL over the
pre-registered star tables; the Spark side is written independently in the
operator modules. Doubles that come out of sums or means in an
engine-dependent order are compared after ``R6`` (floor(x * 1e6 + 0.5) / 1e6,
the same IEEE operations in both engines); money sums per row are exact.
"""

from __future__ import annotations

import math

from stockcast.config import PREDICT, TRAINING, RestockConfig
from stockcast.operators.restock import BASELINE_WEIGHTS
from stockcast.sources.star import SALES_SQL


def r6(x: str) -> str:
    return f"(floor(({x}) * 1e6 + 0.5) / 1e6)"


def r4(x: str) -> str:
    return f"(floor(({x}) * 1e4 + 0.5) / 1e4)"


def dow(x: str) -> str:
    return f"CAST(isodow({x}) - 1 AS INTEGER)"


def clean_sql(training: bool = False) -> str:
    cust = 'TRY_CAST("Customer ID" AS DOUBLE)' if training else '"Customer ID"'
    return f"""
clean AS (
  SELECT "Invoice", "StockCode", "Description", "Quantity", "InvoiceDate", "Price",
         {cust} AS "Customer ID", "Country",
         CAST(year("InvoiceDate") AS INTEGER) AS "Year", CAST(month("InvoiceDate") AS INTEGER) AS "Month",
         CAST(day("InvoiceDate") AS INTEGER) AS "Day", {dow('"InvoiceDate"')} AS "DayOfWeek",
         CAST(hour("InvoiceDate") AS INTEGER) AS "Hour", "Quantity" * "Price" AS "TotalPrice"
  FROM sales
  WHERE "Quantity" > 0 AND NOT starts_with(coalesce("Invoice", 'nan'), 'C')
)"""


DAILY_SQL = f"""
daily0 AS (
  SELECT "StockCode", CAST("InvoiceDate" AS DATE) AS "Date",
         coalesce(sum("Quantity"), 0.0) AS "Quantity", coalesce(sum("TotalPrice"), 0.0) AS "TotalPrice",
         avg("Price") AS "Price"
  FROM clean WHERE "StockCode" IS NOT NULL AND "InvoiceDate" IS NOT NULL
  GROUP BY 1, 2
),
daily AS (
  SELECT "StockCode", CAST(year("Date") AS INTEGER) AS "Year", CAST(month("Date") AS INTEGER) AS "Month",
         CAST(day("Date") AS INTEGER) AS "Day", "Quantity", "TotalPrice", "Price", "Date",
         {dow('"Date"')} AS "DayOfWeek"
  FROM daily0
),
feat_all AS (
  SELECT *, lag("Quantity") OVER (PARTITION BY "StockCode" ORDER BY "Date") AS "Lag1_Quantity",
         avg("Quantity") OVER (PARTITION BY "StockCode" ORDER BY "Date"
                               ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS "Rolling7_Quantity"
  FROM daily
)"""

FEAT_PREDICT_SQL = """
feat AS (
  SELECT "StockCode", "Year", "Month", "Day", "Quantity", "TotalPrice", "Price", "Date",
         "Lag1_Quantity", "Rolling7_Quantity"
  FROM feat_all
  WHERE "Year" IS NOT NULL AND "Month" IS NOT NULL AND "Day" IS NOT NULL AND "Quantity" IS NOT NULL
    AND "TotalPrice" IS NOT NULL AND "Price" IS NOT NULL AND "Date" IS NOT NULL
    AND "Lag1_Quantity" IS NOT NULL AND "Rolling7_Quantity" IS NOT NULL
)"""

FEAT_TRAINING_SQL = """
pairs AS (SELECT DISTINCT "StockCode", "Description" FROM clean WHERE "StockCode" IS NOT NULL),
feat AS (
  SELECT f.*, p."Description" FROM feat_all f LEFT JOIN pairs p ON f."StockCode" = p."StockCode"
  WHERE f."Lag1_Quantity" IS NOT NULL
)"""

# first description of a code, by (date, invoice, text); over all raw lines
FIRST_DESC_RAW_SQL = """
first_desc AS (
  SELECT "StockCode",
         first("Description" ORDER BY "InvoiceDate", "Invoice", "Description") AS "Description",
         count("Description") AS n_described
  FROM sales WHERE "StockCode" IS NOT NULL GROUP BY 1
)"""

FIRST_DESC_CLEAN_SQL = FIRST_DESC_RAW_SQL.replace("FROM sales", "FROM clean")


def with_(*pieces: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in pieces) + "\n"


def base(training: bool = False) -> list[str]:
    """sales -> clean -> daily -> features of the variant."""
    return [SALES_SQL, clean_sql(training), DAILY_SQL, FEAT_TRAINING_SQL if training else FEAT_PREDICT_SQL]


def scorer_sql() -> str:
    w = BASELINE_WEIGHTS
    return (f'CAST({w["Rolling7_Quantity"]!r} AS DOUBLE) * "Rolling7_Quantity" + '
            f'CAST({w["Lag1_Quantity"]!r} AS DOUBLE) * "Lag1_Quantity" + '
            f'CAST({w["DayOfWeek"]!r} AS DOUBLE) * CAST("DayOfWeek" - 3 AS DOUBLE)')


def restock_pieces(cfg: RestockConfig, scored: str | None = None) -> list[str]:
    """latest -> profile -> active -> grid -> scored -> numbers -> edges -> result."""
    n = cfg.last_n_days
    safety = f'CAST({cfg.safety_factor!r} AS DOUBLE) * "Std_Daily_Quantity" * CAST({math.sqrt(cfg.lead_time)!r} AS DOUBLE)'
    if cfg.null_std == "fallback":
        safety = f'coalesce({safety}, d * CAST({cfg.fallback_share!r} AS DOUBLE))'
    if cfg.cost == "unrounded_2dp":
        cost = 'round_even(restock_raw * "Avg_Price" * 100.0, 0) / 100.0'
    else:
        cost = 'round_even(restock_raw, 0) * "Avg_Price"'
    q1, q2 = (1 / 3 * 100) / 100, (2 / 3 * 100) / 100
    if cfg.variant == "training":
        desc = """CASE WHEN coalesce(fd.n_described, 0) = 0 THEN 'Unknown' ELSE fd."Description" END"""
        first = FIRST_DESC_CLEAN_SQL
    else:
        desc = """coalesce(fd."Description", 'Unknown')"""
        first = FIRST_DESC_RAW_SQL
    return [
        f"""
latest AS (SELECT max("Date") AS latest FROM feat),
prof AS (
  SELECT f."StockCode", count(*) AS n_rows, max(f."Date") AS "Last_Date",
         arg_max(f."Quantity", f."Date") AS "Last_Quantity",
         count(*) FILTER (WHERE f."Date" >= l.latest - {n}) AS n_recent,
         sum(f."Quantity") FILTER (WHERE f."Date" >= l.latest - {n}) AS "Total_Quantity",
         avg(f."Quantity") FILTER (WHERE f."Date" >= l.latest - {n}) AS "Avg_Daily_Quantity",
         stddev_samp(f."Quantity") FILTER (WHERE f."Date" >= l.latest - {n}) AS "Std_Daily_Quantity",
         avg(f."Price") FILTER (WHERE f."Date" >= l.latest - {n}) AS "Avg_Price"
  FROM feat f CROSS JOIN latest l GROUP BY f."StockCode"
),
active AS (SELECT * FROM prof WHERE n_rows >= {cfg.min_rows} AND n_recent > 0),
grid AS (
  SELECT a.*, CAST(l.latest + CAST(t.i AS INTEGER) AS DATE) AS "ForecastDate"
  FROM active a CROSS JOIN latest l CROSS JOIN range(1, {cfg.horizon + 1}) t(i)
),
inputs AS (
  SELECT *, "Last_Quantity" AS "Lag1_Quantity", "Avg_Daily_Quantity" AS "Rolling7_Quantity",
         CAST(month("ForecastDate") AS INTEGER) AS "Month", CAST(day("ForecastDate") AS INTEGER) AS "Day",
         {dow('"ForecastDate"')} AS "DayOfWeek"
  FROM grid
),
scored AS ({scored or f'SELECT *, {scorer_sql()} AS prediction FROM inputs'}),
demand AS (
  SELECT "StockCode", sum(prediction) AS d, any_value("Std_Daily_Quantity") AS "Std_Daily_Quantity",
         any_value("Avg_Price") AS "Avg_Price"
  FROM scored GROUP BY 1
),
raw AS (SELECT *, {safety} AS s FROM demand),
raw2 AS (SELECT *, d + s AS restock_raw FROM raw),
numbers AS (
  SELECT "StockCode", round_even(d, 0) AS predicted_weekly_demand, round_even(s, 0) AS safety_stock,
         round_even(restock_raw, 0) AS recommended_restock, "Avg_Price" AS avg_price,
         {cost} AS estimated_cost
  FROM raw2
),
vals AS (
  SELECT list_sort(list(recommended_restock)) AS xs, count(recommended_restock) AS n
  FROM numbers WHERE recommended_restock IS NOT NULL
),
pos AS (
  SELECT xs, n, CAST(n - 1 AS DOUBLE) * CAST({q1!r} AS DOUBLE) AS p1,
         CAST(n - 1 AS DOUBLE) * CAST({q2!r} AS DOUBLE) AS p2 FROM vals
),
parts AS (
  SELECT n, p1 - floor(p1) AS g1, xs[CAST(floor(p1) AS BIGINT) + 1] AS lo1,
         xs[least(CAST(floor(p1) AS BIGINT) + 2, n)] AS hi1,
         p2 - floor(p2) AS g2, xs[CAST(floor(p2) AS BIGINT) + 1] AS lo2,
         xs[least(CAST(floor(p2) AS BIGINT) + 2, n)] AS hi2
  FROM pos
),
edges AS (
  SELECT n,
         CASE WHEN g1 >= 0.5 THEN hi1 - (hi1 - lo1) * (1 - g1) ELSE lo1 + (hi1 - lo1) * g1 END AS e1,
         CASE WHEN g2 >= 0.5 THEN hi2 - (hi2 - lo2) * (1 - g2) ELSE lo2 + (hi2 - lo2) * g2 END AS e2
  FROM parts
)""".strip("\n"),
        first,
        f"""
restock AS (
  SELECT nb."StockCode", nb.predicted_weekly_demand, nb.safety_stock, nb.recommended_restock,
         nb.avg_price, nb.estimated_cost, {desc} AS "Description",
         CASE WHEN nb.recommended_restock IS NULL THEN NULL
              WHEN nb.recommended_restock <= e.e1 THEN 'Low'
              WHEN nb.recommended_restock <= e.e2 THEN 'Medium' ELSE 'High' END AS priority
  FROM numbers nb LEFT JOIN first_desc fd ON nb."StockCode" = fd."StockCode"
  CROSS JOIN edges e
)""",
    ]


def restock_with(cfg: RestockConfig = PREDICT) -> str:
    """WITH ... up to the `restock` CTE of the variant."""
    return with_(*base(cfg.variant == "training"), *restock_pieces(cfg))


RESTOCK_PREDICT = restock_with(PREDICT)
RESTOCK_TRAINING = restock_with(TRAINING)


LINEAR_FEATURES = ("Lag1_Quantity", "Rolling7_Quantity", "Month", "Day", "DayOfWeek")


def linear_sql(train: str) -> str:
    """CTEs up to ``w`` (w0 intercept, w1..w5): least squares of Quantity on the five features over ``train``.

    Normal equations on centred columns, solved by elimination written out step by step.
    """
    n = len(LINEAR_FEATURES)
    rng = range(1, n + 1)
    x = {i: f'"{c}"' for i, c in enumerate(LINEAR_FEATURES, 1)}
    mean = ", ".join([f"avg({x[i]}) AS m{i}" for i in rng] + ['avg("Quantity") AS m0'])
    sums = [f"sum(({x[i]} - m{i}) * ({x[j]} - m{j})) AS a{i}{j}" for i in rng for j in rng if i <= j]
    sums += [f'sum(({x[i]} - m{i}) * ("Quantity" - m0)) AS b{i}' for i in rng]
    out = [f"mean AS (SELECT {mean} FROM {train})", f"e0 AS (SELECT {', '.join(sums)} FROM {train}, mean)"]
    for k in rng:
        new = [f"a{i}{j} - a{k}{i} * a{k}{j} / a{k}{k} AS a{i}{j}" for i in rng for j in rng if k < i <= j]
        new += [f"b{i} - a{k}{i} * b{k} / a{k}{k} AS b{i}" for i in rng if i > k]
        old = [f"a{i}{j}" for i in rng for j in rng if i <= j and i <= k] + [f"b{i}" for i in rng if i <= k]
        out.append(f"e{k} AS (SELECT {', '.join(old + new)} FROM e{k - 1})")
    last = f"e{n}"
    for k in reversed(rng):
        rest = "".join(f" - a{k}{j} * w{j}" for j in rng if j > k)
        out.append(f"s{k} AS (SELECT *, (b{k}{rest}) / a{k}{k} AS w{k} FROM {last})")
        last = f"s{k}"
    weights = ", ".join(f"w{i}" for i in rng)
    out.append(f"w AS (SELECT {weights}, m0 - {' - '.join(f'w{i} * m{i}' for i in rng)} AS w0 FROM {last}, mean)")
    return ",\n".join(out)


def linear_value() -> str:
    return "w0 + " + " + ".join(f'w{i} * "{c}"' for i, c in enumerate(LINEAR_FEATURES, 1))
