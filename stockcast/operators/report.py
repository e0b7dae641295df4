"""Report tables over the restock result.

All tables are derived with aggregations, windows and semi joins. The mean
restock is a scalar subquery; stratified picks use ``row_number() <= k`` per
priority, which Spark plans with a partial per-partition limit before the
exchange (so a priority holding a third of all products never reaches one
task whole); tiny fixed-shape outputs (3 priorities, 4 ranges, 7 bins) come
from one conditional aggregation unfolded with ``explode``, not from joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockcast.config import (
    DEMAND_COLUMN, DEMAND_COLUMN_ALT, HISTOGRAM_EDGES, HISTOGRAM_LABELS, LABEL_WIDTH_CHART,
    LABEL_WIDTH_CONSOLE, LABEL_WIDTH_DASHBOARD, LAST_ROWS_TREND, PICKS_CHART, PICKS_TREND,
    PRIORITY_LABELS, REASONING_TEXT, RESTOCK_RANGES, SUMMARY_TEXT, TOP_CHART, TOP_DASHBOARD,
    TOP_SUMMARY, TREND_TEXT,
)
from stockcast.functions.columns import display_name, half_even, truncate_label
from stockcast.operators.features import by_product

X = "recommended_restock"


def restock_rank_order() -> list[Column]:
    return [F.col(X).desc_nulls_last(), F.col("StockCode")]


def demand_column(df: DataFrame) -> Column:
    """The demand under either name."""
    return F.col(DEMAND_COLUMN if DEMAND_COLUMN in df.columns else DEMAND_COLUMN_ALT)


def cost_column(df: DataFrame) -> Column:
    """Estimated cost, or price x restock when the column is absent."""
    if "estimated_cost" in df.columns:
        return F.col("estimated_cost")
    return F.col("avg_price") * F.col(X) if "avg_price" in df.columns else F.lit(0.0) * F.col(X)


def mean_restock(res: DataFrame) -> Column:
    return res.agg(F.avg(X)).scalar()


def _unfold(agg: DataFrame, rows: list[list[Column]], names: list[str]) -> DataFrame:
    """One aggregated row -> a fixed list of rows (explode of an array of structs)."""
    structs = [F.struct(*[c.alias(n) for c, n in zip(r, names)]) for r in rows]
    return agg.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


# --- A11-A15 ---------------------------------------------------------------

def priority_summary(res: DataFrame, style: str = "file") -> DataFrame:
    """Items, units and cost per priority.

    file:    Low, Medium, High, empty groups as 0; units of the integer output.
    console: High, Medium, Low, empty groups left out; cost = restock x price.
    """
    cost = cost_column(res) if style == "file" else F.col(X) * F.col("avg_price")
    units = F.col(X).cast("long") if style == "file" else F.col(X)
    aggs = []
    for p in PRIORITY_LABELS:
        hit = F.col("priority") == p
        aggs += [F.count(F.when(hit, F.col(X))).alias(f"n_{p}"),
                 F.coalesce(F.sum(F.when(hit, units)), F.lit(0)).alias(f"u_{p}"),
                 F.coalesce(F.sum(F.when(hit, cost)), F.lit(0.0)).alias(f"c_{p}")]
    agg = res.agg(*aggs)
    order = PRIORITY_LABELS if style == "file" else tuple(reversed(PRIORITY_LABELS))
    out = _unfold(agg, [[F.lit(p), F.lit(i), F.col(f"n_{p}"), F.col(f"u_{p}"), F.col(f"c_{p}")]
                        for i, p in enumerate(order)],
                  ["priority", "position", "item_count", "total_units", "total_cost"])
    if style != "file":
        out = out.where(F.col("item_count") > 0)
    return out


def restock_kpis(res: DataFrame) -> DataFrame:
    """Products, urgent (above the mean), total units, mean restock (truncated)."""
    mean = mean_restock(res)
    return res.agg(
        F.count(F.lit(1)).alias("total_items"),
        F.count(F.when(F.col(X) > mean, F.lit(1))).alias("urgent_items"),
        F.sum(X).cast("long").alias("total_units"),
        F.avg(X).cast("long").alias("mean_restock"),
    )


def restock_ranges(res: DataFrame) -> DataFrame:
    """Products per closed range and their share of all products, in %."""
    aggs = [F.count(F.lit(1)).alias("total")]
    for i, (lo, hi, _) in enumerate(RESTOCK_RANGES):
        cond = F.col(X) >= lo if hi == float("inf") else F.col(X).between(lo, hi)
        aggs.append(F.count(F.when(cond, F.lit(1))).alias(f"n{i}"))
    agg = res.agg(*aggs)
    rows = []
    for i, (lo, hi, label) in enumerate(RESTOCK_RANGES):
        share = F.when(F.col("total") > 0, F.col(f"n{i}") / F.col("total") * 100.0).otherwise(F.lit(0.0))
        rows.append([F.lit(label), F.lit(i), F.col(f"n{i}"), share])
    return _unfold(agg, rows, ["range_label", "position", "product_count", "share_pct"])


def restock_histogram(res: DataFrame) -> DataFrame:
    """Bins 0,10,50,100,200,500,1000,max+1; left-closed, the last one closed."""
    x = F.col(X)
    top = res.agg(F.max(X)).scalar() + F.lit(1)
    edges = list(HISTOGRAM_EDGES)
    aggs = []
    for i in range(len(edges)):
        lo = F.lit(float(edges[i]))
        cond = (x >= lo) & (x < F.lit(float(edges[i + 1]))) if i + 1 < len(edges) else (x >= lo) & (x <= top)
        aggs.append(F.count(F.when(cond, F.lit(1))).alias(f"b{i}"))
    agg = res.agg(*aggs)
    return _unfold(agg, [[F.lit(lab), F.lit(i), F.col(f"b{i}")] for i, lab in enumerate(HISTOGRAM_LABELS)],
                   ["bin_label", "position", "product_count"])


def priority_counts(res: DataFrame) -> DataFrame:
    """Items per priority, High, Medium, Low."""
    agg = res.agg(*[F.count(F.when(F.col("priority") == p, F.lit(1))).alias(p) for p in PRIORITY_LABELS])
    return _unfold(agg, [[F.lit(p), F.lit(i), F.col(p)] for i, p in enumerate(reversed(PRIORITY_LABELS))],
                   ["priority", "position", "item_count"])


# --- T3-T5, P19-P21 ----------------------------------------------------------

def top_restock(res: DataFrame, k: int = 10) -> DataFrame:
    """The first k rows of the result with their 1-based position."""
    top = res.orderBy(*restock_rank_order()).limit(k)
    # at most k rows: a single-partition window is bounded here
    return top.withColumn("position", F.row_number().over(Window.orderBy(*restock_rank_order())))


def by_priority(res: DataFrame, p: str) -> DataFrame:
    """P19."""
    return res.where(F.col("priority") == p)


def restock_by_priority(res: DataFrame, ks: Sequence[int] = (5, 5, 5), fallback: int | None = TOP_CHART) -> DataFrame:
    """T4 + W4 + X2: first k_high / k_medium / k_low by restock in each priority,
    High first. With ``fallback`` and no priority at all: the plain top rows."""
    kmap = dict(zip(reversed(PRIORITY_LABELS), ks))
    w = Window.partitionBy("priority").orderBy(*restock_rank_order())
    k = F.when(F.col("priority") == "High", kmap["High"]).when(F.col("priority") == "Medium", kmap["Medium"]) \
         .when(F.col("priority") == "Low", kmap["Low"]).otherwise(0)
    ranked = res.where(F.col("priority").isNotNull()).withColumn("rank", F.row_number().over(w))
    picks = ranked.where(F.col("rank") <= max(ks)).where(F.col("rank") <= k)
    group = F.when(F.col("priority") == "High", 0).when(F.col("priority") == "Medium", 1).otherwise(2)
    picks = picks.withColumn("group_order", group)
    if fallback is None:
        return picks
    has_priority = res.where(F.col("priority").isNotNull()).exists()
    plain = top_restock(res, fallback).where(~has_priority).select(
        *res.columns, F.col("position").alias("rank"), F.lit(0).alias("group_order"))
    return picks.unionByName(plain)


def urgent_flag(res: DataFrame) -> DataFrame:
    """P20: products whose restock is strictly above the mean."""
    return res.where(F.col(X) > mean_restock(res))


def dashboard_table(res: DataFrame, k: int = TOP_DASHBOARD) -> DataFrame:
    return top_restock(res, k)


def search_restock(res: DataFrame, term: str, k: int = TOP_DASHBOARD) -> DataFrame:
    """In the dashboard rows, description (in lower case) or code (as it is) contains the lower-cased term.

    As in the original, a code with capital letters is found only by its digits.
    """
    t = F.lit(term.lower())
    hit = F.contains(F.lower(F.col("Description")), t) | F.contains(F.col("StockCode").cast("string"), t)
    return dashboard_table(res, k).where(F.coalesce(hit, F.lit(False)))


SORTABLE = ("StockCode", "Description", DEMAND_COLUMN, "safety_stock", X)


def sort_restock(res: DataFrame, column: str, ascending: bool = True, k: int = TOP_DASHBOARD) -> DataFrame:
    """T5: the dashboard rows sorted on one column, missing values as 0."""
    if column not in SORTABLE:
        raise ValueError(f"not sortable: {column}")
    c = F.col(column)
    key = F.coalesce(c.cast("string"), F.lit("0")) if column in ("StockCode", "Description") else F.coalesce(c, F.lit(0.0))
    order = [key.asc() if ascending else key.desc(), F.col("StockCode")]
    top = dashboard_table(res, k).drop("position")
    return top.withColumn("position", F.row_number().over(Window.orderBy(*order)))


def dashboard_records(res: DataFrame, k: int = TOP_DASHBOARD) -> DataFrame:
    """The first k rows as JSON records (the code kept in the record)."""
    top = dashboard_table(res, k)
    record = F.to_json(F.struct(*res.columns), {"ignoreNullFields": "false"})
    return top.select("position", record.alias("record"))


# --- P15, P16 --------------------------------------------------------------

def with_display_name(res: DataFrame, unknown_too: bool = True) -> DataFrame:
    return res.withColumn("display_name", display_name("Description", "StockCode", unknown_too))


def with_labels(res: DataFrame) -> DataFrame:
    """The three label widths of the console, dashboard and chart."""
    name = display_name("Description", "StockCode", unknown_too=False)
    d = F.coalesce(F.col("Description"), F.lit("nan"))
    return res.select(
        "StockCode",
        truncate_label(name, LABEL_WIDTH_CONSOLE, pad=True).alias("console_label"),
        truncate_label(d, LABEL_WIDTH_DASHBOARD).alias("dashboard_label"),
        truncate_label(d, LABEL_WIDTH_CHART).alias("chart_label"),
    )


# --- A16, A17, J6, N1-N3 -----------------------------------------------------

def product_trend(features: DataFrame) -> DataFrame:
    """A16 + W3: mean, max daily quantity, mean of the last 5 rows, trend word."""
    rn = F.row_number().over(by_product().orderBy(F.col("Date").desc()))
    ranked = features.select("StockCode", "Quantity", rn.alias("_rn"))
    agg = ranked.groupBy("StockCode").agg(
        F.avg("Quantity").alias("avg_quantity"), F.max("Quantity").alias("max_quantity"),
        F.avg(F.when(F.col("_rn") <= LAST_ROWS_TREND, F.col("Quantity"))).alias("recent_quantity"),
    )
    return agg.withColumn("trend", F.when(F.col("recent_quantity") > F.col("avg_quantity"), "increasing")
                          .otherwise("decreasing"))


def trend_extremes(features: DataFrame) -> DataFrame:
    """First (earliest) maximum and minimum day; the minimum only when it is
    another row than the maximum."""
    agg = features.groupBy("StockCode").agg(
        F.min_by(F.struct("Date", "Quantity"), F.struct(-F.col("Quantity"), F.col("Date"))).alias("mx"),
        F.min_by(F.struct("Date", "Quantity"), F.struct(F.col("Quantity"), F.col("Date"))).alias("mn"),
    )
    same = F.col("mx.Date") == F.col("mn.Date")
    return agg.select(
        "StockCode", F.col("mx.Date").alias("max_date"), F.col("mx.Quantity").alias("max_quantity"),
        F.when(same, F.lit(None)).otherwise(F.col("mn.Date")).alias("min_date"),
        F.when(same, F.lit(None)).otherwise(F.col("mn.Quantity")).alias("min_quantity"),
    )


def trend_picks(res: DataFrame, ks: Sequence[int] = PICKS_TREND) -> DataFrame:
    """The products the trend section looks at (High 2, Medium 2, Low 1)."""
    return restock_by_priority(res, ks, fallback=None)


def product_history(features: DataFrame, picks: DataFrame) -> DataFrame:
    """All feature rows of the picked products (left semi join)."""
    return features.join(picks.select("StockCode"), "StockCode", "left_semi")


def chart_product_series(features: DataFrame, picks: DataFrame) -> DataFrame:
    """(StockCode, Date, Quantity) of the picked products, by date."""
    return product_history(features, picks).select("StockCode", "Date", "Quantity") \
        .orderBy("StockCode", "Date")


def report_picks(res: DataFrame, features: DataFrame, ks: Sequence[int] = PICKS_TREND) -> DataFrame:
    """Picks with display name, trend figures and restock fields."""
    picks = trend_picks(res, ks)
    trend = product_trend(product_history(features, picks))
    return with_display_name(picks).join(trend, "StockCode", "left").select(
        "StockCode", "display_name", "priority", "rank", "group_order", X, demand_column(picks).alias(DEMAND_COLUMN),
        "safety_stock", "avg_quantity", "max_quantity", "recent_quantity", "trend")


def chart_top_restock(res: DataFrame, ks: Sequence[int] = PICKS_CHART) -> DataFrame:
    """Label (25 chars) and value of the chart rows; fill = value / largest value."""
    picks = restock_by_priority(res, ks, fallback=TOP_CHART)
    # at most sum(ks) rows (or the fallback): a global window is bounded here
    top = F.max(X).over(Window.partitionBy())
    return picks.select(
        "StockCode", "priority", "rank", "group_order",
        truncate_label(F.coalesce(F.col("Description"), F.lit("nan")), LABEL_WIDTH_CHART).alias("label"),
        F.col(X).alias("value"), (F.col(X) / top).alias("fill"))


# --- N4-N6 ---------------------------------------------------------------------

def two_places(c: Column) -> Column:
    """Python's '{:.2f}' on a double: its exact binary value rounded to 2 places, ties to even.

    The fraction is cut into its upper 26 bits and the rest; both times 100 are
    exact in a double, so the comparison with one half is exact too.
    """
    x = F.abs(c)
    whole = F.floor(x)
    frac = x - whole
    upper = F.floor(frac * 67108864.0) / 67108864.0  # 2^26
    hundred, rest = upper * 100.0, (frac - upper) * 100.0
    cents = F.floor(hundred)
    over = (hundred - cents - 0.5) + rest
    up = (over > 0) | ((over == 0) & (cents % 2 == 1))
    cents = cents + F.when(up, 1).otherwise(0)
    sign = F.when((c < 0) | F.startswith(c.cast("string"), F.lit("-")), F.lit("-")).otherwise(F.lit(""))
    return F.when(c.isNotNull(), F.concat(
        sign, (whole + F.when(cents == 100, 1).otherwise(0)).cast("string"), F.lit("."),
        F.lpad((cents % 100).cast("string"), 2, "0")))


def summary_text(res: DataFrame, k: int = TOP_SUMMARY) -> DataFrame:
    """One row: counts, the summary sentence, the first k descriptions joined."""
    kpis = restock_kpis(res)
    top = top_restock(res, k).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("position", "Description"))),
        lambda s: s.getField("Description")), ", ")).scalar()
    return kpis.select(
        "total_items", "urgent_items",
        F.format_string(SUMMARY_TEXT, F.col("total_items"), F.col("urgent_items")).alias("summary"),
        top.alias("top_items"))


def product_text(res: DataFrame, features: DataFrame) -> DataFrame:
    """Per product, the trend sentence (mean to 2 places, trend word) and the
    fixed reasoning sentence."""
    trend = product_trend(features)
    named = with_display_name(res).join(trend, "StockCode", "inner")
    return named.select(
        "StockCode",
        F.format_string(TREND_TEXT, F.col("display_name"), two_places(F.col("avg_quantity")),
                        F.col("trend")).alias("trend_text"),
        F.lit(REASONING_TEXT).alias("reasoning_text"))


def _json_text(c: Column) -> Column:
    """A JSON string literal of c, or null. Control characters, quotes and backslashes are escaped;
    other characters stay as they are (the original writes non-ASCII as \\u escapes)."""
    # an array of one is valid JSON around any text; its brackets are cut off again
    one = F.to_json(F.array(c.cast("string")))
    return F.when(c.isNull(), F.lit("null")).otherwise(F.regexp_replace(one, r"(?s)^\[(.*)\]$", "$1"))


def prompt_table(res: DataFrame, features: DataFrame, horizon: int = 7, k: int = 5) -> DataFrame:
    """(kind, StockCode, prompt): one overall prompt, and per product a trend,
    a reasoning and a forecast prompt. Numbers print like Python's str()."""
    from stockcast.config import PROMPT_FORECAST, PROMPT_OVERALL, PROMPT_REASONING, PROMPT_TREND

    kpis = restock_kpis(res)
    item = F.format_string('  {\n    "Description": %s,\n    "recommended_restock": %s\n  }',
                           _json_text(F.col("Description")), F.col(X).cast("string"))
    top = top_restock(res, k).agg(F.sort_array(F.collect_list(F.struct("position", item.alias("j")))).alias("t"))
    items = top.select(F.concat(F.lit("[\n"), F.array_join(F.transform("t", lambda s: s.getField("j")), ",\n"),
                                F.lit("\n]")).alias("x")).scalar()
    overall = kpis.select(F.lit("overall_summary").alias("kind"), F.lit(None).cast("string").alias("StockCode"),
                          F.format_string(PROMPT_OVERALL, F.col("total_items").cast("string"),
                                          F.col("urgent_items").cast("string"), items).alias("prompt"))
    trend = product_trend(features)
    named = with_display_name(res).join(trend, "StockCode", "inner")
    per = named.select(
        "StockCode",
        F.format_string(PROMPT_TREND, F.col("display_name"), two_places(F.col("avg_quantity")),
                        F.col("max_quantity").cast("string"), F.col("trend")).alias("p_trend"),
        F.format_string(PROMPT_REASONING, F.coalesce(F.col("Description"), F.lit("nan")),
                        demand_column(named).cast("string"), F.col("safety_stock").cast("string"),
                        F.col(X).cast("string")).alias("p_reason"),
        F.format_string(PROMPT_FORECAST, F.coalesce(F.col("Description"), F.lit("nan")),
                        two_places(F.col("avg_quantity")), F.col(X).cast("string"),
                        F.lit(str(horizon))).alias("p_forecast"),
    )
    long = per.select("StockCode", F.explode(F.array(
        F.struct(F.lit("product_trend").alias("kind"), F.col("p_trend").alias("prompt")),
        F.struct(F.lit("restock_reasoning").alias("kind"), F.col("p_reason").alias("prompt")),
        F.struct(F.lit("product_forecast").alias("kind"), F.col("p_forecast").alias("prompt")),
    )).alias("r")).select("r.kind", "StockCode", "r.prompt")
    return overall.unionByName(long)
