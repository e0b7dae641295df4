"""Checked queries: one callable (spark, sf_dir) -> DataFrame per operator.

Every query reads the star tables of ``sf_dir`` through the sales mapping and
runs over whole tables. Doubles that come from sums or means are passed
through ``r6`` here and in the SQL text (see ``oracle``); rounding is part of
the comparison, not of the operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockcast.config import PREDICT, TRAINING, RestockConfig
from stockcast.operators.clean import clean_sales
from stockcast.operators.features import engineer_features
from stockcast.functions.materialize import materialize
from stockcast.operators.restock import RESTOCK_COLUMNS, baseline_scorer, restock_recommendations
from stockcast.sources.star import StarSales

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SALES_COLS_RESTOCK = ["Invoice", "StockCode", "Quantity", "InvoiceDate", "Price"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__.removeprefix("q_")] = fn
    return fn


def r6(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.floor(col * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)


def r4(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.floor(col * F.lit(1e4) + F.lit(0.5)) / F.lit(1e4)


def r3(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.floor(col * F.lit(1e3) + F.lit(0.5)) / F.lit(1e3)


def rounded(df: DataFrame, cols: list[str], f=r6) -> DataFrame:
    return df.withColumns({c: f(c) for c in cols})


# --- shared inputs ---------------------------------------------------------

def source(spark: SparkSession, sf: str) -> StarSales:
    return StarSales(spark, sf)


def clean(spark: SparkSession, sf: str, cfg: RestockConfig = PREDICT, cols=None) -> DataFrame:
    return clean_sales(source(spark, sf).sales(cols), cfg)


def features(spark: SparkSession, sf: str, cfg: RestockConfig = PREDICT) -> DataFrame:
    src = source(spark, sf)
    # the star source answers description questions from `part`, so the
    # line scan needs no Description column (no join before the reduction)
    c = clean_sales(src.sales(SALES_COLS_RESTOCK), cfg)
    pairs = src.description_pairs() if cfg.descriptions == "fanout" else None
    return engineer_features(c, cfg, description_pairs=pairs)


def ready_features(spark: SparkSession, sf: str, cfg: RestockConfig = PREDICT, columns=None) -> DataFrame:
    """The feature table written once, so that every step of a query reads it and the lines are scanned once."""
    f = features(spark, sf, cfg)
    return materialize(f.select(*columns) if columns else f)


def restock(spark: SparkSession, sf: str, cfg: RestockConfig = PREDICT, feats: DataFrame | None = None, **kw) -> DataFrame:
    """R5 with the fixed-weight scorer, which SQL can check; ``feats``: materialized features."""
    kw.setdefault("scorer", baseline_scorer)
    if feats is not None:
        kw["materialize_as"] = "ready"
    return restock_recommendations(features(spark, sf, cfg) if feats is None else feats, cfg,
                                   descriptions=source(spark, sf).first_descriptions(), **kw)


# --- restock ---------------------------------------------------------------

@query
def q_restock_recommendations(spark, sf):
    return rounded(restock(spark, sf, PREDICT), ["avg_price"])


@query
def q_restock_training(spark, sf):
    return rounded(restock(spark, sf, TRAINING), ["avg_price", "estimated_cost"])


# --- sources and data checks ----------------------------------------------

from stockcast.operators import clean as C  # noqa: E402
from stockcast.operators import explore as EX  # noqa: E402
from stockcast.operators import features as FE  # noqa: E402
from stockcast.operators import report as RP  # noqa: E402
from stockcast.operators import restock as RS  # noqa: E402
from stockcast.operators import sample as SM  # noqa: E402
from stockcast.functions.columns import format_invoice_date, parse_invoice_date  # noqa: E402
from stockcast.functions.quantiles import tertile_edges  # noqa: E402
from stockcast.sources import quality as QU  # noqa: E402


@query
def q_malformed_invoices(spark, sf):
    return QU.malformed_invoices(source(spark, sf).sales())


@query
def q_dataset_shape(spark, sf):
    # the row count needs one column of the lines; the column count is the schema's
    sales = source(spark, sf).sales()
    return QU.dataset_shape(source(spark, sf).sales(["Quantity"]), len(sales.columns)).select(
        F.col("rows").alias("n_rows"), F.col("columns").alias("n_columns"))


# --- P1-P6 -----------------------------------------------------------------

@query
def q_parse_invoice_date(spark, sf):
    s = source(spark, sf).sales(["Invoice", "StockCode", "InvoiceDate"])
    t = s.select("Invoice", "StockCode", format_invoice_date("InvoiceDate").alias("InvoiceText"))
    return t.withColumn("Parsed", parse_invoice_date("InvoiceText"))


@query
def q_date_parts(spark, sf):
    s = source(spark, sf).sales(["Invoice", "StockCode", "InvoiceDate"])
    return C.with_date_parts(s)


@query
def q_total_price(spark, sf):
    s = source(spark, sf).sales(["Invoice", "StockCode", "Quantity", "Price"])
    return C.with_total_price(s)


@query
def q_drop_returns(spark, sf):
    return C.drop_returns(source(spark, sf).sales(["Invoice", "StockCode", "Quantity"]))


@query
def q_drop_cancelled(spark, sf):
    return C.drop_cancelled(source(spark, sf).sales(["Invoice", "StockCode", "Quantity"]))


@query
def q_numeric_customer(spark, sf):
    return C.numeric_customer(source(spark, sf).sales(["Invoice", "StockCode", "Customer ID"]))


@query
def q_clean_sales(spark, sf):
    return clean(spark, sf, TRAINING)


# --- A3-A7 -----------------------------------------------------------------

@query
def q_describe_sales(spark, sf):
    d = EX.describe_sales(clean(spark, sf, PREDICT, SALES_COLS_RESTOCK))
    return rounded(d, ["mean", "std", "min", "p25", "p50", "p75", "max"])


@query
def q_top_products(spark, sf):
    return EX.top_products(clean(spark, sf, PREDICT, SALES_COLS_RESTOCK))


@query
def q_sales_by_country(spark, sf):
    cols = ["Invoice", "Quantity", "InvoiceDate", "Price", "Country"]
    return rounded(EX.sales_by_country(clean(spark, sf, PREDICT, cols)), ["TotalPrice"], r4)


@query
def q_monthly_sales(spark, sf):
    return rounded(EX.monthly_sales(clean(spark, sf, PREDICT, SALES_COLS_RESTOCK)), ["TotalPrice"], r4)


@query
def q_weekday_sales(spark, sf):
    return rounded(EX.weekday_sales(clean(spark, sf, PREDICT, SALES_COLS_RESTOCK)), ["TotalPrice"], r4)


# --- features ----------------------------------------------------------------

def _daily(spark, sf):
    return FE.product_daily(clean(spark, sf, PREDICT, SALES_COLS_RESTOCK))


@query
def q_product_daily(spark, sf):
    return rounded(rounded(_daily(spark, sf), ["Price"]), ["TotalPrice"], r4)


@query
def q_lag1(spark, sf):
    return FE.with_lag_and_rolling(_daily(spark, sf)).select("StockCode", "Date", "Lag1_Quantity")


@query
def q_rolling7(spark, sf):
    return rounded(FE.with_lag_and_rolling(_daily(spark, sf)).select("StockCode", "Date", "Rolling7_Quantity"),
                   ["Rolling7_Quantity"])


def _feat_out(df):
    return rounded(rounded(df, ["Price", "Rolling7_Quantity"]), ["TotalPrice"], r4)


@query
def q_features_predict(spark, sf):
    return _feat_out(features(spark, sf, PREDICT))


@query
def q_features_training(spark, sf):
    return _feat_out(features(spark, sf, TRAINING))


@query
def q_attach_descriptions(spark, sf):
    daily = _daily(spark, sf).select("StockCode", "Date", "Quantity")
    return FE.attach_descriptions(daily, source(spark, sf).description_pairs())


@query
def q_distinct_descriptions(spark, sf):
    return FE.distinct_descriptions(clean(spark, sf, PREDICT, SALES_COLS_RESTOCK + ["Description"]))


@query
def q_first_description(spark, sf):
    return FE.first_description(source(spark, sf).sales(SALES_COLS_RESTOCK + ["Description"]))


# --- restock steps -------------------------------------------------------------

def _steps(spark, sf, cfg=PREDICT):
    return ready_features(spark, sf, cfg, RESTOCK_COLUMNS)


@query
def q_latest_date(spark, sf):
    f = _steps(spark, sf)
    return f.agg(F.max("Date").alias("latest"))


@query
def q_recent_window(spark, sf):
    return RS.recent_window(_steps(spark, sf)).select("StockCode", "Date", "Quantity")


@query
def q_product_stats(spark, sf):
    return rounded(RS.product_stats(_steps(spark, sf)),
                   ["Avg_Daily_Quantity", "Std_Daily_Quantity", "Avg_Price"])


def _profile(spark, sf, cfg=PREDICT):
    return RS.product_profile(_steps(spark, sf, cfg), cfg)


@query
def q_enough_history(spark, sf):
    return RS.enough_history(_profile(spark, sf), PREDICT.min_rows).select("StockCode", "n_rows")


@query
def q_latest_row(spark, sf):
    return _profile(spark, sf).select("StockCode", "Last_Date", "Last_Quantity")


@query
def q_active_products(spark, sf):
    return RS.active_products(_steps(spark, sf), PREDICT).select("StockCode", "n_rows", "n_recent")


def _grid(spark, sf):
    f = _steps(spark, sf)
    return RS.forecast_grid(RS.active_products(f, PREDICT), RS.latest_date(f), PREDICT.horizon)


@query
def q_forecast_grid(spark, sf):
    return _grid(spark, sf).select("StockCode", "ForecastDate")


@query
def q_forecast_inputs(spark, sf):
    g = RS.forecast_inputs(_grid(spark, sf))
    return rounded(g.select("StockCode", "ForecastDate", "Lag1_Quantity", "Rolling7_Quantity",
                            "Month", "Day", "DayOfWeek"), ["Rolling7_Quantity"])


def _demand(spark, sf):
    return RS.weekly_demand(RS.baseline_scorer(RS.forecast_inputs(_grid(spark, sf))))


@query
def q_weekly_demand(spark, sf):
    return rounded(_demand(spark, sf).select("StockCode", "predicted_weekly_demand"),
                   ["predicted_weekly_demand"])


@query
def q_safety_stock(spark, sf):
    d = _demand(spark, sf)
    return rounded(d.select("StockCode", RS.safety_stock(TRAINING).alias("safety_stock")), ["safety_stock"])


@query
def q_safety_fallback(spark, sf):
    d = _demand(spark, sf)
    return rounded(d.select("StockCode", RS.safety_stock(PREDICT).alias("safety_stock")), ["safety_stock"])


@query
def q_estimated_cost(spark, sf):
    """P13 both ways from one pass over the figures."""
    d = RS.restock_raw(_steps(spark, sf), PREDICT, baseline_scorer)
    return rounded(d.select("StockCode", RS.estimated_cost(PREDICT).alias("cost_predict"),
                            RS.estimated_cost(TRAINING).alias("cost_training")), ["cost_training"])


@query
def q_priority_tertiles(spark, sf):
    nums = RS.restock_numbers(_steps(spark, sf), PREDICT, baseline_scorer)
    return tertile_edges(nums, "recommended_restock").select("n", "e1", "e2")


# --- report tables -------------------------------------------------------------

def _res(spark, sf, feats=None):
    return rounded(restock(spark, sf, PREDICT, feats), ["avg_price"])


def _feat(spark, sf):
    return ready_features(spark, sf, PREDICT)


@query
def q_priority_summary(spark, sf):
    return rounded(RP.priority_summary(_res(spark, sf)), ["total_cost"], r4)


@query
def q_restock_kpis(spark, sf):
    return RP.restock_kpis(_res(spark, sf))


@query
def q_restock_ranges(spark, sf):
    return rounded(RP.restock_ranges(_res(spark, sf)), ["share_pct"])


@query
def q_restock_histogram(spark, sf):
    return RP.restock_histogram(_res(spark, sf))


@query
def q_priority_counts(spark, sf):
    return RP.priority_counts(_res(spark, sf))


@query
def q_top_restock(spark, sf):
    return RP.top_restock(_res(spark, sf), 10)


@query
def q_restock_by_priority(spark, sf):
    return RP.restock_by_priority(_res(spark, sf), (5, 5, 5))


@query
def q_urgent_flag(spark, sf):
    return RP.urgent_flag(_res(spark, sf))


SEARCH_TERM = "Gear"


@query
def q_search_restock(spark, sf):
    return RP.search_restock(_res(spark, sf), SEARCH_TERM)


@query
def q_sort_restock(spark, sf):
    return RP.sort_restock(_res(spark, sf), "safety_stock", ascending=True)


@query
def q_dashboard_records(spark, sf):
    return RP.dashboard_records(_res(spark, sf))


@query
def q_display_name(spark, sf):
    return RP.with_display_name(_res(spark, sf)).select("StockCode", "display_name")


@query
def q_truncate_label(spark, sf):
    return RP.with_labels(_res(spark, sf))


@query
def q_product_trend(spark, sf):
    return rounded(RP.product_trend(_feat(spark, sf)), ["avg_quantity", "recent_quantity"])


@query
def q_trend_extremes(spark, sf):
    return RP.trend_extremes(_feat(spark, sf))


@query
def q_product_history(spark, sf):
    f = _feat(spark, sf)
    return _feat_out(RP.product_history(f, RP.trend_picks(_res(spark, sf, f))))


@query
def q_chart_product_series(spark, sf):
    f = _feat(spark, sf)
    return RP.chart_product_series(f, RP.trend_picks(_res(spark, sf, f)))


@query
def q_report_picks(spark, sf):
    f = _feat(spark, sf)
    return rounded(RP.report_picks(_res(spark, sf, f), f), ["avg_quantity", "recent_quantity"])


@query
def q_chart_top_restock(spark, sf):
    return rounded(RP.chart_top_restock(_res(spark, sf)), ["fill"])


@query
def q_summary_text(spark, sf):
    return RP.summary_text(_res(spark, sf))


@query
def q_product_text(spark, sf):
    f = _feat(spark, sf)
    return RP.product_text(_res(spark, sf, f), f)


# --- sampling, split, metrics ------------------------------------------------------

@query
def q_sample_rows(spark, sf):
    return SM.sample_rows(source(spark, sf).sales())


@query
def q_train_test_split(spark, sf):
    return SM.train_test_split(features(spark, sf, TRAINING)).select("StockCode", "Date", "Quantity", "split")


@query
def q_train_test_split_exact(spark, sf):
    """M1 with the original's counts: the test part has a fifth of the rows, rounded up."""
    return SM.train_test_split_exact(features(spark, sf, TRAINING).select("StockCode", "Date", "Quantity"))


@query
def q_sort_restock_all(spark, sf):
    """T5 on every sortable column, both ways."""
    res = materialize(_res(spark, sf))
    out = None
    for column in RP.SORTABLE:
        for up in (True, False):
            one = RP.sort_restock(res, column, ascending=up).select(F.lit(column).alias("sorted_by"), F.lit(up).alias("ascending"), "position", "StockCode")
            out = one if out is None else out.unionByName(one)
    return out


@query
def q_demand_and_cost_columns(spark, sf):
    """The demand under its other name, the cost from price and amount where no cost is there, and without a price."""
    res = materialize(_res(spark, sf))
    other = res.withColumnRenamed("predicted_weekly_demand", "predicted_demand")
    bare, priceless = other.drop("estimated_cost"), other.drop("estimated_cost", "avg_price")
    parts = [df.select("StockCode", F.lit(name).alias("columns"), RP.demand_column(df).alias("demand"), RP.cost_column(df).alias("cost"))
             for name, df in (("all", res), ("price", bare), ("none", priceless))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def q_summary_round_trip(spark, sf):
    """The summary file read back."""
    from stockcast.sources.sinks import write_summary
    path = write_summary(_res(spark, sf), _shared_path(spark, "summary"))
    back = spark.read.option("header", True).schema("priority string, item_count long, total_units long, total_cost double").csv(path)
    return rounded(back, ["total_cost"], r4)


@query
def q_sample_round_trip(spark, sf):
    """The sample file in the input's layout, read back."""
    from stockcast.sources.csv_sales import CsvSales
    from stockcast.sources.sinks import write_sample
    path = write_sample(source(spark, sf).sales(), _shared_path(spark, "sample"))
    return C.with_invoice_timestamp(CsvSales(spark, path, mode="strict").sales())


@query
def q_schema_faults(spark, sf):
    """Unexpected and missing columns of a file with a renamed and a dropped one, and how many lines fill them."""
    from stockcast.sources.csv_sales import CsvSales
    from stockcast.sources.sinks import write_sales_csv
    lines = _awkward_lines(spark, sf).withColumnRenamed("Description", "Item name").drop("Quantity")
    sales = CsvSales(spark, write_sales_csv(lines, _shared_path(spark, "schema"))).sales()
    counts = QU.column_report(sales).select("column", "non_null_rows")
    return QU.schema_report(spark, sales).join(counts, "column")


@query
def q_regression_metrics(spark, sf):
    from stockcast.operators.model import regression_metrics
    s = SM.train_test_split(features(spark, sf, TRAINING))
    test = s.where(F.col("split") == "test").select("Quantity", F.col("Lag1_Quantity").alias("prediction"))
    return rounded(regression_metrics(test), ["mse", "mae", "r2"])


# --- sinks -----------------------------------------------------------------------

@query
def q_csv_round_trip(spark, sf):
    """S7/S10 + S1: sales lines to CSV in the input layout, read back and parsed."""
    import uuid

    from stockcast.session import ensure_checkpoint_dir
    from stockcast.sources.csv_sales import read_sales
    from stockcast.sources.sinks import write_sales_csv

    path = f"{ensure_checkpoint_dir(spark)}/csv_round_trip/{uuid.uuid4().hex}"
    write_sales_csv(source(spark, sf).sales(), path)
    back = C.with_invoice_timestamp(read_sales(spark, path, mode="strict"))
    return back


def _shared_path(spark, name):
    import uuid

    from stockcast.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark)}/{name}/{uuid.uuid4().hex}"


def _awkward_lines(spark, sf):
    """Lines with quotes, commas, backslashes, outer blanks, non-ASCII text, missing and lettered invoices."""
    src = source(spark, sf)
    li = src.table("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
    part = src.table("part").select("p_partkey", "p_name")
    line, name = F.col("l_linenumber"), F.col("p_name")
    text = (F.when(line == 1, F.concat(F.lit('12" '), name, F.lit(", RED")))
            .when(line == 2, F.concat(F.lit("back\\"), name, F.lit(' "q", z')))
            .when(line == 3, F.concat(F.lit("  "), name, F.lit("  ")))
            .when(line == 4, F.concat(F.lit("CAFÉ "), name)).when(line == 5, F.lit('SAY "HI"'))
            .when(line == 6, F.lit(None)).otherwise(name))
    mark = F.when(line == 3, F.lit(None)).when(line == 4, F.lit("A")).otherwise(F.lit(""))
    return li.join(part, li.l_partkey == part.p_partkey, "left").select(
        F.concat(mark, F.col("l_orderkey").cast("string")).alias("Invoice"),
        F.col("l_partkey").cast("string").alias("StockCode"), text.alias("Description"),
        F.col("l_quantity").cast("double").alias("Quantity"), F.col("l_shipdate").alias("InvoiceDate"))


@query
def q_malformed_lines(spark, sf):
    """S5 on lines with missing and lettered invoices."""
    return QU.malformed_invoices(_awkward_lines(spark, sf))


@query
def q_awkward_round_trip(spark, sf):
    """S10 + S1-S3: awkward texts to CSV and back, strict."""
    from stockcast.sources.csv_sales import CsvSales
    from stockcast.sources.sinks import write_sales_csv
    path = write_sales_csv(_awkward_lines(spark, sf), _shared_path(spark, "awkward"))
    return C.with_invoice_timestamp(CsvSales(spark, path, mode="strict").sales())


@query
def q_csv_first_description(spark, sf):
    """The first description by date of lines read from CSV, codes with several names."""
    from stockcast.sources.csv_sales import CsvSales
    from stockcast.sources.sinks import write_sales_csv
    path = write_sales_csv(_awkward_lines(spark, sf), _shared_path(spark, "first"))
    return CsvSales(spark, path).first_descriptions(order="date")


def _in_given_order(spark, sf):
    """Awkward lines in the order of a hash, which neither dates nor invoices follow."""
    key = F.md5(F.concat_ws("-", F.coalesce("Invoice", F.lit("")), "StockCode", F.coalesce("Description", F.lit("")),
                            F.col("Quantity").cast("int").cast("string"), F.date_format("InvoiceDate", "yyyy-MM-dd")))
    return _awkward_lines(spark, sf).withColumn("key", key).orderBy("key").drop("key")


@query
def q_csv_first_in_file(spark, sf):
    """The first description in the order of the files, which is not that of the dates."""
    from stockcast.sources.csv_sales import CsvSales
    from stockcast.sources.sinks import write_sales_csv
    path = write_sales_csv(_in_given_order(spark, sf), _shared_path(spark, "in_file"))
    return CsvSales(spark, path).first_descriptions()


@query
def q_csv_line_breaks(spark, sf):
    """S1 on descriptions with line breaks, quotes and delimiters inside quotes: written, and read by many tasks."""
    from stockcast.sources.csv_sales import CsvSales
    from stockcast.sources.sinks import write_sales_csv
    broken = F.when(F.length("Description") % 2 == 0, F.concat("Description", F.lit('\n"x", y\n'))).otherwise(F.col("Description"))
    path = write_sales_csv(_awkward_lines(spark, sf).withColumn("Description", broken), _shared_path(spark, "breaks"))
    return C.with_invoice_timestamp(CsvSales(spark, path, mode="strict", multiline=True).sales())


@query
def q_csv_faults(spark, sf):
    """Lines with too many fields and unreadable numbers as rows beside the kept ones, all lines together."""
    from stockcast.sources.csv_sales import read_with_faults
    li = source(spark, sf).table("lineitem")
    quantity = F.when(F.col("l_linenumber") == 6, F.lit("two")).otherwise(F.col("l_quantity").cast("int").cast("string"))
    line = F.concat_ws(",", F.col("l_orderkey"), F.col("l_partkey"), quantity, F.when(F.col("l_linenumber") == 7, F.lit("more")))
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0  # the first line of a file
    path = _shared_path(spark, "faults")
    li.select(F.when(first, F.concat(F.lit("Invoice,StockCode,Quantity\n"), line)).otherwise(line)).write.text(path)
    kept, faults = read_with_faults(spark, path)
    return kept.select(F.lit("kept").alias("kind"), "Invoice", "StockCode", "Quantity", F.lit(None).cast("string").alias("raw")).unionByName(
        faults.select(F.col("reason").alias("kind"), F.lit(None).cast("string").alias("Invoice"), F.lit(None).cast("string").alias("StockCode"),
                      F.lit(None).cast("double").alias("Quantity"), "raw"))


@query
def q_fanout_descriptions(spark, sf):
    """J1 where codes have several descriptions: every (code, description) pair joins every day."""
    lines = _awkward_lines(spark, sf)
    days = lines.select("StockCode", F.to_date("InvoiceDate").alias("Date")).distinct()
    return FE.attach_descriptions(days, FE.distinct_descriptions(lines))


def _several_names(spark, sf):
    """Training lines whose codes have up to four names, a missing one among them, as a weight on the daily rows."""
    name = F.col("Description")
    lines = source(spark, sf).sales(SALES_COLS_RESTOCK + ["Description"]).withColumn(
        "Description", F.when(F.col("Quantity") % 4 == 1, F.concat(F.lit("RED "), name)).when(F.col("Quantity") % 4 == 2, F.concat(F.lit("BLUE "), name))
        .when(F.col("Quantity") % 4 == 3, F.lit(None)).otherwise(name))
    clean = materialize(clean_sales(lines, TRAINING))
    return clean, materialize(engineer_features(clean, TRAINING, FE.distinct_descriptions(clean), fan_out=False))


@query
def q_restock_several_names(spark, sf):
    """R5 and J1, training, on codes with several names: each day counts once per name, without a fan-out."""
    clean, feats = _several_names(spark, sf)
    res = restock_recommendations(feats, TRAINING, scorer=baseline_scorer, descriptions=FE.first_description(clean), materialize_as="ready")
    return rounded(res, ["avg_price", "estimated_cost"])


@query
def q_linear_metrics_several_names(spark, sf):
    """M2, M5 and A18 with the number of names as the weight."""
    from stockcast.operators import model as MD
    metrics, _ = MD.compare_models(_several_names(spark, sf)[1], names=MD.MODEL_ORDER[:1])
    return rounded(metrics, ["mse", "mae", "r2"], r4)


@query
def q_write_restock_round_trip(spark, sf):
    """S7 + P14: the restock file read back."""
    from stockcast.sources.csv_sales import _raw
    from stockcast.sources.sinks import write_restock
    path = write_restock(_res(spark, sf), _shared_path(spark, "restock"))
    back = _raw(spark, path, "UTF-8", ",", False)
    return back.select("StockCode", *[F.col(c).cast("long").alias(c) for c in (
        "predicted_weekly_demand", "safety_stock", "recommended_restock")], "Description", "priority")


@query
def q_by_priority_round_trip(spark, sf):
    """S8 on the training variant, where most rows have no priority: the three folders read back."""
    from stockcast.sources.sinks import write_by_priority
    path = write_by_priority(restock(spark, sf, TRAINING).select("StockCode", "recommended_restock", "priority"),
                             _shared_path(spark, "by_priority"))
    return spark.read.option("header", True).schema("StockCode string, recommended_restock double, priority string").csv(path)


# --- models (rows-only checks: fitted values depend on the learner) ------------------

#: Depth 10 instead of the default 30 keeps these checks short; ``jobs.train`` uses the default.
CHECK_FOREST_DEPTH = 10


def _settings():
    from stockcast.operators import model as MD
    return MD.ModelSettings(rf_depth=CHECK_FOREST_DEPTH)


def _model_test_predictions(spark, sf, name):
    from stockcast.operators import model as MD
    train, test = MD.split_frames(features(spark, sf, TRAINING))
    m = MD.fit(name, train, _settings())
    return MD.predictions(m, test).select("StockCode", "Date", "Quantity", "prediction")


@query
def q_linear_regression(spark, sf):
    """M2 on the test part; predictions to 3 places (two solvers agree to about 1e-9)."""
    return rounded(_model_test_predictions(spark, sf, "Linear Regression"), ["prediction"], r3)


@query
def q_model_round_trip(spark, sf):
    """The linear model saved, loaded again, and used on the test part."""
    from stockcast.operators import model as MD
    train, test = MD.split_frames(features(spark, sf, TRAINING))
    path = MD.save_model(MD.fit("Linear Regression", train), _shared_path(spark, "model"))
    back = MD.load_model(spark, path).transform(test)
    return rounded(back.select("StockCode", "Date", "Quantity", "prediction"), ["prediction"], r3)


@query
def q_random_forest(spark, sf):
    return _model_test_predictions(spark, sf, "Random Forest")


@query
def q_gradient_boosting(spark, sf):
    return _model_test_predictions(spark, sf, "Gradient Boosting")


@query
def q_linear_metrics(spark, sf):
    """M5 + A18: the linear row of the model comparison."""
    from stockcast.operators import model as MD
    r = MD.compare_models(features(spark, sf, TRAINING), _settings(), names=("Linear Regression",))[0]
    return rounded(r, ["mse", "mae", "r2"], r4)


@query
def q_compare_models(spark, sf):
    from stockcast.operators import model as MD
    return MD.compare_models(features(spark, sf, TRAINING), _settings())[0]


@query
def q_best_model(spark, sf):
    from stockcast.operators import model as MD
    return MD.best_model(MD.compare_models(features(spark, sf, TRAINING), _settings())[0])


@query
def q_score(spark, sf):
    """M7 inside R5: the predict-variant restock table scored by a fitted linear model.

    Both variants' feature rows come from one lag table, so the lines are scanned once.
    """
    from stockcast.operators import model as MD
    src = source(spark, sf)
    lagged = materialize(FE.with_lag_and_rolling(_daily(spark, sf)))
    train, _ = MD.split_frames(FE.feature_rows(lagged, TRAINING, src.description_pairs()))
    m = MD.fit("Linear Regression", train)
    res = restock_recommendations(FE.feature_rows(lagged, PREDICT), PREDICT, scorer=MD.model_scorer(m),
                                  descriptions=src.first_descriptions())
    return rounded(res, ["avg_price"])


@query
def q_prompt_table(spark, sf):
    f = _feat(spark, sf)
    return RP.prompt_table(_res(spark, sf, f), f)


@query
def q_schema_report(spark, sf):
    return QU.column_report(source(spark, sf).sales())


@query
def q_to_int(spark, sf):
    """The output table with demand, safety and restock as integers."""
    r = _res(spark, sf)
    return r.withColumns({c: F.col(c).cast("long") for c in
                          ("predicted_weekly_demand", "safety_stock", "recommended_restock")})


@query
def q_by_priority(spark, sf):
    """The High rows (what the per-priority file holds)."""
    return RP.by_priority(_res(spark, sf), "High")


@query
def q_lookup_description(spark, sf):
    """Restock products with their first description, "Unknown" when none."""
    nums = RS.restock_numbers(_steps(spark, sf), PREDICT, baseline_scorer).select("StockCode")
    return RS.with_descriptions(nums.withColumns({c: F.lit(None).cast("double") for c in (
        "predicted_weekly_demand", "safety_stock", "recommended_restock", "avg_price", "estimated_cost")}),
        PREDICT, source(spark, sf).first_descriptions()).select("StockCode", "Description")


@query
def q_concat_priorities(spark, sf):
    """The report's picks (High 5, Medium 4, Low 3) in one table, High first."""
    return RP.restock_by_priority(_res(spark, sf), (5, 4, 3), fallback=None)
