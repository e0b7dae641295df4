"""End-to-end jobs: train, predict, report, sample.

Each job is a short sequence of DataFrame plans; the only values that reach
the driver are bounded (model metrics, one saved model, file paths).
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from stockcast.config import (
    PICKS_CONSOLE, PICKS_REPORT_TABLES, PICKS_SHORT_HTML, PICKS_SHORT_MARKDOWN, PREDICT, TOP_PROMPT, TRAINING, RestockConfig,
)
from stockcast.functions.materialize import materialize
from stockcast.operators import explore as EX
from stockcast.operators import model as MD
from stockcast.operators import report as RP
from stockcast.operators.clean import clean_sales
from stockcast.operators.features import engineer_features
from stockcast.operators.restock import restock_order, restock_recommendations
from stockcast.sources import quality as QU
from stockcast.sources import sinks
from stockcast.sources.csv_sales import PLACE, CsvSales


@dataclass
class TrainResult:
    restock: DataFrame
    metrics: DataFrame
    best: str
    model_path: str
    exploration: dict[str, DataFrame] = field(default_factory=dict)


def _checks(spark: SparkSession, source, sales: DataFrame, out_dir: str) -> None:
    """S4-S6 on the raw lines (and, for CSV, what the lenient reader lost), each written as a table."""
    sinks.write_csv(QU.column_report(sales), os.path.join(out_dir, "checks/columns"))
    sinks.write_csv(QU.dataset_shape(sales), os.path.join(out_dir, "checks/shape"))
    if "Invoice" in sales.columns:
        sinks.write_csv(QU.malformed_invoices(sales), os.path.join(out_dir, "checks/malformed_invoices"))
    if isinstance(source, CsvSales):
        sinks.write_csv(source.report(), os.path.join(out_dir, "checks/read_report"))
        sinks.write_csv(source.faults(), os.path.join(out_dir, "checks/faults"))


def train(spark: SparkSession, source, out_dir: str, config: RestockConfig = TRAINING,
          settings: MD.ModelSettings = MD.ModelSettings(exact_split=True), sample_size: int = 0) -> TrainResult:
    """Load -> checks -> (sample) -> clean -> explore -> features -> models -> restock -> CSV."""
    sales = source.sales()
    _checks(spark, source, sales, out_dir)
    if isinstance(source, CsvSales):  # the first description is the first in the file
        sales = source.sales(places=True)
    if sample_size > 0:
        from stockcast.operators.sample import sample_rows
        sales = sample_rows(sales, sample_size, cols=[c for c in sales.columns if c != PLACE])
    clean = clean_sales(sales, config)
    exploration = {
        "describe": EX.describe_sales(clean), "top_products": EX.top_products(clean),
        "sales_by_country": EX.sales_by_country(clean), "monthly_sales": EX.monthly_sales(clean),
        "weekday_sales": EX.weekday_sales(clean),
    }
    for name, df in exploration.items():
        sinks.write_csv(df, os.path.join(out_dir, "exploration", name))
    # one row per day; how often it counts is a weight
    feats = materialize(engineer_features(clean, config, description_pairs=source.description_pairs(clean), fan_out=False))
    metrics, models = MD.compare_models(feats, settings)
    best = MD.best_model(metrics).first()["model"]
    model_path = MD.save_model(models[best], os.path.join(out_dir, "models/demand_model"))
    # written once: the sinks and the console read the figures, not the lines
    res = restock_order(materialize(restock_recommendations(
        feats, config, scorer=MD.model_scorer(models[best]), descriptions=source.first_descriptions(clean),
        ordered=False, materialize_as="ready")))
    sinks.write_restock(res, os.path.join(out_dir, "reports/restock_recommendations"), as_integers=False)
    return TrainResult(res, metrics, best, model_path, exploration)


def _forecast(spark: SparkSession, source, model_path: str, config: RestockConfig) -> tuple[DataFrame, DataFrame]:
    """(restock, features), both materialized."""
    model = MD.load_model(spark, model_path)
    feats = materialize(engineer_features(clean_sales(source.sales(), config), config))
    res = restock_recommendations(feats, config, scorer=MD.model_scorer(model),
                                  descriptions=source.first_descriptions(), ordered=False, materialize_as="ready")
    return restock_order(materialize(res)), feats


def predict(spark: SparkSession, source, model_path: str, out_dir: str,
            config: RestockConfig = PREDICT, detailed: bool = False) -> DataFrame:
    """Load model -> clean -> features -> restock -> CSV (+ per-priority files, summary)."""
    res, _ = _forecast(spark, source, model_path, config)
    sinks.write_restock(res, os.path.join(out_dir, "predictions/restock"))
    if detailed:
        sinks.write_by_priority(res, os.path.join(out_dir, "predictions/by_priority"))
        sinks.write_summary(res, os.path.join(out_dir, "predictions/summary"))
    return res


def report(spark: SparkSession, source, model_path: str, out_dir: str,
           config: RestockConfig = PREDICT) -> dict[str, str]:
    """Load model -> restock -> every report table as CSV under ``out_dir``/reports; name -> path."""
    res, feats = _forecast(spark, source, model_path, config)
    return save_reports(res, feats, os.path.join(out_dir, "reports"))


def reports(res: DataFrame, features: DataFrame) -> dict[str, DataFrame]:
    """The tables behind the summary, dashboard, charts and trend sections."""
    return {
        "kpis": RP.restock_kpis(res), "ranges": RP.restock_ranges(res),
        "histogram": RP.restock_histogram(res), "priority_counts": RP.priority_counts(res),
        "top": RP.top_restock(res, 5), "dashboard": RP.dashboard_records(res),
        "chart": RP.chart_top_restock(res), "picks": RP.report_picks(res, features),
        "series": RP.chart_product_series(features, RP.trend_picks(res)),
        "tables": RP.restock_by_priority(res, PICKS_REPORT_TABLES), "summary": RP.summary_text(res),
        "short_markdown": RP.restock_by_priority(res, PICKS_SHORT_MARKDOWN, fallback=None),
        "short_html": RP.restock_by_priority(res, PICKS_SHORT_HTML, fallback=None),
        "prompts": RP.prompt_table(res, features, k=TOP_PROMPT),
        "product_text": RP.product_text(res, features),
        "priority_summary": RP.priority_summary(res, style="console"),
    }


def save_reports(res: DataFrame, features: DataFrame, out_dir: str) -> dict[str, str]:
    """Write every report table (CSV folders, written in parallel)."""
    paths = {}
    for name, df in reports(res, features).items():
        paths[name] = sinks.write_csv(df, os.path.join(out_dir, name))
    return paths


def console_tables(res: DataFrame) -> dict[str, DataFrame]:
    """The console view: top 5 per priority with 37-character labels, and the
    High-first summary with cost = restock x price."""
    from pyspark.sql import functions as F

    from stockcast.config import LABEL_WIDTH_CONSOLE
    from stockcast.functions.columns import display_name, truncate_label
    picks = RP.restock_by_priority(res, PICKS_CONSOLE, fallback=None)
    label = truncate_label(display_name("Description", "StockCode", unknown_too=False), LABEL_WIDTH_CONSOLE, pad=True)
    table = picks.select("priority", "group_order", "rank", "StockCode", label.alias("Description"),
                         F.col("predicted_weekly_demand").cast("long").alias("Weekly Demand"),
                         F.col("recommended_restock").cast("long").alias("Restock Amt"),
                         (F.col("avg_price") * F.col("recommended_restock")).alias("Est. Cost"))
    return {"by_priority": table.orderBy("group_order", "rank"),
            "summary": RP.priority_summary(res, style="console")}


def sample(spark: SparkSession, source, out_path: str, n: int = 500, seed: int = 42) -> str:
    """The sampler: n seeded rows to CSV."""
    return sinks.write_sample(source.sales(), out_path, n, seed)
