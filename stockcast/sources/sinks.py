"""Sinks (S7-S10): CSV folders written in parallel, one file per task.

Paths should be on shared storage; nothing is gathered into one file on the
driver. ``StockCode`` is always a named column (the original left the key's
header empty in one of its two writers).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast.config import INVOICE_DATE_TEXT_FORMAT, PRIORITY_LABELS
from stockcast.operators.report import priority_summary
from stockcast.operators.sample import sample_rows


def _csv(df: DataFrame, mode: str = "overwrite"):
    """A CSV writer whose files ``csv_sales`` reads back unchanged: quotes doubled, blanks kept."""
    return (df.write.option("header", True).option("quote", '"').option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).mode(mode))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    _csv(df, mode).csv(path)
    return path


def write_restock(res: DataFrame, path: str, as_integers: bool = True) -> str:
    """S7 (+ P14): the restock table; demand, safety and restock as integers."""
    out = res
    if as_integers:
        out = out.withColumns({c: F.col(c).cast("long") for c in
                               ("predicted_weekly_demand", "safety_stock", "recommended_restock")})
    return write_csv(out, path)


def write_by_priority(res: DataFrame, path: str) -> str:
    """One folder per priority (priority=High/...), written in one job; rows without one are in none."""
    _csv(res.where(F.col("priority").isin(*PRIORITY_LABELS))).partitionBy("priority").csv(path)
    return path


def write_summary(res: DataFrame, path: str) -> str:
    """The per-priority summary."""
    return write_csv(priority_summary(res).drop("position"), path)


def write_sample(sales: DataFrame, path: str, n: int = 500, seed: int = 42) -> str:
    """A seeded sample of the sales lines, dates in the input text format."""
    s = sample_rows(sales, n, seed)
    if "InvoiceDate" in s.columns and dict(s.dtypes)["InvoiceDate"] != "string":
        s = s.withColumn("InvoiceDate", F.date_format("InvoiceDate", INVOICE_DATE_TEXT_FORMAT))
    return write_csv(s, path)


def write_sales_csv(sales: DataFrame, path: str) -> str:
    """Sales lines as CSV in the input layout (dates as day/month/yy hour:minute)."""
    s = sales
    if dict(s.dtypes).get("InvoiceDate") not in (None, "string"):
        s = s.withColumn("InvoiceDate", F.date_format("InvoiceDate", INVOICE_DATE_TEXT_FORMAT))
    return write_csv(s, path)


def write_features(features: DataFrame, path: str) -> str:
    """The daily feature table as Parquet partitioned by Year and Month, so readers
    of a date window (the 30-day stats, a trend period) prune whole folders."""
    features.write.mode("overwrite").partitionBy("Year", "Month").parquet(path)
    return path


def read_features_since(spark, path: str, start_date) -> DataFrame:
    """Rows on or after ``start_date``; the Year/Month filter reaches the folder
    listing (partition pruning), the Date filter the Parquet row groups."""
    d = F.lit(start_date).cast("date")
    df = spark.read.parquet(path)
    ym = F.col("Year") * 100 + F.col("Month")
    return df.where((ym >= F.year(d) * 100 + F.month(d)) & (F.col("Date") >= d))
