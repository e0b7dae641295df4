"""Cleaning: date parts, line totals, returns and cancelled invoices (all narrow)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stockcast.config import CANCEL_PREFIX, PREDICT, RestockConfig
from stockcast.functions.columns import nan_to_null, parse_invoice_date


def with_invoice_timestamp(sales: DataFrame, strict: bool = True) -> DataFrame:
    """Parse InvoiceDate when it is text; timestamps pass through."""
    if isinstance(sales.schema["InvoiceDate"].dataType, StringType):
        return sales.withColumn("InvoiceDate", parse_invoice_date("InvoiceDate", strict=strict))
    return sales


def with_date_parts(df: DataFrame) -> DataFrame:
    """Year, Month, Day, DayOfWeek (Monday = 0), Hour."""
    ts = F.col("InvoiceDate")
    return df.withColumns({
        "Year": F.year(ts), "Month": F.month(ts), "Day": F.dayofmonth(ts),
        "DayOfWeek": F.weekday(ts), "Hour": F.hour(ts),
    })


def with_total_price(df: DataFrame) -> DataFrame:
    """TotalPrice = Quantity * Price."""
    return df.withColumn("TotalPrice", F.col("Quantity") * F.col("Price"))


def drop_returns(df: DataFrame) -> DataFrame:
    """Keep Quantity > 0; NaN and NULL quantities are not kept."""
    return df.where(nan_to_null("Quantity") > 0)


def drop_cancelled(df: DataFrame) -> DataFrame:
    """P5: drop invoices starting with 'C'; a missing invoice reads as 'nan' and stays."""
    return df.where(~F.startswith(F.coalesce(F.col("Invoice").cast("string"), F.lit("nan")),
                                  F.lit(CANCEL_PREFIX)))


def numeric_customer(df: DataFrame) -> DataFrame:
    """Customer ID -> double, values that are not numbers -> NULL."""
    if "Customer ID" not in df.columns:
        return df
    return df.withColumn("Customer ID", F.col("Customer ID").cast("string").try_cast("double"))


def clean_sales(sales: DataFrame, config: RestockConfig = PREDICT, strict_dates: bool = True) -> DataFrame:
    """P1-P6 in the order of the original: parse, parts, total, filters, customer."""
    df = with_invoice_timestamp(sales, strict=strict_dates)
    df = with_date_parts(df)
    df = with_total_price(df)
    df = drop_cancelled(drop_returns(df))
    if config.coerce_customer:
        df = numeric_customer(df)
    return df
