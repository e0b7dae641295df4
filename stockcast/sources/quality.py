"""Data checks on the raw sales table (S4-S6); they warn, rows stay."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockcast.config import EXPECTED_COLUMNS, INVOICE_PATTERN


def schema_report(spark: SparkSession, sales: DataFrame) -> DataFrame:
    """(column, status) for unexpected and missing column names.

    Works on the schema only (metadata of the frame, not its rows).
    """
    have = list(sales.columns)
    rows = [(c, "unexpected") for c in have if c not in EXPECTED_COLUMNS]
    rows += [(c, "missing") for c in EXPECTED_COLUMNS if c not in have]
    return spark.createDataFrame(rows, "column string, status string")


def column_report(sales: DataFrame) -> DataFrame:
    """S4 with counts: (column, status, non_null_rows) for the expected and the
    unexpected columns, in one aggregation over the table."""
    have = list(sales.columns)
    names = list(EXPECTED_COLUMNS) + [c for c in have if c not in EXPECTED_COLUMNS]
    agg = sales.agg(*[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(names) if c in have])
    rows = []
    for i, c in enumerate(names):
        status = "expected" if c in EXPECTED_COLUMNS and c in have else \
            ("missing" if c in EXPECTED_COLUMNS else "unexpected")
        cnt = F.col(f"_{i}") if c in have else F.lit(None).cast("long")
        rows.append(F.struct(F.lit(c).alias("column"), F.lit(status).alias("status"), cnt.alias("non_null_rows")))
    return agg.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def malformed_invoices(sales: DataFrame) -> DataFrame:
    """Lines whose Invoice is not digits and 'C' only; a missing one counts."""
    return sales.where(~F.coalesce(F.col("Invoice").cast("string"), F.lit("nan"))
                       .rlike(INVOICE_PATTERN))


def dataset_shape(sales: DataFrame, columns: int | None = None) -> DataFrame:
    """(rows, columns). A caller that reads fewer columns to count rows names their number."""
    return sales.agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "columns", F.lit(columns or len(sales.columns)).cast("int"))
