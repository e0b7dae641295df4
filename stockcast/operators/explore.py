"""Exploration tables (A3-A7): summary statistics and sales by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockcast.functions.columns import money_sum, nan_to_null
from stockcast.functions.selection import select

DESCRIBE_COLUMNS = ("Quantity", "Price", "TotalPrice")


def describe_sales(clean: DataFrame, columns: Sequence[str] = DESCRIBE_COLUMNS,
                   approx_accuracy: int | None = None) -> DataFrame:
    """A3: count, mean, std, min, 25/50/75 %, max per column; one row per column.

    Two scans as a rule (``selection``): moments and sketches, then the exact
    quartiles and the spread; neither shuffles the distinct values. With
    ``approx_accuracy`` one aggregation with a bounded sketch gives all of it
    instead, for inputs where exact quartiles are not needed.
    """
    if approx_accuracy:
        rows = []
        aggs = []
        for c in columns:
            v = nan_to_null(c).cast("double")
            aggs += [F.count(v).alias(f"{c}_n"), F.avg(v).alias(f"{c}_m"), F.stddev_samp(v).alias(f"{c}_s"),
                     F.min(v).alias(f"{c}_lo"), F.max(v).alias(f"{c}_hi"),
                     F.percentile_approx(v, [0.25, 0.5, 0.75], approx_accuracy).alias(f"{c}_q")]
            q = F.col(f"{c}_q")
            rows.append(F.struct(F.lit(c).alias("column"), F.col(f"{c}_n").alias("count"), F.col(f"{c}_m").alias("mean"),
                                 F.col(f"{c}_s").alias("std"), F.col(f"{c}_lo").alias("min"), q[0].alias("p25"),
                                 q[1].alias("p50"), q[2].alias("p75"), F.col(f"{c}_hi").alias("max")))
        return clean.agg(*aggs).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    found = select(clean.select(*columns), columns, [0.25, 0.5, 0.75], pandas_scaled=True)
    # one row per described column with a value
    rows = [(c, s.n, s.mean, s.std, s.lowest, *s.quantiles, s.highest) for c, s in found.items() if s.n]
    return clean.sparkSession.createDataFrame(rows, "column string, count long, mean double, std double, min double, p25 double, "
                                                    "p50 double, p75 double, max double")


def _top_by(clean: DataFrame, key: str, total: Column, out: str, k: int) -> DataFrame:
    agg = clean.where(F.col(key).isNotNull()).groupBy(key).agg(total.alias(out))
    return agg.orderBy(F.col(out).desc(), F.col(key)).limit(k)


def top_products(clean: DataFrame, k: int = 10) -> DataFrame:
    """A4: total Quantity per StockCode, largest k (code breaks ties)."""
    units = F.coalesce(F.sum(nan_to_null("Quantity")), F.lit(0.0))
    return _top_by(clean, "StockCode", units, "Quantity", k)


def sales_by_country(clean: DataFrame, k: int = 10) -> DataFrame:
    """A5: total TotalPrice per Country, largest k."""
    return _top_by(clean, "Country", money_sum("TotalPrice"), "TotalPrice", k)


def _sum_by(clean: DataFrame, key: str) -> DataFrame:
    return clean.where(F.col(key).isNotNull()).groupBy(key).agg(
        money_sum("TotalPrice").alias("TotalPrice")).orderBy(key)


def monthly_sales(clean: DataFrame) -> DataFrame:
    """TotalPrice by month 1-12, years merged."""
    return _sum_by(clean, "Month")


def weekday_sales(clean: DataFrame) -> DataFrame:
    """TotalPrice by DayOfWeek (Monday = 0)."""
    return _sum_by(clean, "DayOfWeek")
