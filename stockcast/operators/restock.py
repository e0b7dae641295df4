"""Restock recommendations: recent stats, forecast grid, safety stock, priority.

The per-product loop of the original (each turn scanning the whole table) is
one aggregation here. Everything after the feature window runs on the
StockCode partitioning the window already produced:

  features --agg by StockCode (no exchange)--> active products
           --explode 1..horizon days--> forecast grid --scorer--> prediction
           --agg by StockCode (no exchange)--> weekly demand --> formulas

The latest date and the tertile edges are scalar subqueries (one value each),
so the plan stays lazy and has no cross join.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockcast.config import (
    DEMAND_COLUMN, PREDICT, PRIORITY_LABELS, RestockConfig, UNKNOWN_DESCRIPTION,
)
from stockcast.functions.columns import half_even
from stockcast.functions.exact import mean, piece_names, pieces, total
from stockcast.functions.materialize import materialize
from stockcast.functions.quantiles import tertile_edges, tertile_label
from stockcast.operators.features import COPIES

Scorer = Callable[[DataFrame], DataFrame]

#: What the restock steps read of the feature table.
RESTOCK_COLUMNS = ("StockCode", "Date", "Quantity", "Price")


def latest_date(features: DataFrame) -> Column:
    """The latest feature date over all products, as a scalar subquery."""
    return features.agg(F.max("Date")).scalar()


def recent_window(features: DataFrame, last_n_days: int = 30) -> DataFrame:
    """P10: rows on or after latest - n days (n + 1 calendar days)."""
    return features.where(F.col("Date") >= F.date_sub(latest_date(features), last_n_days))


def _weighted(features: DataFrame, recent: Column) -> DataFrame:
    """``features`` with ``_w`` (how often a row counts) and ``_off`` (a recent quantity less its product's recent mean)."""
    w = F.col(COPIES) if COPIES in features.columns else F.lit(1).cast("long")
    q = F.when(recent, F.col("Quantity"))
    out = features.select("*", w.alias("_w"), *pieces("q", q, over=Window.partitionBy("StockCode")))
    return out.withColumn("_off", q - mean("q")).drop(*piece_names("q"))


def _recent_sums(recent: Column) -> list[Column]:
    """What sum, mean and sample std of the quantity and the mean price of the recent rows are put together from.

    Each row counts as often as its weight says; rows of one product count equally often, so the means stay as they are.
    """
    w, q = F.col("_w"), F.col("Quantity")
    return [*pieces("total", F.when(recent, q * w)), *pieces("quantity", F.when(recent, q)), *pieces("price", F.when(recent, F.col("Price"))),
            *pieces("squares", F.col("_off") * F.col("_off") * w), F.sum(F.when(recent & q.isNotNull(), w)).alias("_n")]


def _recent_stats() -> list[Column]:
    return [total("total").alias("Total_Quantity"), mean("quantity").alias("Avg_Daily_Quantity"),
            F.when(F.col("_n") > 1, F.sqrt(total("squares") / (F.col("_n") - 1))).alias("Std_Daily_Quantity"), mean("price").alias("Avg_Price")]


def product_stats(features: DataFrame, last_n_days: int = 30) -> DataFrame:
    """A2: recent-window sum, mean and sample std of daily quantity, mean price."""
    always = F.lit(True)
    sums = _weighted(recent_window(features, last_n_days), always).groupBy("StockCode").agg(*_recent_sums(always))
    return sums.select("StockCode", *_recent_stats())


def product_profile(features: DataFrame, config: RestockConfig = PREDICT) -> DataFrame:
    """A2 + A9 + J4 in one pass: history size, latest quantity, recent stats."""
    recent = F.col("Date") >= F.date_sub(latest_date(features), config.last_n_days)
    sums = _weighted(features, recent).groupBy("StockCode").agg(
        F.sum("_w").alias("n_rows"),
        F.max("Date").alias("Last_Date"),
        F.max_by("Quantity", "Date").alias("Last_Quantity"),
        F.coalesce(F.sum(F.when(recent, F.col("_w"))), F.lit(0)).alias("n_recent"),
        *_recent_sums(recent),
    )
    return sums.select("StockCode", "n_rows", "Last_Date", "Last_Quantity", "n_recent", *_recent_stats())


def enough_history(profile: DataFrame, min_rows: int) -> DataFrame:
    """Products with at least ``min_rows`` feature rows."""
    return profile.where(F.col("n_rows") >= min_rows)


def active_products(features: DataFrame, config: RestockConfig = PREDICT) -> DataFrame:
    """J3 + A9: enough history and present in the recent window."""
    prof = product_profile(features, config)
    return enough_history(prof, config.min_rows).where(F.col("n_recent") > 0)


def forecast_grid(active: DataFrame, latest: Column, horizon: int = 7) -> DataFrame:
    """Each product x the next ``horizon`` days (a generator, not a join)."""
    days = F.sequence(F.date_add(latest, 1), F.date_add(latest, horizon))
    return active.withColumn("ForecastDate", F.explode(days))


def forecast_inputs(grid: DataFrame) -> DataFrame:
    """Lag1 = the latest day's quantity, Rolling7 = the recent mean, date parts."""
    d = F.col("ForecastDate")
    return grid.withColumns({
        "Lag1_Quantity": F.col("Last_Quantity"),
        "Rolling7_Quantity": F.col("Avg_Daily_Quantity"),
        "Month": F.month(d), "Day": F.dayofmonth(d), "DayOfWeek": F.weekday(d),
    })


# Fixed weights of the SQL-expressible baseline scorer (checked against DuckDB).
BASELINE_WEIGHTS = {"Rolling7_Quantity": 0.75, "Lag1_Quantity": 0.25, "DayOfWeek": 0.05}


def baseline_scorer(grid: DataFrame) -> DataFrame:
    """prediction = 0.75 * Rolling7 + 0.25 * Lag1 + 0.05 * (DayOfWeek - 3)."""
    w = BASELINE_WEIGHTS
    pred = (F.lit(w["Rolling7_Quantity"]) * F.col("Rolling7_Quantity")
            + F.lit(w["Lag1_Quantity"]) * F.col("Lag1_Quantity")
            + F.lit(w["DayOfWeek"]) * (F.col("DayOfWeek") - 3).cast("double"))
    return grid.withColumn("prediction", pred)


def weekly_demand(scored: DataFrame) -> DataFrame:
    """A10: sum of the daily predictions; product columns carried along."""
    carry = ["Total_Quantity", "Avg_Daily_Quantity", "Std_Daily_Quantity", "Avg_Price", "n_rows"]
    return scored.groupBy("StockCode").agg(
        F.sum("prediction").alias(DEMAND_COLUMN),
        *[F.any_value(c).alias(c) for c in carry if c in scored.columns],
    )


def safety_stock(config: RestockConfig = PREDICT) -> Column:
    """R2 (+ R3 in predict): factor * std * sqrt(lead time); NULL std -> share of demand."""
    s = F.lit(config.safety_factor) * F.col("Std_Daily_Quantity") * F.lit(math.sqrt(config.lead_time))
    if config.null_std == "fallback":
        s = F.coalesce(s, F.col(DEMAND_COLUMN) * F.lit(config.fallback_share))
    return s


def description_for_result(config: RestockConfig) -> Column:
    """Predict -> NULL or missing is "Unknown"; training -> "Unknown" only when the
    code has no description at all, a NULL first description stays NULL."""
    if config.variant == "training":
        return F.when(F.coalesce(F.col("n_described"), F.lit(0)) == 0, F.lit(UNKNOWN_DESCRIPTION)) \
                .otherwise(F.col("Description"))
    return F.coalesce(F.col("Description"), F.lit(UNKNOWN_DESCRIPTION))


def restock_raw(features: DataFrame, config: RestockConfig, scorer: Scorer) -> DataFrame:
    """R1-R4 before rounding: demand, safety stock and their sum per product."""
    active = active_products(features, config)
    scored = scorer(forecast_inputs(forecast_grid(active, latest_date(features), config.horizon)))
    raw = weekly_demand(scored).withColumn("safety_stock", safety_stock(config))
    return raw.withColumn("recommended_restock", F.col(DEMAND_COLUMN) + F.col("safety_stock"))


def estimated_cost(config: RestockConfig) -> Column:
    """P13 on ``restock_raw``: unrounded restock x price to 2 places, or rounded restock x price."""
    if config.cost == "unrounded_2dp":
        return half_even(F.col("recommended_restock") * F.col("Avg_Price"), 2)
    return half_even("recommended_restock") * F.col("Avg_Price")


def restock_numbers(features: DataFrame, config: RestockConfig, scorer: Scorer) -> DataFrame:
    """One row per product with the rounded figures and cost."""
    return restock_raw(features, config, scorer).select(
        "StockCode",
        half_even(DEMAND_COLUMN).alias(DEMAND_COLUMN),
        half_even("safety_stock").alias("safety_stock"),
        half_even("recommended_restock").alias("recommended_restock"),
        F.col("Avg_Price").alias("avg_price"),
        estimated_cost(config).alias("estimated_cost"),
    )


def with_descriptions(res: DataFrame, config: RestockConfig = PREDICT,
                      descriptions: DataFrame | None = None) -> DataFrame:
    """J2 on the result (one row per product), columns in the variant's order."""
    if descriptions is None:
        res = res.withColumn("Description", F.lit(None).cast("string")).withColumn("n_described", F.lit(0))
    else:
        d = descriptions.select("StockCode", "Description",
                                *(["n_described"] if "n_described" in descriptions.columns else []))
        res = res.join(d, "StockCode", "left")
        if "n_described" not in d.columns:
            res = res.withColumn("n_described", F.when(F.col("Description").isNotNull(), 1).otherwise(0))
    res = res.withColumn("Description", description_for_result(config)).drop("n_described")
    tail = ["priority"] if "priority" in res.columns else []
    if config.variant == "training":
        return res.select("StockCode", DEMAND_COLUMN, "safety_stock", "recommended_restock",
                          "avg_price", "Description", "estimated_cost", *tail)
    return res.select("StockCode", DEMAND_COLUMN, "safety_stock", "recommended_restock",
                      "avg_price", "estimated_cost", "Description", *tail)


def restock_unranked(features: DataFrame, config: RestockConfig, scorer: Scorer,
                     descriptions: DataFrame | None = None) -> DataFrame:
    """R5 before priority and order."""
    return with_descriptions(restock_numbers(features, config, scorer), config, descriptions)


def with_priority(res: DataFrame, config: RestockConfig = PREDICT) -> DataFrame:
    """Low / Medium / High by tertile edges of the rounded restock.

    ``config.strict_edges`` raises when any two of the four bin edges (smallest,
    1/3, 2/3, largest) are equal, as the original's binning does.
    """
    edges = tertile_edges(res, "recommended_restock", method=config.edges)
    if config.strict_edges:
        row = edges.first()
        ends = [row[c] for c in ("lowest", "e1", "e2", "highest")]
        if row["n"] and len(set(ends)) < 4:
            raise ValueError(f"tertile edges are not unique: {ends}")
    e = edges.select(F.struct("e1", "e2")).scalar()
    return res.withColumn("priority", tertile_label(F.col("recommended_restock"), e, PRIORITY_LABELS))


def restock_order(res: DataFrame) -> DataFrame:
    """Restock descending, NULLs last, code as the tie-break."""
    return res.orderBy(F.col("recommended_restock").desc_nulls_last(), F.col("StockCode"))


def restock_recommendations(features: DataFrame, config: RestockConfig, scorer: Scorer,
                            descriptions: DataFrame | None = None,
                            ordered: bool = True, materialize_as: str = "checkpoint") -> DataFrame:
    """The full restock table for either variant.

    Of the features only ``RESTOCK_COLUMNS`` (and ``COPIES``) are read. They and the per-product
    figures are each written once (``materialize_as``), so the latest-date and
    tertile subqueries read them back instead of re-running the scan,
    aggregation and window. ``materialize_as='ready'`` says that ``features``
    is materialized already.
    """
    ready = materialize_as == "ready"
    feats = features.select(*RESTOCK_COLUMNS, *([COPIES] if COPIES in features.columns else []))
    feats = feats if ready else materialize(feats, materialize_as)
    numbers = materialize(restock_numbers(feats, config, scorer), "checkpoint" if ready else materialize_as)
    res = with_descriptions(with_priority(numbers, config), config, descriptions)
    return restock_order(res) if ordered else res


def priority_rank(c: Column | str = "priority") -> Column:
    """Ordered category: Low 1 < Medium 2 < High 3."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col == PRIORITY_LABELS[0], 1).when(col == PRIORITY_LABELS[1], 2) \
            .when(col == PRIORITY_LABELS[2], 3)
