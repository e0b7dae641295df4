"""Product x day features: daily sums, previous-day quantity, 7-row mean.

Plan shape: partial aggregation -> exchange on (StockCode, Date) -> final
aggregation -> exchange on StockCode -> one sort and one Window node for both
window columns. Every later per-product step (stats, last row, history
count, weekly sum) reuses the StockCode partitioning, so no other exchange
touches the daily rows. A product holds at most one row per calendar day, so
a hot product cannot make a window partition larger than its day count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockcast.config import PREDICT, RestockConfig
from stockcast.functions.columns import money_sum, nan_to_null
from stockcast.functions.exact import mean, pieces, total
from stockcast.functions.materialize import materialize

BROADCAST_PAIRS = 100_000  # (code, description) pairs that may be broadcast


def by_product():
    """Window W: one product, by date."""
    return Window.partitionBy("StockCode").orderBy("Date")


def product_daily(clean: DataFrame) -> DataFrame:
    """A1 + P7 + P8: one row per product and day."""
    keyed = clean.where(F.col("StockCode").isNotNull() & F.col("InvoiceDate").isNotNull())
    daily = keyed.groupBy(F.col("StockCode").cast("string").alias("StockCode"),
                          F.to_date("InvoiceDate").alias("Date")).agg(
        *pieces("Quantity", nan_to_null("Quantity")), money_sum("TotalPrice").alias("TotalPrice"), *pieces("Price", nan_to_null("Price")),
    )
    return daily.select(
        "StockCode", F.year("Date").alias("Year"), F.month("Date").alias("Month"),
        F.dayofmonth("Date").alias("Day"), F.coalesce(total("Quantity"), F.lit(0.0)).alias("Quantity"), "TotalPrice",
        mean("Price").alias("Price"), "Date",
        F.weekday("Date").alias("DayOfWeek"),
    )


def with_lag_and_rolling(daily: DataFrame, rolling_excludes_current: bool = False) -> DataFrame:
    """W1 lag of the previous sale day; W2 mean of this and the 6 previous rows."""
    frame = (-7, -1) if rolling_excludes_current else (-6, 0)
    w = by_product()
    return daily.withColumns({
        "Lag1_Quantity": F.lag("Quantity", 1).over(w),
        "Rolling7_Quantity": F.avg("Quantity").over(w.rowsBetween(*frame)),
    })


#: How often a feature row counts: one per description of its code.
COPIES = "Copies"


def with_copies(features: DataFrame, pairs: DataFrame) -> DataFrame:
    """J1 as a weight: every row once, with the number of (StockCode, Description) pairs of its code.

    The table that ``attach_descriptions`` gives holds each row so many times;
    counts, sums, spread and fits that read ``COPIES`` equal theirs.
    """
    copies = pairs.groupBy("StockCode").agg(F.count(F.lit(1)).alias(COPIES))
    return features.join(copies, "StockCode", "left").withColumn(COPIES, F.coalesce(COPIES, F.lit(1).cast("long")))


def attach_descriptions(features: DataFrame, pairs: DataFrame) -> DataFrame:
    """Left join every (StockCode, Description) pair of the code (fan-out)."""
    return features.join(pairs.select("StockCode", "Description"), "StockCode", "left")


def distinct_descriptions(clean: DataFrame) -> DataFrame:
    """Distinct (StockCode, Description); a NULL description is a value."""
    return clean.select(F.col("StockCode").cast("string").alias("StockCode"), "Description") \
        .where(F.col("StockCode").isNotNull()).dropDuplicates(["StockCode", "Description"])


def first_description(sales: DataFrame) -> DataFrame:
    """One description per code, the earliest line (date, invoice, text) wins.

    Returns (StockCode, Description, n_described): Description may be NULL when
    the earliest line has none; n_described counts non-NULL descriptions. The
    lines are reduced to the earliest date per (code, description) first, in a
    hash aggregation; invoices are compared only where several descriptions
    share the earliest date of a code.
    """
    lines = sales.select(F.col("StockCode").cast("string").alias("StockCode"), "Description", "InvoiceDate", "Invoice") \
        .where(F.col("StockCode").isNotNull())
    pairs = materialize(lines.groupBy("StockCode", "Description").agg(
        F.min("InvoiceDate").alias("date"), F.count("Description").alias("n"), F.count("InvoiceDate").alias("dated"),
        F.count(F.lit(1)).alias("lines")))
    # a missing date comes before all others
    date = F.when(F.col("dated") == F.col("lines"), F.col("date"))
    earliest = Window.partitionBy("StockCode")
    pairs = pairs.withColumn("date", date).withColumn("n_described", F.sum("n").over(earliest)).withColumn(
        "rank", F.rank().over(earliest.orderBy("date"))).where(F.col("rank") == 1)
    pairs = pairs.withColumn("equal", F.count(F.lit(1)).over(earliest))
    alone = pairs.where(F.col("equal") == 1).select("StockCode", "Description", "n_described")
    several = pairs.where(F.col("equal") > 1).select(F.col("StockCode").alias("code"), F.col("Description").alias("text"), "date", "n_described")
    undecided = several.limit(BROADCAST_PAIRS + 1).count()
    if not undecided:
        return alone
    several = F.broadcast(several) if undecided <= BROADCAST_PAIRS else several
    same = (F.col("StockCode") == F.col("code")) & F.col("Description").eqNullSafe(F.col("text")) & F.col("InvoiceDate").eqNullSafe(F.col("date"))
    decided = lines.join(several, same).groupBy("StockCode").agg(
        F.min_by("Description", F.struct("Invoice", "Description")).alias("Description"), F.first("n_described").alias("n_described"))
    return alone.unionByName(decided)


def first_description_by_place(sales: DataFrame, place: str) -> DataFrame:
    """X4 in the order of the input: the description of the line with the smallest ``place`` per code.

    Same columns as ``first_description``. The lines are reduced to the first
    place per (code, description) in a hash aggregation.
    """
    pairs = sales.where(F.col("StockCode").isNotNull()).groupBy(F.col("StockCode").cast("string").alias("StockCode"), "Description").agg(
        F.min(place).alias("place"), F.count("Description").alias("n"))
    return pairs.groupBy("StockCode").agg(F.min_by("Description", "place").alias("Description"), F.sum("n").alias("n_described"))


def feature_rows(lagged: DataFrame, config: RestockConfig, description_pairs: DataFrame | None = None,
                 fan_out: bool = True) -> DataFrame:
    """P9 (and J1) on the lag table: the rows and columns of one variant.

    training: fan-out join of description pairs (or their number as a weight,
              ``fan_out=False``), drop rows without a lag.
    predict:  no descriptions, drop rows with any NULL.
    """
    if config.descriptions == "fanout":
        attach = attach_descriptions if fan_out else with_copies
        return attach(lagged, description_pairs).where(F.col("Lag1_Quantity").isNotNull())
    feats = lagged.drop("DayOfWeek")
    if config.drop_any_null:
        return feats.dropna(how="any")
    return feats.where(F.col("Lag1_Quantity").isNotNull())


def engineer_features(clean: DataFrame, config: RestockConfig = PREDICT,
                      description_pairs: DataFrame | None = None,
                      rolling_excludes_current: bool = False, fan_out: bool = True) -> DataFrame:
    """Daily features for either variant (see ``feature_rows``)."""
    pairs = description_pairs
    if config.descriptions == "fanout" and pairs is None:
        pairs = distinct_descriptions(clean)
    return feature_rows(with_lag_and_rolling(product_daily(clean), rolling_excludes_current), config, pairs, fan_out)
