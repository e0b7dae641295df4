"""Seeded sampling (X1) and the repeatable train/test split (M1).

Rows are ranked by an md5 of their values and the seed, so a pick does not
depend on the partitioning. The n-th smallest hash is found as an order
statistic (``selection``) and rows are filtered by it: nothing is gathered or
sorted, whatever n is. Rows whose hash begins like the threshold's are decided
by the whole hash; equal rows among them are counted, not compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockcast.config import SAMPLE_ROWS, SEED, TRAIN_SHARE_PERCENT
from stockcast.functions.columns import md5_bucket
from stockcast.functions.materialize import materialize
from stockcast.functions.selection import order_statistic

_DIGITS = 13  # hex digits of a hash that a double holds exactly


def sample_key(df: DataFrame, seed: int = SEED, cols: Sequence[str] | None = None):
    cols = list(cols or df.columns)
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in cols], F.lit(str(seed))))


def _number(key: Column) -> Column:
    """The first digits of a hash as a number, in the hash's order."""
    return F.conv(F.substring(key, 1, _DIGITS), 16, 10).cast("long").cast("double")


def _ranked(df: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
    """(rows with their hash and its number, the numbers alone, written once): the scans of the
    order statistic read 8 bytes a row and not the joins behind the rows."""
    ranked = df.withColumn("_k", key).withColumn("_x", _number(F.col("_k")))
    return ranked, materialize(ranked.select("_x"))


def _smallest(df: DataFrame, ranked: DataFrame, numbers: DataFrame, n: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows before the threshold, rows at it that belong to the n smallest, rows that do not)."""
    _, edge, below = order_statistic(numbers, "_x", n - 1)
    # rows that are equal count as one with a number, so a row that repeats without end is not gathered
    tied = ranked.where(F.col("_x") == edge).groupBy(*df.columns, "_k").agg(F.count(F.lit(1)).alias("_c"))
    before = F.coalesce(F.sum("_c").over(Window.orderBy("_k", *df.columns).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tied = tied.withColumn("_take", F.greatest(F.lit(0), F.least(F.col("_c"), F.lit(n - below) - before)))

    def copies(many: Column) -> DataFrame:
        return tied.where(many > 0).select(*df.columns, F.explode(F.sequence(F.lit(1).cast("long"), many)).alias("_i")).drop("_i")

    return (ranked.where(F.col("_x") < edge).drop("_k", "_x"), copies(F.col("_take")),
            ranked.where(F.col("_x") > edge).drop("_k", "_x").unionByName(copies(F.col("_c") - F.col("_take"))))


def sample_rows(df: DataFrame, n: int = SAMPLE_ROWS, seed: int = SEED,
                cols: Sequence[str] | None = None) -> DataFrame:
    """N rows without replacement, all rows when there are no more than n."""
    if n <= 0:
        return df.limit(0)
    ranked, numbers = _ranked(df, sample_key(df, seed, cols))
    if numbers.count() <= n:
        return df
    first, tied, _ = _smallest(df, ranked, numbers, n)
    return first.unionByName(tied)


def train_test_split(features: DataFrame, seed: int = SEED,
                     train_percent: int = TRAIN_SHARE_PERCENT,
                     keys: Sequence[str] = ("StockCode", "Date")) -> DataFrame:
    """M1: add ``split`` = 'train' / 'test' from an md5 bucket of the row key; the share is that of the buckets."""
    b = md5_bucket([F.col(k) for k in keys], seed, 100)
    return features.withColumn("split", F.when(b < train_percent, F.lit("train")).otherwise(F.lit("test")))


def train_test_split_exact(features: DataFrame, seed: int = SEED, train_percent: int = TRAIN_SHARE_PERCENT,
                           keys: Sequence[str] = ("StockCode", "Date")) -> DataFrame:
    """M1 with exact counts: of n rows ceil(n * test share) are 'test', as the original counts them."""
    ranked, numbers = _ranked(features, sample_key(features, seed, keys))
    n = numbers.count()
    n_train = n - -(-n * (100 - train_percent) // 100)
    train, test = F.lit("train"), F.lit("test")
    if n_train <= 0:
        return features.withColumn("split", test)
    first, tied, rest = _smallest(features, ranked, numbers, n_train)
    return first.unionByName(tied).withColumn("split", train).unionByName(rest.withColumn("split", test))
