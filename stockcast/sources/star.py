"""The ``sales`` table built from TPC-H style tables.

Mapping (one line item is one sales line):

* Invoice      'C' || order key when the line is cancelled (return flag R with
               status F, or flag A on line 7), else the order key
* StockCode    part key as text
* Description  part name
* Quantity     negative for returned lines (flag R)
* InvoiceDate  ship date
* Price        extended price / quantity
* Customer ID  customer key of the order, as text
* Country      nation of that customer

Only the joins that the requested columns need are planned: a restock run
reads line items alone, and descriptions come from ``part`` directly (every
line of a part carries the same name, so the first description of a code and
the distinct (code, description) pairs are the part's own name). At 100 TB
this keeps the line-item scan free of any join until it has been reduced to
one row per product and day.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockcast.config import EXPECTED_COLUMNS

_LINEITEM_COLS = (
    "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_returnflag", "l_linestatus", "l_shipdate",
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cancelled() -> Column:
    return ((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")) | (
        (F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 7)
    )


class StarSales:
    """Sales lines over star tables in ``sf_dir``; lazy, nothing is read here."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return _table(self.spark, self.sf_dir, name)

    def sales(self, columns: Iterable[str] | None = None) -> DataFrame:
        cols = list(EXPECTED_COLUMNS) if columns is None else list(columns)
        unknown = set(cols) - set(EXPECTED_COLUMNS)
        if unknown:
            raise ValueError(f"unknown sales columns: {sorted(unknown)}")
        li = self.table("lineitem").select(*_LINEITEM_COLS)
        exprs = {
            "Invoice": F.concat(F.when(_cancelled(), F.lit("C")).otherwise(F.lit("")),
                                F.col("l_orderkey").cast("string")),
            "StockCode": F.col("l_partkey").cast("string"),
            "Quantity": F.when(F.col("l_returnflag") == "R", -F.col("l_quantity"))
                         .otherwise(F.col("l_quantity")).cast("double"),
            "InvoiceDate": F.col("l_shipdate"),
            "Price": F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).cast("double"),
        }
        df = li
        if "Description" in cols:
            part = self.table("part").select("p_partkey", "p_name")
            df = df.join(part, df.l_partkey == part.p_partkey, "left")
            exprs["Description"] = F.col("p_name")
        if "Customer ID" in cols or "Country" in cols:
            orders = self.table("orders").select("o_orderkey", "o_custkey")
            df = df.join(orders, df.l_orderkey == orders.o_orderkey, "left")
            exprs["Customer ID"] = F.col("o_custkey").cast("string")
            if "Country" in cols:
                cust = self.table("customer").select("c_custkey", "c_nationkey")
                nation = self.table("nation").select("n_nationkey", "n_name")
                df = (df.join(cust, df.o_custkey == cust.c_custkey, "left")
                        .join(nation, F.col("c_nationkey") == nation.n_nationkey, "left"))
                exprs["Country"] = F.col("n_name")
        return df.select(*[exprs[c].alias(c) for c in cols])

    def descriptions(self) -> DataFrame:
        """(StockCode, Description, n_described): one row per code, its only description."""
        return self.table("part").select(
            F.col("p_partkey").cast("string").alias("StockCode"),
            F.col("p_name").alias("Description"),
            F.when(F.col("p_name").isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("long")
             .alias("n_described"),
        )

    # Every line of a part carries the part's name, so the first description of
    # a code and its distinct (code, description) pairs are both this table.
    def first_descriptions(self, clean: DataFrame | None = None) -> DataFrame:
        return self.descriptions()

    def description_pairs(self, clean: DataFrame | None = None) -> DataFrame:
        return self.descriptions().select("StockCode", "Description")


def sales_from_star(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    return StarSales(spark, sf_dir).sales(columns)


# DuckDB text of the same mapping, used by the SQL oracles.
SALES_SQL = """
sales AS (
  SELECT CASE WHEN (l.l_returnflag = 'R' AND l.l_linestatus = 'F')
                OR (l.l_returnflag = 'A' AND l.l_linenumber = 7) THEN 'C' ELSE '' END
         || CAST(l.l_orderkey AS VARCHAR)                                  AS "Invoice",
         CAST(l.l_partkey AS VARCHAR)                                      AS "StockCode",
         p.p_name                                                          AS "Description",
         CAST(CASE WHEN l.l_returnflag = 'R' THEN -l.l_quantity ELSE l.l_quantity END AS DOUBLE) AS "Quantity",
         l.l_shipdate                                                      AS "InvoiceDate",
         CAST(l.l_extendedprice / l.l_quantity AS DOUBLE)                  AS "Price",
         CAST(o.o_custkey AS VARCHAR)                                      AS "Customer ID",
         n.n_name                                                          AS "Country"
  FROM lineitem l
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""
